"""Near-duplicate embeddings by lattice hashing.

Unit vectors are projected to eight dimensions by several random matrices and decoded to
the nearest point of the E8 lattice. A vector is stored in the cell of its point and looks up that cell
and the neighbouring cells that its residual leans to most; what it meets is verified by the cosine
in double precision. Equal vectors of a label are one class and searched once. Pairs that meet in a cell of many vectors
never become rows: blocks of the cell are compared inside tasks, which emit sums of links and a spanning forest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import stash
from inkwell.llm.graph import connected_components
from inkwell.llm.text_hash import U64, mix

#: A pair at the threshold meets in a table with probability 0.96, in one of five but for 1e-7.
TABLES, PROBES = 5, 8
#: Distance, in units of the lattice, of the projections of a pair at the threshold (per coordinate).
SPREAD = 0.2
#: Cells with more vectors than HEAVY are compared in blocks of about BLOCK vectors; the result is the same for any values.
HEAVY, BLOCK = 64, 512
#: Pairs whose meeting cells are looked up together.
CHUNK = 4096


@lru_cache(maxsize=1)
def minimal_vectors() -> np.ndarray:
    """The 240 shortest vectors of E8: two coordinates of size 1, or eight of size 1/2 with an even number of minus signs."""
    out = []
    for i in range(8):
        for j in range(i):
            for signs in range(4):
                v = np.zeros(8)
                v[i], v[j] = 1 - 2 * (signs & 1), 1 - (signs & 2)
                out.append(v)
    for signs in range(256):
        if signs.bit_count() % 2 == 0:
            out.append(np.array([-0.5 if signs >> k & 1 else 0.5 for k in range(8)]))
    return np.array(out)


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum: round, and where the sum is odd round the worst coordinate the other way."""
    r = np.rint(x)
    odd = np.flatnonzero(r.sum(axis=1) % 2)
    worst = np.abs(x - r)[odd].argmax(axis=1)
    r[odd, worst] += np.where(x[odd, worst] >= r[odd, worst], 1.0, -1.0)
    return r


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """Nearest point of E8, the union of D8 and D8 + 1/2, for every row."""
    a, b = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    closer = ((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1)
    return np.where(closer[:, None], a, b)


def _keys(points: np.ndarray, salt: int) -> np.ndarray:
    """64-bit keys of lattice points (last axis), the table's number included."""
    with np.errstate(over="ignore"):
        twice = np.rint(points * 2).astype(np.int64).view(U64)
        out = np.full(points.shape[:-1], salt + 1, dtype=U64)
        for j in range(8):
            out = mix(out * U64(0x9E3779B97F4A7C15) + twice[..., j])
        return out


def cells(unit: np.ndarray, threshold: float, tables: int = TABLES, probes: int = PROBES, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(own cells, looked-up cells) of unit vectors: shapes (n, tables) and (n, tables * (1 + probes))."""
    d = unit.shape[1]
    scale = SPREAD / math.sqrt(2 - 2 * threshold)
    near = minimal_vectors()
    own, look = [], []
    for t in range(tables):
        x = unit @ (np.random.default_rng([seed, t, d]).standard_normal((d, 8)) * scale)
        c = nearest_e8(x)
        lean = np.argpartition(-((x - c) @ near.T), probes, axis=1)[:, :probes]
        around = np.concatenate([c[:, None, :], c[:, None, :] + near[lean]], axis=1)
        own.append(_keys(c, t))
        look.append(_keys(around, t))
    return np.stack(own, axis=1), np.concatenate(look, axis=1)


def place(vectors: DataFrame, threshold: float, tables: int, probes: int) -> DataFrame:
    """(id, label, copies, own, look, unit): unit vectors of the classes (id, label, copies, embedding) and their cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            at, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
            size = np.diff(at)
            for d in np.unique(size):
                rows = np.flatnonzero(size == d)
                v = flat[at[rows][:, None] + np.arange(d)]
                v = v / np.abs(v).max(axis=1, keepdims=True)
                v /= np.sqrt((v * v).sum(axis=1, keepdims=True))
                own, look = cells(v, threshold, tables, probes)
                pick = pa.array(rows)
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).take(pick) for c in ("id", "label", "copies")],
                     *[pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * x.shape[1]),
                                                pa.array(x.reshape(-1).view(np.int64) if x.dtype == U64 else x.reshape(-1)))
                       for x in (own, look, v)]], ["id", "label", "copies", "own", "look", "unit"])

    label_type = vectors.schema["label"].dataType.simpleString()
    return stash(vectors.mapInArrow(run, f"id bigint, label {label_type}, copies bigint, own array<bigint>, look array<bigint>, "
                                         "unit array<double>"), "cells")


def _padded(lists: pd.Series, fill: int) -> np.ndarray:
    """Lists of numbers as rows of one array, short ones filled up."""
    out = np.full((len(lists), max(1, max(map(len, lists)))), fill, dtype=np.int64)
    for row, x in zip(out, lists):
        row[:len(x)] = x
    return out


def _first_meeting(own: np.ndarray, look: np.ndarray) -> np.ndarray:
    """The smallest of a row's ``own`` cells that is among the row's ``look`` cells."""
    met = (own[:, :, None] == look[:, None, :]).any(axis=2)
    return np.where(met, own, np.iinfo(np.int64).max).min(axis=1)


def compare_blocks(rows: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """(id, others, root) from one block of stored and one of asking vectors of a heavy cell: copies of the vectors
    linked with ``id`` here, and the root of a forest that spans these links.

    A pair is counted in the smallest heavy cell where it meets, there only with the smaller id as the stored one if both are.
    """
    s, a = rows[rows["stored"]], rows[~rows["stored"]]
    empty = pd.DataFrame({c: np.empty(0, dtype=np.int64) for c in ("id", "others", "root")})
    if s.empty or a.empty:
        return empty
    cell = rows["h"].iloc[0]
    p, q = np.nonzero(np.stack(s["unit"].to_list()) @ np.stack(a["unit"].to_list()).T >= threshold)
    sid, aid = s["id"].to_numpy(), a["id"].to_numpy()
    p, q = p[sid[p] != aid[q]], q[sid[p] != aid[q]]
    so, sl, ao, al = _padded(s["own"], -1), _padded(s["look"], -2), _padded(a["own"], -1), _padded(a["look"], -2)
    good = np.zeros(len(p), dtype=bool)
    for at in range(0, len(p), CHUNK):
        i, j = p[at:at + CHUNK], q[at:at + CHUNK]
        first = np.minimum(_first_meeting(so[i], al[j]), _first_meeting(ao[j], sl[i]))
        good[at:at + CHUNK] = (first == cell) & ((sid[i] < aid[j]) | ~(ao[j] == cell).any(axis=1))
    p, q = p[good], q[good]
    if not len(p):
        return empty
    ids, at = np.unique(np.concatenate([sid[p], aid[q]]), return_inverse=True)
    x, y = at[:len(p)], at[len(p):]
    others = np.zeros(len(ids), dtype=np.int64)
    np.add.at(others, x, a["copies"].to_numpy()[q])
    np.add.at(others, y, s["copies"].to_numpy()[p])
    root, last = np.arange(len(ids)), None
    while last is None or (root != last).any():
        last, low = root, np.minimum(root[x], root[y])
        root = root.copy()
        np.minimum.at(root, x, low)
        np.minimum.at(root, y, low)
        root = root[root]
    return pd.DataFrame({"id": ids, "others": others, "root": ids[root]})


def lattice_links(vectors: DataFrame, threshold: float = 0.98, tables: int = TABLES,
                  probes: int = PROBES) -> tuple[DataFrame, DataFrame]:
    """Links of the classes (id, label, copies, embedding; id is a bigint) of one label with cosine >= threshold that share a cell.

    Two tables: (a, b), a < b, the links of pairs that meet in no heavy cell, and (id, others, root) of ``compare_blocks`` for
    all others. Every link is in one of them, once.
    """
    placed = place(vectors, threshold, tables, probes)
    key = ["label", "d", "cell"]
    stored = placed.select("label", F.size("unit").alias("d"), F.explode("own").alias("cell"), F.col("id").alias("x"))
    asked = placed.select("label", F.size("unit").alias("d"), F.explode("look").alias("cell"), F.col("id").alias("y"))
    many = stash(stored.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HEAVY), "heavy-sizes")
    hits = stash(asked.join(many, key), "heavy-asked")
    heavy = stash(hits.groupBy(*key, "n").agg(F.count(F.lit(1)).alias("m")).select(*key, F.struct(
        F.monotonically_increasing_id().alias("h"), F.ceil(F.col("n") / BLOCK).alias("bs"), F.ceil(F.col("m") / BLOCK).alias("ba")).alias("cut")), "heavy")
    sides = (stored.join(heavy, key).select(F.col("x").alias("id"), "cut", F.lit(True).alias("stored"))
             .unionByName(hits.join(heavy, key).select(F.col("y").alias("id"), "cut", F.lit(False).alias("stored"))))
    cuts = sides.groupBy("id").agg(F.collect_list(F.when(F.col("stored"), F.col("cut"))).alias("own"),
                                   F.collect_list(F.when(~F.col("stored"), F.col("cut"))).alias("look"))
    marked = stash(placed.select("id", "copies", "unit").join(cuts, "id", "left"), "marked")

    def numbers(c: str) -> Column:
        return F.coalesce(F.transform(c, lambda x: x["h"]), F.array().cast("array<bigint>"))

    # light cells: at most HEAVY pairs for each lookup
    light = stored.join(heavy, key, "left_anti")
    pairs = (asked.join(light, key).where("x != y")
             .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    left = marked.select(F.col("id").alias("a"), F.col("unit").alias("u"), numbers("own").alias("ao"), numbers("look").alias("al"))
    right = marked.select(F.col("id").alias("b"), F.col("unit").alias("v"), numbers("own").alias("bo"), numbers("look").alias("bl"))
    dot = F.aggregate(F.zip_with("u", "v", lambda p, q: p * q), F.lit(0.0), lambda s, x: s + x)
    apart = ~F.arrays_overlap("ao", "bl") & ~F.arrays_overlap("bo", "al")
    links = pairs.join(left, "a").join(right, "b").where(apart & (dot >= threshold)).select("a", "b")

    # heavy cells: every block of stored vectors meets every block of asking ones in a task of its own
    payload = ["id", "copies", "unit", numbers("own").alias("own"), numbers("look").alias("look")]
    cut = lambda c: marked.select(*payload, F.explode(c).alias("cut"))
    place_of = lambda n: F.pmod(F.xxhash64("id"), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    s = cut("own").select("*", "cut.*").withColumn("i", place_of("bs")).withColumn("j", every("ba")).withColumn("stored", F.lit(True))
    a = cut("look").select("*", "cut.*").withColumn("j", place_of("ba")).withColumn("i", every("bs")).withColumn("stored", F.lit(False))
    blocks = (s.unionByName(a).select("h", "i", "j", "stored", "id", "copies", "unit", "own", "look").groupBy("h", "i", "j")
              .applyInPandas(lambda rows: compare_blocks(rows, threshold), "id bigint, others bigint, root bigint"))
    return links, blocks


def near_duplicate_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                           threshold: float = 0.98, tables: int = TABLES, probes: int = PROBES) -> DataFrame:
    """(id, n_links, component, kept): one row for each row of ``vectors``.

    Vectors link when their labels are equal and not null and their cosine is ``threshold`` or more.
    ``n_links`` counts the other vectors linked directly, copies included; ``component`` is the smallest id reachable.
    Null, empty or zero vectors, vectors with null or non-finite components, of different lengths
    or without an id link with nothing. Rows that repeat an id and vector are further copies; rows that repeat
    an id with another vector or label keep links of their own, but all rows of an id are in one component. No rows
    give no rows.
    """
    v, kind = F.col("e"), vectors.schema[vector_col].dataType.elementType.simpleString()
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("e"))
    sound = (F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size(v) > 0)
             & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")).cast(kind)))
             & F.exists(v, lambda x: x != 0))
    rows = rows.withColumn("ok", F.coalesce(sound, F.lit(False)))
    # equal vectors of a label are a class with a number of its own; the stored table fixes the numbers
    classes = stash(rows.where("ok").groupBy("label", "e").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"))
                    .withColumn("c", F.monotonically_increasing_id()), "classes")
    links, blocks = lattice_links(classes.select(F.col("c").alias("id"), "label", "copies", F.col("e").alias("embedding")),
                                  threshold, tables, probes)
    links, blocks = stash(links, "links"), stash(blocks, "blocks")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = (both.join(classes.select(F.col("c").alias("b"), "copies"), "b").select(F.col("a").alias("c"), F.col("copies").alias("others"))
              .unionByName(blocks.select(F.col("id").alias("c"), "others")).groupBy("c").agg(F.sum("others").alias("others")))
    forest = blocks.where("id != root").select(F.col("root").alias("a"), F.col("id").alias("b"))
    members = stash(rows.where("ok").join(classes.select("label", "e", "c"), ["label", "e"]).select("id", "c"), "members")
    spread = members.groupBy("id").agg(F.min("c").alias("a"), F.max("c").alias("z")).where("a != z").select("id", "a")
    same = members.join(spread, "id").where("c != a").select("a", F.col("c").alias("b")).distinct()
    roots = connected_components(links.unionByName(forest).unionByName(same)).select(F.col("node").alias("c"), "root")
    known = classes.select("c", "least", "copies").join(roots, "c", "left").withColumn("root", F.coalesce("root", "c"))
    smallest = known.groupBy("root").agg(F.min("least").alias("component"))
    known = (known.join(smallest, "root").join(degree, "c", "left")
             .select("c", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component"))
    good = members.join(known, "c").select("id", "n_links", "component")
    # rows that link with nothing still belong to the component of their id's other rows
    other = good.groupBy("id").agg(F.min("component").alias("component"))
    alone = (rows.where("NOT ok").select("id").join(other, "id", "left")
             .select("id", F.lit(0).cast("bigint").alias("n_links"), F.coalesce("component", "id").alias("component")))
    out = good.unionByName(alone)
    return out.select("id", "n_links", "component", F.col("component").eqNullSafe(F.col("id")).alias("kept"))
