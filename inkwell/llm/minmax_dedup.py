"""Near-duplicate documents by min-max hashing.

Every permutation of the shingle hashes is evaluated once and gives two signature values,
its minimum and its maximum. Both are unbiased matches of the Jaccard similarity and are
nearly independent, so half the hash evaluations give the signature of a given variance.
Minima and maxima fill separate bands. Documents that share a band are candidates and are
confirmed on their whole shingle sets; documents with equal sets are one class and only
the class takes part in the search.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import fresh, keep_ids, keep_rows, row_key, stash, text_slices
from inkwell.llm.graph import connected_components
from inkwell.llm.text_hash import U64, distinct_sets, list_column, mix, stream

#: 2 x 126 / 6 = 42 bands of 6 rows: a pair of similarity 0.8 is missed with probability 3e-6.
PERMUTATIONS = 126
ROWS = 6
#: Members of a bucket that one task compares with as many others.
BLOCK = 1024
#: Shingles of a block when the whole sets are compared (8 bytes each).
BLOCK_SHINGLES = 1 << 20
#: Standard deviations below the threshold at which the signatures' estimate rules a pair out (3e-6 of the true links).
SIGMAS = 4.5


def minmax_signature(sets: list[np.ndarray], permutations: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(minima, maxima), each of shape (sets, permutations); the sets must not be empty."""
    a, b = stream(seed, permutations) | U64(1), stream(seed + 1, permutations)
    low = np.empty((len(sets), permutations), dtype=U64)
    high = np.empty_like(low)
    i = 0
    with np.errstate(over="ignore"):
        while i < len(sets):
            j, size = i, 0
            while j < len(sets) and (j == i or size + len(sets[j]) <= 1 << 16):
                size += len(sets[j])
                j += 1
            flat = np.concatenate(sets[i:j])
            starts = np.cumsum([0, *(len(x) for x in sets[i:j - 1])])
            buf = np.empty_like(flat)
            for k in range(permutations):
                np.multiply(flat, a[k], out=buf)
                buf += b[k]
                low[i:j, k] = np.minimum.reduceat(buf, starts)
                high[i:j, k] = np.maximum.reduceat(buf, starts)
            i = j
    return low, high


def band_keys(low: np.ndarray, high: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` values, the band's number included."""
    with np.errstate(over="ignore"):
        both = np.concatenate([low, high], axis=1)
        n, width = both.shape
        cut = both.reshape(n, width // rows, rows)
        keys = np.zeros(cut.shape[:2], dtype=U64)
        for r in range(rows):
            keys = mix(keys * U64(0x9E3779B97F4A7C55) + cut[:, :, r])
        return mix(keys + stream(3, width // rows)[None, :])


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4,
               permutations: int = PERMUTATIONS, rows: int = ROWS) -> DataFrame:
    """(id, n_shingles, d1, d2, bands, sketch) of every row.

    (d1, d2) is a 128-bit digest of the shingle set; ``sketch`` has a byte of each signature value.
    """
    if permutations % rows:
        raise ValueError("rows must divide permutations")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "t"):
            sets = distinct_sets(batch.column("t"), words)
            sizes = np.array([len(x) for x in sets], dtype=np.int64)
            full = np.flatnonzero(sizes)
            d1, d2 = np.zeros(len(sets), dtype=U64), np.zeros(len(sets), dtype=U64)
            n_bands = 2 * permutations // rows
            keys = np.zeros((0, n_bands), dtype=U64)
            sketch: list[bytes | None] = [None] * len(sets)
            if len(full):
                some = [sets[i] for i in full]
                with np.errstate(over="ignore"):
                    d1[full] = [mix(x ^ U64(0xA5A5A5A55A5A5A5A)).sum(dtype=U64) for x in some]
                    d2[full] = [mix(x + U64(0x0F1E2D3C4B5A6978)).sum(dtype=U64) for x in some]
                low, high = minmax_signature(some, permutations)
                keys = band_keys(low, high, rows)
                for i, x in zip(full, (np.concatenate([low, high], axis=1) >> U64(24)).astype(np.uint8)):
                    sketch[i] = x.tobytes()
            starts = np.zeros(len(sets) + 1, dtype=np.int64)
            np.cumsum(np.where(sizes > 0, n_bands, 0), out=starts[1:])
            yield pa.RecordBatch.from_arrays(
                [batch.column("i"), pa.array(sizes), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)),
                 list_column(keys.reshape(-1), starts), pa.array(sketch, pa.binary())],
                ["id", "n_shingles", "d1", "d2", "bands", "sketch"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).mapInArrow(
        run, f"id {kind}, n_shingles bigint, d1 bigint, d2 bigint, bands array<bigint>, sketch binary")


def shingle_sets(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(id, items): the whole shingle set of every row that has words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "t"):
            sets = distinct_sets(batch.column("t"), words)
            starts = np.cumsum([0, *(len(x) for x in sets)])
            flat = np.concatenate(sets) if sets else np.zeros(0, dtype=U64)
            yield pa.RecordBatch.from_arrays([batch.column("i"), list_column(flat, starts)], ["id", "items"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).mapInArrow(
        run, f"id {kind}, items array<bigint>")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have 100 * intersection >= percent * union."""
    left = sets.select(F.col("id").alias("a"), F.col("items").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("items").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    return (pairs.join(right, "b").join(left, "a")
            .where(F.lit(100) * both >= F.lit(percent) * (F.size("x") + F.size("y") - both)).select("a", "b"))


class _Joined:
    """Union-find of a few places; keeps the pairs that joined two groups."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))
        self.forest: list[tuple[int, int]] = []

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def add(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.up[b] = a
            self.forest.append((i, j))


def _compared(rows: DataFrame, percent: int, exact: bool) -> DataFrame:
    """(a, b): a forest over the members of every pair of blocks, whose trees are what its candidate pairs connect.

    ``rows``: (key, lo, hi, side, rep, n, comp, sketch, items). Candidates are pairs of different components whose sizes
    and sketches do not rule out a link; ``exact`` also confirms them on the whole sets. The comparison is numpy
    inside the task, which holds one pair of blocks; the forest has fewer rows than the members.
    """
    id_type = rows.schema["rep"].dataType.simpleString()

    def compare(t: pa.Table) -> Iterator[pa.RecordBatch]:
        rep, n, comp, side = (t.column(c).to_numpy() for c in ("rep", "n", "comp", "side"))
        sketch = np.frombuffer(b"".join(t.column("sketch").to_pylist()), dtype=np.uint8).reshape(len(rep), -1)
        items = [np.sort(x.values.to_numpy().view(U64)) for x in t.column("items")] if exact else []
        lo, hi = t.column("lo").to_numpy(), t.column("hi").to_numpy()
        group = np.stack([t.column("key").to_numpy(), lo, hi], axis=1)
        cut = np.flatnonzero((group[1:] != group[:-1]).any(axis=1)) + 1
        width = sketch.shape[1]
        least = width * (percent / 100 - SIGMAS * np.sqrt(percent / 100 * (1 - percent / 100) / width))
        for i, j in zip([0, *cut], [*cut, len(rep)]):
            joined = _Joined(j - i)
            across = i + np.flatnonzero(side[i:j] == 1)
            for x in range(i, j if lo[i] == hi[i] else i + int((side[i:j] == 0).sum())):
                others = np.arange(x + 1, j) if lo[i] == hi[i] else across
                others = others[comp[others] != comp[x]]
                others = others[100 * np.minimum(n[others], n[x]) >= percent * np.maximum(n[others], n[x])]
                others = others[(sketch[others] == sketch[x]).sum(axis=1) >= least]
                if exact and len(others):
                    flat = np.concatenate([items[y] for y in others])
                    at = np.minimum(np.searchsorted(items[x], flat), len(items[x]) - 1)
                    starts = np.cumsum([0, *(len(items[y]) for y in others[:-1])])
                    both = np.add.reduceat((items[x][at] == flat).astype(np.int64), starts)
                    others = others[100 * both >= percent * (n[others] + n[x] - both)]
                for y in others:
                    joined.add(x - i, int(y) - i)
            if joined.forest:
                ends = rep[i + np.array(joined.forest)]
                yield pa.RecordBatch.from_arrays([pa.array(ends.min(axis=1)), pa.array(ends.max(axis=1))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                t = pa.Table.from_batches([batch.slice(at, BLOCK)])
                held = t if held is None else pa.concat_tables([held, t])
                group = np.stack([held.column(c).to_numpy() for c in ("key", "lo", "hi")], axis=1)
                last = int(np.flatnonzero((group != group[-1]).any(axis=1)).max(initial=-1)) + 1  # the last group may go on
                if last:
                    yield from compare(held.slice(0, last))
                    held = held.slice(last)
        if held is not None and held.num_rows:
            yield from compare(held)

    dealt = rows.repartition("key", "lo", "hi").sortWithinPartitions("key", "lo", "hi", "side", "rep")
    return dealt.mapInArrow(run, f"a {id_type}, b {id_type}").distinct()


def _blocks(rows: DataFrame, size) -> DataFrame:
    """Deals the members of every key with several components to blocks of bounded ``size`` and pairs the blocks."""
    mixed = (rows.groupBy("key").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), size.alias("blocks"))
             .where("c0 < c1").select("key", F.col("blocks").cast("int").alias("blocks")))
    own = F.pmod(F.xxhash64("rep", F.lit(11)), F.col("blocks")).cast("int")
    return (rows.join(mixed, "key").withColumn("own", own)
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
                "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"),
                (F.col("own") > F.col("other")).cast("int").alias("side"), "rep", "n", "comp"))


def links(members: DataFrame, sets: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """(node, root): components of the confirmed links among the members (key, rep, n) of shared buckets.

    First each bucket's smallest member is confirmed with all others, which connects a group of near copies at a cost
    linear in its size. Buckets that still hold several components are then compared by sketches; what those
    connect are families. Last, each family's members, now once each and with their whole sets, are compared
    and confirmed. Buckets and families of any size are dealt to pairs of blocks of bounded size; tasks emit
    forests, never pairs, so no step has more rows than members (times the blocks).
    """
    hubs = members.groupBy("key").agg(F.min(F.struct("rep", "n")).alias("h")).select(
        "key", F.col("h.rep").alias("hub"), F.col("h.n").alias("hub_n"))
    rest = members.join(hubs, "key").where("rep != hub")
    tested = stash(rest.where(F.lit(100) * F.least("n", "hub_n") >= F.lit(percent) * F.greatest("n", "hub_n"))
                   .select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct(), "pairs")
    roots = stash(connected_components(stash(confirm(tested, sets, percent), "links")), "roots")
    named = roots.withColumnRenamed("node", "rep")
    now = stash(rest.select("key", "rep", "n").join(named, "rep", "left")
                .select("key", "rep", "n", F.coalesce("root", "rep").alias("comp")), "members")
    rows = _blocks(now, F.ceil(F.count(F.lit(1)) / BLOCK)).join(sketches, "rep")
    families = connected_components(stash(_compared(rows, percent, False), "alike"))
    family = (families.select(F.col("root").alias("key"), F.col("node").alias("rep"))
              .join(members.select("rep", "n").distinct(), "rep").join(named, "rep", "left")
              .select("key", "rep", "n", F.coalesce("root", "rep").alias("comp")))
    family = stash(family, "families")
    size = F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK), F.ceil(F.sum("n") / BLOCK_SHINGLES))
    rows = _blocks(family, size).join(sketches, "rep").join(sets.withColumnRenamed("id", "rep"), "rep")
    more = stash(_compared(rows, percent, True), "links")
    if more.isEmpty():
        return roots
    return stash(connected_components(more.unionByName(roots.select(F.col("root").alias("a"), F.col("node").alias("b")))), "roots")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                    percent: int = 80, permutations: int = PERMUTATIONS, rows: int = ROWS) -> DataFrame:
    """(id, n_shingles, component, kept): one row for each row of ``docs``.

    Links documents whose sets of distinct ``words``-word shingles have
    100 * intersection >= percent * union; ``component`` is the smallest id reachable.

    Null or empty texts have no shingles and link with nothing. Rows that repeat an id
    are one document: their texts are linked. A row with a null id joins the component
    of equal texts that have an id (null if there are none) and adds no links. Ties do not arise:
    the smallest id is kept. No rows give no rows; other columns are ignored.
    """
    sig = stash(signatures(docs, id_col, text_col, words, permutations, rows), "signatures")
    classes = stash(sig.where("n_shingles > 0").groupBy("d1", "d2", "n_shingles")
                    .agg(F.min("id").alias("rep"), F.first("bands").alias("bands"),
                         F.first("sketch").alias("sketch")), "classes")
    keys = classes.where("rep IS NOT NULL").select("rep", F.col("n_shingles").alias("n"), F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.min("rep").alias("r0"), F.max("rep").alias("r1")).where("r0 < r1").select("key")
    members = stash(keys.join(shared, "key").distinct(), "members")
    needed = stash(members.select("rep").distinct(), "needed")
    sets = stash(shingle_sets(keep_ids(docs, id_col, needed), id_col, text_col, words), "sets")
    roots = links(members, sets, classes.select("rep", "sketch"), percent)
    named = classes.select("d1", "d2", "n_shingles", "rep").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("d1", "d2", "n_shingles", F.coalesce("root", "rep").alias("component"))
    out = sig.select("id", "n_shingles", "d1", "d2").join(named, ["d1", "d2", "n_shingles"], "left")
    same = sig.where("n_shingles > 0 AND id IS NOT NULL")  # an id that has several texts
    several = same.groupBy("id").agg(F.min("d1").alias("x"), F.max("d1").alias("y")).where("x != y")
    if not several.isEmpty():
        ends = out.where("id IS NOT NULL AND component IS NOT NULL").select(F.col("component").alias("a"), F.col("id").alias("b"))
        again = connected_components(ends).select(F.col("node").alias("component"), F.col("root").alias("least"))
        out = out.join(again, "component", "left").withColumn("component", F.coalesce("least", "component")).drop("least")
    component = F.coalesce("component", "id")
    return out.select("id", "n_shingles", component.alias("component"), component.eqNullSafe(F.col("id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                         percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, without near-duplicates: one row of each group of linked texts.

    Rows are judged one by one and linked as in ``near_duplicates``, but by their texts only: null and repeated ids link
    nothing and cost no other row. Of a group the smallest id stays (null ids last; of several texts of that id the one of
    the smallest md5). Rows that repeat an id and its text are reduced to one. Empty texts are all kept.
    """
    keyed = docs.select(row_key(id_col, text_col).alias("row"), F.col(text_col).alias("t"))
    sig = stash(signatures(keyed, "row", "t", words), "signatures")
    full = sig.where("n_shingles > 0")
    same = ["d1", "d2", "n_shingles"]
    # classes are numbered in the order of their first rows, so the root of a group is the class that stays
    heads = stash(full.groupBy(same).agg(F.min("id").alias("first")), "heads")
    numbers = stash(heads.orderBy("first").withColumn("rep", F.monotonically_increasing_id()), "numbers")
    classes = stash(full.groupBy(same).agg(F.first("bands").alias("bands"), F.first("sketch").alias("sketch")).join(numbers, same)
                    .select("rep", F.col("n_shingles").alias("n"), "bands", "sketch"), "classes")
    bands = classes.select("rep", "n", F.explode("bands").alias("key"))
    shared = bands.groupBy("key").agg(F.min("rep").alias("r0"), F.max("rep").alias("r1")).where("r0 < r1").select("key")
    members = stash(bands.join(shared, "key").distinct(), "members")
    needed = stash(members.select("rep").distinct().join(numbers.select("rep", "first"), "rep"), "needed")
    texts = keep_rows(docs, id_col, text_col, needed.select("first")).select(
        row_key(id_col, text_col).alias("row"), F.col(text_col).alias("t"))
    again = stash(full.groupBy("id").count().where("count > 1").select("id"), "repeated")
    repeated = not again.isEmpty()
    found = shingle_sets(texts, "row", "t", words)
    if repeated:
        found = found.groupBy("id").agg(F.first("items").alias("items"))
    sets = stash(found.join(needed, F.col("id") == F.col("first")).select(F.col("rep").alias("id"), "items"), "sets")
    roots = links(members, sets, classes.select("rep", "sketch"), percent)
    stays = (numbers.join(roots.withColumnRenamed("node", "rep"), "rep", "left")
             .select(*same, F.when(F.coalesce("root", "rep") == F.col("rep"), F.col("first")).alias("stays")))
    marks = full.select("id", *same).join(stays, same)
    lost = stash(marks.where("NOT (id <=> stays)").select("id").distinct(), "lost")
    kept = keep_rows(docs, id_col, text_col, lost, anti=True)
    if repeated:
        mark = fresh(docs, "__text")
        once = keep_rows(kept, id_col, text_col, again).withColumn(mark, F.md5(text_col)).dropDuplicates([id_col, mark]).drop(mark)
        kept = keep_rows(kept, id_col, text_col, again, anti=True).unionByName(once)
    return kept
