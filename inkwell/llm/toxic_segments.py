"""Toxicity by maximum-scoring segments.

Every word is scored by the log-odds of its most telling unit (the word itself or one of
its prefixes) in toxic against clean training texts, under an informative Dirichlet prior
from both; words without a significant unit cost a small drift. All maximal scoring
segments of a text are found in one linear scan, each is given the chance of such a score in
clean text of that length (Karlin-Altschul extreme-value statistics), and a logistic
curve fitted on the training rows turns the sum over the significant ones into a score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type
from pyspark.sql.types import ArrayType, DoubleType, StructType

from inkwell.llm.common import BROADCAST_IDS, fresh, map_rows, stash, text_slices
from inkwell.llm.text_hash import U64, mix, prefixes, words

#: Byte lengths of the prefixes that count as units beside the whole word.
PREFIXES = (3, 4, 5, 6, 7, 8)
#: Share of the corpus that the prior weighs; least z and log-odds of a unit; cost of a word without one.
PRIOR, LEAST_Z, LEAST_SCORE, DRIFT = 0.05, 3.0, 1.5, 0.25
#: Largest chance, in clean text of the same length, of a segment that counts as significant.
CHANCE = 1e-3
#: What stands for the word before the first and after the last word of a text.
EDGE = U64(0x9D39247E33776D41)
#: Most units that a worker looks up in one pass (16 bytes each); a larger model has more shards, one pass each.
SHARD_UNITS = 1 << 20
#: Bits of a unit's sketch of 64 up to which its contexts count, and from which its occurrences do; between, a mean of both.
FEW_BITS, MANY_BITS = 32, 60


@dataclass(frozen=True)
class ToxicModel:
    """A stored table (unit, score), read in ``shards`` parts, the extreme-value constants and the logistic curve."""

    units: DataFrame | None = None
    shards: int = 1
    lam: float = 1.0
    k: float = 1.0
    offset: float = -20.0
    slope: float = 0.0

    def shard(self, number: int) -> tuple[np.ndarray, np.ndarray]:
        """Sorted unit hashes of one shard and their scores."""
        if self.units is None:
            return np.zeros(0, dtype=U64), np.zeros(0)
        rows = self.units.where(F.pmod("unit", F.lit(self.shards)) == number).toPandas()
        units, scores = rows["unit"].to_numpy(dtype=np.int64).view(U64), rows["score"].to_numpy(float)
        order = np.argsort(units)
        return units[order], scores[order]

    def probability(self, statistic: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.offset + self.slope * statistic, -40, 40)))


def _units(column: pa.Array) -> tuple[list[tuple[np.ndarray | slice, np.ndarray]], np.ndarray, tuple]:
    """The units of every word as (which words, hashes), the word hashes, and the layout of ``words``."""
    w, s, e, first, data = words(column, punctuation=True)
    with np.errstate(over="ignore"):
        out = [(slice(None), mix(w ^ U64(0x3C3C3C3CC3C3C3C3)))]
    out += [prefixes(data, s, e, length) for length in PREFIXES]
    return out, w, (s, e, first, data)


def _counts(rows: DataFrame) -> DataFrame:
    """(unit, toxic, clean, seen) of (t, y) rows; ``seen``: a 64-bit sketch of the distinct contexts in toxic texts.

    The context of a word is its two neighbours, the ends of the text included, so that the words of a text that
    is copied a thousand times still have one context each, whatever rows stand beside it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "t"):
            units, w, (_, _, first, _) = _units(batch.column("t"))
            if not len(w):
                continue
            y = np.repeat(batch.column("y").to_numpy(zero_copy_only=False).astype(bool), np.diff(first))
            with np.errstate(over="ignore"):
                left, right = np.concatenate([[EDGE], w[:-1]]), np.concatenate([w[1:], [EDGE]])
                full = np.diff(first) > 0
                left[first[:-1][full]] = right[first[1:][full] - 1] = EDGE
                context = mix(left * U64(3) + right) & U64(63)
            bit = np.where(y, U64(1) << context, U64(0))
            for which, h in units:
                if not len(h):
                    continue
                order = np.argsort(h, kind="stable")
                sorted_h = h[order]
                at = np.flatnonzero(np.concatenate([[True], sorted_h[1:] != sorted_h[:-1]]))
                toxic = np.add.reduceat(y[which][order].astype(np.int64), at)
                total = np.diff(np.append(at, len(h)))
                seen = np.bitwise_or.reduceat(bit[which][order], at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sorted_h[at].view(np.int64)), pa.array(toxic), pa.array(total - toxic),
                     pa.array(seen.view(np.int64))], ["unit", "toxic", "clean", "seen"])

    return (rows.mapInArrow(run, "unit bigint, toxic bigint, clean bigint, seen bigint")
            .groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"),
                                 F.expr("bit_or(seen)").alias("seen")))


def _log_odds(counts: DataFrame, toxic: float, clean: float) -> DataFrame:
    """(unit, score, z, share) of the units that are significantly more frequent in toxic texts."""
    bits = F.expr("bit_count(seen)").cast("double")
    contexts = F.least(F.col("toxic"), F.round(-64.0 * F.log(1.0 - F.least(bits, F.lit(MANY_BITS)) / 64.0)))
    # a sketch that fills up says less and less: its count passes into that of the occurrences without a step
    full = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (bits - FEW_BITS) / (MANY_BITS - FEW_BITS)))
    y1, y0 = F.pow(contexts, 1.0 - full) * F.pow(F.col("toxic").cast("double"), full), F.col("clean").cast("double")
    prior, mass = F.lit(PRIOR) * (y1 + y0), PRIOR * (toxic + clean)
    score = (F.log((y1 + prior) / (F.lit(toxic + mass) - y1 - prior))
             - F.log((y0 + prior) / (F.lit(clean + mass) - y0 - prior)))
    spread = F.sqrt(1.0 / (y1 + prior) + 1.0 / (y0 + prior))
    return (counts.where("toxic > 2 AND toxic * 8 > clean").withColumn("score", score).withColumn("z", F.col("score") / spread)
            .withColumn("share", (y0 + prior) / F.lit(clean + mass))
            .where((F.col("z") >= LEAST_Z) & (F.col("score") >= LEAST_SCORE))
            .select("unit", "score", "z", "share"))


def maximal_segments(at: np.ndarray, score: np.ndarray, drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments [first, last] with their scores, in order of place.

    ``at``: places of the positive words in a text whose other words cost ``drift`` each.
    Linear: each open segment remembers the one to its left with a lower cumulative score,
    and a merge removes what it covers.
    """
    done: list[list] = []  # first, last, sum before, sum after, link to the left
    total, last = 0.0, -1
    for p, x in zip(at.tolist(), score.tolist()):
        before = total - drift * (p - last - 1)
        total, last = before + x, p
        first, link = p, len(done) - 1
        while True:
            while link >= 0 and done[link][2] >= before:
                link = done[link][4]
            if link < 0 or done[link][3] >= total:
                break
            first, before = done[link][0], done[link][2]
            link, keep = done[link][4], link
            del done[keep:]
        done.append([first, p, before, total, link])
    return [(a, b, r - l) for a, b, l, r, _ in done]


class _Scorer:
    """Finds the segments of record batches under one model."""

    def __init__(self, units: np.ndarray, scores: np.ndarray) -> None:  # of one shard
        self.units, self.scores = units, scores
        self.bits = np.zeros(1 << 20, dtype=bool)
        self.bits[(units & U64((1 << 20) - 1)).astype(np.int64)] = True

    def best(self, column: pa.Array, before: pa.Array | None):
        """The best score of every word, here or in the shards ``before``, and the layout of ``words``."""
        units, w, layout = _units(column)
        best = np.zeros(len(w))
        if before is not None:
            best[:] = np.concatenate([np.frombuffer(x.as_py(), dtype=np.float64) for x in before])
        if len(self.units):
            for which, h in units:
                hit = np.flatnonzero(self.bits[(h & U64((1 << 20) - 1)).astype(np.int64)])
                if len(hit):
                    place = np.minimum(np.searchsorted(self.units, h[hit]), len(self.units) - 1)
                    ok = self.units[place] == h[hit]
                    word = hit[ok] if isinstance(which, slice) else which[hit[ok]]
                    np.maximum.at(best, word, self.scores[place[ok]])
        return best, layout

    def rows(self, column: pa.Array, before: pa.Array | None):
        """(words in the row, segments, start and end bytes of the words, bytes) of every row."""
        best, (s, e, first, data) = self.best(column, before)
        hot = np.flatnonzero(best)
        cuts = np.searchsorted(hot, first)
        for i in range(len(first) - 1):
            mine = hot[cuts[i]:cuts[i + 1]]
            found = maximal_segments(mine - first[i], best[mine]) if len(mine) else []
            yield int(first[i + 1] - first[i]), found, s[first[i]:first[i + 1]], e[first[i]:first[i + 1]], data


def _map_segments(df: DataFrame, text_col: str, model: ToxicModel, finish, added: StructType) -> DataFrame:
    """``df`` with the columns ``added`` that ``finish`` makes of each batch's segments.

    Models of several shards take one pass for each; the words' best scores go from pass to pass in a stored column.
    """

    def pass_over(df: DataFrame, number: int, carry: str | None, last: bool, added: StructType) -> DataFrame:
        shared = df.sparkSession.sparkContext.broadcast(model.shard(number))

        def run(batches: Iterator[pa.RecordBatch], at: dict[str, str]) -> Iterator[pa.RecordBatch]:
            scorer, text = _Scorer(*shared.value), at[text_col]
            for batch in text_slices(batches, text):
                column, before = batch.column(text), batch.column(at[carry]) if carry else None
                if last:
                    new = finish(scorer.rows(column, before))
                else:
                    best, (_, _, first, _) = scorer.best(column, before)
                    new = [pa.array([best[a:b].tobytes() for a, b in zip(first[:-1], first[1:])], pa.binary())]
                yield pa.RecordBatch.from_arrays([*batch.columns, *new], [f"c{i}" for i in range(len(batch.columns) + len(new))])

        out = map_rows(df, run, added)
        return out.drop(carry) if carry else out

    carry = None
    for number in range(model.shards - 1):
        name = fresh(df, "__best")
        df = stash(pass_over(df, number, carry, False, StructType().add(name, "binary")), "best-scores")
        carry = name
    return pass_over(df, model.shards - 1, carry, True, added)


def _statistic(lam: float, k: float, n: int, found: list) -> float:
    """Sum of the significant segments' log-chances below CHANCE in clean text of ``n`` words, on a log scale."""
    base = math.log(max(k * n, 1e-300) / CHANCE) if n else 0.0
    return math.log1p(sum(max(0.0, min(lam * x - base, 50.0)) for _, _, x in found))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "toxic", fold: int | None = None) -> DataFrame:
    """(t, y) of labelled rows; ``fold``: only ids whose crc32, as text, is not 0 modulo it.

    Rows without an id, a text or a label are no examples; of several labels the largest counts.
    """
    known = (labels.select(F.col(id_col).alias("i"), F.col(label_col).cast("int").alias("y"))
             .where("i IS NOT NULL AND y IS NOT NULL").groupBy("i").agg((F.max("y") > 0).alias("y")))
    if fold:
        known = known.where(F.crc32(F.col("i").cast("string")) % fold != 0)
    if labels.count() <= BROADCAST_IDS:
        known = F.broadcast(known)
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).where("t IS NOT NULL")
    return rows.join(known, "i").select("t", "y")


def fit(rows: DataFrame) -> ToxicModel:
    """Model of (t, y) rows, the same for every order of them. Without toxic or without clean rows it scores
    every text 0 (below 0.5)."""
    spark = rows.sparkSession
    counts = stash(_counts(rows), "units")
    # every word has one whole-word unit and one unit for each prefix that it is long enough for
    sums = counts.agg(F.sum("toxic"), F.sum("clean")).first()
    if not sums[0] or not sums[1]:
        return ToxicModel()
    kept = stash(_log_odds(counts, float(sums[0]), float(sums[1])), "kept-units")
    size, total = kept.agg(F.count(F.lit(1)), F.sum("share")).first()
    if not size:
        return ToxicModel()
    bins = (kept.groupBy(F.round(F.col("score") * 1000).alias("x")).agg(F.sum(F.least("share", F.lit(1e-3))).alias("share"))
            .orderBy("x").toPandas())
    lam = _lambda(bins["x"].to_numpy(float) / 1000, bins["share"].to_numpy(float) * min(1.0, 0.05 / max(total, 1e-12)))
    model = ToxicModel(kept.select("unit", "score"), -(-size // SHARD_UNITS), lam)

    def finish(rows) -> list[pa.Array]:
        found = [(n, [x for _, _, x in f]) for n, f, _, _, _ in rows]
        return [pa.array([n for n, _ in found], pa.int64()), pa.array([f for _, f in found], pa.list_(pa.float64()))]

    seen = stash(_map_segments(rows, "t", model, finish, StructType().add("n", "long").add("found", ArrayType(DoubleType())))
                 .select("n", "found", "y"), "segments")
    clean = seen.where("NOT y").agg(F.sum("n"), F.sum(F.size("found"))).first()
    k = max(float(clean[1] or 0), 0.5) / max(float(clean[0] or 0), 1.0)
    base = F.log(F.lit(k / CHANCE) * F.greatest("n", F.lit(1)))
    stat = F.aggregate("found", F.lit(0.0), lambda a, x: a + F.greatest(F.lit(0.0), F.least(F.lit(lam) * x - base, F.lit(50.0))))
    bins = (seen.select(F.round(F.log1p(stat) * 100).cast("int").alias("b"), "y").groupBy("b")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("y").cast("int")).alias("y")).orderBy("b").toPandas())
    offset, slope = _logistic(bins["b"].to_numpy() / 100.0, bins["n"].to_numpy(float), bins["y"].to_numpy(float))
    return replace(model, k=k, offset=offset, slope=slope)


def _lambda(scores: np.ndarray, share: np.ndarray) -> float:
    """The positive root of the mean of exp(lambda * score) = 1 in clean text."""
    rest = 1.0 - share.sum()

    def excess(x: float) -> float:
        return float((share * np.exp(x * scores)).sum() + rest * math.exp(-x * DRIFT)) - 1.0

    low, high = 1e-6, 1.0
    while excess(high) < 0 and high < 64:
        low, high = high, 2 * high
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if excess(mid) < 0 else (low, mid)
    return high


def _logistic(x: np.ndarray, n: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Newton steps for n rows at each x, y of them positive; a small ridge keeps separable data finite."""
    offset, slope = math.log((y.sum() + 0.5) / (n.sum() - y.sum() + 0.5)), 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(offset + slope * x, -40, 40)))
        g = np.array([(y - n * p).sum(), ((y - n * p) * x).sum() - 1e-3 * slope])
        w = n * p * (1 - p)
        h = np.array([[w.sum() + 1e-6, (w * x).sum()], [(w * x).sum(), (w * x * x).sum() + 1e-3]])
        step = np.clip(np.linalg.solve(h, g), -2, 2)
        offset, slope = offset + step[0], slope + step[1]
        if abs(step).max() < 1e-9:
            break
    return float(offset), max(float(slope), 0.0)


def score(docs: DataFrame, model: ToxicModel, text_col: str = "text", out: str = "toxicity",
          passages: str | None = None) -> DataFrame:
    """``docs`` with a column ``out``: the chance 0 to 1 that the text is toxic.

    ``passages``: also a column of the significant segments (text, first and last word,
    score, chance of such a score in clean text of that length). All rows and columns
    stay; new names that clash get an underscore. Null and empty texts have no segment and get the curve's lowest score.
    """
    curve = replace(model, units=None)
    kind = pa.list_(pa.struct([("text", pa.string()), ("first", pa.int64()), ("last", pa.int64()),
                               ("score", pa.float64()), ("chance", pa.float64())]))

    def finish(rows) -> list[pa.Array]:
        stats, spans = [], []
        for n, found, s, e, data in rows:
            stats.append(_statistic(curve.lam, curve.k, n, found))
            if passages:
                own = [(a, b, x, -math.expm1(-min(curve.k * n * math.exp(-min(curve.lam * x, 700)), 700.0))) for a, b, x in found]
                spans.append([{"text": data[s[a]:e[b]].tobytes().decode("utf-8", "replace"), "first": a, "last": b,
                               "score": x, "chance": p} for a, b, x, p in own if p <= CHANCE])
        chances = pa.array(curve.probability(np.array(stats)), pa.float64())
        return [chances, pa.array(spans, kind)] if passages else [chances]

    added = StructType().add(fresh(docs, out), "double")
    if passages:
        added = added.add(fresh(docs, passages), from_arrow_type(kind))
    return _map_segments(docs, text_col, model, finish, added)


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               label_col: str = "toxic", fold: int | None = 5, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score below ``least``, all columns; learnt from their own labelled rows."""
    model = fit(training_rows(docs, labels, id_col, text_col, label_col, fold))
    mark = fresh(docs, "__toxicity")
    return score(docs, model, text_col, mark).where(F.col(mark) < least).drop(mark)
