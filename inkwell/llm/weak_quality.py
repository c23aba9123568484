"""Quality classifier from weak labels.

Overlapping heuristics vote good, bad or abstain on every document. Expectation-maximisation
on the counts of all vote patterns estimates how each heuristic votes on good and on bad documents and
gives every pattern a posterior; the posteriors then label all documents for a linear
scorer on hashed words, whose counts are one distributed sum over the corpus. No true labels are used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from inkwell.llm.common import fresh, map_rows, text_slices
from inkwell.llm.text_hash import U64, words

#: Hash buckets of the scorer; words that a text's evidence counts as.
BUCKETS, EVIDENCE = 1 << 16, 24.0
#: Beta prior of the share of good documents that a heuristic calls bad: its mean, and the good documents that it counts as.
FALSE_ALARMS, PRIOR_DOCS = 0.002, 8000.0
#: The heuristics: name, largest value that votes good, least value that votes bad. Shares are of LEAST words or bytes at
#: least, so that a few words of a short text are no evidence.
LEAST_WORDS, LEAST_BYTES = 8, 60
HEURISTICS = (
    ("marked_words", 0.05, 0.30),    # share of words that end in two or more symbols
    ("capitals", 0.20, 0.50),        # share of capitals among ASCII letters
    ("repeats", 0.02, 0.15),         # share of words equal to the word before
    ("few_kinds", 0.55, 0.80),       # 1 - distinct words per word, on a scale that long texts do not shift
    ("symbols", 0.06, 0.12),         # share of ASCII punctuation among the bytes
    ("bars", 0.01, 0.05),            # share of words that are a table bar
    ("digits", 0.05, 0.20),          # share of digits among the bytes
    ("short", 0.25, 1.00),           # 1 / (1 + words): votes bad on texts without words only
)


@dataclass(frozen=True)
class QualityModel:
    """Chance of each vote (bad, abstain, good) per heuristic and class (bad, good), the share of good, and the scorer."""

    votes: np.ndarray
    good: float
    weights: np.ndarray
    offset: float
    slope: float


def features(column: pa.Array) -> tuple[np.ndarray, tuple]:
    """(rows x heuristics, the words' layout). Texts without words have features 0, but ``short`` 1."""
    w, s, e, first, data = words(column)
    n = np.diff(first)
    base = np.maximum(n, LEAST_WORDS)
    rows = len(n)

    def per_row(mask: np.ndarray, at: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
        return (total[at[1:]] - total[at[:-1]]).astype(float)

    kind = np.zeros(256, dtype=np.uint8)
    kind[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = 1
    kind[0x30:0x3A], kind[0x41:0x5B], kind[0x61:0x7B] = 2, 3, 4
    edge = np.append(s, len(data))[first[:-1]], np.append(e, 0)[first[1:] - 1]
    edge = np.where(n > 0, edge[0], 0), np.where(n > 0, edge[1], 0)
    k = kind[data]

    def bytes_of(code: int) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(k == code, dtype=np.int64)])
        return (total[edge[1]] - total[edge[0]]).astype(float)

    size = np.maximum(edge[1] - edge[0], LEAST_BYTES)
    marks, digits, upper, lower = (bytes_of(c) for c in (1, 2, 3, 4))
    two = (e - s >= 3)
    two[two] = (k[e[two] - 1] == 1) & (k[e[two] - 2] == 1)
    same = np.zeros(len(w), dtype=bool)
    same[1:] = w[1:] == w[:-1]
    same[first[:-1][n > 0]] = False
    bar = (e - s == 1)
    bar[bar] = data[s[bar]] == 0x7C
    kinds = np.array([len(np.unique(w[a:b])) for a, b in zip(first[:-1], first[1:])], dtype=float)
    out = np.stack([per_row(two, first) / base, upper / np.maximum(upper + lower, LEAST_BYTES), per_row(same, first) / base,
                    np.where(n >= LEAST_WORDS, np.clip(1 - kinds / base ** 0.9, 0, 1), 0), marks / size, per_row(bar, first) / base, digits / size, 1 / (1 + n)], axis=1)
    return out.reshape(rows, len(HEURISTICS)), (w, first)


def cast_votes(x: np.ndarray) -> np.ndarray:
    """0 bad, 1 abstain, 2 good for every row and heuristic."""
    good, bad = np.array([h[1] for h in HEURISTICS]), np.array([h[2] for h in HEURISTICS])
    return np.where(x >= bad, 0, np.where(x <= good, 2, 1)).astype(np.int64)


def _code(votes: np.ndarray) -> np.ndarray:
    return votes @ (3 ** np.arange(votes.shape[1]))


def posterior(votes: np.ndarray, chances: np.ndarray, good: float) -> np.ndarray:
    """Chance of good for rows of votes; ``chances``: (heuristics, classes, votes)."""
    log = np.log(chances)
    each = log[np.arange(votes.shape[1]), :, votes]  # rows x heuristics x classes
    logit = each[:, :, 1].sum(axis=1) - each[:, :, 0].sum(axis=1) + np.log(good / (1 - good))
    return 1 / (1 + np.exp(-np.clip(logit, -50, 50)))


def fit_labellers(votes: np.ndarray, counts: np.ndarray, rounds: int = 200) -> tuple[np.ndarray, float]:
    """EM on vote patterns and their counts: (chances, share of good). Starts from: a bad vote is mostly right."""
    p = np.where((votes == 0).any(axis=1), 0.1, 0.9)
    chances, good = np.full((votes.shape[1], 2, 3), 1 / 3), 0.5
    for _ in range(rounds):
        weight = np.stack([(1 - p) * counts, p * counts])
        for v in range(3):
            chances[:, :, v] = ((votes == v).T @ weight.T + 0.5) / (weight.sum(axis=1) + 1.5)
        # prior knowledge, which enough documents overrule: a heuristic rarely calls a good document bad
        alarms = ((votes == 0).T @ weight[1] + PRIOR_DOCS * FALSE_ALARMS) / (weight[1].sum() + PRIOR_DOCS)
        chances[:, 1, 1:] *= ((1 - alarms) / chances[:, 1, 1:].sum(axis=1))[:, None]
        chances[:, 1, 0] = alarms
        # bad votes are no evidence of a good document
        chances[:, 0, 0] = np.maximum(chances[:, 0, 0], chances[:, 1, 0])
        chances /= chances.sum(axis=2, keepdims=True)
        good = float(np.clip(weight[1].sum() / max(weight.sum(), 1e-9), 1e-3, 1 - 1e-3))
        new = posterior(votes, chances, good)
        if np.abs(new - p).max() < 1e-8:
            break
        p = new
    return chances, good


def fit(docs: DataFrame, text_col: str = "text") -> QualityModel:
    """Fit on all rows of ``docs``. What reaches the driver is bounded: at most 3 ** heuristics patterns, BUCKETS weights."""
    rows = docs.select(F.col(text_col).alias("t"))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(3 ** len(HEURISTICS), dtype=np.int64)
        for batch in text_slices(batches, "t"):
            total += np.bincount(_code(cast_votes(features(batch.column("t"))[0])), minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["code", "n"])

    seen = rows.mapInArrow(tally, "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n")).orderBy("code").toPandas()
    codes, n = seen["code"].to_numpy(dtype=np.int64), seen["n"].to_numpy(dtype=float)
    if not len(codes):
        return QualityModel(np.full((len(HEURISTICS), 2, 3), 1 / 3), 0.5, np.zeros(BUCKETS, np.float32), 0.0, 0.0)
    patterns = codes[:, None] // 3 ** np.arange(len(HEURISTICS)) % 3
    chances, good = fit_labellers(patterns, n)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, BUCKETS))
        for batch in text_slices(batches, "t"):
            x, (w, first) = features(batch.column("t"))
            p = np.repeat(posterior(cast_votes(x), chances, good), np.diff(first))
            bucket = (w & U64(BUCKETS - 1)).astype(np.int64)
            sums[1] += np.bincount(bucket, weights=p, minlength=BUCKETS)
            sums[0] += np.bincount(bucket, weights=1 - p, minlength=BUCKETS)
        at = np.flatnonzero(sums.sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums[0, at]), pa.array(sums[1, at])], ["bucket", "bad", "good"])

    table = (rows.mapInArrow(count, "bucket bigint, bad double, good double").groupBy("bucket")
             .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).toPandas())
    sums = np.zeros((2, BUCKETS))
    sums[:, table["bucket"]] = table[["bad", "good"]].to_numpy().T
    pooled = (sums.sum(axis=0) + 1) / (sums.sum() + BUCKETS)
    smooth = sums + np.maximum(0.02 * sums.sum(), 1.0) * pooled
    weights = (np.log(smooth[1] / smooth[1].sum()) - np.log(smooth[0] / smooth[0].sum())).astype(np.float32)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((401, 2))
        for batch in text_slices(batches, "t"):
            x, (w, first) = features(batch.column("t"))
            at = np.rint(np.clip(_linear(weights, w, first), -50, 50) * 4).astype(int) + 200
            p = posterior(cast_votes(x), chances, good)
            out[:, 0] += np.bincount(at, minlength=401)
            out[:, 1] += np.bincount(at, weights=p, minlength=401)
        at = np.flatnonzero(out[:, 0])
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(out[at, 0]), pa.array(out[at, 1])], ["at", "n", "good"])

    bins = (rows.mapInArrow(scored, "at bigint, n double, good double").groupBy("at")
            .agg(F.sum("n").alias("n"), F.sum("good").alias("good")).orderBy("at").toPandas())
    from inkwell.llm.toxic_segments import _logistic

    offset, slope = _logistic((bins["at"].to_numpy() - 200) / 4, bins["n"].to_numpy(), bins["good"].to_numpy())
    return QualityModel(chances, good, weights, offset, slope)


def _linear(weights: np.ndarray, w: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Evidence of every row: the mean weight of its words, as if it had EVIDENCE words at most."""
    n = np.diff(first)
    total = np.concatenate([[0.0], np.cumsum(weights[(w & U64(BUCKETS - 1)).astype(np.int64)], dtype=np.float64)])
    return (total[first[1:]] - total[first[:-1]]) * np.minimum(n, EVIDENCE) / np.maximum(n, 1)


def score(docs: DataFrame, model: QualityModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``quality`` (scorer, 0 to 1), ``weak_label`` (posterior of the votes) and ``keep``; clashing names
    get an underscore. A document is kept when the odds of both multiply to 1 or more.

    All rows and columns stay. Null and empty texts have no words: they are not kept.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [fresh(docs, x) for x in ("quality", "weak_label", "keep")]

    def run(batches: Iterator[pa.RecordBatch], at: dict[str, str]) -> Iterator[pa.RecordBatch]:
        m, text = shared.value, at[text_col]
        for batch in text_slices(batches, text):
            x, (w, first) = features(batch.column(text))
            weak = posterior(cast_votes(x), m.votes, m.good)
            q = 1 / (1 + np.exp(-np.clip(m.offset + m.slope * _linear(m.weights, w, first), -40, 40)))
            empty = np.diff(first) == 0
            q, weak = np.where(empty, 0.0, q), np.where(empty, 0.0, weak)
            odds = np.log(np.clip([q, weak], 1e-9, 1 - 1e-9)) - np.log1p(-np.clip([q, weak], 1e-9, 1 - 1e-9))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(q), pa.array(weak), pa.array(odds.sum(axis=0) >= 0)],
                                             [*batch.schema.names, *names])

    return map_rows(docs, run, StructType().add(names[0], "double").add(names[1], "double").add(names[2], "boolean"))
