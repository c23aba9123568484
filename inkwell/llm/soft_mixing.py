"""Mixing sources to target weights with soft domain membership.

A linear classifier on hashed words, counted over all labelled rows, gives every document a
posterior over the domains. Nonnegative rates of the documents are then fitted so that the
expected tokens of every domain meet its target: projected gradient steps (with momentum) on
the least squares of the relative domain errors. A step needs the domain totals only, one
distributed sum; the rate of a document follows from its posterior and the few numbers of
each step, so no rates are stored between the steps and a lost task is simply run again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from inkwell.llm.common import BROADCAST_IDS, fresh, map_rows, stash, text_slices
from inkwell.llm.text_hash import U64, words

#: Hash buckets of the classifier; words that a text's evidence counts as.
BUCKETS, EVIDENCE = 1 << 16, 24.0
#: Count vectors of a domain that are summed by one task.
FAN = 32
#: Steps at most, and the relative error of every domain's tokens at which they stop. They also stop where
#: three steps in a row lower the sum of squared errors by less than TOLERANCE squared: closer is not to be had, or hardly.
STEPS, TOLERANCE = 200, 1e-4


@dataclass(frozen=True)
class DomainModel:
    """Log-probabilities (BUCKETS x domains) and log-priors."""

    domains: list[str]
    weights: np.ndarray
    prior: np.ndarray


@dataclass(frozen=True)
class Mixture:
    """What turns a posterior into a rate: the scaled domain errors of every step."""

    domains: list[str]
    targets: np.ndarray
    totals: np.ndarray
    steps: list[np.ndarray]

    @property
    def residual(self) -> np.ndarray:
        """How far each domain's expected tokens are from its target, relative to the target (or to one token)."""
        return (self.totals - self.targets) / np.maximum(self.targets, 1.0)

    def rates(self, p: np.ndarray) -> np.ndarray:
        return replay(p, self.steps)


def replay(p: np.ndarray, steps: list[np.ndarray], ahead: bool = False) -> np.ndarray:
    """Rates of the posteriors ``p`` after ``steps``, from 1; ``ahead``: the point of the next gradient."""
    r = y = np.ones(len(p))
    for i, d in enumerate(steps):
        new = np.maximum(0.0, y - p @ d)
        y = np.maximum(0.0, new + (i / (i + 3)) * (new - r))
        r = new
    return y if ahead else r


def labelled_rows(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  domain_col: str = "lang", label_col: str = "quality") -> DataFrame:
    """(t, y) of the labelled rows; the domain y is the row's ``domain_col`` and its label, like ``en/1``.

    Rows without an id, a text, a domain or a label are no examples; of several labels the largest counts.
    """
    known = (labels.select(F.col(id_col).alias("i"), F.col(label_col).alias("q")).where("i IS NOT NULL AND q IS NOT NULL")
             .groupBy("i").agg(F.max("q").alias("q")))
    if labels.count() <= BROADCAST_IDS:
        known = F.broadcast(known)
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(domain_col).cast("string").alias("l"))
    return (rows.where("t IS NOT NULL AND l IS NOT NULL").join(known, "i")
            .select("t", F.concat_ws("/", "l", F.col("q").cast("string")).alias("y")))


def fit_domains(rows: DataFrame) -> DomainModel:
    """Hashed multinomial model of (t, y) rows. Counts cover all rows; what reaches the driver has
    a fixed size, BUCKETS numbers for each domain. Without rows there are no domains."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in text_slices(batches, "t"):
            w, _, _, first, _ = words(batch.column("t"))
            bucket = (w & U64(BUCKETS - 1)).astype(np.int64)
            names = batch.column("y").to_pylist()
            for name in set(names):
                mine = np.repeat([x == name for x in names], np.diff(first))
                sums[name] = sums.get(name, 0) + np.bincount(bucket[mine], minlength=BUCKETS)
                docs[name] = docs.get(name, 0) + names.count(name)
        for name, x in sums.items():
            dense = np.append(x, docs[name]).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([dense.tobytes()], pa.binary())], ["y", "counts"])

    def add(part: pa.Table) -> pa.Table:
        total = np.zeros(BUCKETS + 1, dtype=np.int64)
        for x in part.column("counts").to_pylist():
            total += np.frombuffer(x, dtype=np.int64)
        return pa.table({"y": part.column("y").slice(0, 1), "part": part.column("part").slice(0, 1), "counts": pa.array([total.tobytes()], pa.binary())})

    # one dense vector for each task and domain, summed in two steps: the driver gets one for each domain
    vectors = rows.mapInArrow(count, "y string, counts binary").withColumn("part", (F.spark_partition_id() % FAN).cast("int"))
    for part in (F.col("part"), F.lit(0)):
        vectors = (vectors.select("y", part.alias("part"), "counts").groupBy("y", "part")
                   .applyInArrow(add, "y string, part int, counts binary"))
    found = {r["y"]: np.frombuffer(bytes(r["counts"]), dtype=np.int64) for r in vectors.select("y", "counts").toLocalIterator()}
    domains = sorted(found)
    weights, prior = np.zeros((BUCKETS, len(domains)), dtype=np.float32), np.zeros(len(domains))
    if domains:
        counts = np.stack([found[name][:-1] for name in domains], axis=1).astype(np.float64)
        prior = np.array([float(found[name][-1]) for name in domains])
        pooled = (counts.sum(axis=1, keepdims=True) + 1.0) / (counts.sum() + BUCKETS)
        smooth = counts + 0.05 * counts.sum(axis=0).mean() * pooled + 1e-9
        weights = np.log(smooth / smooth.sum(axis=0)).astype(np.float32)
        prior = np.log(prior / prior.sum())
    return DomainModel(domains, weights, prior)


def _posteriors(model: DomainModel, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(posteriors, words) of every text; without words the prior."""
    w, _, _, first, _ = words(column)
    n = np.diff(first)
    logit = np.tile(model.prior, (len(n), 1))
    full = np.flatnonzero(n)
    if len(full):
        rows = model.weights[(w & U64(BUCKETS - 1)).astype(np.int64)]
        sums = np.add.reduceat(rows, first[:-1][full], axis=0, dtype=np.float64)
        logit[full] += sums * (np.minimum(n[full], EVIDENCE) / n[full])[:, None]
    p = np.exp(logit - logit.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True), n


def fit_mixture(docs: DataFrame, model: DomainModel, text_col: str = "text", weights: dict[str, float] | None = None,
                total: float | None = None) -> Mixture:
    """Fit the rates of all rows of ``docs`` to the targets.

    ``weights``: share of the tokens that each domain shall have, missing domains none; by
    default ``tempered``. ``total``: tokens in all, by default those of ``docs`` for given weights.
    The steps end when every domain is within TOLERANCE of its target or, where targets cannot be met (a domain
    without tokens, or two that no text tells apart), at the least squares; ``residual`` of the result tells
    which. Neither within STEPS is a RuntimeError.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    k = len(model.domains)

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_slices(batches, "t"):
            p, n = _posteriors(shared.value, batch.column("t"))
            full = n > 0  # a text without words has no tokens to weigh
            yield pa.RecordBatch.from_arrays(
                [pa.FixedSizeListArray.from_arrays(pa.array(p[full].reshape(-1)), k).cast(pa.list_(pa.float64())),
                 pa.array(n[full].astype(np.int64))], ["p", "n"])

    if not k:
        return Mixture([], np.zeros(0), np.zeros(0), [])
    # the steps read this narrow table only, one row for each text, unrounded
    table = stash(docs.select(F.col(text_col).alias("t")).mapInArrow(tally, "p array<double>, n bigint"), "posteriors")

    def totals(steps: list[np.ndarray], ahead: bool = True) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(k)
            for batch in batches:
                p = batch.column("p").flatten().to_numpy().reshape(-1, k)
                out += (replay(p, steps, ahead) * batch.column("n").to_numpy()) @ p
            yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(out)], ["k", "x"])

        got = table.mapInArrow(run, "k int, x double").groupBy("k").agg(F.sum("x").alias("x")).collect()
        out = np.zeros(k)
        for row in got:
            out[row["k"]] = row["x"]
        return out

    have = totals([])
    if have.sum() <= 0:
        return Mixture(model.domains, np.zeros(k), have, [])
    if weights is None:
        targets = tempered(model.domains, have)
    else:
        share = np.array([max(float(weights.get(d, 0.0)), 0.0) for d in model.domains])
        targets = share / max(share.sum(), 1e-300) * (total or have.sum())
    steps: list[np.ndarray] = []
    scale = np.maximum(have, 1.0)
    now = have
    best, idle = np.inf, 0
    while True:
        error = (now - targets) / scale
        loss = float((error * error).sum())
        idle = 0 if loss < best - TOLERANCE ** 2 else idle + 1
        best = min(best, loss)
        if np.abs(error).max() <= TOLERANCE or idle >= 3:
            break
        if len(steps) == STEPS:
            raise RuntimeError(f"the mixture has not settled after {STEPS} steps: relative errors "
                               f"{dict(zip(model.domains, error.round(6).tolist()))}")
        steps.append(error)  # the largest curvature in this scale is 1, so is the step
        now = totals(steps)
    return Mixture(model.domains, targets, totals(steps, False), steps)


def tempered(domains: list[str], have: np.ndarray, power: float = 0.8, low: float = 0.5) -> np.ndarray:
    """Targets that lift rare domains: tokens to the ``power``, scaled so that no domain shrinks but the
    labelled-0 ones (``name/0``), which get ``low`` of that."""
    want = np.where(have > 0, np.maximum(have, 1.0) ** power, 0.0)
    want *= (have[have > 0] / want[have > 0]).max()
    return want * np.array([low if d.endswith("/0") else 1.0 for d in domains])


def with_rates(docs: DataFrame, model: DomainModel, mixture: Mixture, text_col: str = "text") -> DataFrame:
    """``docs`` with ``domain`` (the likeliest), ``n_words`` and ``rate``; clashing names get an underscore.

    All rows and columns stay. Null and empty texts have the prior as posterior and no words.
    Without domains every rate is 1 and the domain null.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model, mixture))

    def run(batches: Iterator[pa.RecordBatch], at: dict[str, str]) -> Iterator[pa.RecordBatch]:
        m, mixed = shared.value
        for batch in text_slices(batches, at[text_col]):
            if m.domains:
                p, n = _posteriors(m, batch.column(at[text_col]))
                domain, rate = [m.domains[i] for i in p.argmax(axis=1)], mixed.rates(p)
            else:
                n = np.diff(words(batch.column(at[text_col]))[3])
                domain, rate = [None] * len(n), np.ones(len(n))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(domain, pa.string()), pa.array(n, pa.int64()), pa.array(rate, pa.float64())],
                [*batch.schema.names, *names])

    names = [fresh(docs, x) for x in ("domain", "n_words", "rate")]
    return map_rows(docs, run, StructType().add(names[0], "string").add(names[1], "long").add(names[2], "double"))


def copies_of(rate, key, seed: int = 17):
    """Whole copies whose expectation is ``rate``, fixed by the row's key."""
    u = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return F.floor(rate + u).cast("int")


def mix_sources(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                domain_col: str = "lang", label_col: str = "quality", weights: dict[str, float] | None = None,
                total: float | None = None) -> DataFrame:
    """The rows of ``docs``, all columns, each repeated as often as its rate says (0 or more times).

    The fraction of a rate is drawn by a hash of the row's id and text, so the result is the same in every run.
    """
    model = fit_domains(labelled_rows(docs, labels, id_col, text_col, domain_col, label_col))
    mixture = fit_mixture(docs, model, text_col, weights, total)
    names = docs.columns
    rated = with_rates(docs, model, mixture, text_col)
    times = copies_of(F.col(rated.columns[-1]), F.struct(F.col(id_col), F.xxhash64(text_col)))
    mark = fresh(rated, "__copy")
    return (rated.withColumn(mark, times).where(F.col(mark) > 0)
            .withColumn(mark, F.explode(F.sequence(F.lit(1), F.col(mark)))).select(*[F.col(f"`{c}`") for c in names]))
