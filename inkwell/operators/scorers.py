"""The scorer hook: any model that labels texts, behind one checked contract.

A scorer maps rows (id, text, more) to (id, label, score, more) with one row for each id at most.
``apply_scorer`` gives it the rows whose text is not blank and completes the result: EMPTY for blank
texts, ERROR for rows that the scorer leaves out or labels with null, both with score 0. Two rows for one id
are an error of the scorer and end the job.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell import constants as C
from inkwell.functions.text import non_blank
from inkwell.operators import models as M
from inkwell.operators.naive_bayes import NBModel


class Scorer(Protocol):
    """What ``apply_scorer`` needs; ``context`` names the columns that are passed beside id and text."""

    context: tuple[str, ...]

    def score(self, rows: DataFrame) -> DataFrame:
        """(id, label, score, more) of rows (id, text, context columns)."""
        ...


@dataclass
class NaiveBayesScorer:
    """A naive Bayes model; rows of a group that it does not cover get no label."""

    model: NBModel

    @property
    def context(self) -> tuple[str, ...]:
        return tuple(c for c in self.model.group_cols if not c.startswith("_"))

    def score(self, rows: DataFrame) -> DataFrame:
        found = M.predict_nb(rows, self.model, "id", "text")
        return found.select("id", F.col("prediction").alias("label"), F.col("prob").alias("score"))


@dataclass
class FrameScorer:
    """A function from rows (id, text) to (id, label, score, more): joins, aggregations, any DataFrame job."""

    function: Callable[[DataFrame], DataFrame]
    context: tuple[str, ...] = ()

    def score(self, rows: DataFrame) -> DataFrame:
        return self.function(rows)


@dataclass
class ArrowScorer:
    """An outside model: ``load`` makes it once for each task, and it labels lists of texts.

    The model takes a list of texts and returns a (label, score) for each. When it fails on a list,
    its texts are tried one by one and only those that fail have no label; a list of the wrong
    length is a failure. Only (id, label, score) come back from Python.
    """

    load: Callable[[], Callable[[list[str]], Sequence[tuple[str, float]]]]
    batch: int = 64
    context: tuple[str, ...] = ()

    def score(self, rows: DataFrame) -> DataFrame:
        load, size = self.load, self.batch

        def attempt(model, texts: list[str]) -> list[tuple]:
            out = [(None if x is None else str(x), None if y is None else float(y)) for x, y in model(texts)]
            if len(out) != len(texts):
                raise ValueError(f"{len(out)} labels for {len(texts)} texts")
            return out

        def labels(model, texts: list[str]) -> list[tuple]:
            try:
                return attempt(model, texts)
            except Exception:
                if len(texts) == 1:
                    return [(None, None)]
                return [labels(model, [t])[0] for t in texts]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = load()
            for batch in batches:
                texts, found = batch.column("text").to_pylist(), []
                for i in range(0, len(texts), size):
                    found += labels(model, texts[i:i + size])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array([x for x, _ in found], pa.string()), pa.array([y for _, y in found], pa.float64())],
                    ["id", "label", "score"])

        kind = rows.schema["id"].dataType.simpleString()
        return rows.select("id", "text").mapInArrow(run, f"id {kind}, label string, score double")


def apply_scorer(df: DataFrame, scorer: Scorer, id_col: str = "doc_id", text_col: str = "cleaned_text") -> DataFrame:
    """(id_col, label, score, more columns of the scorer): one row for every row of ``df``, whose ids are unique."""
    text = F.col(text_col)
    worded = text.isNotNull() & non_blank(text_col)
    rows = df.select(F.col(id_col).alias("id"), text.alias("text"), worded.alias("_worded"),
                     *[F.col(c) for c in scorer.context if c in df.columns])
    found = scorer.score(rows.where("_worded").drop("_worded"))
    more = [c for c in found.columns if c not in ("id", "label", "score")]
    once = found.groupBy("id").agg(F.count(F.lit(1)).alias("_rows"), *[F.first(c).alias(c) for c in ("label", "score", *more)])
    twice = F.raise_error(F.concat(F.lit("the scorer gave several rows for id "), F.col("id").cast("string"))).cast("string")
    out = rows.select("id", "_worded").join(once, "id", "left")
    label = (F.when(F.col("_rows") > 1, twice).when(~F.col("_worded"), F.lit(C.SENTINEL_EMPTY))
             .otherwise(F.coalesce("label", F.lit(C.SENTINEL_ERROR))))
    score = F.when(F.col("_worded") & F.col("label").isNotNull(), F.coalesce("score", F.lit(0.0))).otherwise(F.lit(0.0))
    return out.select(F.col("id").alias(id_col), label.alias("label"), score.alias("score"), *more)
