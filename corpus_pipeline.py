"""Corpus pipeline: raw documents to token files in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and
read again as the next stage's documents. All stages but the last return the columns of the
documents they were given. Each stage first lets go of what the stages before it left in the driver and sees to it that
executors hold small record batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from inkwell.llm import decontaminate, minmax_dedup, soft_mixing, token_parquet, toxic_segments
from inkwell.llm.common import release, small_batches, table
from inkwell.llm.queries import tokenizer_path
from inkwell.session import scratch_path


def _begin(spark: SparkSession) -> None:
    release(spark)
    small_batches(spark)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model rejects go."""
    _begin(spark)
    return toxic_segments.drop_toxic(docs, table(spark, sf_dir, "labels"), fold=None)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays (5-word shingles, 80 %)."""
    _begin(spark)
    return minmax_dedup.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go (5-word shingles, 80 %)."""
    _begin(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or thinned to the target weights of their domains."""
    _begin(spark)
    return soft_mixing.mix_sources(docs, table(spark, sf_dir, "labels"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in id order, read back as (doc_id, n_tokens, input_ids)."""
    _begin(spark)
    path = scratch_path(spark, "tokens")
    token_parquet.write_tokens(docs, path, tokenizer_path())
    return token_parquet.read_tokens(spark, path)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_domains),
    ("tokens", tokenize),
]

#: SQL expresses neither the trained stages nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents of ``sf_dir``; each stage's output is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
