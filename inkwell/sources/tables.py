"""Driver tables and the derived views every query starts from.

The same view definitions are spelled in DuckDB SQL in ``inkwell.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.functions.text import first_line

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _with_url(spark: SparkSession, sf_dir: str, docs: DataFrame) -> DataFrame:
    """docs + ``url``: page ``doc_id % count(pages)`` stands for the document's page.

    The count is a scalar subquery (answered from Parquet footers when the query runs), and the
    page map one equi-join on the computed page id.
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    n_pages = F.greatest(pages.agg(F.count(F.lit(1))).scalar(), F.lit(1))
    return docs.withColumn("page_id", F.pmod(F.col("doc_id"), n_pages)).join(pages, "page_id", "left").drop("page_id")


def articles(spark: SparkSession, sf_dir: str, url: bool = True) -> DataFrame:
    """raw_articles view: one article per document; without ``url`` a plain projection of the scan."""
    docs = table(spark, sf_dir, "documents")
    docs = _with_url(spark, sf_dir, docs) if url else docs
    head = first_line(F.col("text"))
    return docs.select(
        "doc_id",
        F.struct(F.lit(None).cast("string").alias("id"), F.col("source").alias("name")).alias("source"),
        F.lit("").alias("author"),
        head.alias("title"),
        head.alias("description"),
        *(["url"] if url else []),
        F.lit("").alias("urlToImage"),
        F.lit("").alias("publishedAt"),
        F.col("text").alias("content"),
        F.col("lang").alias("language"),
    )


def feed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV-feed stand-in: first lines of documents ⋈ events ⋈ page url; ``doc_id`` is the file order."""
    heads = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("feed_code"),
                                                     first_line(F.col("text")).alias("headline_text"))
    events = table(spark, sf_dir, "events").select(F.col("event_id").alias("doc_id"), "ts")
    return (_with_url(spark, sf_dir, heads.join(events, "doc_id"))
            .select("doc_id", F.date_format("ts", "yyyyMMddHHmm").alias("publish_time"), "feed_code",
                    F.col("url").alias("source_url"), "headline_text"))


def labelled(spark: SparkSession, sf_dir: str, task: str = "quality") -> DataFrame:
    """(doc_id, text, label) for one label column of ``labels``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.col("lang").alias("language"))
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col(task).cast("string").alias("label"))
    return docs.join(labels, "doc_id")


def candidate_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Caller-supplied topic labels with seed texts: one label per ``benchmark`` row."""
    return table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("topic_"), F.col("item_id").cast("string")).alias("label"),
        F.col("text").alias("seed_text"))
