"""TF-IDF queries (T11-T12 feed these; A4-A8, L6, K3-K4)."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.operators import tfidf
from inkwell.plans import oracle as O
from inkwell.plans.catalog import big, r6, register
from inkwell.plans.q_text import cleaned_articles
from inkwell.plans.stages import stage
from inkwell.session import scratch_path

_TFIDF_SQL = O.with_(O.CLEANED, O.tfidf_ctes())


def cleaned_stage(spark, sf_dir):
    """Cleaned articles as a stage table (written once per session, read by every consumer)."""
    return stage(spark, sf_dir, "cleaned", lambda: cleaned_articles(spark, sf_dir).select(
        "doc_id", "language", "cleaned_text", "title", "description"))


def cleaned_docs(spark, sf_dir):
    return cleaned_stage(spark, sf_dir).select("doc_id", "language", "cleaned_text")


@register("term_frequency", sql=_TFIDF_SQL + "SELECT doc_id, term, tf FROM tf")
def q_term_frequency(spark, sf_dir):
    return tfidf.term_frequency(cleaned_docs(spark, sf_dir))


@register("document_frequency", sql=_TFIDF_SQL + "SELECT term, df, cf FROM stats")
def q_document_frequency(spark, sf_dir):
    docs = cleaned_docs(spark, sf_dir)
    return tfidf.document_frequency(tfidf.term_frequency(docs), tfidf.size(docs)[1])


@register("tfidf_vocab", sql=_TFIDF_SQL + "SELECT term, term_id, cf, df, round(idf, 6) AS idf FROM vocab")
def q_tfidf_vocab(spark, sf_dir):
    """Vocabulary fitted, written as a Parquet table and read back (the vectoriser sink)."""
    vec = tfidf.fit(cleaned_docs(spark, sf_dir))
    path = scratch_path(spark, "vocabulary")
    tfidf.save_vocabulary(vec, path)
    v = tfidf.load_vocabulary(spark, path).vocabulary
    return v.select("term", "term_id", "cf", "df", r6("idf").alias("idf"))


@register("tfidf_idf", sql=_TFIDF_SQL + """
SELECT CAST(count(*) AS BIGINT) AS n_terms, round(min(idf), 6) AS min_idf, round(max(idf), 6) AS max_idf,
       round(sum(idf), 6) AS sum_idf FROM vocab""")
def q_tfidf_idf(spark, sf_dir):
    v = tfidf.fit(cleaned_docs(spark, sf_dir)).vocabulary
    return v.agg(big(F.count(F.lit(1))).alias("n_terms"), r6(F.min("idf")).alias("min_idf"),
                 r6(F.max("idf")).alias("max_idf"), r6(F.sum("idf")).alias("sum_idf"))


@register("tfidf_long", sql=_TFIDF_SQL + "SELECT doc_id, term_id, term, round(weight, 6) AS weight FROM weights")
def q_tfidf_long(spark, sf_dir):
    """Weights written as the feature-matrix Parquet table and read back."""
    _vec, w = tfidf.fit_transform(cleaned_docs(spark, sf_dir))
    path = scratch_path(spark, "tfidf")
    w.write.mode("overwrite").parquet(path)
    back = spark.read.parquet(path)
    return back.select("doc_id", "term_id", "term", r6("weight").alias("weight"))


@register("tfidf_norms", sql=_TFIDF_SQL + """
SELECT doc_id, round(sqrt(sum(weight * weight)), 6) AS norm, CAST(count(*) AS BIGINT) AS nnz
FROM weights GROUP BY doc_id""")
def q_tfidf_norms(spark, sf_dir):
    """Invariant: every document row has norm 1 (documents without vocabulary terms have no row)."""
    _vec, w = tfidf.fit_transform(cleaned_docs(spark, sf_dir))
    return w.groupBy("doc_id").agg(r6(F.sqrt(F.sum(F.col("weight") * F.col("weight")))).alias("norm"),
                                   big(F.count(F.lit(1))).alias("nnz"))
