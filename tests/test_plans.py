"""Plan shapes that the scale design relies on."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from inkwell.operators import ingest, tfidf
from inkwell.sources.tables import table

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_quota_is_a_group_limit_before_the_shuffle(spark):
    docs = table(spark, SF, "documents").select("doc_id", F.col("lang").alias("language"))
    p = plan(ingest.first_per_group(docs, 150, ["language"], [F.col("doc_id")]))
    assert "WindowGroupLimit" in p


def test_page_lookup_broadcasts_only_the_bounded_side(spark):
    rows = spark.createDataFrame([(1, "http://x/1")], "doc_id long, source_url string")
    pages = table(spark, SF, "pages")
    p = plan(ingest.lookup_pages(rows, pages, rows_bounded=True))
    assert "BroadcastHashJoin" in p and "LeftSemi" in p
    assert "SortMergeJoin" not in p


def test_scan_reads_only_needed_columns(spark):
    p = plan(E.queries()["source_host"](spark, SF))
    assert "ReadSchema: struct<page_id:bigint,url:string>" in p


def test_tfidf_broadcasts_the_capped_vocabulary(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma"), (2, "beta gamma delta")], "doc_id long, cleaned_text string")
    vec, w = tfidf.fit_transform(docs, max_features=3)
    assert vec.vocabulary.count() == 3
    assert "BroadcastHashJoin" in plan(w)


def test_stopword_lookup_is_hashed(spark):
    p = plan(E.queries()["remove_stopwords"](spark, SF))
    assert "INSET" in p


def test_filters_on_article_columns_need_no_join(spark):
    for name in ("filter_content_len", "head_articles", "count_by_language"):
        assert "Join" not in plan(E.queries()[name](spark, SF))


def test_stage_sees_changed_input(spark, tmp_path):
    import os
    import shutil

    from inkwell.plans.stages import stage
    for t in ("documents", "labels", "pages", "events", "benchmark"):
        shutil.copyfile(f"{SF}/{t}.parquet", tmp_path / f"{t}.parquet")
    d, rows = str(tmp_path), lambda: table(spark, str(tmp_path), "documents").select("doc_id")
    assert stage(spark, d, "t", rows).count() == rows().count()
    small = rows().limit(20).collect()
    spark.createDataFrame(small, "doc_id long").toPandas().to_parquet(os.path.join(d, "documents.parquet"))
    assert stage(spark, d, "t", rows).count() == 20
