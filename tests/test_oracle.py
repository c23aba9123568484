"""Spark queries against their DuckDB SQL on the smallest driver tables."""

import collections
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from inkwell.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
KEYS = ["clean_articles", "remove_stopwords", "ngrams", "source_host", "html_article_text",
        "html_paragraph_text", "tfidf_long", "split_data", "classification_report", "topic_scores",
        "centroid_scores", "scan_feed_csv", "union_languages", "marked_tags", "marked_urls", "marked_dediac",
        "marked_tokens_ar", "marked_cleaned", "marked_image", "scan_articles_array"]


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, collections.Counter(tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("driver tables not present")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_sql_or_is_documented():
    assert set(E.oracle_sql()) <= set(E.queries())
    without = {k for k in set(E.queries()) - set(E.oracle_sql()) if not k.startswith("op")}
    assert without <= {"article_pipeline", "pipeline"}


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    got = E.queries()[key](spark, SF).toPandas()
    want = con.execute(E.oracle_sql()[key]).df()
    assert _rows(got) == _rows(want)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
