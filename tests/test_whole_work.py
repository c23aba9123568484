"""Queries do their whole work, on rows of their own."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from inkwell import constants as C
from inkwell.functions import text as T
from inkwell.operators import ingest
from inkwell.operators import models as M
from inkwell.operators import naive_bayes as NB
from inkwell.operators import scoring, tfidf
from inkwell.operators.scorers import apply_scorer


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """130 documents of one source and language, 30 of another; a page for each ten of them."""
    path = tmp_path_factory.mktemp("tables")
    docs = pd.DataFrame({"doc_id": range(160), "text": [f"head {i}\nbody {i % 7} of {i}" for i in range(160)],
                         "lang": ["en"] * 130 + ["fr"] * 30, "source": "s", "n_chars": 20})
    docs.to_parquet(path / "documents.parquet")
    pd.DataFrame({"page_id": range(16), "url": [f"http://x.org/{i}" for i in range(16)], "html": "<p>x</p>"}).to_parquet(path / "pages.parquet")
    return str(path)


def test_request_cap_is_the_page_size(spark, folder):
    got = [(r["category"], r["title"]) for r in E.queries()["request_cap"](spark, folder).collect()]
    assert sorted(got) == sorted([("en", f"head {i}") for i in range(50)] + [("fr", f"head {i}") for i in range(130, 160)])


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


TEXTS = [(1, "red tea red tea red"), (2, "tea"), (2, "red tea"), (None, "tea pot"), (None, "tea"), (3, None), (4, ""), (5, "pot")]


def test_terms_are_counted_inside_their_rows(spark):
    once = spark.createDataFrame([r for r in TEXTS if r[0] in (1, 3, 4, 5)], "doc_id long, cleaned_text string")
    tf = tfidf.term_frequency(once)
    assert "Exchange" not in plan(tf)
    assert sorted(map(tuple, tf.collect())) == [(1, "red", 3), (1, "red tea", 2), (1, "tea", 2), (1, "tea red", 2), (5, "pot", 1)]


def test_rows_that_share_an_id_are_one_document(spark):
    tf = tfidf.term_frequency(spark.createDataFrame(TEXTS, "doc_id long, cleaned_text string"))
    got = sorted(map(tuple, tf.where("doc_id = 2 OR doc_id IS NULL").collect()), key=str)
    assert got == sorted([(2, "tea", 2), (2, "red", 1), (2, "red tea", 1), (None, "tea", 2), (None, "pot", 1), (None, "tea pot", 1)], key=str)


def test_norms_and_topics_equal_those_of_the_weights(spark):
    docs = spark.createDataFrame([(i, f"tea w{i % 3} pot{i % 5} w{i % 7} tea") for i in range(40)] + [(40, "other words"), (41, "")],
                                 "doc_id long, cleaned_text string")
    seeds = spark.createDataFrame([("a", "tea w1 pot2"), ("b", "w6 w2"), ("c", "nothing")], "label string, seed_text string")
    vec, weights = tfidf.fit_transform(docs, max_features=None)
    tf, (n, parts) = tfidf.term_frequency(docs), tfidf.size(docs)
    own = {r["doc_id"]: r["norm"] for r in tfidf.own_norms(tf, n, parts).collect()}
    assert own == pytest.approx({r["doc_id"]: r["norm"] for r in tfidf.norms(tf, vec).collect()}) and len(own) == 41
    assert "Window" not in plan(tfidf.norms(tf, vec))
    key = lambda df: {r["doc_id"]: (r["topic"], r["n_present"], round(r["topic_score"], 9), round(r["best_cos"], 9)) for r in df.collect()}
    want = key(scoring.topic_scores(weights, docs, seeds, vec))
    assert key(scoring.own_topic_scores(docs, seeds, docs)) == want
    assert key(scoring.counted_topic_scores(docs, seeds, tfidf.kept(vec))) == want


def test_a_small_model_is_broadcast_and_nothing_is_kept_for_each_feature(spark):
    train = spark.createDataFrame([(1, "a b", "x"), (2, "b c c", "y")], "doc_id long, cleaned_text string, label string")
    model = M.train_nb(train)
    scores = NB.log_scores(M.with_terms(train.withColumn("cleaned_text", F.lit("aa bb cc"))), "doc_id", "_terms", model)
    assert "BroadcastHashJoin" in plan(scores) and "keys=[doc_id#" in plan(scores)
    assert "feature#" not in "".join(x for x in plan(scores).splitlines() if "HashAggregate(keys=[doc_id" in x)


ODD = ["Cannot gimme,gonna GOTTA lemme wanna", "wannaـ cannot، xcannot cannotx can not cannotgonna", "wanna", "cannotً gonna_ égimme wanna\n",
       "\U0001F600a\U0001F600 b\U0001F600\U0001F600 c", " a  b\nc ", "", "x", "a b", None]


def test_contractions_are_split_in_one_pass_as_one_by_one(spark):
    x = F.col("text")
    for first, second in C.CONTRACTIONS:
        tail = "(?=[" + C.WS + "]|$)" if first == "wan" else f"(?![{C.WORD}])"
        x = F.regexp_replace(x, f"(?i)(?<![{C.WORD}])({first})({second}){tail}", "$1 $2")
    once = T._split_contractions(F.col("text"))
    rows = spark.createDataFrame([(t,) for t in ODD], "text string").select(x.alias("a"), once.alias("b")).collect()
    assert all(r["a"] == r["b"] for r in rows)
    assert str(once._jc).count("regexp_replace") == 1


def test_a_page_is_read_once_for_all_its_rows(spark):
    rows = spark.createDataFrame([(i, "http://x.org/1" if i < 5 else None, "h", "202001010000", "en") for i in range(6)],
                                 "doc_id long, source_url string, headline_text string, publish_time string, language string")
    pages = spark.createDataFrame([(1, "http://x.org/1", '<meta property="og:image" content="i.png"><p>one</p><p>two</p>')],
                                  "page_id long, url string, html string")
    looked = ingest.lookup_pages(rows, pages, read=ingest.read_pages)
    assert "html" not in looked.columns
    key = lambda df: sorted((r["doc_id"], r["content"], r["urlToImage"]) for r in df.collect())
    want = [(i, "one two", "i.png") for i in range(5)] + [(5, "", "")]
    assert key(ingest.to_article(looked)) == want == key(ingest.to_article(ingest.lookup_pages(rows, pages)))


def test_a_topic_scorer_of_the_documents_themselves_equals_the_fitted_one(spark):
    docs = spark.createDataFrame([(i, f"tea w{i % 3} pot{i % 5} w{i % 7} tea") for i in range(40)] + [(40, "other words"), (41, "")],
                                 "doc_id long, cleaned_text string")
    seeds = spark.createDataFrame([("a", "tea w1 pot2"), ("b", "w6 w2"), ("c", "nothing")], "label string, seed_text string")
    key = lambda s: {r["doc_id"]: (r["label"], round(r["score"], 9), round(r["absent_score"] or 0, 9))
                     for r in apply_scorer(docs, s).collect()}
    assert key(scoring.own_topic_scorer(docs, seeds)) == key(scoring.topic_scorer(seeds, tfidf.fit(docs, max_features=None)))
