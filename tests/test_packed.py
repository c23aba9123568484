"""Terms exchanged in blocks give the rows that a row for each (document, term) gives."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from inkwell.operators import langid, packed, scoring, tfidf, tuning
from inkwell.operators import models as M
from inkwell.operators import naive_bayes as NB
from inkwell.operators.scorers import apply_scorer


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def topics(df) -> dict:
    return {r["doc_id"]: (r["topic"], r["n_present"], round(r["topic_score"], 9), round(r["best_cos"], 9),
                          {k: round(v, 9) for k, v in r["label_scores"].items()}) for r in df.collect()}


DOCS = [(i, f"tea w{i % 3} pot{i % 5} w{i % 7} tea été") for i in range(60)] + [(60, "other words"), (61, ""), (62, None), (63, "a b")]
SEEDS = [("a", "tea w1 pot2"), ("b", "w6 w2 tea"), ("b", "pot4"), ("c", "nothing"), ("d", "été w0")]


@pytest.mark.parametrize("held", [200_000, 0])
def test_topics_come_from_blocks_of_documents(spark, monkeypatch, held):
    monkeypatch.setattr(scoring, "LABELS_HELD", held)
    docs = spark.createDataFrame(DOCS, "doc_id long, cleaned_text string").repartition(3)
    seeds = spark.createDataFrame(SEEDS, "label string, seed_text string")
    vec, weights = tfidf.fit_transform(docs, max_features=None)
    got = scoring.own_topic_scores(docs, seeds, F.col("doc_id") != 5)
    assert topics(got) == topics(scoring.topic_scores(weights, docs.where("doc_id != 5"), seeds, vec))
    assert "term#" not in plan(got) and len(topics(got)) == 63      # no row for each (document, term) is shuffled


def test_topics_of_rows_that_share_an_id(spark):
    docs = spark.createDataFrame([*DOCS, (3, "pot4 w6"), (None, "tea w1")], "doc_id long, cleaned_text string")
    seeds = spark.createDataFrame(SEEDS, "label string, seed_text string")
    vec, weights = tfidf.fit_transform(docs, max_features=None)
    assert topics(scoring.own_topic_scores(docs, seeds, docs)) == topics(scoring.topic_scores(weights, docs, seeds, vec))


def test_a_model_is_not_held_whole(spark, monkeypatch):
    rows = [(i, f"w{i % 3} tea pot{i % 5} tea", f"l{i % 3}", ("en", "fr", None)[i % 3 if i < 50 else 0]) for i in range(60)]
    docs = spark.createDataFrame(rows + [(60, "unknown", "l0", "en"), (61, "tea", "l0", "xx"), (3, "tea w1", "l1", "fr")],
                                 "doc_id long, cleaned_text string, label string, language string").repartition(3)
    model = M.train_nb(docs.where("doc_id < 40"), group_cols=["language"])
    terms = M.with_terms(docs)
    scores = lambda: sorted((r[0], r[1], round(r[2], 9)) for r in NB.log_scores(terms, "doc_id", "_terms", model).collect())
    want = scores()
    monkeypatch.setattr(NB, "FEW_ROWS", 0)
    assert scores() == want and len(want) == 45
    assert "feature" not in "".join(x for x in plan(NB.log_scores(terms, "doc_id", "_terms", model)).splitlines() if "Generate" in x)


def test_features_are_counted_in_blocks(spark):
    docs = spark.createDataFrame([("x", ["a", "b", "a"]), ("x", ["a", None]), (None, ["b"]), ("y", [])], "label string, f array<string>").coalesce(1)
    found = packed.feature_counts(docs, ["label"], "f")
    assert sorted(map(tuple, found.collect()), key=str) == sorted([("x", "a", 3), ("x", "b", 1), ("x", None, 1), (None, "b", 1)], key=str)


def test_a_block_ends_at_its_number_of_terms():
    batch = pa.RecordBatch.from_pydict({"terms": pa.array([["a"] * 3, ["b"] * 9, [], ["c"] * 2, ["d"], None], pa.list_(pa.string()))})
    assert [[len(x or []) for x in t["terms"].to_pylist()] for t in packed.runs(iter([batch, batch.slice(3)]), 4)] == [[3], [9], [0, 2, 1, 0], [2, 1, 0]]


def test_packed_numbers_come_back():
    arrays = [np.arange(300), np.zeros(0, np.int64), np.array([0.1, -2.0]), np.array([-1, 7]), np.frombuffer(b"text", np.uint8)]
    assert [x.tolist() for x in packed.unpack(packed.pack(*arrays))] == [x.tolist() for x in arrays]


def test_trigrams_are_counted_from_the_characters(spark):
    docs = spark.createDataFrame([("x", " ab abمً "), ("x", " ab "), ("y", "  "), (None, "abc"), ("z", None)], "label string, s string")
    grams = docs.withColumn("f", langid.trigrams_of_normalized(F.col("s")))
    want = grams.select("label", F.explode("f").alias("feature")).groupBy("label", "feature").count()
    got = packed.trigram_counts(docs, ["label"], "s").groupBy("label", "feature").agg(F.sum("c"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_a_language_model_counts_wide_characters_as_the_pattern_does(spark):
    docs = spark.createDataFrame([("a\U0001F600b c", "en"), ("abc abd", "en"), ("xyz", "fr"), ("abc", "")], "text string, lang string")
    d = docs.where("lang <> ''").select("lang", langid.trigrams_of_normalized(langid.normalized(F.col("text"))).alias("grams"))
    rows = lambda m: sorted((r["feature"], r["label"], round(r["log_p"], 9)) for r in m.cond.collect())
    got, want = langid.train(docs), NB.fit(d, "lang", "grams")
    assert rows(got) == rows(want) and sorted(map(tuple, got.priors.collect())) == sorted(map(tuple, want.priors.collect()))
    assert langid.train(docs).cond.where(F.length("feature") < 3).isEmpty()


def test_tuned_models_predict_without_a_row_for_each_feature_and_label(spark, monkeypatch):
    rows = spark.createDataFrame([("en", i, f"tea w{i % 4} tea x{i % 3}", f"l{i % 4}") for i in range(20)] + [("en", 20, "nothing known", "l1")] * 2,
                                 "language string, doc_id long, cleaned_text string, label string")
    model = tuning.count_model(rows.where("doc_id < 12"), ["language"])
    c = {(r["feature"], r["label"]): r["c"] for r in model.features.collect()}
    n = {r["label"]: r["n"] for r in model.documents.collect()}
    total, vocab = {x: sum(v for (_, y), v in c.items() if y == x) for x in n}, {f for f, _ in c}

    def best(text):
        words = [w for w in text.split() if w in vocab]
        s = {x: np.log(n[x] / sum(n.values())) + sum(np.log((c.get((w, x), 0) + 1) / (total[x] + len(vocab))) for w in words) for x in n}
        return min((-round(v, 6), x) for x, v in s.items())[1]

    want = {r["doc_id"]: best(r["cleaned_text"]) for r in rows.collect()}
    for block in (1 << 20, 2):
        monkeypatch.setattr(packed, "BLOCK", block)
        got = tuning.predict(rows, model)
        assert {r["doc_id"]: r["prediction"] for r in got.collect()} == want and got.count() == 22
        assert "FlatMapCoGroupsInArrow" in plan(got)


def test_a_topic_scorer_of_documents_fits_them_once(spark, monkeypatch):
    docs = spark.createDataFrame(DOCS[:40], "doc_id long, cleaned_text string")
    seeds, calls = spark.createDataFrame(SEEDS, "label string, seed_text string"), []
    fit = scoring.own_topic_scores
    monkeypatch.setattr(scoring, "own_topic_scores", lambda *a: calls.append(1) or fit(*a))
    scorer, want = scoring.own_topic_scorer(docs, seeds), scoring.topic_scorer(seeds, tfidf.fit(docs, max_features=None))
    key = lambda df: {r["doc_id"]: (r["label"], round(r["score"], 9)) for r in df.collect()}
    for some in (docs, docs.where("doc_id < 7")):
        assert key(apply_scorer(some, scorer)) == key(apply_scorer(some, want))
    assert len(calls) == 1
