"""Scorer hook, classification, the classified table, centroids and score maps."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from inkwell.operators import scoring, tfidf
from inkwell.operators.scorers import ArrowScorer, FrameScorer, apply_scorer
from inkwell.session import scratch_path
from inkwell.sources.classified import read_classified, write_classified

ROWS = [(1, "good day", "en"), (2, " \t", "en"), (3, None, "fr"), (4, "bad luck", "fr"), (5, "boom", "de"), (6, "odd", "de")]


@pytest.fixture
def texts(spark):
    return spark.createDataFrame(ROWS, "doc_id long, cleaned_text string, language string")


def outside():
    """Loads a model from elsewhere: it fails on one word, and gives no label for another."""

    def load():
        def model(texts):
            if any("boom" in t for t in texts):
                raise RuntimeError("model failure")
            return [(None, 0.4) if t == "odd" else ("pos", 0.9) if "good" in t else ("neg", 0.8) for t in texts]

        return model

    return load


@pytest.mark.parametrize("batch", [1, 2, 64])
def test_outside_scorer_through_arrow(texts, batch):
    got = {r["doc_id"]: (r["label"], r["score"]) for r in apply_scorer(texts.coalesce(1), ArrowScorer(outside(), batch)).collect()}
    assert got == {1: ("pos", 0.9), 2: ("EMPTY", 0.0), 3: ("EMPTY", 0.0), 4: ("neg", 0.8), 5: ("ERROR", 0.0), 6: ("ERROR", 0.0)}


def test_a_model_that_gives_too_few_labels_is_tried_text_by_text(texts):
    short = ArrowScorer(lambda: lambda ts: [("x", 1.0)], 64)
    got = {r["doc_id"]: r["label"] for r in apply_scorer(texts, short).collect()}
    assert got == {1: "x", 2: "EMPTY", 3: "EMPTY", 4: "x", 5: "x", 6: "x"}


def test_several_rows_for_an_id_are_an_error(texts):
    twice = FrameScorer(lambda rows: rows.select("id", F.lit("a").alias("label"), F.lit(1.0).alias("score"))
                        .unionByName(rows.select("id", F.lit("b").alias("label"), F.lit(1.0).alias("score"))))
    with pytest.raises(PySparkException, match="several rows for id"):
        apply_scorer(texts, twice).collect()


def test_missing_rows_become_errors_and_more_columns_pass(texts):
    some = FrameScorer(lambda rows: rows.where("id = 1").select("id", F.lit("a").alias("label"), F.lit(1.0).alias("score"),
                                                              F.col("language").alias("extra")), context=("language",))
    got = {r["doc_id"]: (r["label"], r["extra"]) for r in apply_scorer(texts, some).collect()}
    assert got[1] == ("a", "en") and got[4] == ("ERROR", None) and got[2] == ("EMPTY", None)


def constant(label):
    return FrameScorer(lambda rows: rows.select("id", F.lit(label).alias("label"), F.length("text").cast("double").alias("score")))


def test_title_stands_in_for_the_text(spark):
    rows = [(1, "body", "t", "en"), (2, "", "title only", "en"), (3, None, "x", "fr"), (4, "", "", "en")]
    c = spark.createDataFrame(rows, "doc_id long, cleaned_text string, title string, language string")
    loose = scoring.classify(c, constant("m"), constant("t"), require_text=False).collect()
    assert {r["doc_id"]: r["sentiment_score"] for r in loose} == {1: 4.0, 2: 10.0, 3: 1.0}
    strict = scoring.classify(c, constant("m"), constant("t"), ["en"])
    assert [r["doc_id"] for r in strict.collect()] == [1] and "label_scores" in strict.columns
    everything = scoring.classify(c, constant("m"), constant("t"), require_text=False, valid_only=False)
    assert {r["doc_id"]: r["sentiment"] for r in everything.collect()}[4] == "EMPTY"


def test_one_language_is_written_again_without_the_others(spark):
    path = scratch_path(spark, "classified")
    make = lambda rows: spark.createDataFrame(rows, "doc_id long, language string, m map<string,double>")
    first = make([(1, "en", {"a": 0.5}), (2, "fr", None), (3, "fr", {}), (4, "de", {"b": 1.0})])
    write_classified(first, path, ["en", "fr", "de", "ar"])
    read = lambda *l: sorted((r["doc_id"], r["language"], r["m"]) for r in read_classified(spark, path, first.schema, list(l) or None).collect())
    assert read() == [(1, "en", {"a": 0.5}), (2, "fr", None), (3, "fr", {}), (4, "de", {"b": 1.0})]
    write_classified(make([(9, "fr", {"z": 0.25})]), path, ["fr"])
    assert read() == [(1, "en", {"a": 0.5}), (4, "de", {"b": 1.0}), (9, "fr", {"z": 0.25})]
    write_classified(make([]), path, ["en"])        # a language that has no articles any more
    assert read() == [(4, "de", {"b": 1.0}), (9, "fr", {"z": 0.25})] and read("en") == [] and len(read("fr")) == 1
    with pytest.raises(PySparkException, match="not written"):
        write_classified(make([(5, "es", None)]), path, ["fr"])
    for bad in ([], [""]):
        with pytest.raises(ValueError):
            write_classified(first, path, bad)


VECTORS = [(1, [1.0, 0.0], "b"), (2, [0.0, 2.0], "a"), (3, [1.0, 1.0], None), (4, [0.0, 0.0], "c"), (5, None, "a"), (6, [], "b"),
           (7, [3.0], "d"), (8, [0.0, 1.0, 5.0], "e"), (9, [-1.0, 0.1], "b"), (10, [1.0, None], "f")]


@pytest.mark.parametrize("limit", [1, 200, None])
def test_centroids_by_hand_in_any_number_of_blocks(spark, limit):
    v = spark.createDataFrame(VECTORS, "vec_id long, embedding array<double>, label string")
    got = {r["vec_id"]: (r["predicted"], round(r["cosine"], 9)) for r in scoring.centroid_scores(v, matrix_bytes=limit).collect()}
    means = {}
    for _, e, label in VECTORS:
        for i, x in enumerate(e or []):
            if x is not None and label is not None:
                means.setdefault(label, {}).setdefault(i, []).append(x)
    means = {k: {i: sum(x) / len(x) for i, x in c.items()} for k, c in means.items()}
    norm = lambda c: sum(x * x for x in c.values()) ** 0.5
    want = {}
    for i, e, _ in VECTORS:
        if e:
            own = {k: x for k, x in enumerate(e) if x is not None}
            cos = {k: sum(x * c.get(p, 0.0) for p, x in own.items()) / (norm(own) * norm(c)) if norm(own) and norm(c) else 0.0
                   for k, c in means.items()}
            best = min(cos, key=lambda k: (-cos[k], k))
            want[i] = (best, round(cos[best], 9))
    assert got == want


def test_no_vector_is_taken_apart(spark):
    v = spark.createDataFrame(VECTORS, "vec_id long, embedding array<double>, label string")
    plan = scoring.centroid_scores(v)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Exchange" not in plan.split("Subquery")[0]


def test_score_map_holds_the_whole_distribution(spark):
    docs = spark.createDataFrame([(1, "red apple pie"), (2, "green tea"), (3, "nothing shared"), (4, "apple tea tea")], "doc_id long, cleaned_text string")
    seeds = spark.createDataFrame([("fruit", "red apple"), ("tea", "green tea"), ("none", "zebra")], "label string, seed_text string")
    vec, w = tfidf.fit_transform(docs, max_features=None)
    t = scoring.topic_scores(w, docs, seeds, vec).withColumn("all", F.array(*[F.lit(x) for x in ("fruit", "none", "tea")]))
    rows = t.select("doc_id", "topic", "topic_score", "label_scores",
                    scoring.full_scores(F.col("label_scores"), F.col("absent_score"), F.col("all")).alias("m")).collect()
    for r in rows:
        assert abs(sum(r["m"].values()) - 1) < 1e-12 and set(r["m"]) == {"fruit", "none", "tea"}
        assert abs(max(r["m"].values()) - r["topic_score"]) < 1e-12 and abs(r["m"][r["topic"]] - r["topic_score"]) < 1e-12
    assert {r["doc_id"]: set(r["label_scores"]) for r in rows}[3] == set()
