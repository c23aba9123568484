"""Metrics, exact split sizes, label map, naive Bayes and topic-score invariants."""

import math

import pytest
from pyspark.sql import functions as F

from inkwell.operators import evaluate as EV
from inkwell.operators import models as M
from inkwell.operators import naive_bayes as NB


def test_metrics_golden(spark):
    pred = spark.createDataFrame([("0", "0"), ("0", "1"), ("1", "1"), ("1", "2"), ("2", "0")],
                                 "label string, prediction string")
    s = EV.summary(pred).first()
    assert s["accuracy"] == pytest.approx(0.4)
    assert s["weighted_f1"] == pytest.approx(0.4)
    rep = {r["name"]: r for r in EV.report(pred).collect()}
    assert rep["accuracy"]["f1"] == pytest.approx(0.4) and rep["accuracy"]["support"] == 5
    assert rep["macro avg"]["f1"] == pytest.approx(1 / 3)


def test_metrics_predicted_only_and_never_predicted_class(spark):
    pred = spark.createDataFrame([("a", "a"), ("a", "c"), ("b", "a")], "label string, prediction string")
    pc = {r["class"]: r for r in EV.per_class(pred).collect()}
    assert set(pc) == {"a", "b", "c"}
    assert pc["c"]["support"] == 0 and pc["c"]["precision"] == 0.0      # only predicted
    assert pc["b"]["recall"] == 0.0 and pc["b"]["precision"] == 0.0     # never predicted
    s = EV.summary(pred).first()
    assert s["accuracy"] == pytest.approx(1 / 3)


@pytest.mark.parametrize("n", [0, 1, 7, 10, 20, 90])
def test_split_sizes_exact(spark, n):
    df = spark.range(n).withColumnRenamed("id", "doc_id")
    s = M.split(df)
    sizes = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    train, val = int(0.7 * n), int(0.85 * n) - int(0.7 * n)
    assert sizes.get("train", 0) == train and sizes.get("val", 0) == val
    assert sizes.get("test", 0) == n - train - val
    assert s.select("rank").distinct().count() == n
    if n == 90:
        assert (train, val, n - train - val) == (62, 14, 14)


def test_global_rank_many_buckets(spark):
    df = spark.range(5000).withColumnRenamed("id", "doc_id")
    r = M.global_rank(df, M.split_key("doc_id", 42), "doc_id", 5000)
    ranks = sorted(x[0] for x in r.select("rank").collect())
    assert ranks == list(range(5000))


def test_label_map_and_single_label_error(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",)], "label string")
    assert [(r["label"], r["id"]) for r in M.label_map(df).orderBy("id").collect()] == [("a", 0), ("b", 1)]
    with pytest.raises(ValueError):
        M.label_map(spark.createDataFrame([("a",)], "label string"))


def test_naive_bayes_matches_hand_computation(spark):
    train = spark.createDataFrame([(1, "pos", ["good", "great"]), (2, "pos", ["good"]), (3, "neg", ["bad"])],
                                  "id int, label string, f array<string>")
    model = NB.fit(train, "label", "f")
    test = spark.createDataFrame([(10, ["good", "bad", "good"])], "id int, f array<string>")
    r = NB.predict(test, "id", "f", model).first()
    v = 3  # distinct features
    lp_pos = math.log(2 / 3) + 2 * math.log((2 + 1) / (3 + v)) + math.log((0 + 1) / (3 + v))
    lp_neg = math.log(1 / 3) + 2 * math.log((0 + 1) / (1 + v)) + math.log((1 + 1) / (1 + v))
    assert r["label"] == ("pos" if lp_pos > lp_neg else "neg")
    p = 1 / (1 + math.exp(min(lp_pos, lp_neg) - max(lp_pos, lp_neg)))
    assert r["prob"] == pytest.approx(p)


def test_valid_predictions_filter(spark):
    df = spark.createDataFrame([(1, "pos", "t"), (2, "ERROR", "t"), (3, "pos", "ERROR"), (4, "EMPTY", "EMPTY"),
                                (5, None, "t")], "id int, sentiment string, topic string")
    assert [r["id"] for r in M.valid_predictions(df).collect()] == [1]


def test_naive_bayes_takes_any_label(spark):
    from inkwell.operators import naive_bayes

    df = spark.createDataFrame([("sci.space", ["a", "b"]), ("it`s", ["c"]), ("sci.space", ["a"])], "label string, f array<string>")
    model = naive_bayes.fit(df, "label", "f")
    assert {r.label for r in model.cond.collect()} == {"sci.space", "it`s"} and model.cond.count() == 6
