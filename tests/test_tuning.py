"""Label dictionaries, warm starts and grouped evaluation against plain loops."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from inkwell.operators import evaluate, labels, tuning
from inkwell.session import scratch_path

ROWS = "language string, task string, doc_id long, cleaned_text string, label string"


@pytest.mark.parametrize("parts", [None, 1, 7])
def test_label_ids_are_dense_in_order(spark, parts):
    names = [f"l{(i * 7919) % 12000:05d}" for i in range(12000)] + ["l00001", None, ""]
    df = spark.createDataFrame([(x,) for x in names], "label string").repartition(5)
    lmap = labels.label_map(df, partitions=parts)
    assert [r["id"] for r in lmap.orderBy("label").collect()] == list(range(12001))
    back = labels.decode(labels.encode(df, lmap), lmap, out_col="again")
    assert back.where(~F.col("label").eqNullSafe(F.col("again"))).count() == 0 and back.count() == len(names)
    with pytest.raises(ValueError):
        labels.label_map(df.where("label = '' OR label IS NULL"))


def rows(n=160):
    rng = random.Random(3)
    out = []
    for i in range(n):
        lang, label = rng.choice(["en", "en", "en", "fr"]), rng.choice(["x", "y", "z"])
        words = [rng.choice([label * 3, "common", "word", f"w{rng.randint(0, 9)}", lang * 2]) for _ in range(rng.randint(0, 6))]
        out.append((lang, "t", i, " ".join(words), label))
        out.append((lang, "u", i, " ".join(words), "only" if lang == "fr" else rng.choice(["p", "q"])))
    return out


def plain(features, documents, text, alpha=1.0):
    """Multinomial naive Bayes from counts: {label: score}."""
    vocab = {f for c in features.values() for f in c}
    known = [w for w in text.split() if w in vocab]
    total = sum(documents.values())
    return {label: round(math.log(n / total) + sum(math.log((features.get(label, {}).get(w, 0) + alpha)
                         / (sum(features.get(label, {}).values()) + alpha * len(vocab))) for w in known), 6) for label, n in documents.items()}


def test_stored_model_is_tuned_and_both_are_compared(spark):
    data = rows()
    run = tuning.tune_and_compare(spark.createDataFrame(data, ROWS).repartition(4), epochs=3)
    splits = {}
    for lang, task in {(r[0], r[1]) for r in data}:
        mine = [r for r in data if r[:2] == (lang, task)]
        if len({r[4] for r in mine}) > 1:
            order = sorted(mine, key=lambda r: (__import__("hashlib").md5(f"42:{r[2]}".encode()).hexdigest(), r[2]))
            n = len(order)
            splits[lang, task] = order[:int(0.7 * n)], order[int(0.85 * n):]
    assert ("fr", "u") not in splits
    own = {k: ({}, Counter()) for k in splits}
    for k, (train, _) in splits.items():
        for r in train:
            own[k][0].setdefault(r[4], Counter()).update(r[3].split())
            own[k][1][r[4]] += 1
    want = {}
    for k, (_, test) in splits.items():
        base, docs = {}, Counter()
        for (_, task), (f, d) in own.items():
            if task == k[1]:
                for label, c in f.items():
                    base.setdefault(label, Counter()).update(c)
                docs.update(d)
        tuned = {label: base[label] + Counter({w: 3 * x for w, x in own[k][0].get(label, {}).items()}) for label in base}
        more = docs + Counter({label: 3 * x for label, x in own[k][1].items()})
        for r in test:
            for model, f, d in (("original", base, docs), ("finetuned", tuned, more)):
                s = plain(f, d, r[3])
                want[(*k, r[2], model)] = (r[4], min(s, key=lambda x: (-s[x], x)))
    got = {(r["language"], r["task"], r["doc_id"], r["model"]): (r["label"], r["prediction"]) for r in run.predictions.collect()}
    assert got == want


def test_stored_counts_survive_and_merge(spark):
    old = spark.createDataFrame([("t", "x", "aa bb"), ("t", "y", "cc")], "task string, label string, cleaned_text string")
    new = spark.createDataFrame([("t", "x", "aa dd"), ("t", "z", "ee")], "task string, label string, cleaned_text string")
    path = scratch_path(spark, "counts")
    tuning.save(tuning.count_model(old, ["task"]), path)
    tuned = tuning.tune(tuning.load(spark, path), tuning.count_model(new, ["task"]), 2)
    assert {(r["label"], r["feature"]): r["c"] for r in tuned.features.collect()} == {
        ("x", "aa"): 3, ("x", "bb"): 1, ("x", "dd"): 2, ("y", "cc"): 1, ("z", "ee"): 2}
    assert {r["label"]: r["n"] for r in tuned.documents.collect()} == {"x": 3, "y": 1, "z": 2}


def test_grouped_report_equals_the_report_of_each_group(spark):
    rng = random.Random(5)
    data = [(g, rng.choice("abc"), rng.choice("abcd")) for g in ("g1", "g2") for _ in range(60)] + [("g3", "a", "a")]
    pred = spark.createDataFrame(data, "g string, label string, prediction string")
    got = {r["g"]: r for r in evaluate.grouped_report(pred, ["g"]).collect()}
    line = lambda r: (r["name"], *(None if r[c] is None else round(r[c], 12) for c in ("precision", "recall", "f1")), r["support"])
    for g in ("g1", "g2", "g3"):
        own = pred.where(F.col("g") == g)
        assert sorted(map(line, got[g]["report"])) == sorted(map(line, evaluate.report(own).collect()))
        s = evaluate.summary(own).first()
        assert all(abs(got[g][c] - s[c]) < 1e-12 for c in ("accuracy", "weighted_f1", "macro_f1")) and got[g]["n"] == s["n"]
    assert [r["name"] for r in got["g1"]["report"]] == ["a", "b", "c", "d", "accuracy", "macro avg", "weighted avg"]


def test_groups_of_any_size_are_split_exactly(spark):
    df = spark.createDataFrame([("big" if i % 5 else "small", i) for i in range(1003)] + [("one", 5000)], "g string, doc_id long")
    got = tuning.split_groups(df, ["g"]).groupBy("g", "split").count().collect()
    counts = {(r["g"], r["split"]): r["count"] for r in got}
    for g, n in (("big", 802), ("small", 201), ("one", 1)):
        c = [counts.get((g, s), 0) for s in ("train", "val", "test")]
        assert c == [int(0.7 * n), int(0.85 * n) - int(0.7 * n), n - int(0.85 * n)]
