"""Rows that operators must treat alike: in any order, with repeated ids, odd names, and past the bounds of one pass."""

import random

import numpy as np
import pytest

from inkwell.llm import lattice_dedup, soft_mixing, token_parquet, toxic_segments, url_cascade, weak_quality
from inkwell.llm.queries import tokenizer_path
from inkwell.session import scratch_path


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    """Documents with extra columns whose names hold dots or are the operators' own, and their labels."""
    rng, rows, labels = random.Random(3), [], []
    for i in range(240):
        w = prose(5000 + i, 50).split()
        if i % 6 == 0:
            for _ in range(5):
                w[rng.randrange(50)] = rng.choice(["vilea", "vileb", "vilec"])
        rows.append((i, " ".join(w), "en", 0.5, i, "x"))
        labels.append((i, int(i % 6 == 0), int(i % 6 != 1)))
    rows += [(300, None, "en", None, None, None), (301, "", "en", 0.5, 1, "x"), (None, prose(7, 9), None, 0.5, 1, "x"),
             (302, "vilea vileb " * 5 + prose(8, 60_000), "en", 0.5, 1, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, toxicity double, `meta.source` int, __best string")
    return df, spark.createDataFrame(labels, "doc_id long, toxic int, quality int")


def test_toxicity_does_not_depend_on_the_order_of_rows(spark, corpus):
    docs, labels = corpus
    rows = [r.asDict() for r in toxic_segments.training_rows(docs, labels).collect()]
    models = []
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame([(r["t"], r["y"]) for r in rows], "t string, y boolean").coalesce(seed)
        models.append(toxic_segments.fit(df))
    a, b = (m.shard(0) for m in models)
    assert np.array_equal(a[0], b[0]) and np.array_equal(a[1], b[1])
    assert models[0].slope == pytest.approx(models[1].slope) and models[0].slope > 0


def test_toxicity_in_shards_scores_alike(corpus, monkeypatch):
    docs, labels = corpus
    rows = toxic_segments.training_rows(docs, labels)
    whole = toxic_segments.fit(rows)
    size = len(whole.shard(0)[0])
    monkeypatch.setattr(toxic_segments, "SHARD_UNITS", max(1, -(-size // 4)))
    parts = toxic_segments.fit(rows)
    assert whole.shards == 1 and parts.shards in (3, 4)
    assert (parts.lam, parts.k, parts.offset, parts.slope) == pytest.approx((whole.lam, whole.k, whole.offset, whole.slope))
    columns = [*docs.columns, "toxicity_"]
    got = [toxic_segments.score(docs, m) for m in (whole, parts)]
    assert [g.columns for g in got] == [columns, columns]
    one, two = ({r["doc_id"]: r["toxicity_"] for r in g.collect()} for g in got)
    assert one == pytest.approx(two) and len(one) == 244
    assert {i for i, p in one.items() if p >= 0.5 and i is not None and i < 240} == {i for i in range(0, 240, 6)}
    assert one[302] >= 0.5 and one[300] < 0.5 and one[301] < 0.5


def test_evidence_has_no_step(spark):
    rows = [(bits, 400, 20, (1 << bits) - 1 if bits < 63 else -1) for bits in range(20, 63)]
    df = spark.createDataFrame(rows, "unit long, toxic long, clean long, seen long")
    got = {r.unit: r.score for r in toxic_segments._log_odds(df, 50_000.0, 1_000_000.0).collect()}
    steps = [got[b + 1] - got[b] for b in range(30, 62) if b in got and b + 1 in got]
    assert len(steps) > 20 and min(steps) >= -1e-9 and max(steps) < 0.35


def test_dotted_and_clashing_names_stay(corpus):
    docs, labels = corpus
    for out in (toxic_segments.drop_toxic(docs, labels, fold=None), soft_mixing.mix_sources(docs, labels)):
        assert out.columns == docs.columns and 150 < out.count()
        assert out.where("`meta.source` IS NULL").count() <= 1
    scored = weak_quality.score(docs, weak_quality.fit(docs))
    assert scored.columns == [*docs.columns, "quality", "weak_label", "keep"] and scored.count() == 244


def test_infeasible_targets_end_at_the_least_squares(corpus):
    docs, labels = corpus
    model = soft_mixing.fit_domains(soft_mixing.labelled_rows(docs, labels))
    alike = soft_mixing.DomainModel(model.domains, np.zeros_like(model.weights), np.log([0.5, 0.5]))
    mixed = soft_mixing.fit_mixture(docs, alike, weights={model.domains[0]: 1.0})
    assert mixed.totals[0] == pytest.approx(mixed.totals[1]) and abs(mixed.residual).max() > 0.4
    assert soft_mixing.with_rates(docs, alike, mixed).count() == 244


def test_rows_of_an_id_share_a_component(spark):
    a, b = [1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0]
    rows = [(3, a, 1), (7, a, 1), (7, b, 1), (9, b, 1), (9, b, 1), (9, None, 1), (8, b, 2), (8, a, None)]
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "vec_id long, embedding array<double>, label int")
        got = sorted((r.id, r.n_links, r.component, r.kept) for r in lattice_dedup.near_duplicate_vectors(df).collect())
        assert got == sorted([(3, 1, 3, True), (7, 1, 3, False), (7, 2, 3, False), (9, 2, 3, False), (9, 2, 3, False), (9, 0, 3, False),
                              (8, 0, 8, True), (8, 0, 8, True)])


def test_url_rules_lower_ascii_only(spark):
    pages = spark.createDataFrame([(1, "http://İx.com/a"), (2, "http://A.İX.COM/a"), (3, "http://ix.com/a")], "page_id long, url string")
    rules = spark.createDataFrame([("İX.com/", "block")], "rule string, verdict string")
    got = {r.id: (r.host, r.verdict) for r in url_cascade.judge_urls(pages, rules).collect()}
    assert got == {1: ("İx.com", "block"), 2: ("a.İx.com", "block"), 3: ("ix.com", "allow")}


def test_a_hot_id_is_dealt_to_several_token_files(spark):
    rows = [(None, prose(i, 6)) for i in range(600)] + [(i, prose(i, 6)) for i in range(30)]
    path, setting = scratch_path(spark, "tokens"), "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")  # small parts are put together otherwise
    try:
        token_parquet.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), path, tokenizer_path())
    finally:
        spark.conf.unset(setting)
    stored = spark.read.parquet(path)
    files = stored.where("doc_id IS NULL").groupBy("_metadata.file_name").count().collect()
    assert len(files) > 1 and max(r["count"] for r in files) < 600
    starts = sorted(token_parquet.token_starts(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in starts] == [None] * 600 + list(range(30))
    at = 0
    for r in starts:
        assert r.start == at
        at += r.n_tokens
