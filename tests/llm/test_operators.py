"""Small tests of the training-data operators: planted cases, brute force, and odd rows."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from inkwell.llm import (decontaminate, graph, lattice_dedup, minmax_dedup, queries, quote_link, soft_mixing, token_parquet,
                         toxic_segments, url_cascade, warc_chain, weak_quality)
from inkwell.session import scratch_path

DOC = "doc_id long, text string, lang string, kept string, score double"  # names that the operators use themselves
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def doc(i, text, lang="en"):
    return (i, text, lang, "x", 0.5)


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


def shingles(text, n):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def components(sets, percent):
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and 100 * both >= percent * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            up[y] = x
    return {i: root(i) for i in sets}


@pytest.fixture(scope="module")
def docs(spark):
    base = prose(1, 120)
    rows = [doc(i, prose(100 + i, 60)) for i in range(30)]
    rows += [doc(40 + i, base) for i in range(5)]
    for i in range(12):  # near copies, some of them too far from the first
        w = base.split()
        for k in range(i):
            w[(7 * k + i) % 120] = f"new{i}x{k}"
        rows.append(doc(60 + i, " ".join(w)))
    rows += [doc(80, None), doc(81, ""), doc(82, " \t\n"), doc(83, "One"), doc(84, "one"), doc(85, "a b c"), doc(86, "a b d"),
             doc(87, "y" * 300_000 + " z"), doc(88, prose(5, 20_000)), doc(89, prose(5, 20_000) + " end")]
    return spark.createDataFrame(rows, DOC)


def test_near_duplicates_match_brute_force(docs):
    for n in (4, 5):
        sets = {r.doc_id: shingles(r.text, n) for r in docs.collect()}
        want = components(sets, 80)
        got = minmax_dedup.near_duplicates(docs, words=n, percent=80).collect()
        assert {r.id: r.component for r in got} == want
        assert {r.id: r.n_shingles for r in got} == {i: len(s) for i, s in sets.items()}
        assert all(r.kept == (r.id == r.component) for r in got)


def test_near_duplicates_of_odd_rows(spark, docs):
    assert minmax_dedup.near_duplicates(docs.limit(0)).collect() == []
    text = prose(3, 50)
    odd = spark.createDataFrame([doc(None, text), doc(7, text), doc(7, text), doc(7, prose(4, 50)), doc(9, prose(4, 50)), doc(None, None)], DOC)
    got = {(r.id, r.n_shingles, r.component, r.kept) for r in minmax_dedup.near_duplicates(odd).collect()}
    assert got == {(None, 46, 7, False), (7, 46, 7, True), (9, 46, 7, False), (None, 0, None, True)}
    kept = minmax_dedup.drop_near_duplicates(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()).count((False, 7)) == 2


def test_near_duplicates_are_dropped_row_by_row(spark):
    a, b, c, near = prose(21, 60), prose(22, 60), prose(23, 60), prose(21, 60) + " more"
    rows = [doc(None, a), doc(7, a), doc(None, b), doc(None, prose(24, 60)), doc(None, None), doc(None, None), doc(None, ""), doc(9, near),
            doc(9, c), doc(9, None), doc(3, ""), doc(3, ""), doc(12, c), doc(7, prose(25, 60)), doc(None, b), doc(15, prose(26, 60)),
            doc(15, prose(26, 60)), doc(None, b + " more")]
    kept = minmax_dedup.drop_near_duplicates(spark.createDataFrame(rows, DOC))
    want = [(7, a), (None, None), (None, None), (None, ""), (None, prose(24, 60)), (9, c), (9, None), (3, ""), (3, ""), (7, prose(25, 60)),
            (15, prose(26, 60))]
    got = [(r.doc_id, r.text) for r in kept.collect()]
    of_b = [x for x in got if x[0] is None and (x[1] or "").startswith(b)]
    assert len(of_b) == 1 and sorted(map(repr, got)) == sorted(map(repr, want + of_b))
    unique = spark.createDataFrame([doc(i, prose(30 + i, 40)) for i in range(20)], DOC)
    assert minmax_dedup.drop_near_duplicates(unique).count() == 20 and minmax_dedup.drop_near_duplicates(unique.limit(0)).count() == 0


def test_a_family_without_links_stays_apart_and_blocks_agree(spark, monkeypatch):
    shared = prose(11, 150).split()
    rows = []
    for i in range(60):  # all pairs near 0.7, a few linked
        w = list(shared)
        for k in range(5 if i % 10 else 1):
            w[(29 * k + 3 * i) % 150] = f"own{i}n{k}"
        rows.append(doc(i, " ".join(w)))
    df = spark.createDataFrame(rows, DOC)
    want = components({r[0]: shingles(r[1], 4) for r in rows}, 80)
    for block in (1024, 8):
        monkeypatch.setattr(minmax_dedup, "BLOCK", block)
        assert {r.id: r.component for r in minmax_dedup.near_duplicates(df, words=4).collect()} == want


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 50), (50, 70), (5, 5)]
    got = dict(graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, 50: 50, 70: 50, 100: 50}


def test_contained_items_match_brute_force(spark, docs):
    long_doc = prose(5, 20_000).split()
    items = [(1, " ".join(long_doc[500:530])), (2, " ".join(long_doc[900:906])), (3, prose(77, 40)), (4, None), (5, ""), (None, "x y"),
             (6, " ".join(long_doc[500:530]).upper()), (7, "ONE"), (8, " ".join(long_doc[10:40]) + " unknown words")]
    df = spark.createDataFrame(items, "item_id long, text string")
    by_set = {}
    for i, t in items:
        if i is not None and shingles(t, 5):
            by_set.setdefault(frozenset(shingles(t, 5)), i)
    want = {(r.doc_id, i) for r in docs.collect() for s, i in by_set.items() if 100 * len(s & shingles(r.text, 5)) >= 80 * len(s)}
    got = decontaminate.contained_items(docs, df).collect()
    assert {(r.id, r.item) for r in got} == want and (88, 1) in want and (83, 7) in want
    left = decontaminate.drop_contaminated(docs, df)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {r.doc_id for r in docs.collect()} - {d for d, _ in want}
    assert decontaminate.contained_items(docs, df.limit(0)).count() == 0


def test_contaminated_rows_go_alone(spark):
    item, clean = prose(51, 30), prose(52, 40)
    leak = "before " + item + " after"
    rows = [doc(None, leak), doc(None, clean), doc(None, None), doc(4, leak), doc(4, clean), doc(4, ""), doc(4, leak), doc(5, clean), doc(6, leak)]
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    for df in (spark.createDataFrame(rows, DOC), spark.createDataFrame(rows, DOC).limit(0)):
        got = sorted(map(repr, decontaminate.drop_contaminated(df, items).collect()))
        assert got == sorted(repr(r) for r in df.collect() if r.text != leak)
    df = spark.createDataFrame(rows, DOC)
    assert decontaminate.drop_contaminated(df, items.limit(0)).count() == len(rows)


def test_maximal_segments_match_the_definition():
    def slow(x):  # remove the best segment, go on at both sides
        best = max(((sum(x[a:b]), a - b, a, b) for a in range(len(x)) for b in range(a + 1, len(x) + 1)), default=None)
        if best is None or best[0] <= 0:
            return []
        _, _, a, b = best
        return slow(x[:a]) + [(a, b - 1)] + [(p + b, q + b) for p, q in slow(x[b:])]

    rng = random.Random(5)
    for _ in range(60):
        x = [rng.choice([-0.25] * 3 + [0.6, 1.7, 3.1]) + (rng.random() * 1e-3 if rng.random() < 0 else 0) for _ in range(rng.randint(1, 14))]
        at = np.array([i for i, v in enumerate(x) if v > 0], dtype=int)
        got = toxic_segments.maximal_segments(at, np.array([x[i] for i in at]))
        assert sum(s for _, _, s in got) == pytest.approx(sum(sum(x[a:b + 1]) for a, b in slow(x)))


def test_toxicity_learns_planted_words(spark):
    rng = random.Random(1)
    bad = ["vilea", "vileb", "vilec", "viled"]
    rows, labels = [], []
    for i in range(400):
        w = prose(1000 + i, 60).split()
        toxic = i % 8 == 0
        if toxic:
            for _ in range(6):
                w[rng.randrange(60)] = rng.choice(bad) + "!"
        rows.append(doc(i, " ".join(w)))
        labels.append((i, int(toxic)))
    rows += [doc(1000, None), doc(1001, ""), doc(None, "VILEA vileb, vilec viled"), doc(1000, "quiet words")]
    df, lab = spark.createDataFrame(rows, DOC), spark.createDataFrame(labels + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxic_segments.fit(toxic_segments.training_rows(df, lab, fold=5))
    got = toxic_segments.score(df, model, out="toxicity", passages="found").collect()
    wrong = [r.doc_id for r in got if r.doc_id is not None and r.doc_id < 1000 and (r.toxicity >= 0.5) != (r.doc_id % 8 == 0)]
    assert len(wrong) <= 2 and len(got) == len(rows)
    assert next(r for r in got if r.doc_id is None).toxicity >= 0.5
    assert "vile" in next(r for r in got if r.doc_id == 8).found[0]["text"].lower()
    assert all(r.toxicity < 0.5 for r in got if r.doc_id in (1000, 1001))
    kept = toxic_segments.drop_toxic(df, lab)
    assert kept.columns == df.columns and kept.where("doc_id IS NULL").count() == 0
    none = toxic_segments.fit(toxic_segments.training_rows(df, lab.limit(0)))
    assert toxic_segments.score(df, none).where("toxicity >= 0.5").count() == 0


def test_mixing_meets_targets(spark):
    words = {"en/1": "alpha beta gamma delta", "fr/1": "un deux trois quatre", "fr/0": "!!! ### $$$ %%%"}
    rows, labels, n = [], [], 0
    for name, count in (("en/1", 200), ("fr/1", 40), ("fr/0", 20)):
        for _ in range(count):
            rng = random.Random(n)
            rows.append(doc(n, " ".join(rng.choice(words[name].split()) for _ in range(20)), name[:2]))
            if n % 2:
                labels.append((n, int(name[-1])))
            n += 1
    df = spark.createDataFrame(rows + [doc(900, None), doc(None, ""), doc(0, "again", None)], DOC)
    lab = spark.createDataFrame(labels + [(None, 1), (2, None)], "doc_id long, quality int")
    model = soft_mixing.fit_domains(soft_mixing.labelled_rows(df, lab))
    assert model.domains == ["en/1", "fr/0", "fr/1"]
    mixed = soft_mixing.fit_mixture(df, model, weights={"en/1": 0.5, "fr/1": 0.5, "fr/0": 0.0})
    assert np.abs(mixed.totals - mixed.targets).max() < 0.01 * mixed.totals.sum()
    rated = soft_mixing.with_rates(df, model, mixed).collect()
    assert len(rated) == 263 and all(r.rate >= 0 for r in rated)
    assert np.abs(mixed.residual[[0, 2]]).max() < 1e-3 and len(mixed.steps) < soft_mixing.STEPS
    # the totals are those of the whole texts' own posteriors, which no rounding stands between
    total = {d: sum(r.rate * r.n_words * (r.domain == d) for r in rated) for d in model.domains}
    assert total["en/1"] == pytest.approx(mixed.targets[0], rel=0.02) and total["fr/1"] == pytest.approx(mixed.targets[2], rel=0.02)
    out = soft_mixing.mix_sources(df, lab)
    assert out.columns == df.columns and out.where("lang = 'en'").count() >= 199
    assert soft_mixing.mix_sources(df.limit(0), lab).count() == 0
    assert soft_mixing.mix_sources(df, lab.limit(0)).count() == df.count()


def test_token_files_round_trip(spark):
    from tokenizers import Tokenizer

    spec = queries.tokenizer_path()
    texts = [None, "", "Hello don't!!'s x!'s <|endoftext|>abc <|ENDOFTEXT|> a1b2", "ñ́! …!… İstanbul ΑΣ", "中文 字!字 ﬁ ǅ", "a" * 5000,
             prose(3, 400).title(), "x\x0by\xa0z"]
    df = spark.createDataFrame([doc(50 - i, t) for i, t in enumerate(texts)] + [doc(None, "null id"), doc(50, "again")], DOC)
    path = scratch_path(spark, "tokens")
    token_parquet.write_tokens(df, path, spec)
    tokenizer = Tokenizer.from_file(spec)
    want = sorted((r.doc_id if r.doc_id is not None else -1, tuple([*tokenizer.encode(r.text or "", add_special_tokens=False).ids, 1]))
                  for r in df.collect())
    stored = token_parquet.read_tokens(spark, path).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, tuple(r.input_ids)) for r in stored) == want
    starts = sorted(token_parquet.token_starts(spark, path).collect(), key=lambda r: r.start)
    at = 0
    for r in starts:
        assert r.start == at
        at += r.n_tokens
    by = {(r.doc_id, r.ids_crc32) for r in starts}
    assert by == {(None if i < 0 else i, zlib.crc32(np.array(t, "<u4").tobytes())) for i, t in want}
    assert [r.doc_id for r in starts] == sorted((r.doc_id for r in starts), key=lambda x: -1 if x is None else x)
    assert token_parquet.read_tokens(spark, path, (44, 46)).count() == 3
    empty = scratch_path(spark, "tokens")
    token_parquet.write_tokens(df.limit(0), empty, spec)
    assert token_parquet.token_starts(spark, empty).count() == 0


def test_tokenizer_gets_few_pieces_at_once():
    from tokenizers import Tokenizer

    with open(queries.tokenizer_path(), encoding="utf-8") as f:
        spec = f.read()
    coder, sent = token_parquet.PieceEncoder(spec), []

    class Counted:
        def encode_batch_fast(self, texts, **options):
            sent.append(sum(len(x.split()) for x in texts))
            return whole.encode_batch_fast(texts, **options)

    whole, coder.tokenizer = Tokenizer.from_str(spec), Counted()
    letters = "abcdefghijklmnopqrstuvwxyz"
    names = [a + b + c for a in letters for b in letters for c in letters]
    texts = [" ".join(names), None, " ".join(f"{x}'{x} {x}9!" for x in names[::5]), "", " ".join(names[::-1])]
    ids, first = coder.encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])] == [
        whole.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert len(coder.keys) > 2 * (1 << 13) and max(sent) <= 1 << 13


def test_token_files_have_dictionary_pages_and_indexes(spark):
    import glob

    import pyarrow.parquet as pq

    df = spark.createDataFrame([(i, prose(i, 50)) for i in range(300)], "doc_id long, text string")
    path = scratch_path(spark, "tokens")
    token_parquet.write_tokens(df, path, queries.tokenizer_path(), page_rows=16)
    meta = pq.ParquetFile(glob.glob(path.removeprefix("file:") + "/part-*")[0]).metadata
    columns = {meta.row_group(0).column(i).path_in_schema: meta.row_group(0).column(i) for i in range(meta.num_columns)}
    assert "RLE_DICTIONARY" in columns["input_ids.list.element"].encodings
    assert "DELTA_BINARY_PACKED" in columns["doc_id"].encodings
    assert all(c.has_offset_index and c.has_column_index for c in columns.values())


def test_embeddings_match_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.standard_normal((40, 64))
    vectors = [(i, list(map(float, base[i % 40] + rng.standard_normal(64) * rng.choice([0.02, 0.1, 0.14]))), i % 40 % 3) for i in range(200)]
    vectors += [(300, vectors[0][1], 0), (301, vectors[0][1], 0), (302, None, 0), (303, [0.0] * 64, 0), (304, [float("nan")] * 64, 0),
                (305, [1.0, 2.0], 0), (306, [2.0, 4.0], 0), (307, vectors[0][1], None), (308, [], 1), (309, [None, 1.0], 0), (310, [float("inf"), 1.0], 0)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, label int")
    sound = {i: np.array(v) for i, v, lab in vectors if v and lab is not None and None not in v and np.isfinite(v).all() and np.any(v)}
    label = {i: lab for i, _, lab in vectors}
    links = {i: set() for i in label}
    for a, b in itertools.combinations(sound, 2):
        if label[a] == label[b] and len(sound[a]) == len(sound[b]):
            if sound[a] @ sound[b] / np.linalg.norm(sound[a]) / np.linalg.norm(sound[b]) >= 0.98:
                links[a].add(b)
                links[b].add(a)
    got = lattice_dedup.near_duplicate_vectors(df).collect()
    assert {r.id: r.n_links for r in got} == {i: len(x) for i, x in links.items()}
    root = {i: i for i in links}
    for _ in links:
        root = {i: min([root[i], *(root[j] for j in links[i])]) for i in links}
    assert {r.id: r.component for r in got} == root
    assert lattice_dedup.near_duplicate_vectors(df.limit(0)).count() == 0


def test_e8_decoding_finds_the_nearest_point():
    x = np.random.default_rng(1).standard_normal((200, 8)) * 2
    c = lattice_dedup.nearest_e8(x)
    distance = ((x - c) ** 2).sum(axis=1)
    assert (distance <= 1 + 1e-9).all()
    around = ((x[:, None, :] - (c[:, None, :] + lattice_dedup.minimal_vectors()[None])) ** 2).sum(axis=2)
    assert (around >= distance[:, None] - 1e-9).all() and len(lattice_dedup.minimal_vectors()) == 240


def test_cascade_is_exact(spark, monkeypatch):
    from pyspark.sql import functions as F

    universe = spark.range(20_000).select(*url_cascade.hashes(F.col("id")))
    listed = spark.range(0, 20_000, 37).select(*url_cascade.hashes(F.col("id")))
    cascade = url_cascade.build_cascade(listed, universe)
    pdf = universe.toPandas()
    got = cascade.has(pdf.h1.to_numpy().view(np.uint64), pdf.h2.to_numpy().view(np.uint64))
    assert got.tolist() == [i % 37 == 0 for i in range(20_000)] and len(cascade.levels) > 1 and cascade.size < 10_000
    rows = [(1, "http://WWW.Example.com/en/x?q#f", "x"), (2, "https://a.example.com/en/", "x"), (3, "ftp://b.net/es/1", "x"), (4, "http://net/fr/", "x"),
            (5, "http://com", "x"), (6, None, "x"), (7, "no scheme", "x"), (8, "http://notexample.com/en/1", "x"), (None, "http://x.net/fr", "x"),
            (9, "a://b://c/d", "x"), (10, "", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, verdict string")
    rules = spark.createDataFrame(queries.URL_RULES + [(None, "block")], "rule string, verdict string")
    want = {1: "www.example.com/en/", 2: "example.com/en/", 3: "net/es/", 4: "net/fr/", 8: "com/"}
    for size in (url_cascade.SHARD_BYTES, 16):
        monkeypatch.setattr(url_cascade, "SHARD_BYTES", size)
        got = url_cascade.judge_urls(pages, rules).collect()
        assert {r.id: r.rule for r in got if r.rule} == want and len(got) == len(rows)
        assert {r.id for r in got if r.verdict == "block"} == {2, 3, 4}
        assert {r.id: (r.host, r.path) for r in got}[9] == ("b:", "//c/d")
    assert url_cascade.judge_urls(pages, rules.limit(0)).where("verdict = 'allow'").count() == len(rows)


def test_warc_rejects_magic_in_payloads(spark):
    fake = "x WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 5\r\n\r\nHELLO\r\n\r\n"
    rows = [(i, f"http://a/{i}", (fake * (i % 4) + "é" * (i * 7 % 300) + "WARC/1.0\r\n" * (i % 3)) if i % 5 else None) for i in range(60)]
    rows += [(100 + i, None, "copy " * 300) for i in range(6)] + [(None, "u", "copy " * 300), (700, "a\r\nWARC/1.0\r\nb", "")]
    path = scratch_path(spark, "warc")
    warc_chain.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), path)
    split = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in (split, "5k"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = {r.name: r for r in warc_chain.read_warc(spark, path, payload=size == split).collect()}
            assert len(got) == len(rows)
            for i, _, html in rows:
                r, body = got[f"urn:page:{'null' if i is None else i}"], (html or "").encode()
                assert (r.payload_bytes, r.payload_digest, r.verified) == (len(body), hashlib.sha1(body).hexdigest(), True)
                revisit = len(body) >= 1000 and body.startswith(b"copy") and i != 105
                assert (r.kind, r.refers) == (("revisit", "urn:page:105") if revisit else ("response", None))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)


def test_quotes_are_linked(spark):
    rows = [(1, 0, "Hello there\n\nSecond part"), (1, 1, "> Hello   there\n\nHi!"), (1, 2, "> > hello there\n>\n> Hi!\nOk"), (1, 3, "no quote"),
            (1, 4, "> never said"), (2, 0, "Hello there"), (2, 1, None), (2, 2, ""), (None, 1, "> x"), (3, None, "y"), (1, 5, ">Second part\n> Hi!"),
            (1, 3, "no quote")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, text string")
    got = {(r.conv, r.turn): r for r in quote_link.link_quotes(df).collect()}
    assert {k: r.reply_to for k, r in got.items() if r.reply_to is not None} == {(1, 1): 0, (1, 2): 1}
    assert got[1, 2].text == "Ok" and got[1, 0].text == "Hello there\n\nSecond part" and (got[1, 2].thread, got[1, 2].depth) == (0, 2)
    assert (got[1, 4].n_quotes, got[1, 4].n_linked) == (1, 0) and got[1, 5].text == ""
    assert quote_link.link_quotes(df).count() == len(rows) and quote_link.link_quotes(df.limit(0)).count() == 0


def test_weak_labels_agree_with_planted_quality(spark):
    def junk(i):
        w = prose(i, 40).split()
        return [" ".join(x + "###" for x in w), " ".join(w).upper(), " ".join([w[0]] * 40), " | ".join(w)][i % 4]

    rows = [doc(i, prose(i, 60).capitalize() + "." if i % 6 else junk(i // 6)) for i in range(600)] + [doc(900, None), doc(901, ""), doc(902, "Short one.")]
    df = spark.createDataFrame(rows, DOC)
    got = weak_quality.score(df, weak_quality.fit(df)).collect()
    wrong = [r.doc_id for r in got if r.doc_id < 900 and r.keep != (r.doc_id % 6 != 0)]
    assert len(wrong) <= 6 and {r.doc_id: r.keep for r in got}[902] and not {r.doc_id: r.keep for r in got}[901]
    assert weak_quality.score(df, weak_quality.fit(df.limit(0))).count() == len(rows)


def test_false_alarms_of_a_labeller_are_estimated():
    rng = np.random.default_rng(0)
    for n, least, most in ((100_000, 0.04, 0.055), (20_000, 0.03, 0.055)):
        good = rng.random(n) < 0.85
        votes = np.where(rng.random((n, 8)) < 0.03, 1, 2)
        alarms = np.array([0.0005, 0.0005, 0.05, 0.0005, 0.0005, 0.0005, 0.0005, 0.0005])
        votes[rng.random((n, 8)) < np.where(good[:, None], alarms, 0.35)] = 0
        patterns, counts = np.unique(votes, axis=0, return_counts=True)
        chances, share = weak_quality.fit_labellers(patterns, counts.astype(float))
        called_bad = weak_quality.posterior(votes, chances, share) < 0.5
        assert least <= chances[2, 1, 0] <= most and np.delete(chances[:, 1, 0], 2).max() < 0.01
        assert called_bad[good].mean() < 0.01 and called_bad[~good].mean() > 0.85
