"""Cross-tokenizer alignment and pair counts: perfect hashes, brute force, many tables and odd rows."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from inkwell.llm import pair_counts
from inkwell.llm.perfect_hash import PerfectHash, bucket_of
from inkwell.llm.queries import tokenizer_path

pytest.importorskip("public_tokenizers")
PARTS = [" ", "  ", "   ", "\n", " \n ", "\t", "a", "b", "the", "ing", "é", "漢", "字", "🙂", "　", "\xa0", "<s>", "<|endoftext|>", "0", "12", "'s",
         "ll", "\r\n", ";", "}", "\0", "ك", "ال", "<0x41>", "tokenization", "don't", "====", "\x85", "\x1c", " "]


def test_perfect_hash_is_minimal_and_survives_bytes():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 63, 64, 65, 1000, 40_000):
        keys = np.unique(rng.integers(-2**62, 2**62, n))
        made = PerfectHash.from_bytes(PerfectHash.build(keys).to_bytes())
        assert sorted(made.slots(keys).tolist()) == list(range(len(keys)))
        strange = rng.integers(-2**62, 2**62, 500)
        slots = made.slots(strange)
        assert ((slots >= -1) & (slots < max(len(keys), 1))).all()
    assert set(bucket_of(np.arange(1000), 7).tolist()) == set(range(7))


def brute(rows):
    """The contract by the libraries' own whole-text encodings."""
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    ta = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    ta.encode_special_tokens = True
    tb = SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    level = pair_counts._byte_level()
    docs = []
    for _, text in rows:
        raw = b" " + text.encode() if text else b""
        a = ta.encode(" " + text, add_special_tokens=False).ids if text else []
        b = tb.encode(text) if text else []
        xa = [bytes(level[c] for c in ta.id_to_token(i)) for i in a]
        xb = [bytes([int(tb.id_to_piece(i)[3:5], 16)]) if tb.is_byte(i) else tb.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if b"".join(xa) != raw or b"".join(xb) != raw or not text:
            docs.append((0, 0, []))
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in xa]).tolist(), np.cumsum([len(x) for x in xb]).tolist()
        cuts = sorted(set(ends_a) & set(ends_b))
        groups, p, q = [], 0, 0
        for c in cuts:
            i, j = ends_a.index(c, p) + 1, ends_b.index(c, q) + 1
            groups.append((a[p:i], b[q:j]))
            p, q = i, j
        docs.append((len(a), len(b), groups))
    held = Counter(k for _, _, g in docs for k in {(x, y) for ga, gb in g for x in ga for y in gb})
    most = {}
    for (x, _), n in held.items():
        most[x] = max(most.get(x, 0), n)
    out = []
    for (i, _), (na, nb, g) in zip(rows, docs):
        links = [(x, y) for ga, gb in g for x in ga for y in gb]
        text = ";".join(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)) for ga, gb in g)
        out.append((i, na, nb, len(g), len(links), sum(held[k] == most[k[0]] for k in links), sum(held[k] for k in links), text))
    return sorted(out, key=str), held


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(250)]
    texts += [None, "", " ", "  ", "\n", "a", "a ", " a", "▁", "x ▁ y", "a▁b c", "the end", "the end", "don't  stop\n\n now ", "=" * 999,
              "\t" * 50 + "x", " " * 77, "naïve 漢字かな交じり文 🙂🙂", "word " * 3000, "x" * 3000]
    return [(i, t) for i, t in enumerate(texts)] + [(5, "the end"), (5, "the end"), (None, "null id")]


COLUMNS = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"]


@pytest.mark.parametrize("pairs,bucket", [(None, None), (200, 50), (10_000, 30)])
def test_against_whole_texts(spark, rows, pairs, bucket):
    docs = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "doc_id long, text string, i string, `n.best` double").repartition(6)
    files = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    got = sorted((tuple(r) for r in pair_counts.align(docs, *files, pairs=pairs, bucket=bucket).select(*COLUMNS).collect()), key=str)
    want, held = brute(rows)
    assert got == want
    counts = pair_counts.PairCounts(docs, *files, pairs=pairs, bucket=bucket)
    assert {(r["a"], r["b"]): r["n"] for r in counts.pairs(spark).collect()} == dict(held)
    assert (counts.tables > 1) == (pairs == 200)


def test_small_flushes_and_fans_change_nothing(spark, rows, monkeypatch):
    monkeypatch.setattr(pair_counts, "FLUSH", 5)
    monkeypatch.setattr(pair_counts, "FAN", 2)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    out = pair_counts.align(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    assert sorted((tuple(r) for r in out.select(*COLUMNS).collect()), key=str) == brute(rows)[0]


def test_small_caches_and_joins_change_nothing(rows, monkeypatch):
    with open(tokenizer_path("byte_bpe_50k.json"), encoding="utf-8") as f, open(tokenizer_path("piece_bpe_32k.model"), "rb") as g:
        spec = f.read(), g.read()

    def forms(some, aligner):
        slot, first = aligner.slots(pa.array(some, pa.string()))
        return [";".join(aligner.groups[i] for i in slot[x:y]) for x, y in zip(first[:-1], first[1:])]

    texts = [t for _, t in rows]
    want = {i: w[7] for i, w in enumerate(sorted(brute(list(enumerate(texts)))[0]))}
    assert forms(texts, pair_counts.Aligner(*spec, texts=True)) == list(want.values())
    for name, value in (("REMEMBER", 3), ("JOIN", 1), ("LISTED", 2)):
        monkeypatch.setattr(pair_counts, name, value)
    aligner = pair_counts.Aligner(*spec, texts=True)
    assert [x for t in texts for x in forms([t], aligner)] == list(want.values())
    monkeypatch.setattr(aligner, "by_word", False)
    aligner.forget()
    assert [x for t in texts for x in forms([t], aligner)] == list(want.values())
    assert aligner.letters


def test_tables_without_pairs(spark):
    files = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    assert pair_counts.align(spark.createDataFrame([], "doc_id long, text string"), *files).count() == 0
    blank = pair_counts.align(spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string"), *files)
    assert [tuple(r) for r in blank.select(*COLUMNS[1:]).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2
