"""Prefix token counts: against the library for every prefix, and questions answered from the index."""

import random

import pytest
from pyspark.sql import functions as F

from inkwell.llm import prefix_counts
from inkwell.llm.queries import tokenizer_path
from inkwell.session import scratch_path

pytest.importorskip("public_tokenizers")
PARTS = [" ", "  ", "   ", "▁", "\n", "\t", "a", "b", "the", "ing", "é", "漢", "字", "🙂", "　", "\xa0", "<s>", "</s>", "0", "12", "'",
         "ll", "\r\n", ";", "}", "\0", "ك", "ال", "<0x41>", "tokenization", "<unk>"]


@pytest.fixture(scope="module")
def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))


def odd_texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 40))) for _ in range(n)]


def test_every_prefix_as_the_library_counts_it(library):
    with open(tokenizer_path("piece_bpe_32k.model"), "rb") as f:
        counter = prefix_counts.PrefixCounter(f.read())
    texts = odd_texts(3, 300) + [" " * n + "foo" for n in range(70)] + ["=" * 200, "aaaa" * 50, "漢" * 60, "supercalifragilistic" * 8]
    for text in texts:
        want = [len(x) for x in library.encode([text[:i] for i in range(len(text) + 1)])]
        assert counter.counts(text).tolist() == want, text
    assert counter.known and all(len(w) <= prefix_counts.LONG for w in counter.known)


def test_index_and_questions(spark, library):
    long = " ".join(odd_texts(5, 1200))
    texts = [None, "", " ", "a", long, "z" * 9000] + odd_texts(4, 20)
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(3, "a", "x", 1), (3, "other text", "y", 2), (None, "null id", "n", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, last string, block int")
    path = scratch_path(spark, "prefix")
    prefix_counts.write_index(prefix_counts.prefix_index(docs, tokenizer_path("piece_bpe_32k.model")), path)
    index = spark.read.parquet(path)
    got = sorted((-1 if r[0] is None else r[0], r[1], r[2], r[3]) for r in prefix_counts.totals(index).select("doc_id", "n_chars", "n_bytes", "n_tokens").collect())
    want = sorted((-1 if i is None else i, len(t or ""), len((t or "").encode()), len(library.encode(t or ""))) for i, t, *_ in rows)
    assert got == want

    rng = random.Random(1)
    asked = [(i, t, k) for i, t, *_ in rows for k in {0, 1, len(t or ""), len(t or "") + 1, -1, *(rng.randint(0, len(t or "")) for _ in range(4))}]
    asked += [(99, "gone", 1)]
    ask = spark.createDataFrame(asked, "doc_id long, text string, chars long").withColumn("digest", F.unhex(F.md5("text")))
    answer = prefix_counts.prefix_tokens(index, ask).collect()
    assert len(answer) == len(asked)
    for r in answer:
        t = r["text"] or ""
        known = 0 <= r["chars"] <= len(t) and r["doc_id"] != 99
        assert r["tokens"] == (len(library.encode(t[:r["chars"]])) if known else None)

    for limit in (0, 1, 5, 300):
        cuts = prefix_counts.truncate(docs, index, limit)
        assert cuts.columns == docs.columns and cuts.count() == len(rows)
        found = sorted((str(r["doc_id"]), str(r["text"])) for r in cuts.collect())
        counts = {}
        for _, t, *_ in rows:
            if t is not None and t not in counts:
                ends = range(len(t) + 1) if len(t) < 2000 else range(0, 2500)
                counts[t] = max(k for k, x in zip(ends, library.encode([t[:k] for k in ends])) if len(x) <= limit)
        assert found == sorted((str(i), str(None if t is None else t[:counts[t]])) for i, t, *_ in rows)

    taken = prefix_counts.within_budget(index, 2000, parts=3).collect()
    assert sum(r["part"] for r in taken) == 2000
    order = sorted(taken, key=lambda r: r["start"])
    assert [r["doc_id"] for r in order] == sorted((r["doc_id"] for r in order), key=lambda x: -1 if x is None else x)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert prefix_counts.prefix_index(docs, tokenizer_path("piece_bpe_32k.model")).count() == 0
