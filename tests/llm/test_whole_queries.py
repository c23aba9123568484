"""The registered queries without SQL and the pipeline, against plain Python on a small folder of odd tables."""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

import corpus_pipeline
from inkwell.llm import queries, soft_mixing, toxic_segments, weak_quality
from inkwell.llm.text_hash import words
from test_operators import components, prose, shingles

TOXIC_WORD = re.compile(rb"[^\x09-\x0D !-/:-@\[-`{-~]+")
PLAIN_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def word_hash(w: bytes) -> int:
    return int(words(pa.array([w.decode("utf-8", "surrogateescape")]))[0][0])


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """documents (null, empty, long, repeated and toxic texts; null and repeated ids; dotted and clashing columns), labels
    and benchmark."""
    rng = np.random.default_rng(4)
    texts = [prose(9000 + i, 40) for i in range(200)]
    for i in range(0, 200, 8):
        w = texts[i].split()
        for j in rng.integers(0, 40, 5):
            w[j] = ["vilea", "Vileb!", "vilec,"][j % 3]
        texts[i] = " ".join(w)
    for i in range(3, 200, 16):
        texts[i] = " ".join(x + "##" for x in texts[i].split())
    item = prose(77, 12)
    texts += [texts[1], texts[1] + " end", texts[2], f"{prose(78, 10)} {item} {prose(79, 10)}", None, "", " \t\n", prose(80, 6000), "one", "one"]
    ids = [*range(len(texts))]
    texts += ["vilea vileb vilec " * 4, prose(81, 20), prose(82, 20)]
    ids += [None, None, 5]
    n = len(texts)
    docs = pd.DataFrame({"doc_id": pd.array(ids, "Int64"), "text": texts, "lang": ["en" if i % 3 else "fr" for i in range(n)],
                         "source": "s", "n_chars": [len(t or "") for t in texts], "meta.source": range(n), "rate": 0.5,
                         "toxicity": "x", "__copy": 1})
    labels = pd.DataFrame({"doc_id": pd.array([*range(160), 2, None], "Int64"), "quality": [int(i % 16 != 3) for i in range(162)],
                           "toxic": [int(i % 8 == 0) for i in range(160)] + [0, 1]})
    bench = pd.DataFrame({"item_id": [1, 2, 3], "text": [item, prose(83, 12), None]})
    path = tmp_path_factory.mktemp("tables")
    for name, df in (("documents", docs), ("labels", labels), ("benchmark", bench)):
        df.to_parquet(path / f"{name}.parquet")
    return str(path), docs, labels


def rows_of(docs):
    return [(None if pd.isna(i) else int(i), t) for i, t in zip(docs["doc_id"], docs["text"])]


def brute_toxicity(train, texts):
    """Scores of ``texts`` under the model of ``train`` (text, toxic), with dictionaries for every count."""
    def parts(text):
        return [w.lower() for w in TOXIC_WORD.findall((text or "").encode())]

    def units(w):
        return [("word", w)] + [(k, w[:k]) for k in toxic_segments.PREFIXES if len(w) >= k]

    edge, count, seen, sums = int(toxic_segments.EDGE), defaultdict(lambda: [0, 0]), defaultdict(set), [0, 0]
    for text, y in train:
        w = parts(text)
        h = [edge, *map(word_hash, w), edge]
        for i, x in enumerate(w):
            place = int(toxic_segments.mix(np.array([(h[i] * 3 + h[i + 2]) % 2 ** 64], dtype=np.uint64))[0]) & 63
            for u in units(x):
                count[u][y] += 1
                sums[y] += 1
                if y:
                    seen[u].add(place)
    kept, least = {}, toxic_segments
    mass = least.PRIOR * sum(sums)
    for u, (clean, toxic) in count.items():
        if toxic > 2 and toxic * 8 > clean:
            bits = len(seen[u])
            contexts = min(toxic, round(-64 * math.log(1 - min(bits, least.MANY_BITS) / 64)))
            full = min(1.0, max(0.0, (bits - least.FEW_BITS) / (least.MANY_BITS - least.FEW_BITS)))
            y1 = contexts ** (1 - full) * toxic ** full
            prior = least.PRIOR * (y1 + clean)
            score = math.log((y1 + prior) / (sums[1] + mass - y1 - prior)) - math.log((clean + prior) / (sums[0] + mass - clean - prior))
            if score / math.sqrt(1 / (y1 + prior) + 1 / (clean + prior)) >= least.LEAST_Z and score >= least.LEAST_SCORE:
                kept[u] = (score, (clean + prior) / (sums[0] + mass))
    share = np.array([s for _, s in kept.values()])
    lam = least._lambda(np.array([x for x, _ in kept.values()]), np.minimum(share, 1e-3) * min(1, 0.05 / share.sum()))

    def found(text):
        best = [max((kept[u][0] for u in units(w) if u in kept), default=0.0) for w in parts(text)]
        at = [i for i, x in enumerate(best) if x]
        return len(best), [s for _, _, s in least.maximal_segments(np.array(at, int), np.array([best[i] for i in at]))]

    segments = [(*found(t), y) for t, y in train]
    clean = [(n, len(f)) for n, f, y in segments if not y]
    k = max(sum(f for _, f in clean), 0.5) / max(sum(n for n, _ in clean), 1)

    def statistic(n, f):
        return least._statistic(lam, k, max(n, 1), [(0, 0, x) for x in f])

    x = np.array([round(statistic(n, f) * 100) / 100 for n, f, _ in segments])
    offset, slope = least._logistic(x, np.ones(len(x)), np.array([float(y) for _, _, y in segments]))
    return [1 / (1 + math.exp(-(offset + slope * statistic(*found(t))))) for t in texts]


def test_toxicity_query_matches_plain_python(spark, folder):
    path, docs, labels = folder
    toxic = {int(i): y for i, y in zip(labels["doc_id"], labels["toxic"]) if not pd.isna(i)} | {2: max(labels["toxic"][[2, 160]])}
    rows = rows_of(docs)
    train = [(t, toxic[i]) for i, t in rows if t is not None and i in toxic and zlib.crc32(str(i).encode()) % 5]
    want = brute_toxicity(train, [t for _, t in rows])
    got = queries.op9_toxic_segments(spark, path).collect()
    assert Counter((r.doc_id, round(r.score, 2)) for r in got) == Counter((i, round(p, 2)) for (i, _), p in zip(rows, want))
    assert all(r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    flagged = {i for (i, _), p in zip(rows, want) if p >= 0.5}
    assert {*range(0, 200, 8)} <= flagged and len(flagged - {*range(0, 200, 8), None}) <= 1


def brute_mixture(train, texts):
    """(domains, posteriors, words, rates) by whole matrices over all texts."""
    def buckets(text):
        return [word_hash(w) % soft_mixing.BUCKETS for w in PLAIN_WORD.findall((text or "").encode())]

    names = sorted({d for _, d in train})
    counts, prior = np.zeros((soft_mixing.BUCKETS, len(names))), np.zeros(len(names))
    for text, d in train:
        prior[names.index(d)] += 1
        np.add.at(counts[:, names.index(d)], buckets(text), 1)
    pooled = (counts.sum(axis=1, keepdims=True) + 1) / (counts.sum() + soft_mixing.BUCKETS)
    smooth = counts + 0.05 * counts.sum(axis=0).mean() * pooled + 1e-9
    weight, prior = np.log(smooth / smooth.sum(axis=0)), np.log(prior / prior.sum())
    n, p = [], []
    for text in texts:
        b = buckets(text)
        x = prior + (weight[b].sum(axis=0) * min(len(b), soft_mixing.EVIDENCE) / len(b) if b else 0)
        n.append(len(b))
        p.append(np.exp(x - x.max()) / np.exp(x - x.max()).sum())
    n, p = np.array(n), np.array(p)
    have = n @ p
    targets, scale = soft_mixing.tempered(names, have), np.maximum(have, 1)
    r = y = np.ones(len(n))
    for i in range(soft_mixing.STEPS):
        error = ((y * n) @ p - targets) / scale
        if abs(error).max() <= soft_mixing.TOLERANCE:
            break
        new = np.maximum(0, y - p @ error)
        y = np.maximum(0, new + i / (i + 3) * (new - r))
        r = new
    return names, p, n, r


def mixing_parts(docs, labels, kept=None):
    quality = {int(i): q for i, q in zip(labels["doc_id"], labels["quality"]) if not pd.isna(i)}
    quality[2] = max(labels["quality"][[2, 160]])
    return [(t, f"{lang}/{quality[i]}") for (i, t), lang in zip(rows_of(docs), docs["lang"]) if t is not None and i in quality]


def test_mixing_query_matches_plain_python(spark, folder):
    path, docs, labels = folder
    rows = rows_of(docs)
    names, p, n, rate = brute_mixture(mixing_parts(docs, labels), [t for _, t in rows])
    want = Counter((i, names[a.argmax()], int(m), round(float(r), 3)) for (i, _), a, m, r in zip(rows, p, n, rate))
    got = queries.op10_soft_mixing(spark, path).collect()
    assert Counter((r.doc_id, r.domain, r.n_words, round(r.rate, 3)) for r in got) == want
    assert all(math.floor(r.rate) <= r.copies <= math.floor(r.rate) + 1 for r in got) and names == ["en/0", "en/1", "fr/0", "fr/1"]


def brute_features(text):
    raw = (text or "").encode()
    spans = [m.span() for m in PLAIN_WORD.finditer(raw)]
    w = [raw[a:b].lower() for a, b in spans]
    inner = raw[spans[0][0]:spans[-1][1]] if w else b""
    mark = lambda c: 33 <= c <= 47 or 58 <= c <= 64 or 91 <= c <= 96 or 123 <= c <= 126
    upper, lower = sum(65 <= c <= 90 for c in inner), sum(97 <= c <= 122 for c in inner)
    base, size = max(len(w), weak_quality.LEAST_WORDS), max(len(inner), weak_quality.LEAST_BYTES)
    return [sum(len(x) >= 3 and mark(x[-1]) and mark(x[-2]) for x in w) / base, upper / max(upper + lower, weak_quality.LEAST_BYTES),
            sum(a == b for a, b in zip(w, w[1:])) / base,
            min(max(1 - len(set(w)) / base ** 0.9, 0), 1) if len(w) >= weak_quality.LEAST_WORDS else 0,
            sum(map(mark, inner)) / size, sum(x == b"|" for x in w) / base, sum(48 <= c <= 57 for c in inner) / size, 1 / (1 + len(w))]


def test_quality_query_matches_plain_python(spark, folder):
    path, docs, _ = folder
    texts = [t for _, t in rows_of(docs)]
    votes = [tuple(0 if x >= bad else 2 if x <= good else 1 for x, (_, good, bad) in zip(brute_features(t), weak_quality.HEURISTICS))
             for t in texts]
    kinds = Counter(votes)
    chances, good = weak_quality.fit_labellers(np.array(list(kinds)), np.array([float(x) for x in kinds.values()]))
    weak = weak_quality.posterior(np.array(votes), chances, good)
    sums = np.zeros((2, weak_quality.BUCKETS))
    bags = [[word_hash(w) % weak_quality.BUCKETS for w in PLAIN_WORD.findall((t or "").encode())] for t in texts]
    for bag, p in zip(bags, weak):
        np.add.at(sums[1], bag, p)
        np.add.at(sums[0], bag, 1 - p)
    pooled = (sums.sum(axis=0) + 1) / (sums.sum() + weak_quality.BUCKETS)
    smooth = sums + max(0.02 * sums.sum(), 1) * pooled
    weight = np.log(smooth[1] / smooth[1].sum()) - np.log(smooth[0] / smooth[0].sum())
    x = np.array([weight[b].sum() * min(len(b), weak_quality.EVIDENCE) / len(b) if b else 0.0 for b in bags])
    offset, slope = toxic_segments._logistic(np.rint(x * 4) / 4, np.ones(len(x)), weak)
    quality = 1 / (1 + np.exp(-(offset + slope * x)))
    want = Counter((i, *(round(float(v), 2) if b else 0.0 for v in (q, p))) for (i, _), b, q, p in zip(rows_of(docs), bags, quality, weak))
    got = queries.op6_weak_quality(spark, path).collect()
    assert Counter((r.doc_id, round(r.quality, 2), round(r.weak_label, 2)) for r in got) == want


def test_token_query_matches_the_library(spark, folder):
    from tokenizers import Tokenizer

    path, docs, _ = folder
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    want = Counter()
    for i, t in rows_of(docs):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want[i, len(ids), zlib.crc32(ids.tobytes())] += 1
    got = sorted(queries.op7_token_parquet(spark, path).collect(), key=lambda r: r.start)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1]]
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in got), key=lambda i: -1 if i is None else i)


def test_pipeline_matches_plain_python(spark, folder, tmp_path):
    from tokenizers import Tokenizer

    path, docs, labels = folder
    columns, now, outs = list(docs.columns), spark.read.parquet(path + "/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = str(tmp_path / name)
        stage(spark, now, path).write.parquet(out)
        now = spark.read.parquet(out)
        assert name == "tokens" or now.columns == columns
        outs[name] = now.toPandas()
    key = "meta.source"  # the number of the row

    toxic = {int(i): y for i, y in zip(labels["doc_id"], labels["toxic"]) if not pd.isna(i)} | {2: max(labels["toxic"][[2, 160]])}
    rows = rows_of(docs)
    scores = brute_toxicity([(t, toxic[i]) for i, t in rows if t is not None and i in toxic], [t for _, t in rows])
    clean = outs["toxicity"]
    assert set(clean[key]) == {j for j, p in zip(docs[key], scores) if p < 0.5} and 170 < len(clean) < len(docs) - 20

    sets = {j: shingles(t, 5) for j, t in zip(clean[key], clean["text"])}
    root = components(sets, 80)
    kept = outs["near_duplicates"]
    empty = {j for j, s in sets.items() if not s}
    assert Counter(root[j] for j in kept[key]) == Counter(set(root.values())) and empty <= set(kept[key]) and len(kept) < len(clean)

    bench = pd.read_parquet(path + "/benchmark.parquet")
    items = [shingles(t, 5) for t in bench["text"] if t]
    fine = {j for j in kept[key] if not any(100 * len(x & sets[j]) >= 80 * len(x) for x in items)}
    left = outs["decontamination"]
    assert set(left[key]) == fine and len(left) == len(kept) - 1

    mixed, texts = outs["mixing"], list(left["text"])
    _, _, _, rate = brute_mixture(mixing_parts(left, labels), texts)
    copies = Counter(mixed[key])
    assert all(math.floor(r + 1e-6) <= copies[j] <= math.floor(r + 1e-6) + 1 for j, r in zip(left[key], rate))
    assert set(mixed[key]) <= set(left[key]) and len(mixed) >= 0.9 * len(left)

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    want = Counter((i, (*tokenizer.encode(t or "", add_special_tokens=False).ids, 1)) for i, t in rows_of(mixed))
    assert Counter((None if pd.isna(i) else int(i), tuple(x)) for i, x in zip(outs["tokens"]["doc_id"], outs["tokens"]["input_ids"])) == want

    whole = corpus_pipeline.run(spark, path).toPandas()
    assert Counter(tuple(x) for x in whole["input_ids"]) == Counter(tuple(x) for x in outs["tokens"]["input_ids"])
