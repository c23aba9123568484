"""Alignment of two tokenizers and corpus-wide counts of their linked token pairs.

Tokenizer A is a byte-level BPE, B a sentencepiece BPE with byte fallback; both read a space and
the text. Byte offsets where tokens of both end cut a text into groups, and every A token of a
group is linked with every B token of it. Words (with the space before them) and runs of
punctuation never share a token, so each distinct one is encoded and aligned once in a worker; they are told
apart by 64-bit hashes. Alignment is a merge of the running byte offsets of all new words at once.

Counting: the first pass gives the distinct pairs of every document. The distinct pairs of the corpus are dealt
to buckets, and each bucket gets a minimal perfect hash. Partial counts then become dense vectors
indexed by that hash, which are summed in a tree. The second pass aligns the documents again and
looks up the counts: the hash gives the slot, the key stored there verifies it. A lookup
table holds PAIRS pairs at most; more are dealt to several tables, and each has its own second
pass over the texts, whose sums are added up.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.llm.common import stash, text_slices
from inkwell.llm.perfect_hash import PerfectHash, bucket_of
from inkwell.llm.text_hash import raw_text, span_hashes

#: Distinct pairs of a broadcast lookup table (at most 25 bytes each) and of a bucket, about.
PAIRS, BUCKET = 4_000_000, 1 << 15
#: Dense vectors that are summed by one task of the tree.
FAN = 32
#: Words that a Python worker remembers, pairs gathered before they are handed on, words that are encoded as one text.
REMEMBER, FLUSH, JOIN = 400_000, 1 << 20, 128
#: Links of a group that are listed one by one; larger groups are counted by distinct ids.
LISTED = 4096
#: Bits of a token id in a pair, and of a pair.
ID_BITS, PAIR_BITS = 24, 48
#: Fixed value: the character that stands for a space in the pieces of B.
SPACE = "▁"


def _kinds() -> np.ndarray:
    """Kind of a byte: 1 ASCII white space, 2 ASCII letter, 3 ASCII punctuation but the apostrophe, 4 lead of a Latin letter, 0 other."""
    kind = np.zeros(256, dtype=np.uint8)
    kind[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = 1
    kind[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 2
    kind[[*range(0x21, 0x27), *range(0x28, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = 3
    kind[0xC3:0xC9] = 4
    return kind


_KIND = _kinds()


def word_starts(data: np.ndarray, letters: bool) -> np.ndarray:
    """Mask of the bytes where a word starts, so that no token of A or B goes over the place.

    A space or line end after a character that is neither white space nor SPACE starts one; with
    ``letters`` so does a change between a Latin letter and ASCII punctuation (but the apostrophe).
    """
    n = len(data)
    before = np.zeros(n + 3, dtype=np.uint8)
    before[3:] = data
    c, b1, b2, b3 = data, before[2:-1], before[1:-2], before[:-3]
    lead3 = ((b3 == 0xE1) & (b2 == 0x9A)) | ((b3 == 0xE2) & ((b2 == 0x80) | (b2 == 0x81) | (b2 == 0x96))) | ((b3 == 0xE3) & (b2 == 0x80))
    blank = (_KIND[b1] == 1) | ((b1 >= 0x80) & (lead3 | ((b2 == 0xC2) & ((b1 == 0x85) | (b1 == 0xA0)))))
    start = ((c == 0x20) | (c == 0x0A)) & ~blank
    if letters:
        k, k1 = _KIND[c], _KIND[b1]
        sign = (b2 == 0xC3) & ((b1 == 0x97) | (b1 == 0xB7))
        after_letter = (k1 == 2) | ((_KIND[b2] == 4) & (b1 >= 0x80) & (b1 < 0xC0) & ~sign)
        start |= (k == 3) & after_letter
        following = np.zeros(n, dtype=np.uint8)
        following[:-1] = data[1:]
        letter = (k == 2) | ((k == 4) & ~((c == 0xC3) & ((following == 0x97) | (following == 0xB7))))
        start |= letter & (k1 == 3)
    return start


def _csr(lists: list, kind) -> tuple[np.ndarray, np.ndarray]:
    """(flat values, lengths) of a list of lists."""
    sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    return np.fromiter((i for x in lists for i in x), dtype=kind, count=int(sizes.sum())), sizes


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for every range, one after the other."""
    total = np.cumsum(size)
    return np.arange(total[-1] if len(total) else 0) + np.repeat(start - (total - size), size)


class Aligner:
    """Aligns texts under one pair of tokenizers.

    What is known of a word lies in arrays by its slot: ``numbers`` (tokens of A and B, groups,
    links; -1 tokens where the tokens do not give back the word), its distinct pairs with how often they
    are linked, and with ``texts`` the text form of its groups.
    """

    made: dict[tuple[int, int], "Aligner"] = {}

    def __init__(self, a: str, b: bytes, texts: bool = False) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        level, vocab = _byte_level(), self.a.get_vocab(with_added_tokens=False)
        a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            a_bytes[i] = bytes(level[c] for c in token)
        self.b = SentencePieceProcessor(model_proto=b)
        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(b)
        b_bytes = [bytes([int(p.piece[3:5], 16)]) if p.type == proto.SentencePiece.BYTE
                   else p.piece.replace(SPACE, " ").encode() for p in proto.pieces]
        if max(len(a_bytes), len(b_bytes)) > 1 << ID_BITS:
            raise ValueError(f"token ids need more than {ID_BITS} bits")
        pieces = [p.piece for p in proto.pieces if p.type != proto.SentencePiece.BYTE]
        self.by_word = not any("\n" in p or SPACE in p.lstrip(SPACE) for p in pieces)
        normal = [p.piece for p in proto.pieces if p.type in (proto.SentencePiece.NORMAL, proto.SentencePiece.USER_DEFINED)]
        glued = (np.frombuffer(p.replace(SPACE, " ").encode(), dtype=np.uint8) for p in normal)
        self.letters = not any(word_starts(x, True)[1:].any() for x in glued)
        self.line = len(self.b.encode("\n"))
        self.sides = [self._side(x) for x in (a_bytes, b_bytes)]
        self.texts, self.age = texts, 0
        self.forget()

    @classmethod
    def of(cls, a: str, b: bytes, texts: bool = False) -> "Aligner":
        key = hash(a), hash(b), texts
        if key not in cls.made:
            cls.made[key] = cls(a, b, texts)
        return cls.made[key]

    @staticmethod
    def _side(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        size = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        return np.frombuffer(b"".join(tokens), dtype=np.uint8), np.cumsum(size) - size, size

    def forget(self) -> None:
        self.age += 1
        self.keys, self.slot = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
        self.numbers = np.zeros((0, 4), dtype=np.int64)
        self.first, self.pairs, self.times = np.zeros(1, dtype=np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.groups: list[str] = []

    # --- words of a slice ----------------------------------------------------------------

    def slots(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(slot of every word, first word of each row, len + 1); rows that cannot be aligned have no words."""
        blob = pa.array([None if not t else " " + t for t in column.to_pylist()], pa.large_string())
        data, offsets = raw_text(blob)
        start = word_starts(data, self.letters) if self.by_word else np.zeros(len(data), dtype=bool)
        full = offsets[:-1][np.diff(offsets) > 0]
        start[full] = True
        s = np.flatnonzero(start)
        e = np.append(s[1:], len(data))[:len(s)]
        first = np.searchsorted(s, offsets)
        h = span_hashes(data, s, e)
        keys, at, back = np.unique(h, return_index=True, return_inverse=True)
        if len(self.keys) > REMEMBER:
            self.forget()
        place = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), dtype=bool)
        inside = place < len(self.keys)
        new[inside] = self.keys[place[inside]] != keys[inside]
        if new.any():
            raw = data.tobytes()
            self._learn([raw[x:y] for x, y in zip(s[at[new]].tolist(), e[at[new]].tolist())])
            fresh = np.arange(len(self.numbers) - int(new.sum()), len(self.numbers))
            to = np.searchsorted(self.keys, keys[new])
            self.keys, self.slot = np.insert(self.keys, to, keys[new]), np.insert(self.slot, to, fresh)
        slot = self.slot[np.searchsorted(self.keys, keys)][back]
        bad = self.numbers[slot, 0] < 0
        if bad.any():
            row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
            lost = np.zeros(len(offsets) - 1, dtype=bool)
            lost[row[bad]] = True
            slot = slot[~lost[row]]
            first = np.concatenate([[0], np.cumsum(np.where(lost, 0, np.diff(first)))])
        return slot, first

    # --- new words -------------------------------------------------------------------------

    def _encode(self, texts: list[str]) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        a = [x.ids for x in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        if self.by_word:  # nothing merges with a line end, so it keeps the space that B adds apart
            b = [x[self.line:] for x in self.b.encode(["\n" + x for x in texts], num_threads=1)]
        else:
            b = self.b.encode([x[1:] for x in texts], num_threads=1)
        return _csr(a, np.int64), _csr(b, np.int64)

    def _tokens(self, words: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, tokens of each word) of A and of B. Words that start with a space or line end are encoded many
        at a time where the place between two of them is one that no token goes over."""
        n = len(words)
        out = [[None] * n, [None] * n]
        ready = [i for i, w in enumerate(words) if self.by_word and w[0] in b" \n" and (0x21 <= w[-1] <= 0x7E)]
        alone = sorted(set(range(n)) - set(ready))
        for lo in range(0, len(ready), JOIN):
            mine = ready[lo:lo + JOIN]
            sizes = np.array([len(words[i]) for i in mine])
            for k, (ids, _) in enumerate(self._encode([b"".join(words[i] for i in mine).decode()])):
                ends = np.cumsum(self.sides[k][2][ids])
                if len(ends) and ends[-1] == sizes.sum():
                    cut = np.searchsorted(ends, np.cumsum(sizes), side="right")
                    for i, x, y in zip(mine, [0, *cut[:-1].tolist()], cut.tolist()):
                        out[k][i] = ids[x:y]
        alone += [i for i in ready if out[0][i] is None or out[1][i] is None]
        if alone:
            for k, (ids, size) in enumerate(self._encode([words[i].decode() for i in alone])):
                ends = np.cumsum(size)
                for i, x, y in zip(alone, (ends - size).tolist(), ends.tolist()):
                    out[k][i] = ids[x:y]
        return [(np.concatenate([np.zeros(0, np.int64), *x]), np.fromiter(map(len, x), dtype=np.int64, count=n)) for x in out]

    def _learn(self, words: list[bytes]) -> None:
        for lo in range(0, len(words), 1 << 14):  # a word's number and a pair share 63 bits
            self._learn_some(words[lo:lo + (1 << 14)])

    def _learn_some(self, words: list[bytes]) -> None:
        n = len(words)
        size = np.fromiter(map(len, words), dtype=np.int64, count=n)
        tokens = self._tokens(words)
        ok = np.ones(n, dtype=bool)
        raw = np.frombuffer(b"".join(words), dtype=np.uint8)
        start = np.cumsum(size) - size
        for (ids, count), (data, at, length) in zip(tokens, self.sides):
            word = np.repeat(np.arange(n), count)
            ok &= np.bincount(word, weights=length[ids], minlength=n).astype(np.int64) == size
            keep = ok[word]  # same length: the bytes can be held against each other
            made = data[_ranges(at[ids[keep]], length[ids[keep]])]
            differ = made != raw[_ranges(start[ok], size[ok])]
            ok[np.repeat(np.flatnonzero(ok), size[ok])[differ]] = False
        # all words that are left lie one after the other; groups end where tokens of both end
        (a, word_a), (b, word_b) = ((ids[np.repeat(ok, count)], np.repeat(np.arange(n), count)[np.repeat(ok, count)]) for ids, count in tokens)
        end_a, end_b = np.cumsum(self.sides[0][2][a]), np.cumsum(self.sides[1][2][b])
        cuts = np.intersect1d(end_a, end_b, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, end_a), np.searchsorted(cuts, end_b)
        n_a, n_b = np.bincount(group_a, minlength=len(cuts)), np.bincount(group_b, minlength=len(cuts))
        first_a, first_b = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
        word = word_a[first_a] if len(cuts) else word_a
        links = n_a * n_b
        listed = np.flatnonzero(links <= LISTED)
        of = np.repeat(listed, links[listed])
        k = _ranges(np.zeros(len(listed), dtype=np.int64), links[listed])
        pair = a[first_a[of] + k // n_b[of]] << ID_BITS | b[first_b[of] + k % n_b[of]]
        key, times = np.unique(word[of] << PAIR_BITS | pair, return_counts=True)
        large = []
        for g in np.flatnonzero(links > LISTED).tolist():
            right = Counter(b[first_b[g]:first_b[g] + n_b[g]].tolist()).items()
            for p, x in Counter(a[first_a[g]:first_a[g] + n_a[g]].tolist()).items():
                large += [(int(word[g]) << PAIR_BITS | p << ID_BITS | q, x * y) for q, y in right]
        if large:
            more = np.array(large, dtype=np.int64)
            key, back = np.unique(np.concatenate([key, more[:, 0]]), return_inverse=True)
            times = np.bincount(back, weights=np.concatenate([times, more[:, 1]])).astype(np.int64)
        total = lambda x: np.bincount(word, weights=x, minlength=n).astype(np.int64)
        numbers = np.stack([np.where(ok, total(n_a), -1), total(n_b), total(np.ones(len(word))), total(links)], axis=1)
        self.numbers = np.concatenate([self.numbers, numbers])
        per_word = np.bincount(key >> PAIR_BITS, minlength=n)
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(per_word)])
        self.pairs = np.concatenate([self.pairs, key & ((1 << PAIR_BITS) - 1)])
        self.times = np.concatenate([self.times, times])
        if self.texts:
            self._write(n, word, a.tolist(), b.tolist(), first_a.tolist(), n_a.tolist(), first_b.tolist(), n_b.tolist())

    def _write(self, n: int, word: np.ndarray, a: list, b: list, first_a: list, n_a: list, first_b: list, n_b: list) -> None:
        a, b = list(map(str, a)), list(map(str, b))
        made = [a[i] + "|" + b[j] if x == y == 1 else ",".join(a[i:i + x]) + "|" + ",".join(b[j:j + y])
                for i, x, j, y in zip(first_a, n_a, first_b, n_b)]
        ends = np.searchsorted(word, np.arange(n), side="right").tolist()
        self.groups += [";".join(made[x:y]) for x, y in zip([0, *ends], ends)]


def _byte_level() -> dict[str, int]:
    """The byte of every character of the byte-level alphabet: printable Latin-1 stands for itself, the rest from U+0100 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [i for i in range(256) if i not in own]
    return {**{chr(i): i for i in own}, **{chr(0x100 + k): i for k, i in enumerate(rest)}}


class PairTable:
    """A lookup table of pairs: the perfect hashes of its buckets, its keys, and a number for each."""

    def __init__(self, buckets: int, rows) -> None:
        """``rows``: (bucket, hash, keys) and, once they are known, counts."""
        self.buckets, self.hashes, self.start = buckets, {}, {}
        keys, counts, at = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
        for r in rows:
            b = r["bucket"]
            self.hashes[b], self.start[b] = PerfectHash.from_bytes(bytes(r["hash"])), at
            keys.append(np.frombuffer(bytes(r["keys"]), dtype=np.int64))
            if "counts" in r:
                counts.append(np.frombuffer(bytes(r["counts"]), dtype=np.int64))
            at += len(keys[-1])
        self.keys, self.counts = np.concatenate(keys), np.concatenate(counts)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of every key, -1 for keys that are not in the table."""
        out = np.full(len(keys), -1, dtype=np.int64)
        bucket = bucket_of(keys, self.buckets)
        order = np.argsort(bucket, kind="stable")
        names, first = np.unique(bucket[order], return_index=True)
        for b, a, z in zip(names.tolist(), first, [*first[1:], len(order)]):
            if b in self.hashes:
                mine = order[a:z]
                slot = self.hashes[b].slots(keys[mine])
                out[mine[slot >= 0]] = slot[slot >= 0] + self.start[b]
        hit = np.flatnonzero(out >= 0)
        out[hit[self.keys[out[hit]] != keys[hit]]] = -1
        return out


def _first_pass(texts: DataFrame, shared) -> DataFrame:
    """(pair, n): documents that hold a pair, partial counts of a task."""
    most = FLUSH

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner.of(*shared.value)
        keys, counts = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        new: list[np.ndarray] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            both = np.concatenate([keys, *new])
            n = np.concatenate([counts, np.ones(len(both) - len(counts), dtype=np.int64)])
            k, back = np.unique(both, return_inverse=True)
            return k, np.bincount(back, weights=n, minlength=len(k)).astype(np.int64)

        for batch in text_slices(batches, "t"):
            slot, first = aligner.slots(batch.column("t"))
            sizes = np.diff(aligner.first)[slot]
            row = np.repeat(np.repeat(np.arange(len(first) - 1), np.diff(first)), sizes)
            pair = aligner.pairs[_ranges(aligner.first[slot], sizes)]
            new.append(np.unique(row << PAIR_BITS | pair) & ((1 << PAIR_BITS) - 1))
            if sum(map(len, new)) > most:
                keys, counts = merged()
                new.clear()
                if len(keys) > most:
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["pair", "n"])
                    keys, counts = keys[:0], counts[:0]
        keys, counts = merged()
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["pair", "n"])

    return texts.mapInArrow(run, "pair bigint, n bigint")


def _with_bucket(pairs: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket = bucket_of(batch.column("pair").to_numpy(), buckets)
            yield pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int32)), *batch.columns], ["bucket", *batch.schema.names])

    return pairs.mapInArrow(run, "bucket int, " + ", ".join(f"{n} {t}" for n, t in pairs.dtypes))


def _hash_buckets(distinct: DataFrame) -> DataFrame:
    """(bucket, hash, keys): the perfect hash of every bucket and its keys in slot order."""

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        keys = rows["pair"].to_numpy()
        made = PerfectHash.build(keys)
        ordered = np.empty(len(keys), dtype=np.int64)
        ordered[made.slots(keys)] = keys
        return pd.DataFrame({"bucket": [rows["bucket"].iloc[0]], "hash": [made.to_bytes()], "keys": [ordered.tobytes()]})

    return distinct.groupBy("bucket").applyInPandas(build, "bucket int, hash binary, keys binary")


def _tree_sum(partial: DataFrame, shared) -> DataFrame:
    """(bucket, counts): the dense count vectors of the buckets of one table, summed FAN vectors at a time."""

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        counts = np.zeros(len(table.keys), dtype=np.int64)
        for batch in batches:
            slot = table.slots(batch.column("pair").to_numpy())
            if (slot < 0).any():
                raise AssertionError("a counted pair is not in its table")
            np.add.at(counts, slot, batch.column("n").to_numpy())
        ends = [*list(table.start.values())[1:], len(counts)]
        for (b, a), z in zip(table.start.items(), ends):
            if counts[a:z].any():
                yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([counts[a:z].tobytes()], pa.binary())], ["bucket", "counts"])

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.frombuffer(x, dtype=np.int64) for x in rows["counts"])
        return pd.DataFrame({"bucket": [rows["bucket"].iloc[0]], "part": [rows["part"].iloc[0]], "counts": [total.tobytes()]})

    vectors = partial.select("pair", "n").mapInArrow(dense, "bucket int, counts binary")
    vectors = stash(vectors.select("bucket", F.spark_partition_id().alias("part"), "counts"), "vectors")
    left = (vectors.agg(F.max("part")).first()[0] or 0) + 1
    while left > 1:
        left = -(-left // FAN)
        level = vectors.select("bucket", F.floor(F.col("part") / FAN).cast("int").alias("part"), "counts")
        vectors = level.groupBy("bucket", "part").applyInPandas(add, "bucket int, part int, counts binary")
    return vectors.select("bucket", "counts")


class PairCounts:
    """Corpus-wide counts of the linked pairs of ``docs``, in lookup tables.

    ``a``, ``b``: paths of the tokenizers on the driver; their bytes (fixed vocabularies) are
    broadcast. A pair's number is its A id times 2**24 plus its B id. ``tables``: how many lookup
    tables there are; each holds about ``pairs`` pairs at most, or one bucket.
    """

    def __init__(self, docs: DataFrame, a: str, b: str, text_col: str = "text", pairs: int | None = None, bucket: int | None = None) -> None:
        pairs, bucket = pairs or PAIRS, bucket or BUCKET
        sc = docs.sparkSession.sparkContext
        with open(a, encoding="utf-8") as f, open(b, "rb") as g:
            self.tokenizers = sc.broadcast((f.read(), g.read()))
        partial = stash(_first_pass(docs.select(F.col(text_col).alias("t")), self.tokenizers), "pairs")
        distinct = stash(partial.select("pair").distinct(), "distinct")
        self.n_pairs = distinct.count()
        self.buckets = max(1, -(-self.n_pairs // bucket))
        hashes = stash(_hash_buckets(_with_bucket(distinct, self.buckets)), "hashes")
        # a table takes the buckets whose running sum of pairs falls to it; one row for each bucket
        upto = F.sum(F.octet_length("keys") / 8).over(Window.orderBy("bucket"))
        room = max(pairs - 2 * bucket, 1)
        placed = F.broadcast(stash(hashes.select("bucket", F.floor((upto - 1) / room).alias("tab")), "tables"))
        numbers = sorted(r["tab"] for r in placed.select("tab").distinct().collect())
        dealt = partial if len(numbers) < 2 else stash(_with_bucket(partial, self.buckets).join(placed, "bucket"), "dealt")
        self.parts = []
        for t in numbers:
            mine = hashes.join(placed.where(F.col("tab") == t), "bucket", "left_semi")
            table = sc.broadcast(PairTable(self.buckets, [r.asDict() for r in mine.collect()]))
            counts = _tree_sum(dealt if len(numbers) < 2 else dealt.where(F.col("tab") == t), table)
            self.parts.append(stash(mine.join(counts, "bucket"), "counts"))
            table.destroy()
        self.most = self._most(docs.sparkSession)

    @property
    def tables(self) -> int:
        return len(self.parts)

    def pairs(self, spark) -> DataFrame:
        """(a, b, n): the documents that hold a pair linked, one row for every linked pair of the corpus."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k, c in zip(batch.column("keys"), batch.column("counts")):
                    k, c = (np.frombuffer(x.as_py(), dtype=np.int64) for x in (k, c))
                    yield pa.RecordBatch.from_arrays([pa.array(k >> ID_BITS), pa.array(k & ((1 << ID_BITS) - 1)), pa.array(c)], ["a", "b", "n"])

        out = spark.createDataFrame([], "keys binary, counts binary")
        for p in self.parts:
            out = out.unionByName(p.select("keys", "counts"))
        return out.mapInArrow(run, "a bigint, b bigint, n bigint")

    def _most(self, spark) -> np.ndarray:
        """The highest count of every id of A; one row for each id of the vocabulary."""
        rows = self.pairs(spark).groupBy("a").agg(F.max("n").alias("n")).collect()
        out = np.zeros(max((r["a"] for r in rows), default=0) + 1, dtype=np.int64)
        for r in rows:
            out[r["a"]] = r["n"]
        return out

    def lookup(self, t: int) -> PairTable:
        return PairTable(self.buckets, [r.asDict() for r in self.parts[t].collect()])


def _second_pass(texts: DataFrame, counts: PairCounts, t: int) -> DataFrame:
    """Rows of ``texts`` (i, d, t) aligned again, with their best links and count sums under lookup table ``t``."""
    sc = texts.sparkSession.sparkContext
    tokenizers, table = counts.tokenizers, sc.broadcast((counts.lookup(t) if counts.tables else PairTable(1, []), counts.most))
    whole = t == 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, (pairs, most) = Aligner.of(*tokenizers.value, whole), table.value
        age, sums = -1, np.zeros((0, 2), dtype=np.int64)

        def counted(first: int) -> np.ndarray:
            """Best links and count sums of the words from slot ``first`` on: they are the same in every text."""
            at = aligner.first[first:]
            distinct, back = np.unique(aligner.pairs[at[0]:], return_inverse=True)
            slot = pairs.slots(distinct)
            n = np.where(slot >= 0, pairs.counts[slot] if len(pairs.counts) else 0, 0)
            top = (slot >= 0) & (n == most[np.minimum(distinct >> ID_BITS, len(most) - 1)])
            times = aligner.times[at[0]:]
            run_ = [np.concatenate([[0], np.cumsum(times * x[back])]) for x in (top, n)]
            return np.stack([np.diff(x[at - at[0]]) for x in run_], axis=1)

        for batch in text_slices(batches, "t"):
            slot, first = aligner.slots(batch.column("t"))
            if age != aligner.age:
                age, sums = aligner.age, sums[:0]
            if len(sums) < len(aligner.numbers):
                sums = np.concatenate([sums, counted(len(sums))])
            of_word = np.concatenate([aligner.numbers[slot], sums[slot]], axis=1)
            cells = np.diff(np.concatenate([np.zeros((1, 6), np.int64), np.cumsum(of_word, axis=0)])[first], axis=0)
            groups = None
            if whole:
                parts = [aligner.groups[i] for i in slot.tolist()]
                groups = [";".join(parts[x:y]) for x, y in zip(first[:-1].tolist(), first[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column("i"), batch.column("d"), *(pa.array(cells[:, k]) for k in range(6)),
                 pa.array(groups, pa.string()) if whole else pa.nulls(len(cells), pa.string())],
                ["i", "d", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups"])

    kind = texts.schema["i"].dataType.simpleString()
    return texts.mapInArrow(run, f"i {kind}, d binary, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
                                 "n_best bigint, count_sum bigint, groups string")


def align(docs: DataFrame, a: str, b: str, id_col: str = "doc_id", text_col: str = "text", pairs: int | None = None,
          bucket: int | None = None) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups) of every row of ``docs``.

    ``groups`` lists the groups as ``a1,a2|b1;a3|b2,b3``. ``n_best``: links whose pair no other pair
    of the same A id exceeds in the corpus; ``count_sum``: the documents that hold a link's pair, summed
    over the links. Null and empty texts, and texts whose tokens do not give back the space and the text, have zeros and
    empty groups. Every row counts as a document, rows that repeat an id or a text too. Extra
    columns are left out; an empty table gives an empty table.
    """
    counts = PairCounts(docs, a, b, text_col, pairs, bucket)
    texts = docs.select(F.col(id_col).alias("i"), F.unhex(F.md5(text_col)).alias("d"), F.col(text_col).alias("t"))
    out = _second_pass(texts, counts, 0)
    rest = None
    for t in range(1, counts.tables):
        more = _second_pass(texts, counts, t).select("i", "d", "n_best", "count_sum")
        # equal rows have equal numbers: one of them is enough
        more = stash(more.dropDuplicates(["i", "d"]), "more")
        rest = more if rest is None else rest.unionByName(more)
    if rest is not None:
        rest = rest.groupBy(F.col("i").alias("i_"), F.col("d").alias("d_")).agg(F.sum("n_best").alias("b_"), F.sum("count_sum").alias("s_"))
        out = out.join(rest, F.col("i").eqNullSafe(F.col("i_")) & F.col("d").eqNullSafe(F.col("d_")), "left")
        out = out.withColumns({"n_best": F.col("n_best") + F.coalesce("b_", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("s_", F.lit(0))})
    return out.select(F.col("i").alias("id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
