"""Exact token counts of every prefix of a text, by dynamic programming over its prefixes.

The tokens of a byte-pair encoding are fixed by neighbours alone: a sequence of tokens is the
encoding of its text if and only if every two adjacent tokens are the encoding of theirs. So each
prefix has exactly one last token that fits the last token of the prefix before it, and one pass
gives the count of every prefix. No token spans the start of a word (a run of spaces), the start of a
line or, in vocabularies that part them, the place between a letter and another character, so the pass runs once for each distinct word and the counts of a text are running sums.

The index is a table with one row for every BLOCK code points of a document: the tokens before
the block and, for every prefix that ends in it, what the count differs from that. Questions about
truncation and budgets read the index; texts are not encoded again. Counts of prefixes are not
monotonic: a longer prefix may have fewer tokens.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.llm.common import stash, text_slices

#: Code points of a block of the index.
BLOCK = 4096
#: Words and token pairs that a Python worker remembers; longer words are not remembered.
REMEMBER, LONG = 1_000_000, 128
#: Fixed value: the character that stands for a space in the pieces.
SPACE = "▁"


class PrefixCounter:
    """Token counts of all prefixes under a sentencepiece BPE model with identity normalisation."""

    made: dict[int, "PrefixCounter"] = {}

    def __init__(self, model: bytes) -> None:
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        normal = proto.normalizer_spec
        if proto.trainer_spec.model_type != proto.trainer_spec.BPE or normal.precompiled_charsmap \
                or normal.remove_extra_whitespaces or not normal.add_dummy_prefix or proto.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("prefix counts need a BPE model with identity normalisation and a leading space")
        self.pieces = {p.piece: i for i, p in enumerate(proto.pieces) if p.type == proto.SentencePiece.NORMAL}
        if any(p.type in (proto.SentencePiece.USER_DEFINED, proto.SentencePiece.UNUSED) for p in proto.pieces) \
                or any("\n" in p or SPACE in p.lstrip(SPACE) for p in self.pieces):
            raise ValueError("prefix counts need pieces that hold no line end and no space after another character")
        # every end of a piece: None ends the search for pieces that stop at a place
        self.ends = {p[i:]: False for p in self.pieces for i in range(len(p))} | dict.fromkeys(self.pieces, True)
        self.bigrams = {p[i:i + 2] for p in self.pieces for i in range(len(p) - 1)}
        letters = {c for p in self.pieces for c in p if c.isalpha()}
        if any((x[0] in letters) != (x[1] in letters) for x in self.bigrams if x[0] != SPACE):
            letters = set()  # letters and other characters share pieces: only spaces and line ends part words
        some = re.escape("".join(sorted(letters)))
        cut = [f"{SPACE}*[{some}]+"] if letters else []
        self.words_of = re.compile("|".join([*cut, f"{SPACE}*[^{some}{SPACE}\n]+", f"{SPACE}+", "\n"])).findall
        fallback = proto.trainer_spec.byte_fallback
        self.cost = lambda c: len(c.encode()) if fallback else 1
        self.library = SentencePieceProcessor(model_proto=model)
        self.line = len(self.library.encode("\n"))
        self._forget()

    @classmethod
    def of(cls, model: bytes) -> "PrefixCounter":
        key = hash(model)
        if key not in cls.made:
            cls.made[key] = cls(model)
        return cls.made[key]

    def _forget(self) -> None:
        self.fits: dict[tuple[str, str], bool] = {}
        self.known: dict[str, bytes] = {}

    def _fit(self, a: str, b: str) -> bool:
        """Whether b may follow a (a empty: b may come first), by the library's own encoding of both together."""
        pieces = self.pieces
        if a and a[-1] + b[0] not in self.bigrams:
            got = self._fit("", b)  # nothing merges across: b has to be a whole encoding itself
        elif a and a + b in pieces:
            got = False
        else:
            # a line end merges with nothing, so it keeps the leading space that the library adds apart
            want = [pieces[x] for x in (a, b) if x in pieces]
            got = b not in pieces or self.library.encode("\n" + (a + b).replace(SPACE, " "))[self.line:] == want
        self.fits[(a, b)] = got
        return got

    def _word(self, word: str) -> bytes:
        """Tokens of word[:1], word[:2], ... word, as 4-byte numbers."""
        last, count, ends, fits = [""], [0], self.ends.get, self.fits.get
        for i in range(1, len(word) + 1):
            for j in range(i - 1, -1, -1):
                token = word[j:i]
                piece = ends(token)
                if piece is None and j < i - 1:
                    raise AssertionError(f"no token ends at {i} of {word!r}")
                if piece or j == i - 1:
                    a = last[j]
                    ok = fits((a, token))
                    if self._fit(a, token) if ok is None else ok:
                        last.append(token)
                        count.append(count[j] + (1 if piece else self.cost(token)))
                        break
        return array("I", count[1:]).tobytes()

    def _words(self, found: list[str]) -> list[bytes]:
        known, out = self.known, []
        for word in found:
            got = known.get(word)
            if got is None:
                got = self._word(word)
                if len(word) <= LONG:
                    known[word] = got
            out.append(got)
        if len(known) > REMEMBER or len(self.fits) > 4 * REMEMBER:
            self._forget()
        return out

    def counts(self, text: str) -> np.ndarray:
        """Tokens of text[:0], text[:1], ... text, as the library counts them; the empty prefix has none."""
        if not text:
            return np.zeros(1, dtype=np.int64)
        parts = self._words(self.words_of(SPACE + text.replace(" ", SPACE)))
        n = np.frombuffer(b"".join(parts), dtype="<u4").astype(np.int64)
        lengths = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) // 4
        whole = n[np.cumsum(lengths) - 1]
        n += np.repeat(np.cumsum(whole) - whole, lengths)
        n[0] = 0  # the leading space is no character of the text
        return n


def prefix_index(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK) -> DataFrame:
    """The prefix index: (doc_id, digest, block, base, counts, last, n_chars, n_bytes, n_tokens).

    ``model`` is the path of the sentencepiece file on the driver; its bytes (a fixed vocabulary)
    are broadcast. Row ``block`` holds the prefixes of block * BLOCK + 1 to (block + 1) * BLOCK code
    points: ``base`` tokens and ``counts[i]`` more. ``last`` marks the last row of a document; only
    that one has its code points, bytes and tokens. Every row of ``docs`` has one such row: a null or
    empty text one block without counts (its digest null, or that of the empty text). Repeated ids
    are told apart by ``digest``, the md5 of the text; equal rows give equal index rows. Extra
    columns of ``docs`` are left out.
    """
    with open(model, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PrefixCounter.of(shared.value)
        for batch in text_slices(batches, "t"):
            source, number, base, rows, tail = [], [], [], [], []
            for i, text in enumerate(batch.column("t").to_pylist()):
                n = counter.counts(text or "")
                total = len(n) - 1
                for b in range(max(1, -(-total // block))):
                    part = n[b * block + 1:(b + 1) * block + 1]
                    source.append(i)
                    number.append(b)
                    base.append(n[b * block])
                    rows.append((part - n[b * block]).astype(np.int16))
                    tail.append(None)
                tail[-1] = (total, len((text or "").encode()), int(n[-1]))
            ends = np.cumsum([0, *(len(x) for x in rows)])
            picked = pa.array(source, pa.int32())
            cells = [[None if x is None else x[k] for x in tail] for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("i").take(picked), batch.column("d").take(picked), pa.array(number, pa.int32()),
                 pa.array(np.array(base, dtype=np.int64)),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int16), *rows]))),
                 pa.array([x is not None for x in tail], pa.bool_()), *(pa.array(x, pa.int64()) for x in cells)],
                ["doc_id", "digest", "block", "base", "counts", "last", "n_chars", "n_bytes", "n_tokens"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    return rows.withColumn("d", F.unhex(F.md5("t"))).mapInArrow(
        run, f"doc_id {kind}, digest binary, block int, base bigint, counts array<smallint>, last boolean, "
             "n_chars bigint, n_bytes bigint, n_tokens bigint")


def write_index(index: DataFrame, path: str) -> None:
    """Store the index; counts are delta-encoded, so a code point takes a few bits."""
    (index.write.option("compression", "zstd").option("parquet.writer.version", "PARQUET_2_0")
     .option("parquet.enable.dictionary", "false").parquet(path))


def totals(index: DataFrame) -> DataFrame:
    """(doc_id, digest, n_chars, n_bytes, n_tokens): one row for every document row; reads no counts."""
    return index.where("last").select("doc_id", "digest", "n_chars", "n_bytes", "n_tokens")


def prefix_tokens(index: DataFrame, prefixes: DataFrame, block: int = BLOCK) -> DataFrame:
    """Columns of ``prefixes`` (doc_id, digest, chars, more) and ``tokens`` of the first ``chars`` code points.

    A prefix longer than its text, negative, or of an unknown document has null tokens. Only the
    blocks asked for are joined: both sides are dealt by (document, block).
    """
    place = F.when(F.col("chars") > 0, F.floor((F.col("chars") - 1) / block)).otherwise(0).cast("int")
    side = index.select("doc_id", "digest", F.col("block").alias("_block"), "base", "counts").dropDuplicates(["doc_id", "digest", "_block"])
    asked = prefixes.withColumn("_block", place)
    same = [asked[c].eqNullSafe(side[c]) for c in ("doc_id", "digest", "_block")]
    at = F.get(F.col("counts"), F.pmod(F.col("chars") - 1, F.lit(block)).cast("int"))
    tokens = F.when(F.col("chars") == 0, F.col("base")).when(F.col("chars") > 0, F.col("base") + at)
    return asked.join(side, same, "left").select(*[asked[f"`{c}`"] for c in prefixes.columns], tokens.cast("bigint").alias("tokens"))


def truncations(index: DataFrame, limit: int, block: int = BLOCK) -> DataFrame:
    """(doc_id, digest, chars, tokens): the longest prefix of every document with ``limit`` tokens at most.

    Every block finds its longest such prefix inside the row; a document keeps the one of its last
    block that has any. The empty prefix always fits.
    """
    room = F.lit(limit) - F.col("base")
    fits = F.transform("counts", lambda c, i: F.when(c <= room, i + 1).otherwise(0))
    end = F.coalesce(F.array_max(fits), F.lit(0))
    found = index.select("doc_id", "digest", F.when(end > 0, F.struct(
        (F.col("block").cast("bigint") * block + end).alias("chars"),
        (F.col("base") + F.get(F.col("counts"), end - 1)).alias("tokens"))).alias("cut"))
    cut = F.max("cut")
    return found.groupBy("doc_id", "digest").agg(cut.alias("cut")).select(
        "doc_id", "digest", F.coalesce("cut.chars", F.lit(0)).cast("bigint").alias("chars"),
        F.coalesce("cut.tokens", F.lit(0)).cast("bigint").alias("tokens"))


def truncate(docs: DataFrame, index: DataFrame, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs``, all rows and columns, each text cut to its longest prefix of ``limit`` tokens at most; null stays null."""
    cuts = truncations(index, limit).select(F.col("doc_id").alias("__id"), F.col("digest").alias("__digest"), F.col("chars").alias("__chars"))
    same = docs[id_col].eqNullSafe(F.col("__id")) & F.unhex(F.md5(docs[text_col])).eqNullSafe(F.col("__digest"))
    cut = docs.join(cuts, same, "left")
    return cut.select(*[(F.substring(docs[text_col], F.lit(1), F.col("__chars").cast("int")).alias(c) if c == text_col
                         else docs[f"`{c}`"]) for c in docs.columns])


def within_budget(index: DataFrame, budget: int, parts: int = 256) -> DataFrame:
    """(doc_id, digest, n_tokens, start, part): what a budget of tokens takes, documents in (doc_id, digest) order.

    ``part`` is the tokens that fit of each document that the budget reaches: all, or of the last
    one what is left. Starts are running sums inside ranges of ids plus the sums of the ranges
    before, so no task sees all documents.
    """
    rows = totals(index).select("doc_id", "digest", "n_tokens")
    rows = rows.repartitionByRange(parts, "doc_id", "digest").withColumn("_p", F.spark_partition_id())
    rows = stash(rows, "budget")  # the ranges are sampled: they have to stay as they are
    sums = rows.groupBy("_p").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_p").orderBy("doc_id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    start = F.col("_before") + F.col("_inside")
    return (rows.join(F.broadcast(sums), "_p").withColumn("start", start).where(F.col("start") < budget)
            .select("doc_id", "digest", "n_tokens", "start", F.least("n_tokens", F.lit(budget) - F.col("start")).alias("part")))
