"""Token ids as Parquet list columns.

Documents are put in ascending id order by a range partitioning and encoded partition by
partition; every partition is one file. The ids are dictionary-encoded list values, the
metadata columns are delta-encoded, row groups and pages are kept small and the page
indexes are written, so that a reader fetches only the pages of the documents or columns
that it asks for. Reads use Spark's own Parquet source.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkwell.llm.common import text_slices
from inkwell.llm.text_hash import pieces

#: Bytes of a row group and of a page, rows of a page.
ROW_GROUP, PAGE, PAGE_ROWS = 32 << 20, 128 << 10, 512
#: Fixed value: the pre-token pattern of the word tokenizers that are encoded piece by piece.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Pieces whose ids a Python worker remembers; most that go through the tokenizer at once (its answer takes far more
#: memory than the ids, and a worker that lives on keeps it).
REMEMBER, LEARN = 2_000_000, 1 << 13


class PieceEncoder:
    """Encodes whole texts through the tokenizers library, each distinct piece of text once.

    For word tokenizers that drop white space, the ids of a text are those of its pieces one
    after the other: no pre-token spans white space or goes from an ASCII letter or digit to
    ASCII punctuation or back (the apostrophe of contractions apart). Other tokenizers
    get whole texts. Both ways give what ``encode(text, add_special_tokens=False)`` gives.
    """

    made: dict[int, "PieceEncoder"] = {}

    def __init__(self, spec: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        config = json.loads(spec)
        self.whole = [x["content"].encode() for x in config.get("added_tokens", [])]
        self.by_piece = _by_words(config)
        self.ends = np.zeros(0, dtype=bool)
        if self.by_piece:
            vocab = self.tokenizer.get_vocab(with_added_tokens=True)
            self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
            suffix = config["model"]["end_of_word_suffix"]
            self.ends[[i for w, i in vocab.items() if w.endswith(suffix)]] = True
        self._forget()

    @classmethod
    def of(cls, spec: str) -> "PieceEncoder":
        key = hash(spec)
        if key not in cls.made:
            cls.made[key] = cls(spec)
        return cls.made[key]

    def _forget(self) -> None:
        self.keys = np.zeros(0, dtype=np.uint64)  # sorted hashes of the known pieces
        self.slot = np.zeros(0, dtype=np.int32)
        self.start = np.zeros(1, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.int32)

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        encode = self.tokenizer.encode_batch_fast
        simple = np.array([x.isalpha() for x in texts], dtype=bool)
        flat = lengths = np.zeros(0, dtype=np.int32)
        if simple.any():
            joined = " ".join([x for x, ok in zip(texts, simple) if ok])
            flat = np.array(encode([joined], add_special_tokens=False)[0].ids, dtype=np.int32)
            lengths = np.diff(np.flatnonzero(self.ends[flat]), prepend=-1)
            if len(lengths) != simple.sum():  # some piece is not one pre-token
                flat, lengths, simple = flat[:0], lengths[:0], np.zeros(len(texts), dtype=bool)
        rest = [x.ids for x in encode([x for x, ok in zip(texts, simple) if not ok], add_special_tokens=False)]
        lengths = np.concatenate([lengths, [len(x) for x in rest]]).astype(np.int64)
        first = len(self.start) - 1
        slot = np.empty(len(keys), dtype=np.int32)
        slot[np.concatenate([np.flatnonzero(simple), np.flatnonzero(~simple)])] = np.arange(first, first + len(keys))
        at = np.searchsorted(self.keys, keys)
        self.keys, self.slot = np.insert(self.keys, at, keys), np.insert(self.slot, at, slot)
        self.start = np.concatenate([self.start, self.start[-1] + np.cumsum(lengths)])
        self.ids = np.concatenate([self.ids, flat, np.array([i for x in rest for i in x], dtype=np.int32)])

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, first of each row, len + 1); a null text has none."""
        if not self.by_piece:
            rows = [np.array(x.ids, dtype=np.int32) for x in
                    self.tokenizer.encode_batch([x or "" for x in column.to_pylist()], add_special_tokens=False)]
            return np.concatenate([np.zeros(0, np.int32), *rows]), np.cumsum([0, *(len(x) for x in rows)])
        h, s, e, first, data = pieces(column, self.whole)
        if not len(h):
            return np.zeros(0, np.int32), np.zeros(len(first), dtype=np.int64)
        keys, at, back = np.unique(h, return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > REMEMBER:
            self._forget()
        place = np.searchsorted(self.keys, keys)
        new = np.ones(len(keys), dtype=bool)
        inside = place < len(self.keys)
        new[inside] = self.keys[place[inside]] != keys[inside]
        if new.any():
            blob, fresh = data.tobytes(), np.flatnonzero(new)
            for lo in range(0, len(fresh), LEARN):
                some = fresh[lo:lo + LEARN]
                self._learn(keys[some], [blob[a:b].decode() for a, b in zip(s[at[some]].tolist(), e[at[some]].tolist())])
        place = self.slot[np.searchsorted(self.keys, keys)][back]
        lengths = self.start[place + 1] - self.start[place]
        to = np.zeros(len(h) + 1, dtype=np.int64)
        np.cumsum(lengths, out=to[1:])
        source = np.repeat(self.start[place] - to[:-1], lengths) + np.arange(to[-1])
        return self.ids[source], to[first]


def _by_words(config: dict) -> bool:
    """Whether the tokenizer splits at white space, drops it, folds case and ends words with a suffix."""
    cuts = [((x.get("pattern") or {}).get("Regex"), x.get("behavior")) for x in (config.get("pre_tokenizer") or {}).get("pretokenizers", [])]
    plain = all(not (x.get("lstrip") or x.get("rstrip") or x.get("single_word") or x.get("normalized") or re.search(r"\s", x["content"]))
                for x in config.get("added_tokens", []))
    norm = [x.get("type") for x in (config.get("normalizer") or {}).get("normalizers", [])]
    return (plain and cuts[:1] == [(WORD_PATTERN, "Removed")] and norm == ["NFC", "Replace", "Lowercase"]
            and bool(config["model"].get("end_of_word_suffix")) and not config["model"].get("dropout"))


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
           end_id: int = 1) -> DataFrame:
    """(doc_id, n_tokens, input_ids) of every row: the whole text's ids and ``end_id``; a null text is empty.

    ``tokenizer`` is the path of the tokenizer's JSON file on the driver; its text (a fixed
    vocabulary, whatever the corpus) is broadcast.
    """
    with open(tokenizer, encoding="utf-8") as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = PieceEncoder.of(spec.value)
        for batch in text_slices(batches, "t"):
            ids, first = coder.encode(batch.column("t"))
            n = np.diff(first)
            starts = np.zeros(len(n) + 1, dtype=np.int64)
            np.cumsum(n + 1, out=starts[1:])
            flat = np.full(starts[-1], end_id, dtype=np.int32)
            mask = np.ones(starts[-1], dtype=bool)
            mask[starts[1:] - 1] = False
            flat[mask] = ids
            yield pa.RecordBatch.from_arrays(
                [batch.column("i"), pa.array(n + 1, pa.int64()),
                 pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(flat))],
                ["doc_id", "n_tokens", "input_ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).mapInArrow(
        run, f"doc_id {kind}, n_tokens bigint, input_ids array<int>")


def write_tokens(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = 1, row_group: int = ROW_GROUP, page: int = PAGE, page_rows: int = PAGE_ROWS) -> None:
    """Write the token ids of ``docs`` to Parquet files in ascending id order (nulls first).

    One row for each row; rows that repeat an id stand one after the other, ordered by a hash of
    their texts, and may be dealt to several files. No rows give an empty table. The files' numbers
    (``part-<number>``) are in id order.
    """
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    rows = rows.repartitionByRange(F.col("i"), F.xxhash64("t")).sortWithinPartitions("i", F.xxhash64("t"))
    (encode(rows, tokenizer, "i", "t", end_id).write.option("compression", "zstd")
     .option("parquet.block.size", row_group).option("parquet.page.size", page)
     .option("parquet.page.row.count.limit", page_rows).option("parquet.writer.version", "PARQUET_2_0")
     .option("parquet.enable.dictionary", "true").option("parquet.enable.dictionary#doc_id", "false")
     .option("parquet.enable.dictionary#n_tokens", "false").parquet(path))


def read_tokens(spark: SparkSession, path: str, ids: tuple[int, int] | None = None, tokens: bool = True) -> DataFrame:
    """The stored rows; ``ids``: only ids in [low, high], which prunes files, row groups and pages.

    Without ``tokens`` only the metadata columns are read.
    """
    df = spark.read.parquet(path)
    if ids is not None:
        df = df.where(F.col("doc_id").between(*ids))
    return df if tokens else df.select("doc_id", "n_tokens")


def token_starts(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every stored row, from the files.

    ``start``: ids of all rows before it. Files come in id order by their numbers, so it is the total of the
    files before (one row for each file) and the running sum within the file.
    """

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("input_ids")
            flat, at = lists.values.to_numpy().astype("<u4", copy=False), lists.offsets.to_numpy()
            sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("row"), batch.column("doc_id"),
                 pa.array(np.diff(at), pa.int64()), pa.array(sums, pa.int64())],
                ["file", "row", "doc_id", "n_tokens", "ids_crc32"])

    df = spark.read.parquet(path)
    kind = df.schema["doc_id"].dataType.simpleString()
    rows = df.select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"),
                     "doc_id", "input_ids").mapInArrow(
        crc, f"file string, row bigint, doc_id {kind}, n_tokens bigint, ids_crc32 bigint")
    totals = df.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.sum("n_tokens").alias("all"))
    number = F.regexp_extract("file", "^part-(\\d+)", 1).cast("bigint")  # not by name: part-100000 is after part-99999
    before = Window.orderBy(number, "file").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("file", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("file").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.withColumn("inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(totals, "file")
            .select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"))
