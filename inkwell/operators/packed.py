"""Terms of many documents, counted in blocks and exchanged packed.

A task counts the terms of a block of documents at once (numpy on Arrow columns). Where sums over all documents
are needed, a block sends each part (by a hash of the term) one value with its distinct terms and where
they occur: a term goes once for each block, not once for each document. The terms are compared whole; hashes
only choose the part. A part sends each block one value back with sums for the block's rows,
and the block's parts are added up. Both exchanges are shuffles of few, large rows; a part's size is bounded by
the number of parts, a block's by BLOCK.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

#: Terms of a block (one row at least), and most rows of it.
BLOCK, BLOCK_ROWS = 1 << 20, 1 << 14
#: Characters of text whose terms a part takes at most, and at least while there are cores without a part.
PART_CHARS, SMALL_CHARS = 32 << 20, 1 << 20
#: Bytes of a record batch on its way to a worker.
BATCH_BYTES = 2 << 20

#: Kinds of packed rows: a block's own columns, where its terms occur, the same of seeds.
HEADER, TERMS, SEEDS = 0, 1, 2
PACKED = "part int, block bigint, kind int, data binary"
SUMS = "block bigint, kind int, data binary"


def parts_of(spark: SparkSession, chars: int) -> int:
    """Parts for the terms of texts of so many characters."""
    return max(1, -(-chars // PART_CHARS), min(4 * spark.sparkContext.defaultParallelism, -(-chars // SMALL_CHARS)))


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of numbers as compressed bytes; whole numbers take as few bytes as the largest needs."""
    out = [len(arrays).to_bytes(4, "little")]
    for a in arrays:
        if a.dtype.kind in "iu" and a.dtype != np.uint8 and (not len(a) or a.min() >= 0):
            a = a.astype(np.min_scalar_type(int(a.max()) if len(a) else 0))
        head = f"{a.dtype.str}:{len(a)}".encode()
        out += [len(head).to_bytes(4, "little"), head, np.ascontiguousarray(a).tobytes()]
    raw = b"".join(out)
    return len(raw).to_bytes(8, "little") + pa.Codec("zstd", compression_level=1).compress(raw, asbytes=True)


def unpack(data: bytes) -> list[np.ndarray]:
    size = int.from_bytes(data[:8], "little")
    raw = pa.Codec("zstd").decompress(data[8:], size, asbytes=True)
    n, at, out = int.from_bytes(raw[:4], "little"), 4, []
    for _ in range(n):
        size = int.from_bytes(raw[at:at + 4], "little")
        kind, length = raw[at + 4:at + 4 + size].decode().rsplit(":", 1)
        at += 4 + size
        out.append(np.frombuffer(raw, np.dtype(kind), int(length), at))
        at += out[-1].nbytes
    return out


def _ipc(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_table(table)
    return sink.getvalue().to_pybytes()


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and the sum of each one's values."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(values[order], starts) if len(keys) else values


def segments(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of every segment, one segment after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def runs(batches: Iterator[pa.RecordBatch], limit: int | None = None) -> Iterator[pa.Table]:
    """Whole rows with ``limit`` terms at most (one row at least) as tables, from batches of any size."""
    limit, held, size, rows = limit or BLOCK, [], 0, 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column("terms")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = int(ends[start - 1]) if start else 0
            stop = min(int(np.searchsorted(ends, base + limit - size, side="right")), start + BLOCK_ROWS - rows)
            stop = max(stop, start + (not held))
            if stop > start:
                held.append(batch.slice(start, stop - start))
                size, rows, start = size + int(ends[stop - 1]) - base, rows + stop - start, stop
            if start < batch.num_rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size, rows = [], 0, 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


@dataclass
class Counts:
    """The distinct terms of a block, a word or two words in a row, and the rows with each, in order."""

    words: pa.Array         # distinct words, in order
    first: np.ndarray       # of each term: its word
    second: np.ndarray      # its second word, else -1
    starts: np.ndarray      # where its rows begin
    lengths: np.ndarray     # how many there are
    rows: np.ndarray
    times: np.ndarray       # occurrences in the row

    def strings(self, of: np.ndarray) -> pa.Array:
        """The terms at the places ``of``."""
        left = self.words.take(pa.array(self.first[of]))
        second = self.second[of]
        if not len(second) or second.max() < 0:
            return left
        right = self.words.take(pa.array(second, mask=second < 0))
        return pc.binary_join_element_wise(left, right, " ", null_handling="skip")


def count(lists: pa.ListArray, pairs: bool) -> Counts:
    """Counts of the words of every row and, with ``pairs``, of its pairs of neighbours. A null is no word and parts its neighbours."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    n, values = len(lists), lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    row = np.repeat(np.arange(n, dtype=np.int64), np.diff(offsets))
    coded = values.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    place = np.empty(len(order) + 1, np.int64)
    place[order], place[-1] = np.arange(len(order)), -1
    word = place[pc.fill_null(coded.indices, len(order)).to_numpy(zero_copy_only=False)]
    wide = len(order) + 1
    known = word >= 0
    keys = word[known] * wide * n + row[known]
    if pairs and len(word) > 1:
        both = known[1:] & known[:-1] & (row[1:] == row[:-1])
        keys = np.concatenate([keys, (word[:-1][both] * wide + word[1:][both] + 1) * n + row[1:][both]])
    keys.sort()
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    times = np.diff(at, append=len(keys))
    term, rows = np.divmod(keys[at], max(n, 1))
    starts = np.flatnonzero(np.concatenate([[True], term[1:] != term[:-1]])) if len(term) else np.zeros(0, np.int64)
    first, second = np.divmod(term[starts], wide)
    return Counts(coded.dictionary.take(pa.array(order)), first, second - 1, starts, np.diff(starts, append=len(term)), rows, times)


def _part(counts: Counts, parts: int) -> np.ndarray:
    """The part of every term; of a single word ``crc32(word) % parts``, as Spark's crc32 gives."""
    crc = np.fromiter((zlib.crc32(w) for w in counts.words.cast(pa.binary()).to_pylist()), np.uint64, len(counts.words))
    h = crc[counts.first]
    two = counts.second >= 0
    mixed = (h[two] * np.uint64(0x9E3779B97F4A7C15)) ^ (crc[counts.second[two]] * np.uint64(0xC2B2AE3D27D4EB4F))
    h[two] = mixed ^ (mixed >> np.uint64(31))
    return (h % np.uint64(parts)).astype(np.int64)


def _text(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, length of each) of an array of strings."""
    if not len(strings):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    offsets = np.frombuffer(strings.buffers()[1], np.int32)[strings.offset:strings.offset + len(strings) + 1]
    return np.frombuffer(strings.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]], np.diff(offsets)


def strings_of(text: np.ndarray, lengths: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]).astype(np.int32)
    return pa.StringArray.from_buffers(len(lengths), pa.py_buffer(offsets), pa.py_buffer(text))


def deal(docs: DataFrame, parts: int, pairs: bool, kind: int = TERMS) -> DataFrame:
    """Packed rows of ``docs`` (terms, other columns): for each block a header with its other columns, and for each
    part its distinct terms with the rows where they occur. Rows of one ``grp`` stand together where there is that column.

    With ``kind`` SEEDS the rows are named by their column ``number`` and there is no header.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        base = (task.partitionId() if task else 0) << 32
        for seq, table in enumerate(runs(batches)):
            if "grp" in table.column_names:
                table = table.take(pc.sort_indices(table.column("grp"))).combine_chunks()
            block = base + seq if kind == TERMS else -1 - base - seq
            found, names, first = [], np.zeros(0, np.uint8), np.zeros(0, np.int64)
            own = table.drop_columns(["terms"])
            if "grp" in table.column_names:
                names, first = _groups(_one(table.column("grp")))
            if kind == TERMS:
                header = _ipc(own)
                found.append((block % parts, HEADER, header))
            mark = zlib.crc32(header) if kind == TERMS else 0
            c = count(_one(table.column("terms")), pairs)
            part = _part(c, parts)
            order = np.argsort(part.astype(np.uint16) if parts < 1 << 16 else part, kind="stable")
            part, lengths = part[order], c.lengths[order]
            entries = segments(c.starts[order], lengths)
            rows, times, text = c.rows[entries], c.times[entries], c.strings(order)
            if kind == SEEDS:
                rows = _one(own.column("number")).to_numpy()[rows]
            ends = np.concatenate([[0], np.cumsum(lengths)])
            cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else np.zeros(0, np.int64)
            for a, b in zip(cuts, np.append(cuts[1:], len(part)), strict=True):
                e = slice(ends[a], ends[b])
                found.append((int(part[a]), kind, pack(np.array([table.num_rows, mark]), *_text(text.slice(a, b - a)), lengths[a:b], rows[e], times[e], names, first)))
            for some in range(0, len(found), 64):
                p, k, d = zip(*found[some:some + 64], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(p, pa.int32()), pa.array([block] * len(p), pa.int64()), pa.array(k, pa.int32()),
                                                  pa.array(d, pa.binary())], ["part", "block", "kind", "data"])

    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return docs.mapInArrow(run, PACKED)


def _groups(sorted_names: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(the distinct names as bytes of a table, where the rows of each begin)."""
    coded = sorted_names.dictionary_encode()
    codes = coded.indices.to_numpy()
    return np.frombuffer(_ipc(pa.table({"name": coded.dictionary})), np.uint8), np.flatnonzero(np.diff(codes, prepend=-1))


def _one(column: pa.ChunkedArray) -> pa.Array:
    return column.chunk(0) if column.num_chunks == 1 else pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


@dataclass
class Piece:
    """What a block, or a block of seeds, has in a part: ``terms`` are places in the part's array of distinct terms."""

    block: int
    kind: int
    n: int              # rows of the block
    mark: int           # of the block's header
    terms: np.ndarray
    lengths: np.ndarray
    rows: np.ndarray
    times: np.ndarray
    names: np.ndarray   # groups of the block's rows (``group_names``) and where each begins, if they have any
    first: np.ndarray

    def group_names(self) -> list[str]:
        return pa.ipc.open_stream(self.names.tobytes()).read_all()["name"].to_pylist() if len(self.names) else []


def pieces(table: pa.Table, more: pa.Array | None = None) -> tuple[list[Piece], pa.Array, np.ndarray]:
    """The pieces of a part, its distinct terms, and the places of the strings ``more`` among these."""
    found, texts = [], []
    for block, kind, data in zip(table["block"].to_pylist(), table["kind"].to_pylist(), table["data"], strict=True):
        if kind != HEADER:
            (n, mark), text, sizes, *rest = unpack(data.as_py())
            found.append((block, kind, int(n), int(mark), *rest))
            texts.append(strings_of(text, sizes))
    texts.append(pa.array([], pa.string()) if more is None else more)
    coded = pa.concat_arrays(texts).dictionary_encode()
    place, at, out = coded.indices.to_numpy(), 0, []
    for (block, kind, n, mark, *rest), text in zip(found, texts, strict=False):
        out.append(Piece(block, kind, n, mark, place[at:at + len(text)], *rest))
        at += len(text)
    return out, coded.dictionary, place[at:]


def passed_on(table: pa.Table) -> list[tuple[int, int, bytes]]:
    """The headers of a part, as rows of sums."""
    return [(r["block"], HEADER, r["data"]) for r in table.filter(pc.equal(table["kind"], HEADER)).to_pylist()]


def sums_table(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    return pa.table({"block": pa.array([r[0] for r in rows], pa.int64()), "kind": pa.array([r[1] for r in rows], pa.int32()),
                     "data": pa.array([r[2] for r in rows], pa.binary())})


def block_rows(table: pa.Table) -> tuple[pa.Table, dict[int, list[list[np.ndarray]]]]:
    """A block's header and its unpacked sums by kind. The first array of sums has the mark of their header."""
    header, by_kind = None, {}
    for kind, data in zip(table["kind"].to_pylist(), table["data"], strict=True):
        if kind == HEADER:
            header = data.as_py()
        else:
            by_kind.setdefault(kind, []).append(unpack(data.as_py()))
    if header is None or any(int(x[0][0]) != zlib.crc32(header) for found in by_kind.values() for x in found):
        raise ValueError("the rows of a block changed while it was counted again: write the input of the query to a table first")
    return pa.ipc.open_stream(header).read_all().combine_chunks(), by_kind


def counted(docs: DataFrame, pairs: bool = True) -> DataFrame:
    """(doc_id, term, tf) of rows (doc_id, terms), each row by itself; no shuffle."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches):
            c, ids = count(_one(table.column("terms")), pairs), _one(table.column("doc_id"))
            for a in range(0, len(c.starts), 1 << 16):
                of = np.arange(a, min(a + (1 << 16), len(c.starts)))
                e = slice(c.starts[a], c.starts[of[-1]] + c.lengths[of[-1]])
                term = c.strings(np.repeat(of, c.lengths[of]))
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(c.rows[e])), term, pa.array(c.times[e], pa.int64())], ["doc_id", "term", "tf"])

    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return docs.select("doc_id", "terms").mapInArrow(run, f"doc_id {kind}, term string, tf bigint")


def by_part(packed: DataFrame, run: Callable[[pa.Table], pa.Table]) -> DataFrame:
    return packed.groupBy("part").applyInArrow(run, SUMS)


def feature_counts(docs: DataFrame, columns: list[str], features_col: str) -> DataFrame:
    """(columns, feature, c): the features of rows with equal ``columns``, counted inside each block; to be added up."""
    same = F.to_json(F.struct(*columns))
    rows = docs.select(*columns, same.alias("grp"), F.col(features_col).alias("terms"))
    kinds = ", ".join(f"`{n}` {rows.schema[n].dataType.simpleString()}" for n in columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches):
            lists, group = _one(table.column("terms")), _one(table.column("grp")).dictionary_encode().indices.to_numpy()
            offsets = lists.offsets.to_numpy().astype(np.int64)
            coded = lists.values.slice(offsets[0], offsets[-1] - offsets[0]).dictionary_encode()
            word = pc.fill_null(coded.indices, len(coded.dictionary)).to_numpy(zero_copy_only=False).astype(np.int64)
            wide = int(group.max()) + 1 if len(group) else 1
            keys, c = np.unique(word * wide + np.repeat(group, np.diff(offsets)), return_counts=True)
            word, at = np.divmod(keys, wide)
            rows = np.zeros(wide, np.int64)
            rows[group[::-1]] = np.arange(len(group))[::-1]
            head = table.select(columns).take(pa.array(rows[at]))
            found = head.append_column("feature", coded.dictionary.take(pa.array(word, mask=word == len(coded.dictionary))))
            yield from found.append_column("c", pa.array(c, pa.int64())).combine_chunks().to_batches(max_chunksize=1 << 16)

    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return rows.mapInArrow(run, f"{kinds}, feature {rows.schema['terms'].dataType.elementType.simpleString()}, c bigint")


def trigram_counts(docs: DataFrame, columns: list[str], text_col: str) -> DataFrame:
    """(columns, feature, c): all runs of three characters of the texts of rows with equal ``columns``, counted inside
    each batch; to be added up. The texts have no characters beyond the basic plane."""
    same = F.to_json(F.struct(*columns))
    rows = docs.where(F.col(text_col).isNotNull()).select(*columns, same.alias("grp"), F.col(text_col).alias("text"))
    kinds = ", ".join(f"`{n}` {rows.schema[n].dataType.simpleString()}" for n in columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table.take(pc.sort_indices(table.column("grp"))).combine_chunks()
            firsts = np.append(_groups(_one(table.column("grp")))[1], table.num_rows)
            for a, b in zip(firsts[:-1], firsts[1:], strict=True):
                texts = _one(table.column("text")).slice(a, b - a)
                raw, _ = _text(texts)
                char = np.frombuffer(raw.tobytes().decode().encode("utf-16-le"), np.uint16)
                row = np.repeat(np.arange(b - a), pc.utf8_length(texts).to_numpy())
                known = np.flatnonzero(np.bincount(char, minlength=1))
                n, place = len(known), np.zeros(1 << 16, np.int64)
                place[known] = np.arange(n)
                x = place[char]
                keys = ((x[:-2] * n + x[1:-1]) * n + x[2:])[row[2:] == row[:-2]] if len(x) > 2 else np.zeros(0, np.int64)
                if n ** 3 <= 4 * BLOCK:
                    c = np.bincount(keys, minlength=1)
                    keys = np.flatnonzero(c)
                    c = c[keys]
                else:
                    keys, c = np.unique(keys, return_counts=True)
                three = np.stack([keys // (n * n), keys // n % n, keys % n], axis=1) if n else np.zeros((0, 3), np.int64)
                text = known[three].astype(np.uint16).tobytes().decode("utf-16-le")
                grams = pa.array([text[i:i + 3] for i in range(0, len(text), 3)], pa.string())
                head = table.select(columns).take(pa.array(np.full(len(keys), a)))
                yield from head.append_column("feature", grams).append_column("c", pa.array(c, pa.int64())).combine_chunks().to_batches()

    docs.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return rows.mapInArrow(run, f"{kinds}, feature string, c bigint")


def model_sums(docs: DataFrame, model: DataFrame, parts: int) -> DataFrame:
    """(other columns of ``docs``, sums) of every row that shares a feature with a label of its group: (label, s) of
    these labels, s the sum of the label's weights over the row's features.

    ``docs``: terms, ``grp`` and other columns. ``model``: grp, feature, label, weight. Both are dealt to the parts by
    the feature; the model is not held whole anywhere.
    """
    model = model.select(F.pmod(F.crc32(F.col("feature").cast("binary")), F.lit(parts)).cast("int").alias("part"), "grp", "feature", "label", "weight")
    others = [c for c in docs.columns if c not in ("terms", "grp")]
    kind = model.schema["label"].dataType.simpleString()
    pair = pa.struct([("label", to_arrow_type(model.schema["label"].dataType)), ("s", pa.float64())])

    def weigh(table: pa.Table, rows: pa.Table) -> pa.Table:
        found, _, place = pieces(table, _one(rows["feature"].cast(pa.string())))
        groups = _one(rows["grp"]).dictionary_encode()
        number = {x: i for i, x in enumerate(groups.dictionary.to_pylist())}
        labels = _one(rows["label"]).dictionary_encode()
        wide, some = max(len(number), 1), max(len(labels.dictionary), 1)
        keys = place.astype(np.int64) * wide + groups.indices.to_numpy()
        order = np.argsort(keys, kind="stable")
        keys, code, weight = keys[order], labels.indices.to_numpy()[order].astype(np.int64), rows["weight"].to_numpy()[order]
        starts = np.flatnonzero(np.diff(keys, prepend=-1))
        keys, n_labels = keys[starts], np.diff(starts, append=len(keys))
        names, out = np.frombuffer(_ipc(pa.table({"label": labels.dictionary})), np.uint8), passed_on(table)
        for p in found if len(keys) else []:
            group = np.repeat([number.get(x, -1) for x in p.group_names()], np.diff(p.first, append=p.n)).astype(np.int64)[p.rows]
            key = np.repeat(p.terms, p.lengths).astype(np.int64) * wide + group
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hits = np.flatnonzero((keys[at] == key) & (group >= 0))
            at, row = at[hits], p.rows[hits].astype(np.int64) * some
            times, ends = p.times[hits].astype(np.float64), np.cumsum(n_labels[at])
            sums = np.zeros(p.n * some) if p.n * some <= 4 * BLOCK else None
            seen = np.zeros(p.n * some, bool) if sums is not None else None
            sparse: list[tuple[np.ndarray, np.ndarray]] = []
            start = 0
            while start < len(hits):        # as many features as have BLOCK labels together, one at least
                stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + BLOCK, side="right")))
                n, first = n_labels[at[start:stop]], starts[at[start:stop]]
                of = segments(first, n)
                pairs, s = np.repeat(row[start:stop], n) + code[of], np.repeat(times[start:stop], n) * weight[of]
                if sums is None:
                    sparse.append(summed(pairs, s))
                else:
                    sums += np.bincount(pairs, s, minlength=len(sums))
                    seen[pairs] = True
                start = stop
            if sums is not None:
                pairs = np.flatnonzero(seen)
                s = sums[pairs]
            else:
                pairs, s = summed(*(np.concatenate(x) for x in zip(*sparse, strict=True))) if sparse else (np.zeros(0, np.int64), np.zeros(0))
            if len(pairs):
                out.append((p.block, TERMS, pack(np.array([p.mark]), *np.divmod(pairs, some), s, names)))
        return sums_table(out)

    def add(table: pa.Table) -> pa.Table:
        own, sums = block_rows(table)
        found = sums.get(TERMS, [])
        if not found:
            return own.select(others).slice(0, 0).append_column("sums", pa.array([], pa.list_(pair)))
        labels = [_one(pa.ipc.open_stream(x[4].tobytes()).read_all()["label"]) for x in found]
        coded, starts = pa.concat_arrays(labels).dictionary_encode(), np.cumsum([0, *(len(x) for x in labels)])[:-1]
        codes, some = coded.indices.to_numpy(), len(coded.dictionary)
        pairs, s = summed(np.concatenate([x[1].astype(np.int64) * some + codes[a + x[2].astype(np.int64)] for x, a in zip(found, starts, strict=True)]),
                          np.concatenate([x[3] for x in found]))
        row, label = np.divmod(pairs, some)
        values = pa.StructArray.from_arrays([coded.dictionary.take(pa.array(label)), pa.array(s)], ["label", "s"])
        rows, offsets = np.unique(row, return_index=True)
        lists = pa.ListArray.from_arrays(pa.array(np.append(offsets, len(row)), pa.int32()), values)
        return own.select(others).take(pa.array(rows)).append_column("sums", lists)

    sums = deal(docs, parts, pairs=False).groupBy("part").cogroup(model.groupBy("part")).applyInArrow(weigh, SUMS)
    columns = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in others)
    return sums.groupBy("block").applyInArrow(add, f"{columns}, sums array<struct<label:{kind},s:double>>")
