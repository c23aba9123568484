"""Benchmark decontamination by size-partitioned MinHash containment search.

A short item inside a long document has a tiny Jaccard similarity, so the documents are
partitioned by the size of their shingle sets and the length of a signature follows the
partition: one-permutation MinHash with as many bins as keep the load of a bin at a level
that the item's size asks for. A document's bin minima are looked up in the index of the
items' bin minima for that number of bins; an item that is contained shares at least one
minimum with probability 1 - 1e-6. Candidates are confirmed on the whole sets.

The index holds the test items only. It is broadcast in parts of bounded size, so that
the documents are never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import keep_rows, row_key, stash, text_slices
from inkwell.llm.minmax_dedup import shingle_sets
from inkwell.llm.text_hash import U64, distinct_sets

#: Shingles of test items in one broadcast part (about 40 bytes each); more items make more passes.
PART_SHINGLES = 2_000_000
#: Chance that a contained item shares no bin minimum.
MISS = 1e-6


def bin_load(size: int, percent: int) -> int | None:
    """log2 of the bins that a document has for each of its shingles, for items of ``size``; None: every shingle.

    With b bins for each shingle a given shingle is its bin's minimum with probability
    b * (1 - exp(-1 / b)); all of the shared ones fail with at most MISS.
    """
    shared = math.ceil(size * percent / 100)
    for j in range(-6, 5):
        b = 2.0 ** j
        if shared * math.log1p(-min(b * -math.expm1(-1 / b), 1 - 1e-12)) <= math.log(MISS):
            return j
    return None


def bins_of(n: int, load: int | None) -> int:
    """log2 of the number of bins of a set of ``n`` shingles; 64 keeps every shingle."""
    return 64 if load is None else min(max(math.ceil(math.log2(max(n, 1))) + load, 0), 63)


def bin_minima(sorted_set: np.ndarray, bits: int) -> np.ndarray:
    """The smallest value of every bin; a bin is the values that agree in the highest ``bits`` bits."""
    if bits >= 64 or len(sorted_set) < 2:
        return sorted_set
    if bits == 0:
        return sorted_set[:1]
    bin_of = sorted_set >> U64(64 - bits)
    return sorted_set[np.concatenate([[True], bin_of[1:] != bin_of[:-1]])]


class _Index:
    """Items (id, sorted set) by load class; tables of bin minima are made when a partition first needs them."""

    def __init__(self, items: list[tuple[int, np.ndarray]], percent: int) -> None:
        self.items, self.percent = items, percent
        self.classes: dict[int | None, list[int]] = {}
        for i, (_, x) in enumerate(items):
            self.classes.setdefault(bin_load(len(x), percent), []).append(i)
        self.tables: dict[tuple[int | None, int], tuple] = {}

    def table(self, load: int | None, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        if (load, bits) not in self.tables:
            minima = [bin_minima(self.items[i][1], bits) for i in self.classes[load]]
            values = np.concatenate(minima)
            owner = np.repeat(self.classes[load], [len(x) for x in minima])
            order = np.argsort(values, kind="stable")
            seen = np.zeros(1 << max(12, (16 * len(values)).bit_length()), dtype=bool)
            seen[(values & U64(len(seen) - 1)).astype(np.int64)] = True
            self.tables[load, bits] = values[order], owner[order], seen
        return self.tables[load, bits]

    def search(self, own: np.ndarray) -> list[tuple[int, int, int]]:
        """(item id, shared shingles, item's shingles) of every item that ``own`` (sorted) contains."""
        out = []
        for load in self.classes:
            bits = bins_of(len(own), load)
            values, owner, seen = self.table(load, bits)
            mine = bin_minima(own, bits)
            mine = mine[seen[(mine & U64(len(seen) - 1)).astype(np.int64)]]
            if not len(mine):
                continue
            low, high = np.searchsorted(values, mine), np.searchsorted(values, mine, side="right")
            found = {int(i) for a, b in zip(low, high) for i in owner[a:b]}
            for i in sorted(found):
                item, want = self.items[i]
                at = np.minimum(np.searchsorted(own, want), len(own) - 1)
                shared = int((own[at] == want).sum())
                if 100 * shared >= self.percent * len(want):
                    out.append((item, shared, len(want)))
        return out


def contained_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    item_id: str = "item_id", item_text: str = "text", words: int = 5,
                    percent: int = 80) -> DataFrame:
    """(id, item, shared, size) for every row of ``docs`` and test item that it contains.

    Contained: 100 * |item's shingles in the document| >= percent * |item's shingles|, on sets of
    distinct ``words``-word shingles of the whole lower-cased (A-Z) texts. A text of fewer words is one
    shingle, so such an item is found only in documents of the same words. Items with equal
    sets are one item, the smallest id. Null and empty texts and items without an id match
    nothing. Rows that repeat an id each give their pairs. Empty tables give no rows.
    """
    spark = docs.sparkSession
    classes = (shingle_sets(items.where(F.col(item_id).isNotNull()), item_id, item_text, words)
               .where(F.size("items") > 0).groupBy("items").agg(F.min("id").alias("item")))
    kind = docs.schema[id_col].dataType.simpleString()
    item_kind = items.schema[item_id].dataType.simpleString()
    spec = f"id {kind}, item {item_kind}, shared bigint, size bigint"
    # parts of bounded size: all items of one part number are read and broadcast together
    sized = stash(classes.select("item", "items", F.size("items").alias("n")), "items")
    total = sized.agg(F.sum("n")).first()[0] or 0
    parts = -(-total // PART_SHINGLES)
    out = None
    for part in range(parts):
        mine = sized.where(F.pmod(F.xxhash64("item"), F.lit(parts)) == part).select("item", "items").toArrow()
        lists = mine.column("items").combine_chunks()
        flat, at = lists.values.to_numpy().view(U64), lists.offsets.to_numpy()
        sets = [(i, flat[a:b]) for i, a, b in zip(mine.column("item").to_pylist(), at[:-1], at[1:])]
        shared = spark.sparkContext.broadcast(sets)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = _Index(shared.value, percent)
            for batch in text_slices(batches, "t"):
                rows = [(i, *hit) for i, own in enumerate(distinct_sets(batch.column("t"), words)) if len(own)
                        for hit in index.search(own)]
                if rows:
                    which, item, common, size = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("i").take(pa.array(which)), pa.array(item, mine_type), pa.array(common, pa.int64()),
                         pa.array(size, pa.int64())], ["id", "item", "shared", "size"])

        mine_type = mine.schema.field("item").type
        found = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).mapInArrow(run, spec)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], spec) if out is None else out


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      item_id: str = "item_id", item_text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that contain no test item, all columns. Every row is judged by its own text: rows that
    share a null or repeated id with a row that contains an item stay."""
    keyed = docs.select(row_key(id_col, text_col).alias("row"), F.col(text_col).alias("t"))
    found = stash(contained_items(keyed, items, "row", "t", item_id, item_text, words, percent).select("id").distinct(),
                  "contaminated")
    return keep_rows(docs, id_col, text_col, found, anti=True)
