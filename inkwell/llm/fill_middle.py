"""Fill-in-middle transformation with cuts found in a Fenwick tree of text blocks.

A unit of a text is a word with the white space before it; white space at the end is one more.
A text is divided into fixed blocks of BLOCK bytes. A Fenwick tree over the blocks holds how many
units end in each block and how many code points start there, so the block of any unit is
found by a binary-lifting descent, with the code points before it on the way, and only that
block is looked at to place the cut. Trees of all rows of a batch are descended together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from inkwell.llm.common import fresh, text_slices
from inkwell.llm.text_hash import raw_text

#: Bytes of a block.
BLOCK = 1024
#: The marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


class BlockTrees:
    """Fenwick trees of unit ends and code points, one for every text of a batch.

    ``offsets`` are byte offsets of the texts in ``data``; tree nodes of text i are
    ``first[i] + 1`` to ``first[i + 1]``.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, block: int = BLOCK) -> None:
        self.data, self.offsets, self.block = data, offsets, block
        size = np.diff(offsets)
        blocks = -(-size // block)
        self.first = np.zeros(len(size) + 1, dtype=np.int64)
        np.cumsum(blocks, out=self.first[1:])
        n = int(self.first[-1])
        row = np.repeat(np.arange(len(size)), blocks)
        self.start = offsets[row] + (np.arange(n) - self.first[row]) * block
        # a unit ends after the last byte of a word, and at the end of a text that ends in white space
        word = np.zeros(len(data) + 1, dtype=bool)
        np.logical_not(_SPACE[data], out=word[:-1])
        full = size > 0
        last = offsets[1:][full] - 1
        self.ends = word[:-1] & ~word[1:]
        self.ends[last] = True
        lead = (data & 0xC0) != 0x80
        self.units = self._tree(self.ends, row)
        self.points = self._tree(lead, row)
        self.n_units = self._prefix(self.units, blocks)

    def _tree(self, mask: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Node k of a text sums its blocks k - lowbit(k) to k - 1."""
        if not len(row):
            return np.zeros(1, dtype=np.int64)
        sums = np.concatenate([[0], np.cumsum(np.add.reduceat(mask, self.start, dtype=np.int64))])
        k = np.arange(len(row)) - self.first[row] + 1
        node = self.first[row] + k
        return np.concatenate([[0], sums[node] - sums[node - (k & -k)]])

    def _prefix(self, tree: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Sums of the first k blocks of every text."""
        k, out = k.copy(), np.zeros(len(k), dtype=np.int64)
        while (k > 0).any():
            on = k > 0
            out[on] += tree[self.first[:-1][on] + k[on]]
            k[on] -= k[on] & -k[on]
        return out

    def cut(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes, code points) of the first ``units[i]`` units of every text i."""
        blocks = np.diff(self.first)
        at = np.zeros(len(blocks), dtype=np.int64)
        left, points = units.astype(np.int64), np.zeros(len(blocks), dtype=np.int64)
        step = 1 << int(blocks.max(initial=0)).bit_length()
        while step:  # blocks are passed while units are left after them
            to = at + step
            ok = to <= blocks
            node = np.where(ok, self.first[:-1] + to, 0)
            ok &= self.units[node] < left
            at[ok] = to[ok]
            left[ok] -= self.units[node[ok]]
            points[ok] += self.points[node[ok]]
            step >>= 1
        size = np.zeros(len(blocks), dtype=np.int64)
        for i in np.flatnonzero(units > 0):
            a = int(self.start[self.first[i] + at[i]])
            b = min(a + self.block, int(self.offsets[i + 1]))
            end = int(np.flatnonzero(self.ends[a:b])[left[i] - 1]) + 1
            points[i] += int(np.count_nonzero((self.data[a:a + end] & 0xC0) != 0x80))
            size[i] = a + end - self.offsets[i]
        return size, np.where(units > 0, points, 0)


def draws(id_col: Column, seed: int = 42) -> list[Column]:
    """Four numbers of a row, fixed by ``seed`` and its id (null ids: the word null)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("null")))
    digest = F.sha2(text, 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def fill_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, rate: int = 50,
                spm_rate: int = 80) -> DataFrame:
    """``docs`` with n_units, form, prefix_chars, middle_chars and fim_text; clashing names get an underscore.

    The cuts stand after the smaller and the larger of two drawn numbers of units, each from 0 to
    all. ``rate`` percent of the texts are rearranged, ``spm_rate`` percent of those as spm
    (suffix, prefix, middle), the rest as psm. Empty texts (null counts as empty) and texts that
    contain a mark stay plain, so that every output can be restored; plain rows have null counts of
    code points. All rows and columns stay; rows that repeat an id get the same draws. A batch
    holds whole texts of about a megabyte, or one longer text.
    """
    names = [fresh(docs, x) for x in ("n_units", "form", "prefix_chars", "middle_chars", "fim_text")]
    hidden = [fresh(docs, f"__h{i}") for i in range(4)]
    # positions instead of names inside the batches: names may hold dots or clash
    mapped = docs.select(*[docs[f"`{c}`"] for c in docs.columns], *[h.alias(n) for h, n in zip(draws(docs[f"`{id_col}`"], seed), hidden)])
    place, width = docs.columns.index(text_col), len(docs.columns)
    mapped = mapped.toDF(*[f"c{i}" for i in range(width + 4)])
    types = [*(f.dataType for f in docs.schema.fields)]
    out = StructType()
    for i, t in enumerate(types):
        out = out.add(f"c{i}", t)
    out = out.add("n", "long").add("form", "string").add("pc", "long").add("mc", "long").add("out", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
        for batch in text_slices(batches, f"c{place}"):
            data, offsets = raw_text(batch.column(place))
            trees = BlockTrees(data, offsets)
            n = trees.n_units
            h = [batch.column(width + i).to_numpy() for i in range(4)]
            x, y = h[0] % (n + 1), h[1] % (n + 1)
            blob = data.tobytes()
            texts = [blob[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            plain = np.array([not t or any(m in t for m in marks) for t in texts], dtype=bool) | (h[2] % 100 >= rate)
            low, high = (np.where(plain, 0, k) for k in (np.minimum(x, y), np.maximum(x, y)))
            (p, p_chars), (q, q_chars) = trees.cut(low), trees.cut(high)
            spm = h[3] % 100 < spm_rate
            form, made = [], []
            for i, t in enumerate(texts):
                if plain[i]:
                    form.append("plain")
                    made.append(t)
                    continue
                pre, mid, suf = marks[0] + t[:p[i]], marks[2] + t[p[i]:q[i]], marks[1] + t[q[i]:]
                form.append("spm" if spm[i] else "psm")
                made.append(suf + pre + mid if spm[i] else pre + suf + mid)
            text = pa.array(made, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:width], pa.array(n, pa.int64()), pa.array(form),
                 pa.array(p_chars, pa.int64(), mask=plain), pa.array(q_chars - p_chars, pa.int64(), mask=plain), text],
                out.names)

    return mapped.mapInArrow(run, out).toDF(*docs.columns, *names)


def restore(form: Column, text: Column) -> Column:
    """The text that ``fill_middle`` was given, from its form and output alone."""
    p, s, m = (F.locate(x, text) for x in (PREFIX, SUFFIX, MIDDLE))
    width = len(PREFIX)

    def between(a: Column, b: Column) -> Column:
        return F.substring(text, a + width, b - a - width)

    rest = F.substring(text, m + width, F.length(text))
    psm = F.concat(between(p, s), rest, between(s, m))
    spm = F.concat(between(p, m), rest, between(s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(text)
