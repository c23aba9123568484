"""Vectorised word and shingle hashing on the UTF-8 bytes of Arrow text columns.

A word is a run of bytes other than the ASCII white space 0x20 and 0x09-0x0D, after A-Z
is lower-cased. Word hashes are prefix sums of a keyed polynomial over the bytes, so a
batch costs a few numpy passes over its bytes and no Python loop over words. A shingle
hash combines the hashes of its words. Hashes are 64 bits wide and the same in every task.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U64 = np.uint64
#: Bytes that are hashed at once; a worker holds two tables of so many 64-bit numbers and a few such arrays besides.
_BLOCK = 1 << 18
_P = 0x9E3779B97F4A7C55
_Q = 0xD6E8FEB86659FD93


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser: spreads every input bit over the whole word (returns a new array)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers of a seed."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + mix(np.array([seed], dtype=U64)))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Tables:
    """Per-process lookup tables, made once."""

    made: "_Tables | None" = None

    def __init__(self) -> None:
        self.space = np.zeros(256, dtype=bool)
        self.space[[0x20, *range(0x09, 0x0E)]] = True
        self.marks = self.space.copy()  # white space and ASCII punctuation
        self.marks[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True
        self.exact = stream(7, 256)
        lower = np.arange(256)
        lower[65:91] += 32
        self.byte = self.exact[lower]
        self.kind = np.zeros(256, dtype=np.uint8)  # 1 ASCII letter, 2 digit, 3 punctuation but the apostrophe
        self.kind[self.marks & ~self.space] = 3
        self.kind[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
        self.kind[0x30:0x3A] = 2
        self.kind[0x27] = 0
        self.pow = _powers(_P, _BLOCK + 1)
        self.inv = _powers(pow(_P, -1, 1 << 64), _BLOCK + 1)

    @classmethod
    def get(cls) -> "_Tables":
        if cls.made is None:
            cls.made = cls()
        return cls.made


def raw_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty."""
    if column.null_count:
        column = pa.compute.fill_null(column, "")
    column = column.cast(pa.large_string())
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64, count=n + 1 + column.offset)[column.offset:]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def _spans(data: np.ndarray, cuts: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word; ``cuts`` are positions that no word crosses."""
    word = np.zeros(len(data) + 2, dtype=bool)
    np.logical_not(gaps[data], out=word[1:-1])
    start = word[1:-1] & ~word[:-2]
    end = word[1:-1] & ~word[2:]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    start[cuts] |= word[1:-1][cuts]
    end[cuts - 1] |= word[1:-1][cuts - 1]
    return np.flatnonzero(start), np.flatnonzero(end) + 1


def _block_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray, byte: np.ndarray | None = None) -> np.ndarray:
    t = _Tables.get()
    byte = t.byte if byte is None else byte
    n = len(data)
    if n > _BLOCK:
        # one word longer than a block: hash its blocks and combine them
        return np.array([_long_word(data[a:b], byte) for a, b in zip(s, e)], dtype=U64)
    sums = np.zeros(n + 1, dtype=U64)
    np.cumsum(byte[data] * t.pow[:n], out=sums[1:])
    return mix((sums[e] - sums[s]) * t.inv[s] + (e - s).astype(U64) * U64(_Q))


def _long_word(data: np.ndarray, byte: np.ndarray) -> int:
    if len(data) <= _BLOCK:
        return int(_block_hashes(data, np.array([0]), np.array([len(data)]), byte)[0])
    h = 0
    for a in range(0, len(data), _BLOCK):
        part = data[a:a + _BLOCK]
        h = (h * _P + int(_block_hashes(part, np.array([0]), np.array([len(part)]), byte)[0])) % (1 << 64)
    return h


def _blocks(s: np.ndarray, e: np.ndarray):
    """Runs [a, b) of words that span a block of bytes at most, or one longer word."""
    a = 0
    while a < len(s):
        b = max(int(np.searchsorted(e, s[a] + _BLOCK, side="right")), a + 1)
        yield a, b
        a = b


def span_hashes(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Hashes of the bytes of ascending spans, case and all."""
    with np.errstate(over="ignore"):
        out, exact = np.empty(len(s), dtype=U64), _Tables.get().exact
        for a, b in _blocks(s, e):
            lo, hi = int(s[a]), int(e[b - 1])
            out[a:b] = _block_hashes(data[lo:hi], s[a:b] - lo, e[a:b] - lo, exact)
        return out


def words(column: pa.Array, punctuation: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end of every word; first word of each row, len + 1; the bytes).

    ``punctuation``: ASCII punctuation also ends a word.
    """
    with np.errstate(over="ignore"):
        t = _Tables.get()
        data, offsets = raw_text(column)
        s, e = _spans(data, offsets, t.marks if punctuation else t.space)
        out = np.empty(len(s), dtype=U64)
        for a, b in _blocks(s, e):
            lo, hi = int(s[a]), int(e[b - 1])
            out[a:b] = _block_hashes(data[lo:hi], s[a:b] - lo, e[a:b] - lo)
        return out, s, e, np.searchsorted(s, offsets, side="left"), data


def pieces(column: pa.Array, whole: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Like ``words``, also cut between ASCII letters, digits and punctuation (but the apostrophe).

    ``whole``: strings that are not cut inside. If one occurs, case counts in the hashes;
    else the hashes of texts that differ in A-Z case only are equal.
    """
    with np.errstate(over="ignore"):
        t = _Tables.get()
        data, offsets = raw_text(column)
        kind = t.kind[data]
        cut = np.zeros(len(data), dtype=bool)
        cut[1:] = (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0)
        byte, blob = t.byte, data.tobytes()
        for x in whole:
            at = blob.find(x)
            while at >= 0:
                byte = t.exact
                cut[at + 1:at + len(x)] = False
                at = blob.find(x, at + len(x))
        cuts = np.flatnonzero(cut)
        s, e = _spans(data, np.union1d(cuts, offsets), t.space)
        out = np.empty(len(s), dtype=U64)
        for a, b in _blocks(s, e):
            lo, hi = int(s[a]), int(e[b - 1])
            out[a:b] = _block_hashes(data[lo:hi], s[a:b] - lo, e[a:b] - lo, byte)
        return out, s, e, np.searchsorted(s, offsets, side="left"), data


def prefixes(data: np.ndarray, s: np.ndarray, e: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(which, hash): the words of ``length`` bytes or more, and the hash of their first ``length`` bytes."""
    with np.errstate(over="ignore"):
        t = _Tables.get()
        which = np.flatnonzero(e - s >= length)
        h = np.zeros(len(which), dtype=U64)
        at = s[which]
        for j in range(length):
            h += t.byte[data[at + j]] * t.pow[j]
        return which, mix(h + U64(length * _P % (1 << 64)))


def shingles(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, first of each row): the ``n``-word shingles of every row, repeats included.

    A row with fewer words than ``n`` has its whole sequence as one; without words, none.
    """
    with np.errstate(over="ignore"):
        w, _, _, first, _ = words(column)
        counts = np.diff(first)
        k = np.where(counts >= n, counts - n + 1, (counts > 0).astype(counts.dtype))
        starts = np.zeros(len(k) + 1, dtype=np.int64)
        np.cumsum(k, out=starts[1:])
        if not len(w):
            return np.zeros(0, dtype=U64), starts
        all_h = np.zeros(len(w), dtype=U64)
        q = 1
        for j in range(n):
            if len(w) > j:
                all_h[:len(w) - j] += w[j:] * U64(q)
            q = q * _Q % (1 << 64)
        keep = np.ones(len(w), dtype=bool)
        ends = first[1:][counts >= n]
        for j in range(1, n):
            keep[ends - j] = False
        short = np.flatnonzero((counts > 0) & (counts < n))
        for i in short:
            a, b = first[i], first[i + 1]
            h = 0
            for x in w[a:b]:
                h = (h * _P + int(x)) % (1 << 64)
            all_h[a] = (h + int(b - a) * _Q) % (1 << 64)
            keep[a + 1:b] = False
        return mix(all_h[keep]), starts


def distinct_sets(column: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted set of ``n``-word shingles of every row."""
    h, starts = shingles(column, n)
    return [np.unique(h[a:b]) for a, b in zip(starts[:-1], starts[1:])]


def list_column(flat: np.ndarray, starts: np.ndarray, kind: pa.DataType = pa.int64()) -> pa.Array:
    """A list column of flat 64-bit values."""
    return pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(flat.view(np.int64), type=kind))
