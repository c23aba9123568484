"""URL rules through a Bloom filter cascade.

The keys of a url are the suffixes of its host joined with prefixes of its path. Level 0 of a
cascade encodes the listed keys; level 1 the keys of the corpus that level 0 takes for listed;
level 2 the listed keys that level 1 takes for unlisted; and so on until none is mistaken. Every key
of the corpus was seen while building, so membership is exact, and urls are judged where they
lie: no join of urls with rules. The size depends on the listed keys and only on the logarithm of the corpus.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell.llm.common import stash
from inkwell.llm.text_hash import U64, mix

#: Bytes of filters that one broadcast holds; larger lists are cut into shards, one pass each.
SHARD_BYTES = 64 << 20


@dataclass(frozen=True)
class Level:
    words: np.ndarray
    bits: int
    hashes: int
    salt: int

    def places(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """(keys, hashes) bit numbers."""
        with np.errstate(over="ignore"):
            a, b = mix(h1 + U64(self.salt)), mix(h2 ^ U64(self.salt)) | U64(1)
            steps = np.arange(self.hashes, dtype=U64)
            return mix(a[:, None] + steps[None, :] * b[:, None]) % U64(self.bits)

    def has(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        at = self.places(h1, h2)
        return ((self.words[(at >> U64(6)).astype(np.int64)] >> (at & U64(63))) & U64(1)).all(axis=1)


@dataclass(frozen=True)
class Cascade:
    """Exact membership for the keys of the corpus that it was built on."""

    levels: tuple[Level, ...]

    def has(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Listed: the first level that rejects a key has an odd number, or none rejects and their count is odd."""
        listed = np.zeros(len(h1), dtype=bool)
        left = np.arange(len(h1))
        for i, level in enumerate(self.levels):
            ok = level.has(h1[left], h2[left])
            listed[left[~ok]] = i % 2 == 1
            left = left[ok]
        listed[left] = len(self.levels) % 2 == 1
        return listed

    @property
    def size(self) -> int:
        return sum(x.words.nbytes for x in self.levels)


def _numbers(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(x).to_numpy(zero_copy_only=False).view(U64) for x in names]


def _encode(keys: DataFrame, n: int, rate: float, salt: int) -> Level:
    """A filter of ``n`` keys (h1, h2): tasks emit word masks, equal words are combined before the driver gets them."""
    hashes = max(1, math.ceil(math.log2(1 / rate)))
    bits = max(64, math.ceil(n * hashes / math.log(2) / 64) * 64)
    empty = Level(np.zeros(bits // 64, dtype=U64), bits, hashes, salt)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = empty.places(*_numbers(batch, "h1", "h2")).reshape(-1)
            word, back = np.unique(at >> U64(6), return_inverse=True)
            mask = np.zeros(len(word), dtype=U64)
            np.bitwise_or.at(mask, back, U64(1) << (at & U64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(mask.view(np.int64))], ["word", "mask"])

    table = keys.mapInArrow(run, "word bigint, mask bigint").groupBy("word").agg(F.expr("bit_or(mask)").alias("mask")).toArrow()
    words = empty.words.copy()
    words[table.column("word").to_numpy()] = table.column("mask").to_numpy().view(U64)
    return Level(words, bits, hashes, salt)


def _kept(keys: DataFrame, level: Level) -> DataFrame:
    """The keys that ``level`` accepts."""
    shared = keys.sparkSession.sparkContext.broadcast(level)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(shared.value.has(*_numbers(batch, "h1", "h2"))))

    return keys.mapInArrow(run, "h1 bigint, h2 bigint")


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """Cascade of the ``listed`` keys over all keys of the ``universe``, both (h1, h2).

    Repeated keys count once. Of the universe only the keys that a level mistakes are ever shuffled or
    stored; the first level is sized so that they are about as many as the listed ones.
    """
    mine = stash(listed.distinct(), "listed")
    n = mine.count()
    if not n:
        return Cascade(())
    total = max(universe.count(), n)
    levels = [_encode(mine, n, min(0.5, max(1e-9, math.sqrt(0.5) * n / total)), 1)]
    other = stash(_kept(universe, levels[0]).distinct().join(mine, ["h1", "h2"], "left_anti"), "mistaken")
    while True:
        n = other.count()
        if not n:
            return Cascade(tuple(levels))
        levels.append(_encode(other, n, 0.5, len(levels) + 1))
        mine, other = other, stash(_kept(mine, levels[-1]), "mistaken")


def hashes(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key).alias("h1"), F.xxhash64(key, F.lit(0x5EED)).alias("h2")


def ascii_lower(c: Column) -> Column:
    """``c`` with A-Z, and nothing else, lower-cased: hosts of urls and of rules alike."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?``, ``#`` or
    the end. A null url or one without ``://`` has both empty."""
    rest = F.when(F.instr(url, "://") > 0, url.substr(F.instr(url, "://") + F.lit(3), F.length(url)))
    host = ascii_lower(F.regexp_extract(rest, "^([^/?#]*)", 1))
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1), F.lit(""))


def url_keys(host: Column, path: Column, lengths: list[int]) -> Column:
    """All keys of a url: every suffix of its host at a dot, with the path's prefixes of the given lengths."""
    labels = F.split(host, "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    cuts = F.filter(F.array(*[F.lit(x) for x in lengths]), lambda x: x <= F.length(path))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(cuts, lambda x: F.concat(s, path.substr(F.lit(1), x)))))


def judge_urls(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """(id, host, path, rule, verdict) for every row of ``pages``.

    ``rules``: (rule, verdict) with rule = host + path, like ``example.com/en/``, and verdict allow or
    block. A rule fits its host and all subdomains where the url's path starts with the rule's; the
    longest rule wins, of equal lengths the one with the longer host. A rule that is both allowed and
    blocked blocks. Urls that no rule fits, null urls included, get ``default`` and a null rule. Null rules are
    ignored; no rules give ``default`` everywhere.
    """
    spark = pages.sparkSession
    rules = rules.where("rule IS NOT NULL AND verdict IN ('allow', 'block')").select(
        F.concat(ascii_lower(F.regexp_extract("rule", "^([^/]*)", 1)), F.regexp_extract("rule", "^[^/]*((?s:.*))", 1)).alias("rule"), "verdict")
    lengths = sorted(r[0] for r in rules.select(F.length(F.regexp_extract("rule", "^[^/]*((?s:.*))", 1))).distinct().collect())
    host, path = host_and_path(F.col(url_col).cast("string"))
    out = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    if not lengths:
        return out.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    keyed = out.withColumn("keys", url_keys(F.col("host"), F.col("path"), lengths))
    keyed = keyed.withColumn("h1", F.transform("keys", lambda k: hashes(k)[0]))
    keyed = keyed.withColumn("h2", F.transform("keys", lambda k: hashes(k)[1]))
    universe = keyed.select(F.explode(F.arrays_zip("h1", "h2")).alias("z")).select("z.h1", "z.h2")
    keyed = keyed.withColumn("rank", F.lit(-1)).withColumn("best", F.lit(-1)).withColumn("blocked", F.lit(False))
    size = rules.count() * 64 // 8  # about 40 bits a key in level 0, 3 in the rest
    shards = max(1, -(-size // SHARD_BYTES))
    for shard in range(shards):
        mine = [rules.where(F.col("verdict") == v).select(*hashes(F.col("rule"))) for v in ("allow", "block")]
        own = F.pmod(F.col("h1"), F.lit(shards)) == shard
        cascades = tuple(build_cascade(x.where(own), universe.where(own)) for x in mine)
        shared = spark.sparkContext.broadcast(cascades)

        def run(batches: Iterator[pa.RecordBatch], shared=shared, shard=shard) -> Iterator[pa.RecordBatch]:
            allow, block = shared.value
            for batch in batches:
                keys = batch.column("keys")
                first = keys.offsets.to_numpy() - keys.offsets[0].as_py()
                h1, h2 = (batch.column(x).flatten().to_numpy().view(U64) for x in ("h1", "h2"))
                mine = np.ones(len(h1), dtype=bool) if shards == 1 else (h1.view(np.int64) % shards) == shard
                bad = mine & block.has(h1, h2)
                good = mine & allow.has(h1, h2)
                text = keys.flatten()
                total = pa.compute.utf8_length(text).to_numpy(zero_copy_only=False)
                hosts = pa.compute.find_substring(text, "/").to_numpy(zero_copy_only=False)
                hosts = np.where(hosts < 0, total, hosts)
                rank = np.where(bad | good, total * 65536 + np.minimum(hosts, 65535), -1)
                best, high = batch.column("best").to_numpy().copy(), batch.column("rank").to_numpy().copy()
                blocked = batch.column("blocked").to_numpy(zero_copy_only=False).copy()
                for i in np.flatnonzero(np.maximum.reduceat(np.append(rank, -1), first[:-1]) >= 0) if len(first) > 1 else []:
                    if first[i] == first[i + 1]:
                        continue
                    j = int(rank[first[i]:first[i + 1]].argmax())
                    if rank[first[i] + j] > high[i]:
                        high[i], best[i], blocked[i] = rank[first[i] + j], j, bad[first[i] + j]
                columns = dict(zip(batch.schema.names, batch.columns))
                columns |= {"rank": pa.array(high), "best": pa.array(best), "blocked": pa.array(blocked)}
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        keyed = keyed.withColumn("rank", F.col("rank").cast("bigint")).withColumn("best", F.col("best").cast("bigint"))
        keyed = keyed.mapInArrow(run, keyed.schema)
        if shards > 1:
            keyed = stash(keyed, "judged")
    rule = F.when(F.col("best") >= 0, F.get("keys", F.col("best").cast("int")))
    verdict = F.when(F.col("best") < 0, F.lit(default)).when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow"))
    return keyed.select("id", "host", "path", rule.alias("rule"), verdict.alias("verdict"))
