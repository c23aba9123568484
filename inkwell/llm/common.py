"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from inkwell.session import scratch_path
from inkwell.sources.tables import table

__all__ = ["table", "stash", "text_slices", "keep_ids", "keep_keys", "keep_rows", "row_key", "fresh", "map_rows",
           "release", "small_batches"]


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage with a table that every executor can read, so a lost executor
    never loses a stage's result, and gives the planner real sizes for what follows.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let go of what finished jobs left in the driver: Spark drops the shuffles, broadcasts and plans of
    frames that nobody holds any more when the driver's JVM collects its garbage."""
    gc.collect()
    spark._jvm.java.lang.System.gc()


#: Bytes of a record batch between the JVM and its Python workers, one row at least.
BATCH_BYTES = 2 << 20


def small_batches(spark: SparkSession) -> None:
    """Let the session's record batches end at BATCH_BYTES instead of 10 000 rows, whatever the rows' length: an executor
    holds several of them for each task, on both sides, and its JVM and workers do not give that memory back."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def text_slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches into runs of whole rows of about ``limit`` text bytes, one row at least.

    Keeps the working memory of vectorised code near the size of the longest text.
    """
    for batch in batches:
        n, start = batch.num_rows, 0
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        size = 0
        for i in range(n):
            size += int(lengths[i])
            if size >= limit or i - start >= 4095:
                yield batch.slice(start, i + 1 - start)
                start, size = i + 1, 0
        if start < n:
            yield batch.slice(start, n - start)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def map_rows(df: DataFrame, run, added: StructType) -> DataFrame:
    """``df.mapInArrow(run)`` for a ``run(batches, names)`` that appends the columns ``added`` to the batches of ``df``.

    Inside, the columns of ``df`` are called c0, c1, ... (``names`` maps their real names to these), so names with
    dots do no harm.
    """
    inner = [f"c{i}" for i in range(len(df.columns))]
    names = dict(zip(df.columns, inner))
    schema = StructType([StructField(c, f.dataType) for c, f in zip(inner, df.schema.fields)]
                        + [StructField(f"x{i}", f.dataType) for i, f in enumerate(added.fields)])

    def renamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in run(batches, names):
            yield pa.RecordBatch.from_arrays(batch.columns, schema.fieldNames())

    return df.toDF(*inner).mapInArrow(renamed, schema).toDF(*df.columns, *added.fieldNames())


#: Most ids that are broadcast (8 bytes each); longer lists are joined by a shuffle.
BROADCAST_IDS = 2_000_000


def keep_ids(df: DataFrame, key: str, ids: DataFrame, anti: bool = False) -> DataFrame:
    """Rows of ``df`` whose ``key`` is (``anti``: is not) among ``ids`` (one column, stashed).

    The list is counted first: up to BROADCAST_IDS rows it is broadcast, so that the texts
    stay where they are; beyond that both sides are shuffled. The rows are the same.
    """
    return keep_keys(df, [df[key]], ids, anti, BROADCAST_IDS)


def keep_keys(df: DataFrame, own: list, keys: DataFrame, anti: bool = False, most: int = BROADCAST_IDS // 4) -> DataFrame:
    """Like ``keep_ids`` with several columns ``own`` of ``df`` against those of ``keys`` in the same order; nulls are equal."""
    sides = [fresh(df, f"__key{i}") for i in range(len(own))]
    keys = keys.toDF(*sides)
    if keys.count() <= most:
        keys = F.broadcast(keys)
    same = F.lit(True)
    for column, side in zip(own, sides):
        same = same & column.eqNullSafe(keys[side])
    return df.join(keys, same, "left_anti" if anti else "left_semi")


def row_key(id_col: str, text_col: str):
    """What tells the rows of a table apart, null and repeated ids included: (none, id, digest), ids before null."""
    return F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), F.unhex(F.md5(text_col)).alias("digest"))


def keep_rows(df: DataFrame, id_col: str, text_col: str, keys: DataFrame, anti: bool = False) -> DataFrame:
    """Like ``keep_ids`` with ``keys``, one stashed column of distinct ``row_key`` values: no other row of an id is touched."""
    name = keys.columns[0]
    keys = keys.select(F.col(f"{name}.id"), F.col(f"{name}.digest"))
    return keep_keys(df, [df[id_col], F.unhex(F.md5(df[text_col]))], keys, anti)
