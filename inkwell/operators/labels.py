"""Label dictionaries: dense ids of any number of labels, encoding and decoding.

Ids are the places of the labels in ascending order. They come from a distributed dense rank:
distinct labels are put in ranges, ranked inside their range, and moved by the sizes of the ranges
before it. No task holds all labels, and none is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.session import cut_lineage


def dense_ids(values: DataFrame, column: str, out: str = "id", partitions: int | None = None) -> DataFrame:
    """(column, out): the distinct non-null values of ``column`` with their ids, 0 for the smallest."""
    distinct = values.select(column).where(F.col(column).isNotNull()).distinct()
    ranges = distinct.repartitionByRange(partitions, column) if partitions else distinct.repartitionByRange(column)
    # ranges are cut at sampled values: they are kept as they fell
    placed = cut_lineage(ranges.withColumn("_range", F.spark_partition_id()))
    sizes = placed.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)      # one row for each range
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_range").orderBy(column)) - 1
    return (placed.withColumn("_place", place).join(F.broadcast(starts), "_range")
            .select(column, (F.col("_start") + F.col("_place")).cast("bigint").alias(out)))


def label_map(df: DataFrame, label_col: str = "label", partitions: int | None = None) -> DataFrame:
    """(label, id) of the sorted distinct labels, numbered from 0. Fewer than two labels is an error."""
    ids = dense_ids(df.select(F.col(label_col).alias("label")), "label", "id", partitions)
    n = len(ids.limit(2).collect())
    if n < 2:
        raise ValueError(f"need at least 2 distinct labels to train a classifier, found {n}")
    return ids


def encode(df: DataFrame, lmap: DataFrame, label_col: str = "label", out_col: str = "label_id") -> DataFrame:
    """All rows of ``df`` with the id of their label in ``out_col``; null for labels that the map does not have."""
    side = lmap.select(F.col("label").alias("_l"), F.col("id").alias(out_col))
    return df.join(side, df[label_col] == F.col("_l"), "left").drop("_l")


def decode(df: DataFrame, lmap: DataFrame, id_col: str = "label_id", out_col: str = "label") -> DataFrame:
    """All rows of ``df`` with the label of their id in ``out_col``; null for ids that the map does not have."""
    side = lmap.select(F.col("id").alias("_i"), F.col("label").alias(out_col))
    return df.join(side, df[id_col] == F.col("_i"), "left").drop("_i")
