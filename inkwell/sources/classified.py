"""The table of classified articles: JSON lines in one folder for each language.

Writing some languages replaces those and leaves the others as they are (dynamic partition
overwrite), so one language can be run again without touching the rest. Every written language
also gets a marker row, which reads leave out: a language without articles replaces its old rows too.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK, PART = "_written", "part_language"


def write_classified(df: DataFrame, path: str, languages: Iterable[str]) -> None:
    """Replace the rows of ``languages`` by those of ``df``; rows of other languages in ``df`` are an error."""
    names = sorted(set(languages))
    if not names or not all(names):
        raise ValueError("name at least one language, and none that is empty")
    known = F.col("language").isin(names)
    checked = F.when(known, F.col("language")).otherwise(
        F.raise_error(F.concat(F.lit("a row of a language that is not written: "), F.coalesce("language", F.lit("null")))).cast("string"))
    rows = df.withColumn("language", checked).withColumn(MARK, F.lit(False))
    marks = df.sparkSession.createDataFrame([(x, True) for x in names], f"language string, {MARK} boolean")
    (rows.unionByName(marks, allowMissingColumns=True).withColumn(PART, F.col("language"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("ignoreNullFields", False)
     .partitionBy(PART).json(path))


def read_classified(spark: SparkSession, path: str, schema: T.StructType, languages: Iterable[str] | None = None) -> DataFrame:
    """The rows that were written, in their declared schema; ``languages`` reads only their folders."""
    full = T.StructType(list(schema.fields)).add(MARK, "boolean").add(PART, "string")
    df = spark.read.schema(full).json(path)
    if languages is not None:
        df = df.where(F.col(PART).isin(list(languages)))
    return df.where(~F.col(MARK)).drop(MARK, PART)
