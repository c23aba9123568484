"""Sources and sinks at the edges: CSV feed, article JSON, API landing zone, request grid."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell import constants as C

SOURCE = T.StructType([T.StructField("id", T.StringType()), T.StructField("name", T.StringType())])

FEED_COLUMNS = ["publish_time", "feed_code", "source_url", "headline_text"]
FEED_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in FEED_COLUMNS]
                           + [T.StructField("_bad", T.StringType())])

ARTICLE_FIELDS = ["author", "title", "description", "url", "urlToImage", "publishedAt", "content"]
RAW_ARTICLE_SCHEMA = T.StructType(
    [T.StructField("source", SOURCE)]
    + [T.StructField(c, T.StringType()) for c in ARTICLE_FIELDS]
    + [T.StructField("fetched_at", T.StringType()), T.StructField("language", T.StringType())])

API_ARTICLE = T.StructType([T.StructField("source", SOURCE)]
                           + [T.StructField(c, T.StringType()) for c in ARTICLE_FIELDS])
API_ENVELOPE = T.StructType([
    T.StructField("status", T.StringType()),
    T.StructField("articles", T.ArrayType(API_ARTICLE)),
    T.StructField("_corrupt", T.StringType()),
])


# --- CSV feed ----------------------------------------------------------------------

def _read_feed_file(spark: SparkSession, path: str, index: int) -> DataFrame:
    df = (spark.read.schema(FEED_SCHEMA)
          .option("header", True).option("multiLine", True)
          .option("quote", '"').option("escape", '"')
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad")
          .option("encoding", "UTF-8")
          .csv(path))
    # one multi-line CSV file is read by one task in file order
    return df.withColumn("_file", F.lit(index)).withColumn("_pos", F.monotonically_increasing_id())


def read_feed(spark: SparkSession, paths) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected) of a list of feed CSV files, in list order.

    rows: the four string columns ('' for empty) plus ``feed_order`` (file index,
    position). Rows with fewer than four fields are skipped; rows with more go to
    ``rejected`` (raw line in ``_bad``). An empty file yields no rows.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        empty = spark.createDataFrame([], FEED_SCHEMA)
        return empty.drop("_bad"), empty.select("_bad")
    df = reduce(DataFrame.unionByName, [_read_feed_file(spark, p, i) for i, p in enumerate(paths)])
    order = F.struct(F.col("_file").alias("file"), F.col("_pos").alias("pos"))
    bad = F.col("_bad").isNotNull()
    # a long row is told by its fields, also where the fourth is empty; quoted parts hold no separators
    long_row = bad & (F.size(F.split(F.regexp_replace("_bad", '"[^"]*"', ""), ",")) > len(FEED_COLUMNS))
    # Spark rejects scans that read only the corrupt-record column (e.g. under count());
    # this always-true test keeps a data column in every filter
    touch = F.coalesce(F.length(F.col("publish_time")), F.lit(0)) >= F.lit(0)
    rows = df.where(~bad & touch).select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in FEED_COLUMNS],
                                         order.alias("feed_order"))
    rejected = df.where(long_row & touch).select("_bad", order.alias("feed_order"))
    return rows, rejected


def write_feed(df: DataFrame, path: str) -> None:
    (df.select(*FEED_COLUMNS).write.mode("overwrite")
     .option("header", True).option("quote", '"').option("escape", '"').option("quoteAll", True)
     .csv(path))


# --- article JSON -------------------------------------------------------------------

def read_articles(spark: SparkSession, path: str, json_array: bool = False, schema=None) -> DataFrame:
    """Article files: JSON lines (our sink), or pretty-printed JSON arrays with ``json_array``.

    A missing path raises Spark's AnalysisException (path does not exist).
    """
    reader = spark.read.schema(schema or RAW_ARTICLE_SCHEMA)
    if json_array:
        reader = reader.option("multiLine", True)
    return reader.json(path)


def write_articles(df: DataFrame, path: str, by=None) -> None:
    """JSON lines, overwrite, null fields kept as keys; optionally one folder per value of ``by``.

    The folders are named ``part_<column>=...`` and the rows keep the column itself, so '' and null,
    which share a folder, come back as they were.
    """
    cols = [] if by is None else [by] if isinstance(by, str) else list(by)
    w = df.withColumns({f"part_{c}": F.col(c) for c in cols}) if cols else df
    w = w.write.mode("overwrite").option("ignoreNullFields", False)
    (w.partitionBy(*[f"part_{c}" for c in cols]) if cols else w).json(path)


# --- API landing zone --------------------------------------------------------------------

def write_api_envelopes(articles: DataFrame, root: str, page_col: str = "page") -> None:
    """Land article rows as API responses ``country=…/category=…/`` of ``{status, articles}``."""
    env = (articles.groupBy("country", "category", page_col)
           .agg(F.lit("ok").alias("status"),
                F.sort_array(F.collect_list(F.struct(F.col("_pos"), F.struct(*[F.col(c) for c in
                             ["source", *ARTICLE_FIELDS]]).alias("a")))).alias("_arts"))
           .select("country", "category", page_col, "status",
                   F.transform("_arts", lambda x: x["a"]).alias("articles")))
    # JSON lines, one response per line; read back with ``read_api(..., json_lines=True)``
    # in ranges of the request's order: the names of a request's files, and the lines in them, keep its pages in order
    env = env.repartitionByRange("country", "category", page_col).sortWithinPartitions("country", "category", page_col)
    env.write.mode("overwrite").partitionBy("country", "category").json(root)


def read_api(spark: SparkSession, root: str, extra_fields=(), json_lines: bool = False) -> DataFrame:
    """One row per article of every response, tagged with country, category and ``response``.

    ``response`` = (file, block, line) tells responses apart and orders them: ``block`` is the byte at
    which the task's piece of the file starts and ``line`` grows along it. ``digest`` is the md5 of the response's
    raw text where files hold one response per line (``json_lines``), the same in every read; files of one pretty-printed
    response each (as fetched) have a null digest, as the file is the identity. A response without ``articles`` contributes no rows;
    an unparsable one is skipped; the rest are read.
    """
    schema = T.StructType(list(API_ENVELOPE.fields))
    for name, dtype in extra_fields:
        schema = schema.add(name, dtype)
    # ids of rows grow along a task, which reads its blocks one after the other
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                     F.monotonically_increasing_id().alias("line"))
    if json_lines:
        raw = spark.read.option("basePath", root).text(root).withColumn("response", place)
        parsed = F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
        env = raw.select("country", "category", "response", F.unhex(F.md5("value")).alias("digest"), parsed.alias("e"))
        env = env.select("country", "category", "response", "digest", "e.*")
    else:
        env = (spark.read.schema(schema).option("multiLine", True)
               .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt")
               .option("basePath", root).json(root))
        env = env.withColumn("response", place).withColumn("digest", F.lit(None).cast("binary"))
    env = env.where(F.col("_corrupt").isNull())
    extra = [c for c in env.columns if c not in ("status", "articles", "_corrupt", "country", "category", "response", "digest")]
    arts = env.select("country", "category", "response", "digest", *extra,
                      F.posexplode(F.coalesce(F.col("articles"), F.array().cast(T.ArrayType(API_ARTICLE))))
                      .alias("pos", "a"))
    return arts.select("country", "category", "response", "digest", *extra, "pos", "a.*")


def request_grid(spark: SparkSession, countries, categories, page_size: int = C.PAGE_SIZE) -> DataFrame:
    """(country, category, page_size, language) for every pair; language 'ar' for 'ae', else 'en'.

    ``countries`` and ``categories`` may be DataFrames with a ``country`` and a ``category`` column,
    or lists; the categories are one array, expanded per country row.
    """
    if not isinstance(countries, DataFrame):
        countries = spark.createDataFrame([(c,) for c in countries], "country string")
    if isinstance(categories, DataFrame):
        cats = categories.agg(F.collect_list("category")).scalar()
    else:
        cats = F.array(*[F.lit(c) for c in categories])
    grid = countries.select("country", F.explode(cats).alias("category"))
    return grid.select("country", "category", F.lit(page_size).cast("bigint").alias("page_size"),
                       F.when(F.col("country") != F.lit("ae"), F.lit("en")).otherwise(F.lit("ar"))
                       .alias("language"))
