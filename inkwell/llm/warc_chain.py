"""WARC archives: written by Spark, read back with boundary-chain verification.

An archive is read in parallel by Spark's text source with the record magic as separator, so every
place where the magic occurs, also inside a payload, gives a candidate record. A candidate's
header tells where its successor must begin. Per block of a file the chains are followed in
memory and contracted to (entry, exit) links; pointer jumping over the links finds, from the
start of each file, the entry of every block in a logarithmic number of rounds; only the
records on the chain from the start are retained. Nothing relies on payloads being free of
the magic.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from inkwell.llm.common import keep_keys, stash

MAGIC = "WARC/1.0\r\n"
END = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def _bytes(c: Column) -> Column:
    return F.octet_length(c).cast("bigint")


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
               least_bytes: int = 1000, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write one record for each row of ``pages``; every task writes one archive.

    A payload is the text in UTF-8 (null: empty). Of rows with equal payloads of ``least_bytes``
    or more the one with the largest id becomes a response, the others revisits of it
    without the payload; rows that repeat that id and payload are responses too, a null id is
    a revisit where any id has the payload. Line breaks in urls become spaces; a null
    url is written as the record's own name. Payloads are not shuffled: only ids, lengths and digests are.
    """
    page = pages.select(F.col(id_col).alias("i"), F.regexp_replace(F.col(url_col).cast("string"), "[\\r\\n]", " ").alias("u"),
                        F.coalesce(F.col(body_col).cast("string"), F.lit("")).alias("b"))
    page = page.withColumn("n", _bytes(F.col("b"))).withColumn("d", F.sha1(F.col("b").cast("binary")))
    narrow = stash(page.select("i", "u", "n", "d"), "digests")
    keeper = (narrow.where(F.col("n") >= least_bytes).groupBy("d", "n").agg(F.max("i").alias("r"), F.count(F.lit(1)).alias("c"))
              .where("c > 1 AND r IS NOT NULL").select("d", "n", "r"))
    revisits = stash(narrow.join(keeper, ["d", "n"]).where(~F.col("i").eqNullSafe(F.col("r"))), "revisits")
    again = stash(revisits.select("i", F.unhex("d").alias("d")).distinct(), "revisit-keys")
    first = keep_keys(page, [page["i"], F.unhex(page["d"])], again, anti=True)

    def record(kind: str, body: Column, more: list[Column]) -> Column:
        http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                        F.col("n").cast("string"), F.lit(END))
        name = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("i").cast("string"), F.lit("null")), F.lit(">"))
        return F.concat(
            F.lit(f"{MAGIC}WARC-Type: {kind}\r\nWARC-Record-ID: "), name, F.lit("\r\nWARC-Target-URI: "), F.coalesce("u", name),
            F.lit(f"\r\nWARC-Date: {date}\r\nWARC-Payload-Digest: sha1:"), F.col("d"), *more,
            F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
            (_bytes(http) + _bytes(body)).cast("string"), F.lit(END), http, body,
            F.lit("\r\n\r"))  # the writer adds the last line feed

    refers = [F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: <urn:page:"), F.col("r").cast("string"), F.lit(">")]
    (first.select(record("response", F.col("b"), []).alias("value"))
     .unionByName(revisits.select(record("revisit", F.lit(""), refers).alias("value"))).write.text(path))


def _segments(spark: SparkSession, path: str) -> DataFrame:
    """(file, block, order, value): what stands between the places of the magic, in order within a block."""
    return (spark.read.option("lineSep", MAGIC).text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("order"), "value"))


def _parsed() -> list[Column]:
    """Header fields, payload length and digest of a segment ``value`` that follows the magic."""
    v = F.col("value")
    head = F.substring_index(v, END, 1)

    def field(name: str, pattern: str) -> Column:
        return F.nullif(F.regexp_extract(F.concat(F.lit("\r\n"), F.col("head")), f"(?i)\\r\\n{name}:[ \\t]*{pattern}", 1), F.lit(""))

    return [("head", head), ("size", _bytes(v)), ("head_bytes", _bytes(F.col("head"))),
            ("length", field("Content-Length", "(\\d{1,18})(?=\\r\\n|$)").cast("bigint")),
            ("kind", F.lower(field("WARC-Type", "([^\\r\\n]*)"))), ("name", field("WARC-Record-ID", "<?([^\\r\\n>]*)")),
            ("uri", field("WARC-Target-URI", "([^\\r\\n]*)")), ("refers", field("WARC-Refers-To", "<?([^\\r\\n>]*)")),
            ("stated", field("WARC-Payload-Digest", "sha1:([^\\r\\n]*)")),
            ("head", F.lit(None).cast("string")),
            ("good", F.coalesce((F.col("head_bytes") < F.col("size")) & F.col("length").isNotNull(), F.lit(False))),
            ("whole", F.col("good") & (F.col("size") - F.col("head_bytes") - 4 >= F.col("length")))]


def _payload() -> list[tuple[str, Column]]:
    """The payload of a whole record: its block after the HTTP header."""
    body = F.expr("substring(cast(value as binary), cast(head_bytes + 5 as int), cast(length as int))")
    http = F.substring_index(F.col("body").cast("string"), END, 1)
    stated = F.nullif(F.regexp_extract("http", "(?i)\\r\\nContent-Length:[ \\t]*(\\d{1,18})", 1), F.lit("")).cast("bigint")
    return [("body", F.when(F.col("whole"), body)), ("http", http),
            ("payload", F.expr("substring(body, cast(octet_length(http) + 5 as int))")),
            ("bytes", F.when(F.col("kind") == "revisit", stated).otherwise(F.octet_length("payload").cast("bigint"))),
            ("digest", F.when(F.col("kind") == "revisit", F.lower("stated")).otherwise(F.sha1("payload"))),
            ("http", F.lit(None).cast("string"))]


def _with(df: DataFrame, columns: list[tuple[str, Column]]) -> DataFrame:
    for name, c in columns:
        df = df.withColumn(name, c)
    return df


def _places(df: DataFrame) -> DataFrame:
    """Adds ``at``, the byte where each segment begins: all segments and separators of the file before it."""
    step = F.col("size") + len(MAGIC)
    blocks = df.groupBy("file", "block").agg(F.sum(step).alias("all"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("file", "block").orderBy("order").rowsBetween(Window.unboundedPreceding, -1)
    return (df.withColumn("at", F.coalesce(F.sum(step).over(inside), F.lit(0))).join(blocks, ["file", "block"])
            .withColumn("at", F.col("at") + F.col("base")).drop("base"))


def _exits(pdf: pd.DataFrame) -> pd.DataFrame:
    """For every candidate of a block, where its chain leaves the block (pointer doubling)."""
    pdf = pdf.sort_values("start")
    start, nxt = pdf["start"].to_numpy(), pdf["next"].to_numpy()
    to = np.minimum(np.searchsorted(start, nxt), max(len(start) - 1, 0))
    to = np.where(start[to] == nxt, to, np.arange(len(start)))  # itself where the chain leaves
    while not np.array_equal(to[to], to):
        to = to[to]
    return pd.DataFrame({"file": pdf["file"], "block": pdf["block"], "start": start, "exit": nxt[to]})


def _walk(pdf: pd.DataFrame) -> pd.DataFrame:
    """The candidates of a block on the chain from its entry."""
    pdf = pdf.sort_values("start")
    start, nxt = pdf["start"].to_numpy(), pdf["next"].to_numpy()
    i, keep = int(np.searchsorted(start, pdf["entry"].iloc[0])), []
    while i < len(start):
        keep.append(i)
        j = int(np.searchsorted(start, nxt[i]))
        if j >= len(start) or start[j] != nxt[i]:
            break
        i = j
    return pdf.iloc[keep][["file", "start"]]


def reachable(candidates: DataFrame) -> DataFrame:
    """(file, start) of the records on the chain from byte 0 of their file.

    ``candidates``: (file, block, start, next). A candidate's successor lies behind it, so a
    chain enters a block once. A file that does not begin with a record gives none.
    """
    links = stash(candidates.groupBy("file", "block").applyInPandas(_exits, "file string, block bigint, start bigint, exit bigint"),
                  "links")
    ends = links.select("file", F.col("exit").alias("start")).distinct()
    jump = links.join(ends, ["file", "start"], "left_semi").unionByName(links.where("start = 0")).distinct()
    jump = stash(jump.select("file", "start", "exit"), "jumps")
    reached = stash(jump.where("start = 0").select("file", "start"), "reached")
    count = reached.count()
    while count:
        more = (reached.join(jump, ["file", "start"]).select("file", F.col("exit").alias("start"))
                .join(jump.select("file", "start"), ["file", "start"], "left_semi"))
        grown = stash(reached.unionByName(more).distinct(), "reached")
        n = grown.count()
        reached = grown
        if n == count:
            break
        count = n
        far = jump.select("file", F.col("start").alias("exit"), F.col("exit").alias("far"))
        jump = stash(jump.join(far, ["file", "exit"], "left")
                     .select("file", "start", F.coalesce("far", "exit").alias("exit")), "jumps")
    entries = (reached.join(links.select("file", "block", "start"), ["file", "start"])
               .select("file", "block", F.col("start").alias("entry")))
    return candidates.join(entries, ["file", "block"]).groupBy("file", "block").applyInPandas(_walk, "file string, start bigint")


def read_warc(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """(file, start, kind, name, uri, refers, payload_bytes, payload_digest, verified) of every record.

    ``payload_bytes`` and ``payload_digest`` (lower-case hex SHA-1) are those of the full payload: computed from the
    record, for revisits as the record states them. ``verified``: a response has the digest that its header
    states. ``payload``: also the payload itself (null for revisits). Bytes that no chain from a file's
    start reaches are no records. Empty or missing archives of a folder give no rows.
    """
    light = ["file", "block", "order", "size", "head_bytes", "length", "kind", "name", "uri", "refers", "stated", "good",
             "whole", "bytes", "digest"]
    seen = stash(_with(_with(_segments(spark, path), _parsed()), _payload()).select(*light), "segments")
    seen = stash(_places(seen), "places")
    start = F.col("at") - len(MAGIC)
    found = seen.where(F.col("good") & (start >= 0)).withColumn("start", start).withColumn(
        "next", F.col("at") + F.col("head_bytes") + len(END) + F.col("length") + len(END))
    chain = stash(reachable(found.select("file", "block", "start", "next")), "chain")
    records = found.join(chain, ["file", "start"])
    part = F.col("whole") if not payload else F.lit(False)
    done = records.where(part)
    split = stash(records.where(~part).select("file", "start", "at"), "split")
    columns = ["file", "start", "kind", "name", "uri", "refers", F.col("bytes").alias("payload_bytes"),
               F.col("digest").alias("payload_digest"),
               F.coalesce(F.lower("stated") == F.col("digest"), F.lit(False)).alias("verified")]
    out = done.select(*columns)
    if payload:
        out = out.withColumn("payload", F.lit(None).cast("binary")).limit(0)
        columns.append(F.when(F.col("kind") != "revisit", F.col("payload")).alias("payload"))
    elif split.isEmpty():
        return out
    # records whose payload holds the magic: put their segments together again. Which segments belong to which
    # record is found on narrow rows, block by block, so that only wanted segments leave their tasks.
    marked = seen.select("file", "block", "order", "size", "at").join(
        chain.select("file", (F.col("start") + len(MAGIC)).alias("at"), F.col("start")), ["file", "at"], "left")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = (marked.groupBy("file", "block").agg(F.max("start").alias("top"))
               .select("file", "block", F.max("top").over(before).alias("top")))
    inside = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    marked = (marked.withColumn("start", F.max("start").over(inside)).join(carried, ["file", "block"])
              .withColumn("start", F.coalesce("start", "top")).where("start IS NOT NULL").drop("top"))
    wanted = stash(marked.join(split.select("file", "start"), ["file", "start"]).select("file", "block", "order", "at", "start", "size"),
                   "wanted")
    segments = _segments(spark, path).withColumn("bytes", _bytes(F.col("value")))
    texts = keep_keys(segments, [segments["file"], segments["block"], segments["order"]], wanted.select("file", "block", "order"))
    # both scans cut the files alike; if not, say so instead of mixing records up
    texts = wanted.join(texts, ["file", "block", "order"], "left").withColumn(
        "value", F.when(F.col("bytes") == F.col("size"), F.col("value"))
        .otherwise(F.raise_error(F.lit("the archive's blocks changed between two scans; read it again"))))
    whole = (texts.groupBy("file", "start")
             .agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("parts"))
             .select("file", "start", F.array_join(F.transform("parts", lambda x: x["value"]), MAGIC).alias("value")))
    return out.unionByName(_with(_with(whole, _parsed()), _payload()).select(*columns))
