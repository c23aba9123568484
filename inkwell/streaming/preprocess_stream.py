"""The stateless preprocessing stage (raw articles -> cleaned articles) as a file-source stream.

New article files landing in ``source_dir`` (JSON lines) are cleaned and appended to a Parquet
table. The stage has no state, so every micro-batch is independent; the per-language quota
of ingest needs state and stays a batch job.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from inkwell.operators.preprocess import preprocess
from inkwell.sources.feed import RAW_ARTICLE_SCHEMA


def start(spark: SparkSession, source_dir: str, out_dir: str, checkpoint: str,
          available_now: bool = True, max_files_per_trigger: int = 1000) -> StreamingQuery:
    """Start the stream; a restart with the same ``checkpoint`` goes on where it stopped. With ``available_now`` it processes what is there and stops."""
    raw = (spark.readStream.schema(RAW_ARTICLE_SCHEMA)
           .option("maxFilesPerTrigger", max_files_per_trigger).json(source_dir))
    writer = (preprocess(raw).writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start(out_dir)
