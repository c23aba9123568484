"""The preprocessing stream gives the same rows as the batch stage."""

import os

from inkwell.operators.preprocess import preprocess
from inkwell.session import scratch_path
from inkwell.sources import feed as S
from inkwell.streaming import preprocess_stream


def test_stream_equals_batch(spark, fixtures):
    raw = S.read_articles(spark, os.path.join(fixtures, "raw_articles.json"), json_array=True)
    src = scratch_path(spark, "stream-src")
    S.write_articles(raw, src)
    out, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    q = preprocess_stream.start(spark, src, out, ckpt)
    q.awaitTermination(120)
    preprocess_stream.start(spark, src, out, ckpt).awaitTermination(120)  # a restart adds nothing
    got = sorted(tuple(r) for r in spark.read.parquet(out).select("title", "cleaned_text").collect())
    want = sorted(tuple(r) for r in preprocess(raw).select("title", "cleaned_text").collect())
    assert got == want
