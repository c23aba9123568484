"""What an executor holds for a task does not grow with the rows of a scan."""

import tracemalloc

import numpy as np
import pyarrow as pa

import corpus_pipeline
from inkwell.llm import text_hash
from inkwell.llm.common import BATCH_BYTES
from test_operators import prose


def test_pipeline_stages_get_small_batches(spark, tmp_path):
    conf = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.createDataFrame([(i, prose(i, 20)) for i in range(20)], "doc_id long, text string")
    docs.limit(3).selectExpr("doc_id AS item_id", "text").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs.selectExpr("doc_id", "0 AS toxic", "1 AS quality").write.parquet(str(tmp_path / "labels.parquet"))

    def seen(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "size"])

    try:
        for name, stage in corpus_pipeline.STAGES:
            if name in ("toxicity", "near_duplicates", "decontamination"):
                spark.conf.unset(conf)
                stage(spark, docs, str(tmp_path))
                got = (spark.range(3000).coalesce(1).selectExpr("id", "repeat('x', CAST(3000 + id AS INT)) AS t")
                       .mapInArrow(seen, "n long, size long").collect())
                assert sum(r.n for r in got) == 3000 and max(r.size for r in got) <= BATCH_BYTES + 10_000, name
    finally:
        spark.conf.unset(conf)


def test_hashes_take_little_memory(monkeypatch):
    column = pa.array(["some words of a text " * 50_000])  # 1 MB
    monkeypatch.setattr(text_hash._Tables, "made", None)
    tracemalloc.start()
    h, s, e, first, data = text_hash.words(column)
    held, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(h) == 250_000 and len(np.unique(h)) == 5
    assert held < 14e6 and most < 30e6, (held, most)


def test_words_longer_than_a_block_hash_alike_everywhere():
    sizes = [text_hash._BLOCK - 1, text_hash._BLOCK, text_hash._BLOCK + 1, 1 << 19, (1 << 20) + 1]
    long = [("ab" * n)[:n] for n in sizes]
    alone = [text_hash.words(pa.array([x]))[0][0] for x in long]
    mixed = text_hash.words(pa.array(["a " + " ".join(long), None, long[2].upper()]))[0]
    assert list(mixed[1:6]) == alone and mixed[6] == alone[2] and len(set(alone)) == len(long)
