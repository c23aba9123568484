"""Fill-in-middle: a plain loop over the units, round trips and odd rows."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from inkwell.llm import fill_middle
from inkwell.llm.text_hash import raw_text

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
LONG = "wörter\n und 漢字 🙂 " * 20_000
TEXTS = [None, "", " ", "\n\t", "a", " a", "a ", " a \n", "a<P>b c d", "<S>", "x <M> y", "<P", "é", "漢字 漢　字 x", "🙂 🙂\v🙂",
         "a\x00b c", "one two three four five", "one two three four five", LONG, "x" * 5000, (" " * 3000 + "y") * 3, "ab " * 341 + "c",
         "á é b"]


def expected(i, text):
    t = text or ""
    units = UNIT.findall(t)
    assert "".join(units) == t
    h = [int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[8 * k:8 * k + 8], 16) for k in range(4)]
    x, y = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:x]), "".join(units[x:y]), "".join(units[y:])
    if not t or "<P>" in t or "<S>" in t or "<M>" in t or h[2] % 100 >= 50:
        return len(units), "plain", None, None, t
    if h[3] % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_against_a_plain_loop_and_back(spark):
    rows = [(len(TEXTS) * k + i, t) for k in range(12) for i, t in enumerate(TEXTS) if t != LONG or k < 4]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = fill_middle.fill_middle(docs).withColumn("back", fill_middle.restore(F.col("form"), F.col("fim_text")))
    got = {r["doc_id"]: (r["n_units"], r["form"], r["prefix_chars"], r["middle_chars"], r["fim_text"]) for r in out.collect()}
    assert got == {i: expected(i, t) for i, t in rows}
    assert {x[1] for x in got.values()} == {"plain", "psm", "spm"}
    assert out.where(~F.col("back").eqNullSafe(F.coalesce("text", F.lit("")))).count() == 0


def test_extra_clashing_and_dotted_columns_and_repeated_rows(spark):
    schema = "doc_id long, text string, form string, `meta.source` string, n_units int"
    rows = [(1, "a b c d e f", "x", "s", 1), (1, "a b c d e f", "x", "s", 1), (1, "other words", "y", None, 2), (None, "p q r s", "z", "", None)]
    out = fill_middle.fill_middle(spark.createDataFrame(rows, schema))
    assert out.columns == ["doc_id", "text", "form", "meta.source", "n_units", "n_units_", "form_", "prefix_chars", "middle_chars", "fim_text"]
    got = out.select("doc_id", "text", "form", "`meta.source`", "n_units").collect()
    assert sorted(map(str, got)) == sorted(map(str, spark.createDataFrame(rows, schema).collect()))
    assert out.where("text = 'a b c d e f'").select("fim_text").distinct().count() == 1
    empty = fill_middle.fill_middle(spark.createDataFrame([], schema))
    assert empty.count() == 0


@pytest.mark.parametrize("block", [1, 2, 3, 7, 64])
def test_every_cut_of_the_trees(block):
    texts = [t for t in TEXTS if t != LONG and len(t or "") < 400]
    data, offsets = raw_text(pa.array(texts, pa.string()))
    trees = fill_middle.BlockTrees(data, offsets, block)
    units = [UNIT.findall(t or "") for t in texts]
    assert trees.n_units.tolist() == [len(u) for u in units]
    for k in range(max(map(len, units)) + 1):
        size, points = trees.cut(np.array([min(k, len(u)) for u in units]))
        heads = ["".join(u[:k]) for u in units]
        assert size.tolist() == [len(h.encode()) for h in heads]
        assert points.tolist() == [len(h) for h in heads]
