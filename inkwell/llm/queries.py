"""The registered queries of this subpackage and their SQL (tables of DuckDB).

Each query applies its operator to its whole table and derives the asked columns from the
operator's result.
"""

from __future__ import annotations

import importlib.util

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell.llm import (decontaminate, fill_middle, lattice_dedup, minmax_dedup, pair_counts, prefix_counts, quote_link,
                         soft_mixing, token_parquet, toxic_segments, url_cascade, warc_chain, weak_quality)
from inkwell.llm.common import stash, table
from inkwell.session import scratch_path


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Path of a public tokenizer's file beside the installed ``public_tokenizers`` package."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: The rules of the url query: (rule, verdict).
URL_RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"),
             ("net/fr/", "block")]


def op1_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's url."""
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    return url_cascade.judge_urls(table(spark, sf_dir, "pages"), rules).withColumnRenamed("id", "page_id")


def op2_warc_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC archives and read back over their boundary chains."""
    path = scratch_path(spark, "warc")
    warc_chain.write_warc(table(spark, sf_dir, "pages"), path)
    records = warc_chain.read_warc(spark, path)
    number = lambda c: F.regexp_extract(c, "^urn:page:(-?\\d+)$", 1).try_cast("bigint")
    return records.select(number(F.col("name")).alias("page_id"), "payload_bytes", "payload_digest",
                          F.col("kind").alias("record_type"), number(F.col("refers")).alias("refers_to"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every (document, benchmark item) where the document contains 80 % or more of the item's 5-word shingles."""
    hits = decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return hits.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"),
                       F.col("shared").alias("n_shared"), F.col("size").alias("n_shingles"))


def quoted_messages(conversations: DataFrame) -> DataFrame:
    """The conversations as mail: every message quotes the one before it, which quotes the one before that."""
    before = conversations.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("p1"))
    earlier = conversations.select("conv_id", (F.col("turn") + 2).alias("turn"), F.col("text").alias("p2"))
    rows = conversations.join(before, ["conv_id", "turn"], "left").join(earlier, ["conv_id", "turn"], "left")
    two = F.concat(quote_link.quote(quote_link.quote(F.col("p2"))), F.lit("\n"))
    one = F.concat(F.coalesce(two, F.lit("")), quote_link.quote(F.col("p1")), F.lit("\n\n"))
    return rows.select("conv_id", "turn", F.concat(F.coalesce(one, F.lit("")), F.coalesce("text", F.lit(""))).alias("text"))


def op4_quote_link(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies found from quotations in all conversations, with texts free of quotes, in reply order columns."""
    mail = stash(quoted_messages(table(spark, sf_dir, "conversations")), "mail")
    out = quote_link.link_quotes(mail)
    return out.withColumnRenamed("conv", "conv_id")


def op5_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of whole documents on 4-word shingles at 80 %."""
    out = minmax_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)
    return out.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"), "kept")


def op6_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learnt from the heuristics' votes on all documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return weak_quality.score(docs, weak_quality.fit(docs)).select("doc_id", "quality", "weak_label", "keep")


def op7_token_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of whole documents written as Parquet lists in id order, then read back."""
    path = scratch_path(spark, "tokens")
    token_parquet.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return token_parquet.token_starts(spark, path)


def op8_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of the embeddings of each label at cosine 0.98."""
    out = lattice_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))
    return out.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


def op9_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learnt from the labelled rows whose crc32(doc_id) is not 0 modulo 5."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxic_segments.fit(toxic_segments.training_rows(docs, table(spark, sf_dir, "labels"), fold=5))
    out = toxic_segments.score(docs, model, out="score")
    return out.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 5 == 0).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Domain, words, fitted rate and copies of every document."""
    docs = table(spark, sf_dir, "documents")
    model = soft_mixing.fit_domains(soft_mixing.labelled_rows(docs, table(spark, sf_dir, "labels")))
    narrow = docs.select("doc_id", "text")
    rated = soft_mixing.with_rates(narrow, model, soft_mixing.fit_mixture(docs, model))
    key = F.struct(F.col("doc_id"), F.xxhash64("text"))
    return rated.select("doc_id", "domain", "n_words", "rate", soft_mixing.copies_of(F.col("rate"), key).alias("copies"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in fill-in-middle form, by digests of the output and of the text restored from it."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = fill_middle.fill_middle(docs)
    restored = fill_middle.restore(F.col("form"), F.col("fim_text"))
    return out.select("doc_id", F.col("n_units").alias("n"), "form", "prefix_chars", "middle_chars",
                      F.sha2("fim_text", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"))


def op12_pair_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of two tokenizers over every document, with corpus-wide counts of the linked id pairs."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = pair_counts.align(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    return out.select(F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                      digest.alias("groups_sha256"))


def op13_prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and exact tokens of every document, from the index of all its prefixes."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    index = prefix_counts.prefix_index(docs, tokenizer_path("piece_bpe_32k.model"))
    return prefix_counts.totals(index).select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


QUERIES = {
    "op1_url_cascade": op1_url_cascade,
    "op2_warc_chain": op2_warc_chain,
    "op3_decontaminate": op3_decontaminate,
    "op4_quote_link": op4_quote_link,
    "op5_minmax_dedup": op5_minmax_dedup,
    "op6_weak_quality": op6_weak_quality,
    "op8_lattice_dedup": op8_lattice_dedup,
    "op9_toxic_segments": op9_toxic_segments,
    "op10_soft_mixing": op10_soft_mixing,
    "op11_fill_middle": op11_fill_middle,
}
if importlib.util.find_spec("public_tokenizers") is not None:
    QUERIES |= {"op7_token_parquet": op7_token_parquet, "op12_pair_counts": op12_pair_counts,
                "op13_prefix_counts": op13_prefix_counts}

_WORDS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x20\x09-\x0D]+')"""


def _shingles(table_name: str, key: str, n: int) -> str:
    """SQL of the distinct (key, shingle) rows of a table."""
    return f"""SELECT DISTINCT {key}, CASE WHEN len(w) < {n} THEN array_to_string(w, ' ')
  ELSE array_to_string(w[i:i + {n - 1}], ' ') END AS s
FROM (SELECT {key}, w, unnest(range(1, greatest(len(w) - {n - 2}, 2))) AS i
  FROM (SELECT {key}, {_WORDS} AS w FROM {table_name} WHERE text IS NOT NULL) WHERE len(w) > 0)"""


_RULES = " UNION ALL ".join(f"SELECT '{r}' AS rule, '{v}' AS verdict" for r, v in URL_RULES)

ORACLE = {
    "op11_fill_middle": r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || CAST(doc_id AS VARCHAR)) AS x FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
  [CAST('0x' || x[8 * i + 1:8 * i + 8] AS BIGINT) FOR i IN range(4)] AS h FROM d),
c AS (SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS lo,
  greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS hi,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 50 THEN 'plain'
    WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM w),
p AS (SELECT doc_id, t, n, form, array_to_string(u[1:lo], '') AS pre, array_to_string(u[lo + 1:hi], '') AS mid,
  array_to_string(u[hi + 1:n], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
    ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256, sha256(t) AS restored_sha256 FROM p
""",
    "op1_url_cascade": rf"""
WITH p AS (SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS u FROM pages),
h AS (SELECT page_id, translate(regexp_extract(u, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(u, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r AS (SELECT rule, verdict, split_part(rule, '/', 1) AS rh, substr(rule, strpos(rule, '/')) AS rp FROM ({_RULES})),
m AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM h JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id)
SELECT h.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM h LEFT JOIN m USING (page_id)
""",
    "op2_warc_chain": """
WITH p AS (SELECT page_id, coalesce(html, '') AS b FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(b)) AS BIGINT) AS n, sha1(b) AS d FROM p),
k AS (SELECT *, max(page_id) OVER (PARTITION BY d, n) AS r FROM d)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
  CASE WHEN n >= 1000 AND r <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND r <> page_id THEN r END AS refers_to FROM k
""",
    "op8_lattice_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
link AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id
  WHERE list_cosine_similarity(x.e, y.e) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
root AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a), n AS (SELECT a, count(*) AS c FROM link GROUP BY a)
SELECT vec_id, coalesce(c, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN root ON root.a = vec_id LEFT JOIN n ON n.a = vec_id
""",
    "op3_decontaminate": f"""
WITH d AS ({_shingles('documents', 'doc_id', 5)}), b AS ({_shingles('benchmark', 'item_id', 5)}),
sized AS (SELECT item_id, count(*) AS n, list(s ORDER BY s) AS all_s FROM b GROUP BY item_id),
first_of AS (SELECT min(item_id) AS item_id, any_value(n) AS n FROM sized GROUP BY all_s),
hit AS (SELECT doc_id, item_id, count(*) AS c FROM b JOIN d USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, c AS n_shared, n AS n_shingles FROM hit JOIN first_of USING (item_id) WHERE 100 * c >= 80 * n
""",
    "op4_quote_link": r"""
WITH m AS (SELECT conv_id, turn, coalesce(text, '') AS text FROM conversations),
q AS (SELECT m.*, p.turn AS t1, len(string_split_regex(trim(p.text, E' \n\t'), '\n[ \t]*\n')) AS n1,
  CASE WHEN g.turn IS NULL THEN 0 ELSE len(string_split_regex(trim(g.text, E' \n\t'), '\n[ \t]*\n')) END AS n2
  FROM m LEFT JOIN m p ON p.conv_id = m.conv_id AND p.turn = m.turn - 1
  LEFT JOIN m g ON g.conv_id = m.conv_id AND g.turn = m.turn - 2)
SELECT conv_id, turn, text, t1 AS reply_to, CAST(coalesce(n1 + n2, 0) AS BIGINT) AS n_quotes,
  CAST(coalesce(n1 + n2, 0) AS BIGINT) AS n_linked, min(turn) OVER (PARTITION BY conv_id) AS thread,
  turn - min(turn) OVER (PARTITION BY conv_id) AS depth FROM q
""",
    "op5_minmax_dedup": f"""
WITH RECURSIVE s AS ({_shingles('documents', 'doc_id', 4)}),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pair AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM pair JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 80 * (p.n + q.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b),
root AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT documents.doc_id, coalesce(n, 0) AS n_shingles, component_id, documents.doc_id = component_id AS kept
FROM documents JOIN root ON root.a = documents.doc_id LEFT JOIN n ON n.doc_id = documents.doc_id
""",
}
