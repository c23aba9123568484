"""Text queries: cleaning steps, tokenisation, stop words, preprocessing."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.functions import text as T
from inkwell.operators.preprocess import count_by_language, preprocess
from inkwell.plans import oracle as O
from inkwell.plans.catalog import big, joined, register
from inkwell.session import spread
from inkwell.sources.tables import articles, table


def _docs(spark, sf_dir):
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


def cleaned_articles(spark, sf_dir, url: bool = False):
    return preprocess(spread(articles(spark, sf_dir, url)))


# --- single steps of clean_text, over every document ------------------------------

def _step_query(name, fn, sql_fn):
    register(name, sql=f"SELECT doc_id, {sql_fn('text')} AS result FROM documents")(
        lambda spark, sf_dir: _docs(spark, sf_dir).select("doc_id", fn(F.col("text")).alias("result")))


_step_query("strip_tags", T.strip_tags, O.strip_tags)
_step_query("strip_urls", T.strip_urls, O.strip_urls)
_step_query("strip_symbols", T.strip_symbols, O.strip_symbols)
_step_query("collapse_ws", T.collapse_ws, O.collapse_ws)
_step_query("clean_text", T.clean_text, O.clean_text)
_step_query("dediac", lambda c: T.dediac(T.clean_text(c)), lambda x: O.dediac(O.clean_text(x)))


@register("tokenize", sql=f"""
SELECT doc_id, CAST(len(tok) AS BIGINT) AS n_tokens, array_to_string(tok, '|') AS tokens
FROM (SELECT doc_id, {O.tokenize(O.clean_text('text'))} AS tok FROM documents)""")
def q_tokenize(spark, sf_dir):
    d = _docs(spark, sf_dir).select("doc_id", T.tokenize(T.clean_text("text")).alias("tok"))
    return d.select("doc_id", big(F.size("tok")).alias("n_tokens"), joined("tok").alias("tokens"))


@register("tokenize_ar", sql=f"""
SELECT doc_id, array_to_string(regexp_extract_all({O.clean_text('text')}, {O.q(T.C.ARABIC_TOKEN_RE)}), '|')
       AS tokens FROM documents""")
def q_tokenize_ar(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", joined(T.tokenize_ar(T.clean_text("text"))).alias("tokens"))


@register("remove_stopwords", sql=f"""
SELECT doc_id, CAST(len(kept) AS BIGINT) AS n_kept, array_to_string(kept, '|') AS kept
FROM (SELECT doc_id, {O.remove_stopwords(O.tokenize(O.clean_text('text')), 'lang')} AS kept FROM documents)""")
def q_remove_stopwords(spark, sf_dir):
    d = _docs(spark, sf_dir).select(
        "doc_id", T.remove_stopwords(T.tokenize(T.clean_text("text")), F.col("lang")).alias("kept"))
    return d.select("doc_id", big(F.size("kept")).alias("n_kept"), joined("kept").alias("kept"))


@register("cleaned_text", sql=f"""
SELECT doc_id, {O.cleaned_text('text', 'lang')} AS cleaned_text FROM documents""")
def q_cleaned_text(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", T.cleaned_text("text", F.col("lang")).alias("cleaned_text"))


_CLEANED_SQL = O.with_(O.ARTICLES) + f"""
SELECT doc_id, title, coalesce(language, 'en') AS language,
       {O.cleaned_text(O.first_non_empty('content', 'description'), "coalesce(language, 'en')")} AS cleaned_text,
       publishedAt, source_id, source_name, url, description,
       CAST(length(content) AS BIGINT) AS content_chars
FROM articles"""


@register("clean_articles", sql=_CLEANED_SQL)
def q_clean_articles(spark, sf_dir):
    c = cleaned_articles(spark, sf_dir, url=True)
    return c.select("doc_id", "title", "language", "cleaned_text", "publishedAt",
                    F.col("source.id").alias("source_id"), F.col("source.name").alias("source_name"),
                    "url", "description", big(F.length("content")).alias("content_chars"))


@register("count_by_language", sql=f"""
SELECT language, count(*) AS n_articles FROM ({_CLEANED_SQL}) GROUP BY language""")
def q_count_by_language(spark, sf_dir):
    return count_by_language(cleaned_articles(spark, sf_dir))


@register("text_fallback", sql=O.with_(O.ARTICLES) + f"""
SELECT doc_id, {O.first_non_empty('content', 'description')} AS body,
       {O.first_non_empty('description', 'title')} AS headline FROM articles""")
def q_text_fallback(spark, sf_dir):
    a = articles(spark, sf_dir, url=False)
    return a.select("doc_id", T.first_non_empty("content", "description").alias("body"),
                    T.first_non_empty("description", "title").alias("headline"))


@register("terms", sql=f"""
SELECT doc_id, CAST(len(t) AS BIGINT) AS n_terms, array_to_string(t, '|') AS terms
FROM (SELECT doc_id, {O.terms(O.cleaned_text('text', 'lang'))} AS t FROM documents)""")
def q_terms(spark, sf_dir):
    d = _docs(spark, sf_dir).select("doc_id", T.terms(T.cleaned_text("text", F.col("lang"))).alias("t"))
    return d.select("doc_id", big(F.size("t")).alias("n_terms"), joined("t").alias("terms"))


@register("ngrams", sql=f"""
SELECT doc_id, CAST(len(g) AS BIGINT) AS n_ngrams, array_to_string(g, '|') AS ngrams
FROM (SELECT doc_id, {O.ngrams('t')} AS g
      FROM (SELECT doc_id, {O.terms(O.cleaned_text('text', 'lang'))} AS t FROM documents))""")
def q_ngrams(spark, sf_dir):
    d = _docs(spark, sf_dir).select("doc_id", T.terms(T.cleaned_text("text", F.col("lang"))).alias("t"))
    d = d.select("doc_id", T.ngrams("t").alias("g"))
    return d.select("doc_id", big(F.size("g")).alias("n_ngrams"), joined("g").alias("ngrams"))
