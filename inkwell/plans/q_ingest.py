"""Ingest queries: sources, sinks, field functions, HTML heuristics, quota."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from inkwell import constants as C
from inkwell.functions import fields, html
from inkwell.operators import ingest
from inkwell.operators.preprocess import preprocess
from inkwell.plans import oracle as O
from inkwell.plans.catalog import big, register
from inkwell.plans.q_langid import langid_model
from inkwell.session import scratch_path, spread
from inkwell.sources import feed as S
from inkwell.sources.tables import articles, feed_rows, table

TARGETS = "(" + ", ".join(O.q(x) for x in C.TARGET_LANGUAGES) + ")"


def _pages(spark, sf_dir):
    return spread(table(spark, sf_dir, "pages"))


# --- field functions ---------------------------------------------------------------------

@register("source_host", sql=f"SELECT page_id, {O.source_host('url')} AS source_name FROM pages")
def q_source_host(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", fields.source_host("url").alias("source_name"))


@register("publish_time", sql=f"""
SELECT event_id, {O.publish_time("strftime(ts, '%Y%m%d%H%M')")} AS publishedAt FROM events""")
def q_publish_time(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", fields.publish_time(F.date_format("ts", "yyyyMMddHHmm")).alias("publishedAt"))


@register("html_article_text", sql=f"""
SELECT page_id, {O.has_article('html')} AS has_article, {O.article_text('html')} AS article_text FROM pages""")
def q_html_article_text(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", html.has_article("html").alias("has_article"),
                                        html.article_text("html").alias("article_text"))


_NESTED = "'<div><article><h1>' || coalesce(url, '') || '</h1>' || coalesce(html, '') || '<article class=x>in ' || page_id || '</article> tail</article> after</div>'"


@register("html_nested_article", sql=f"""
SELECT page_id, {O.article_text('nested')} AS article_text FROM (SELECT page_id, {_NESTED} AS nested FROM pages)""")
def q_html_nested_article(spark, sf_dir):
    """Every page put into an article of its own, with one more article inside: the outer one is read to its end."""
    nested = F.concat(F.lit("<div><article><h1>"), F.coalesce("url", F.lit("")), F.lit("</h1>"), F.coalesce("html", F.lit("")),
                      F.lit("<article class=x>in "), F.col("page_id").cast("string"), F.lit("</article> tail</article> after</div>"))
    return _pages(spark, sf_dir).select("page_id", html.article_text(nested).alias("article_text"))


@register("html_paragraph_text", sql=f"SELECT page_id, {O.paragraph_text('html')} AS paragraph_text FROM pages")
def q_html_paragraph_text(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", html.paragraph_text("html").alias("paragraph_text"))


@register("html_main_image", sql=f"SELECT page_id, {O.main_image('html')} AS main_image FROM pages")
def q_html_main_image(spark, sf_dir):
    return _pages(spark, sf_dir).select("page_id", html.main_image("html").alias("main_image"))


# --- feed -> articles --------------------------------------------------------------------

_PAGE_BY_URL = "page_by_url AS (SELECT url, arg_min(html, page_id) AS html FROM pages GROUP BY url)"


@register("feed_page_join", sql=O.with_(O.FEED_ROWS, _PAGE_BY_URL) + f"""
SELECT f.doc_id, f.source_url, p.html IS NOT NULL AS has_page,
       CASE WHEN p.html IS NULL THEN '' ELSE {O.main_text('p.html')} END AS content
FROM feed_rows f LEFT JOIN page_by_url p ON p.url = f.source_url""")
def q_feed_page_join(spark, sf_dir):
    """Every feed row looked up in the page table (failed fetch = '')."""
    fr = feed_rows(spark, sf_dir)
    pages = table(spark, sf_dir, "pages")
    # the page of each url is chosen on the narrow columns; html is then fetched once, by page id
    one = pages.where(F.col("html").isNotNull()).groupBy("url").agg(F.min("page_id").alias("page_id"))
    found = pages.select("page_id", "html").join(one, "page_id").select(F.col("url").alias("source_url"), "html")
    j = fr.join(found, "source_url", "left")
    return j.select("doc_id", "source_url", F.col("html").isNotNull().alias("has_page"),
                    F.when(F.col("html").isNotNull(), html.main_text("html")).otherwise(F.lit(""))
                    .alias("content"))


def _detected_feed(spark, sf_dir):
    return ingest.detect_headline_language(spread(feed_rows(spark, sf_dir)), langid_model(spark, sf_dir))


_DETECTED_SQL = [O.FEED_ROWS, O.LANGID_MODEL, O.langid_detect("det", "feed_rows", "doc_id", "headline_text"),
                 "detected AS (SELECT f.*, d.language FROM feed_rows f JOIN det d USING (doc_id))"]
_TARGET_SQL = _DETECTED_SQL + [f"selected AS (SELECT * FROM detected WHERE language IN {TARGETS})"]
_SELECTED_SQL = _DETECTED_SQL + [f"""selected AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY language ORDER BY doc_id) AS rn
    FROM detected WHERE language IN {TARGETS}) WHERE rn <= {C.QUOTA_PER_LANGUAGE})"""]


@register("filter_language", sql=O.with_(*_DETECTED_SQL) + f"""
SELECT doc_id, language FROM detected WHERE language IN {TARGETS}""")
def q_filter_language(spark, sf_dir):
    d = _detected_feed(spark, sf_dir)
    return d.where(F.col("language").isin(C.TARGET_LANGUAGES)).select("doc_id", "language")


@register("language_quota", sql=O.with_(*_SELECTED_SQL) + "SELECT doc_id, language FROM selected")
def q_language_quota(spark, sf_dir):
    return ingest.select_rows(_detected_feed(spark, sf_dir), quota=C.QUOTA_PER_LANGUAGE).select("doc_id", "language")


_ORDER_CASE = "CASE language " + " ".join(
    f"WHEN {O.q(x)} THEN {i}" for i, x in enumerate(C.TARGET_LANGUAGES)) + " END"


@register("union_languages", sql=O.with_(*_TARGET_SQL) + f"""
SELECT doc_id, language,
       CAST(row_number() OVER (ORDER BY {_ORDER_CASE}, doc_id) AS BIGINT) AS position
FROM selected""")
def q_union_languages(spark, sf_dir):
    """Rows of each target language, concatenated in target-language order, with their position.

    Positions come from the exact rank within buckets of 4096 ids and a prefix sum over the
    bucket counts, so no language is ordered in one task.
    """
    sel = ingest.select_rows(_detected_feed(spark, sf_dir))
    place = F.array_position(F.array(*[F.lit(x) for x in C.TARGET_LANGUAGES]), F.col("language"))
    u = sel.select("doc_id", "language", place.alias("lang_order"), F.floor(F.col("doc_id") / 4096).alias("bucket"))
    sizes = u.groupBy("lang_order", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("lang_order", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    offs = sizes.select("lang_order", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("off"))
    rn = F.row_number().over(Window.partitionBy("lang_order", "bucket").orderBy("doc_id"))
    return (u.withColumn("rn", rn).join(offs, ["lang_order", "bucket"])
            .select("doc_id", "language", big(F.col("off") + F.col("rn")).alias("position")))


_ARTICLE_SQL = O.with_(*_TARGET_SQL, _PAGE_BY_URL) + f"""
SELECT s.doc_id, NULL::VARCHAR AS source_id, {O.source_host('s.source_url')} AS source_name, '' AS author,
       s.headline_text AS title, s.headline_text AS description, s.source_url AS url,
       CASE WHEN p.html IS NULL THEN '' ELSE {O.main_image('p.html')} END AS urlToImage,
       {O.publish_time('s.publish_time')} AS publishedAt,
       CASE WHEN p.html IS NULL THEN '' ELSE {O.main_text('p.html')} END AS content,
       s.language
FROM selected s LEFT JOIN page_by_url p ON p.url = s.source_url"""


def feed_articles(spark, sf_dir):
    return ingest.feed_to_articles(spread(feed_rows(spark, sf_dir)), table(spark, sf_dir, "pages"),
                                   langid_model(spark, sf_dir))


@register("feed_to_article", sql=_ARTICLE_SQL)
def q_feed_to_article(spark, sf_dir):
    a = feed_articles(spark, sf_dir)
    return a.select("doc_id", F.col("source.id").alias("source_id"), F.col("source.name").alias("source_name"),
                    "author", "title", "description", "url", "urlToImage", "publishedAt", "content", "language")


# --- article filters and limits ---------------------------------------------------------

@register("filter_content_len", sql=O.with_(O.ARTICLES) + """
SELECT doc_id, language FROM articles WHERE content IS NOT NULL AND length(content) > 5""")
def q_filter_content_len(spark, sf_dir):
    a = articles(spark, sf_dir, url=False)
    return a.where(F.col("content").isNotNull() & (F.length("content") > 5)).select("doc_id", "language")


@register("first_k_per_language", sql=O.with_(O.ARTICLES) + f"""
SELECT doc_id, language FROM (
  SELECT doc_id, language, row_number() OVER (PARTITION BY language ORDER BY doc_id) AS rn
  FROM articles WHERE length(content) > 5) WHERE rn <= 5""")
def q_first_k_per_language(spark, sf_dir):
    """First 5 articles with content of every language (the reference's demo takes ar and en)."""
    a = articles(spark, sf_dir, url=False).where(F.length("content") > 5)
    return ingest.first_per_group(a, 5, ["language"], [F.col("doc_id")]).select("doc_id", "language")


@register("head_articles", sql=O.with_(O.ARTICLES) + """
SELECT doc_id, language, title FROM articles ORDER BY doc_id LIMIT 10""")
def q_head_articles(spark, sf_dir):
    return articles(spark, sf_dir, url=False).orderBy("doc_id").limit(10).select("doc_id", "language", "title")


@register("request_grid", sql=f"""
SELECT lower(n.n_name) AS country, lower(r.r_name) AS category, CAST({C.PAGE_SIZE} AS BIGINT) AS page_size,
       CASE WHEN lower(n.n_name) <> 'ae' THEN 'en' ELSE 'ar' END AS language
FROM nation n CROSS JOIN region r""")
def q_request_grid(spark, sf_dir):
    """countries = nation names, categories = region names."""
    countries = table(spark, sf_dir, "nation").select(F.lower("n_name").alias("country"))
    cats = table(spark, sf_dir, "region").select(F.lower("r_name").alias("category"))
    return S.request_grid(spark, countries, cats)


# --- sources and sinks as round trips over derived data --------------------------------------

@register("scan_feed_csv", sql=O.with_(O.FEED_ROWS) + """
SELECT publish_time, feed_code, coalesce(source_url, '') AS source_url, headline_text FROM feed_rows""")
def q_scan_feed_csv(spark, sf_dir):
    path = scratch_path(spark, "feed-csv")
    S.write_feed(feed_rows(spark, sf_dir), path)
    rows, _rejected = S.read_feed(spark, [path])
    return rows.select(*S.FEED_COLUMNS)


@register("feed_reject", sql=O.with_(O.FEED_ROWS) + """
SELECT publish_time || ',' || feed_code || ',"' || replace(headline_text, '"', '""') || ', more",,extra ' || doc_id AS _bad
FROM feed_rows WHERE doc_id % 3 = 0 AND headline_text NOT LIKE '%' || chr(13) || '%'""")
def q_feed_reject(spark, sf_dir):
    """Rows with more than four fields, from a feed file in which every third row has five."""
    f = feed_rows(spark, sf_dir).where(~F.col("headline_text").contains("\r"))
    quoted = F.concat(F.lit('"'), F.replace("headline_text", F.lit('"'), F.lit('""')), F.lit(', more"'))
    last = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit(",extra "), F.col("doc_id").cast("string"))).otherwise(F.lit(""))
    line = F.concat_ws(",", "publish_time", "feed_code", quoted, last)
    path = scratch_path(spark, "feed-csv")
    # the header is one more line at the head of every file: written by each task before its rows
    f.select(line.alias(",".join(S.FEED_COLUMNS))).write.option("header", True).option("quote", "").option("escapeQuotes", False).option("sep", "\x01").csv(path)
    _rows, rejected = S.read_feed(spark, [path])
    return rejected.select("_bad")


@register("scan_articles_json", sql=O.with_(O.ARTICLES) + """
SELECT source_name, title, url, CAST(length(content) AS BIGINT) AS content_chars, language FROM articles""")
def q_scan_articles_json(spark, sf_dir):
    path = scratch_path(spark, "articles-json")
    S.write_articles(articles(spark, sf_dir).drop("doc_id").withColumn("fetched_at", F.lit("")), path)
    back = S.read_articles(spark, path)
    return back.select(F.col("source.name").alias("source_name"), "title", "url",
                       big(F.length("content")).alias("content_chars"), "language")


_CLEAN_SQL = O.with_(O.ARTICLES) + f"""
SELECT doc_id, title, coalesce(language, 'en') AS language,
       {O.cleaned_text(O.first_non_empty('content', 'description'), "coalesce(language, 'en')")} AS cleaned_text
FROM articles"""


@register("sink_roundtrip_json", sql=_CLEAN_SQL)
def q_sink_roundtrip_json(spark, sf_dir):
    path = scratch_path(spark, "cleaned-json")
    cleaned = preprocess(spread(articles(spark, sf_dir, url=False)))
    S.write_articles(cleaned, path)
    back = S.read_articles(spark, path, schema=cleaned.schema)
    return back.select(F.col("doc_id").cast("bigint").alias("doc_id"), "title", "language", "cleaned_text")


@register("sink_by_language", sql=f"""
SELECT language, count(*) AS n_articles, CAST(sum(length(cleaned_text)) AS BIGINT) AS n_chars
FROM ({_CLEAN_SQL}) GROUP BY language""")
def q_sink_by_language(spark, sf_dir):
    path = scratch_path(spark, "cleaned-by-lang")
    cleaned = preprocess(spread(articles(spark, sf_dir, url=False)))
    S.write_articles(cleaned, path, by="language")
    back = S.read_articles(spark, path, schema=cleaned.schema)
    return back.groupBy("language").agg(F.count(F.lit(1)).alias("n_articles"),
                                        big(F.sum(F.length("cleaned_text"))).alias("n_chars"))


def _landing_zone(spark, sf_dir):
    """Article rows landed as API responses: country = source name, category = language."""
    a = articles(spark, sf_dir).select(
        F.col("source.name").alias("country"), F.col("language").alias("category"),
        F.floor(F.col("doc_id") / F.lit(C.PAGE_SIZE)).alias("page"), F.col("doc_id").alias("_pos"),
        "source", "author", "title", "description", "url", "urlToImage", "publishedAt", "content")
    root = scratch_path(spark, "api-landing")
    S.write_api_envelopes(a, root)
    return S.read_api(spark, root, json_lines=True)


_API_ROWS_SQL = O.with_(O.ARTICLES) + """
SELECT source_name AS country, language AS category, title, description, url,
       CAST(length(content) AS BIGINT) AS content_chars FROM articles"""


@register("api_envelope_explode", sql=_API_ROWS_SQL)
def q_api_envelope_explode(spark, sf_dir):
    r = _landing_zone(spark, sf_dir)
    return r.select("country", "category", "title", "description", "url",
                    big(F.length("content")).alias("content_chars"))


@register("request_cap", sql=O.with_(O.ARTICLES) + f"""
SELECT country, category, title FROM (
  SELECT source_name AS country, language AS category, title,
         row_number() OVER (PARTITION BY source_name, language ORDER BY doc_id) AS rn
  FROM articles) WHERE rn <= {C.PAGE_SIZE}""")
def q_request_cap(spark, sf_dir):
    """The first PAGE_SIZE articles of every (country, category), in the order of the landed responses."""
    r = _landing_zone(spark, sf_dir)
    capped = ingest.first_per_group(r, C.PAGE_SIZE, ["country", "category"], [F.col("response"), F.col("pos")])
    return capped.select("country", "category", "title")


@register("api_responses", sql=O.with_(O.ARTICLES) + f"""
SELECT source_name AS country, language AS category, count(DISTINCT CAST(floor(doc_id / {C.PAGE_SIZE}) AS BIGINT)) AS n_responses,
       count(*) AS n_articles FROM articles GROUP BY ALL""")
def q_api_responses(spark, sf_dir):
    """Responses of every request told apart by their place, several of them in one file of lines."""
    r = _landing_zone(spark, sf_dir)
    return r.groupBy("country", "category").agg(F.countDistinct("response").alias("n_responses"), F.count(F.lit(1)).alias("n_articles"))


@register("api_to_article", sql=O.with_(
    O.ARTICLES, O.LANGID_MODEL,
    "heads AS (SELECT doc_id, coalesce(nullif(description, ''), nullif(title, ''), '') AS lt FROM articles)",
    O.langid_detect("det", "heads", "doc_id", "lt"),
) + """
SELECT a.source_name AS country, a.language AS category, a.title, a.description, a.author, a.urlToImage,
       a.publishedAt, CASE WHEN d.language <> '' THEN d.language
                           WHEN a.source_name <> 'ae' THEN 'en' ELSE 'ar' END AS language
FROM articles a JOIN det d USING (doc_id)""")
def q_api_to_article(spark, sf_dir):
    r = _landing_zone(spark, sf_dir)
    out = ingest.api_to_article(r, langid_model(spark, sf_dir))
    return out.select("country", "category", "title", "description", "author", "urlToImage", "publishedAt",
                      "language")


@register("stage_counts", sql=O.with_(*_SELECTED_SQL) + f"""
SELECT 'feed_rows' AS stage, count(*) AS n_rows FROM feed_rows
UNION ALL SELECT 'target_language', count(*) FROM detected WHERE language IN {TARGETS}
UNION ALL SELECT 'selected', count(*) FROM selected
UNION ALL SELECT 'documents', count(*) FROM documents""")
def q_stage_counts(spark, sf_dir):
    """Rows at each ingest stage, as one table (the reference prints them)."""
    det = _detected_feed(spark, sf_dir)
    tgt = det.where(F.col("language").isin(C.TARGET_LANGUAGES))
    sel = ingest.select_rows(det, quota=C.QUOTA_PER_LANGUAGE)

    def n(df, stage):
        return df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(stage).alias("stage"), "n_rows")

    return (n(det, "feed_rows").unionByName(n(tgt, "target_language")).unionByName(n(sel, "selected"))
            .unionByName(n(table(spark, sf_dir, "documents"), "documents")))
