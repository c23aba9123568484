"""Ingest: feed rows -> raw articles (language, quota, page lookup, HTML heuristics)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell import constants as C
from inkwell.functions import fields, html
from inkwell.operators import langid


def first_per_group(df: DataFrame, k: int, group_cols, order_cols) -> DataFrame:
    """First ``k`` rows of each group in the given order (row_number <= k).

    Catalyst plans this as a WindowGroupLimit before the shuffle, so each task
    forwards at most ``k`` rows per group even when one group holds most rows.
    """
    w = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def detect_headline_language(feed: DataFrame, model, id_col: str = "doc_id") -> DataFrame:
    """feed + language of the headline ('' for an empty headline)."""
    return langid.detect(feed, id_col, "headline_text", model).drop("language_prob")


def select_rows(feed: DataFrame, languages=tuple(C.TARGET_LANGUAGES), quota: int | None = None,
                order_col: str = "doc_id") -> DataFrame:
    """Target languages only: all rows, or with a ``quota`` the first so many of each in feed order."""
    kept = feed.where(F.col("language").isin(list(languages)))
    return kept if quota is None else first_per_group(kept, quota, ["language"], [F.col(order_col)])


def read_pages(pages: DataFrame) -> DataFrame:
    """``pages`` with ``page_text`` and ``page_image`` in place of ``html``.

    What is looked at several times (the visible page, the image's tag) is a column of an own
    projection, made once for each page.
    """
    seen = pages.withColumn("_page", html.visible("html")).drop("html")
    found = seen.withColumns({"page_text": html.visible_main_text("_page"), "_tag": html.image_tag("_page")}).drop("_page")
    return found.withColumn("page_image", html.tag_image("_tag")).drop("_tag")


def lookup_pages(rows: DataFrame, pages: DataFrame, url_col: str = "source_url",
                 rows_bounded: bool = False, read=None) -> DataFrame:
    """rows + ``html`` of the page with the same url (null when no page: a failed fetch).

    With ``read`` (``read_pages``) the columns that it makes of the chosen pages (url, html) take the
    place of ``html``: every page is read once, however many rows have its url.

    The page of each url (the lowest ``page_id`` that was fetched; ids are the key of the page table) is
    chosen on the narrow columns among the urls in the rows; the html is then read by page id, so it
    passes no aggregate. The rows are bounded by ``quota * len(languages)`` when called after
    ``select_rows``: pass ``rows_bounded`` there and the small sides are broadcast on that bound;
    otherwise these are shuffle joins (AQE may still pick a broadcast from runtime sizes).
    """
    urls = rows.select(F.col(url_col).alias("url")).where(F.col("url").isNotNull()).distinct()
    # the url side is bounded by the quota, so the page table streams past it without a shuffle
    small = F.broadcast if rows_bounded else (lambda d: d)
    hits = pages.where(F.col("html").isNotNull()).select("page_id", "url").join(small(urls), "url", "left_semi")
    one = hits.groupBy("url").agg(F.min("page_id").alias("page_id"))
    found = pages.select("page_id", "html").join(small(one), "page_id").select(F.col("url").alias(url_col), "html")
    found = read(found) if read else found
    return rows.join(small(found), url_col, "left")


def to_article(rows: DataFrame, url_col: str = "source_url") -> DataFrame:
    """Project a looked-up feed row to the raw-article shape; its page may be read already (``read_pages``)."""
    rows = rows if "page_text" in rows.columns else read_pages(rows)
    keep = [c for c in ("doc_id", "feed_order") if c in rows.columns]
    return rows.select(
        *keep,
        F.struct(F.lit(None).cast("string").alias("id"),
                 fields.source_host(F.col(url_col)).alias("name")).alias("source"),
        F.lit("").alias("author"),
        F.col("headline_text").alias("title"),
        F.col("headline_text").alias("description"),
        F.col(url_col).alias("url"),
        F.coalesce("page_image", F.lit("")).alias("urlToImage"),
        fields.publish_time(F.col("publish_time")).alias("publishedAt"),
        F.coalesce("page_text", F.lit("")).alias("content"),
        fields.fetched_at().alias("fetched_at"),
        F.col("language"),
    )


def feed_to_articles(feed: DataFrame, pages: DataFrame, model, languages=tuple(C.TARGET_LANGUAGES),
                     quota: int | None = None, id_col: str | None = None) -> DataFrame:
    """The whole ingest stage: detect -> target languages -> quota -> page lookup -> article.

    ``id_col`` identifies and orders the rows: ``doc_id`` when the feed has one, else the
    ``feed_order`` of ``read_feed``.
    """
    id_col = id_col or ("doc_id" if "doc_id" in feed.columns else "feed_order")
    detected = detect_headline_language(feed, model, id_col)
    selected = select_rows(detected, languages, quota, id_col)
    return to_article(lookup_pages(selected, pages, rows_bounded=quota is not None, read=read_pages))


def api_to_article(rows: DataFrame, model) -> DataFrame:
    """API rows -> articles with per-field defaults; language of description (else title),
    falling back to the request's default ('ar' for country 'ae', else 'en')."""
    # the language depends on the text alone: distinct texts are scored, whatever response they came in
    base = rows.withColumn("_lt", F.coalesce(
        F.nullif(F.col("description"), F.lit("")), F.nullif(F.col("title"), F.lit("")), F.lit("")))
    # each by a 128-bit digest, so that its rows of trigrams do not carry the text
    base = base.withColumn("_key", F.unhex(F.md5("_lt")))
    texts = base.groupBy("_key").agg(F.first("_lt").alias("_text"))
    det = base.join(langid.detect(texts, "_key", "_text", model, out_col="_lang").select("_key", "_lang"), "_key")
    default_lang = F.when(F.col("country") != F.lit("ae"), F.lit("en")).otherwise(F.lit("ar"))
    empty_source = F.struct(F.lit(None).cast("string").alias("id"), F.lit(None).cast("string").alias("name"))
    out = det.select(
        F.coalesce(F.col("source"), empty_source).alias("source"),
        *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("author", "title", "description", "url",
                                                              "urlToImage")],
        F.coalesce(F.col("publishedAt"), fields.fetched_at()).alias("publishedAt"),
        F.coalesce(F.col("content"), F.lit("")).alias("content"),
        F.when(F.col("_lang") != F.lit(""), F.col("_lang")).otherwise(default_lang).alias("language"),
        fields.fetched_at().alias("fetched_at"),
        "country", "category",
    )
    return out
