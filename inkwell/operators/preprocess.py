"""Article preprocessing: raw article -> cleaned article (one projection, no shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell.functions import text as T


def preprocess(articles: DataFrame, arabic_normalize: bool = False,
               english_stopwords=None, arabic_stopwords=None) -> DataFrame:
    """cleaned_articles: title, language, cleaned_text, publishedAt, source, url, description, content.

    ``language`` defaults to 'en' only when missing; the text is content, else
    description, else ''.
    """
    lang = F.coalesce(F.col("language"), F.lit("en"))
    body = T.first_non_empty("content", "description")
    cleaned = T.clean_text(body, lang, arabic_normalize)
    tokens = T.remove_stopwords(T.tokenize(cleaned, lang, arabic_normalize), lang,
                                english_stopwords, arabic_stopwords)
    keep = [c for c in ("doc_id",) if c in articles.columns]
    return articles.select(
        *keep,
        F.col("title"),
        lang.alias("language"),
        T.join_tokens(tokens).alias("cleaned_text"),
        F.col("publishedAt"),
        F.col("source"),
        *([F.col("url")] if "url" in articles.columns else []),
        F.col("description"),
        F.col("content"),
    )


def count_by_language(df: DataFrame) -> DataFrame:
    return df.groupBy("language").agg(F.count(F.lit(1)).alias("n_articles"))
