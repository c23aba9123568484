"""Cleaning queries over texts that hold what the given tables lack: tags, links, Arabic with diacritics, page images.

Every document's whole text is put between marks derived from its row, the same on both sides. The SQL is
written from the rules (code points, splitting, expected values), not from the library's patterns.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.functions import html
from inkwell.functions import text as T
from inkwell.plans import oracle as O
from inkwell.plans.catalog import joined, register
from inkwell.session import scratch_path, spread
from inkwell.sources import feed as S
from inkwell.sources.tables import articles, table

#: An Arabic phrase for each remainder of doc_id: short vowels, shadda, tanween; tatweel and superscript alef; punctuation.
PHRASES = ["كِتَابٌ جَدِيدٌ، من رقم ", "السَّلامُ عليكم ـــ في هٰذا اليوم؟ ", "مرحبا بكم! "]


def marked(spark, sf_dir):
    """(doc_id, lang, m): the text inside a tag, with a tag broken by a line end, links and an Arabic phrase after it."""
    phrase = F.get(F.array(*[F.lit(p) for p in PHRASES]), F.pmod(F.col("doc_id"), F.lit(len(PHRASES))).cast("int"))
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"))
    number = F.col("doc_id").cast("string")
    return d.select("doc_id", F.when(F.pmod("doc_id", F.lit(2)) == 0, F.lit("ar")).otherwise(F.col("lang")).alias("lang"), F.concat(
        F.lit('<div class="'), F.coalesce("source", F.lit("")), F.lit('">'), F.coalesce("text", F.lit("")),
        F.lit("</div><br\n/> see https://example.org/"), number, F.lit("?q=<b>1</b> or http (cannot) "), phrase, number,
        F.lit(" a < b > c<>d http://x/<i")).alias("m"))


_MARKED = f"""marked AS (
  SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'ar' ELSE lang END AS lang,
    '<div class="' || coalesce(source, '') || '">' || coalesce(text, '') || '</div><br' || chr(10) || '/> see https://example.org/'
    || doc_id || '?q=<b>1</b> or http (cannot) ' || {O.sql_list(PHRASES)}[doc_id % {len(PHRASES)} + 1] || doc_id
    || ' a < b > c<>d http://x/<i' AS m FROM documents)"""

# the rules once more: blanks, tags on one line, links up to a blank, kept characters
_BLANK = r"\t\n\v\f\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_DIACRITICS = " || ".join(f"chr({code})" for code in [*range(1611, 1619), 1648, 1600])


def _no_tags(x):
    return f"regexp_replace({x}, '<[^>\\n]*>', ' ', 'g')"


def _no_links(x):
    return f"regexp_replace({x}, 'http[^{_BLANK}]+', ' ', 'g')"


def _no_diacritics(x):
    return f"translate({x}, {_DIACRITICS}, '')"


def _arabic_tokens(x):
    """Blanks around every other character, then the pieces between blanks."""
    return (f"list_filter(string_split_regex(regexp_replace({x}, '([^\\pL\\pN\\pM_\\s])', ' \\1 ', 'g'), '\\s+'), "
            "lambda t: t <> '')")


def _clean(x):
    words = f"regexp_replace({_no_links(_no_tags(x))}, '[^\\pL\\pN_{_BLANK}' || chr(1536) || '-' || chr(1791) || ']', ' ', 'g')"
    return f"array_to_string(list_filter(string_split_regex({words}, '[{_BLANK}]+'), lambda p: p <> ''), ' ')"


@register("marked_tags", sql=f"WITH {_MARKED} SELECT doc_id, {_no_tags('m')} AS result FROM marked")
def q_marked_tags(spark, sf_dir):
    return marked(spark, sf_dir).select("doc_id", T.strip_tags("m").alias("result"))


@register("marked_urls", sql=f"WITH {_MARKED} SELECT doc_id, {_no_links('m')} AS result FROM marked")
def q_marked_urls(spark, sf_dir):
    return marked(spark, sf_dir).select("doc_id", T.strip_urls("m").alias("result"))


@register("marked_dediac", sql=f"WITH {_MARKED} SELECT doc_id, {_no_diacritics('m')} AS result FROM marked")
def q_marked_dediac(spark, sf_dir):
    return marked(spark, sf_dir).select("doc_id", T.dediac("m").alias("result"))


@register("marked_tokens_ar", sql=f"WITH {_MARKED} SELECT doc_id, array_to_string({_arabic_tokens('m')}, '|') AS tokens FROM marked")
def q_marked_tokens_ar(spark, sf_dir):
    return marked(spark, sf_dir).select("doc_id", joined(T.tokenize_ar("m")).alias("tokens"))


@register("marked_cleaned", sql=f"""
WITH {_MARKED}, c AS (SELECT doc_id, lang, {_clean('m')} AS x FROM marked),
n AS (SELECT doc_id, lang, CASE WHEN lang = 'ar' THEN {_no_diacritics('x')} ELSE x END AS x FROM c),
t AS (SELECT doc_id, lang, CASE WHEN lang = 'ar' THEN {_arabic_tokens('x')} ELSE {O.tokenize('x')} END AS tok FROM n)
SELECT doc_id, {O.join_tokens(O.remove_stopwords('tok', 'lang'))} AS cleaned_text FROM t""")
def q_marked_cleaned(spark, sf_dir):
    """The whole chain with the Arabic options: every second document counts as Arabic."""
    return marked(spark, sf_dir).select("doc_id", T.cleaned_text("m", F.col("lang"), True).alias("cleaned_text"))


@register("marked_image", sql=f"""
SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'https://img.example/' || page_id || '.jpg?a=1&b=2'
  WHEN 1 THEN 'say "' || page_id || '"' ELSE {O.main_image('html')} END AS main_image FROM pages""")
def q_marked_image(spark, sf_dir):
    """Pages with an image tag before them: double quotes, single quotes, one inside a comment, another property."""
    n = F.col("page_id").cast("string")
    tags = F.array(
        F.concat(F.lit('<meta property="og:image" data-x=1 content="https://img.example/'), n, F.lit('.jpg?a=1&amp;b=2"/>')),
        F.concat(F.lit("<META content='say \""), n, F.lit("\"' Property = 'og:image'>")),
        F.concat(F.lit('<!-- <meta property="og:image" content="no'), n, F.lit('"> -->')),
        F.concat(F.lit('<meta property="og:title" content="no'), n, F.lit('">')))
    page = F.concat(F.get(tags, F.pmod("page_id", F.lit(4)).cast("int")), F.coalesce("html", F.lit("")))
    return spread(table(spark, sf_dir, "pages")).select("page_id", html.main_image(page).alias("main_image"))


#: Articles of one array file.
ARRAY = 1000


@register("scan_articles_array", sql=O.with_(O.ARTICLES) + """
SELECT doc_id, source_name, title, url, CAST(length(content) AS BIGINT) AS content_chars, language FROM articles""")
def q_scan_articles_array(spark, sf_dir):
    """Article files as the ingest step leaves them, one pretty-printed array each, read with the declared schema."""
    a = articles(spark, sf_dir)
    arrays = a.groupBy(F.floor(F.col("doc_id") / ARRAY)).agg(F.collect_list(F.struct(*a.columns)).alias("all"))
    path = scratch_path(spark, "article-arrays")
    (arrays.select(F.to_json("all", {"pretty": "true", "ignoreNullFields": "false"}).alias("value"))
     .write.option("maxRecordsPerFile", 1).text(path))
    back = S.read_articles(spark, path, json_array=True, schema=a.schema)
    return back.select("doc_id", F.col("source.name").alias("source_name"), "title", "url",
                       F.length("content").cast("bigint").alias("content_chars"), "language")
