"""Article text, paragraph text and main image of a raw HTML page, as Column expressions.

The extractors follow a flat reading of the page: comments, ``<script>`` and
``<style>`` bodies are not text; every tag separates text pieces; each piece is
entity-decoded and stripped, blank pieces are dropped and the rest joined by one
space. An ``<article>`` ends at the closing tag that matches its opening tag: the depth of
nested articles is counted over the page's article tags.
"""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkwell import constants as C

# Fixed patterns (shared spelling with the DuckDB oracle).
INVISIBLE_RE = [
    r"(?is)<!--.*?-->",
    r"(?is)<script\b.*?</script\s*>",
    r"(?is)<style\b.*?</style\s*>",
]
SEPARATOR = "<>"                       # matches TAG_SPLIT_RE, so removed blocks split text
TAG_SPLIT_RE = r"<[A-Za-z/!?][^>]*>|<>"
HAS_ARTICLE_RE = r"(?i)<article(?:[\s/][^>]*)?>"
HAS_ARTICLE_AT_START_RE = r"(?i)^<article(?:[\s/][^>]*)?>"
EMPTY_AT_START_RE = r"(?i)^<article(?:[\s/][^>]*)?/>|^<article/>"
END_AT_START_RE = r"(?i)^</article\s*>"
ARTICLE_TAG_RE = r"(?i)(?=<article(?:[\s/][^>]*)?>|</article\s*>)"   # the place before an article tag
PARAGRAPH_OPEN_RE = r"(?is)<p\b[^>]*>"
PARAGRAPH_END_RE = r"</p\s*>|</article\s*>|</body\s*>|</div\s*>"
PARAGRAPH_RE = rf"(?is)<p\b[^>]*>(.*?)(?=<p\b|{PARAGRAPH_END_RE}|\z)"
META_IMAGE_RE = r"""(?is)<meta\s[^>]*?property\s*=\s*(?:"og:image"|'og:image')[^>]*>"""
CONTENT_DQ_RE = r"""(?is)\scontent\s*=\s*"([^"]*)\""""
CONTENT_SQ_RE = r"""(?is)\scontent\s*=\s*'([^']*)'"""
HAS_CONTENT_RE = r"""(?is)\scontent\s*="""
# References first, then the text between them; a lone '&' is itself.
REFERENCE_RE = r"&#[xX][0-9A-Fa-f]+;?|&#[0-9]+;?|&[A-Za-z][A-Za-z0-9]*;|[^&]+|&"
EDGE_WS_RE = rf"^[{C.WS}]+|[{C.WS}]+\z"

#: The named references: the standard library's table, as map entries; ``&apos;`` is HTML 5's.
ENTITIES = {f"&{name};": chr(code) for name, code in name2codepoint.items()} | {"&apos;": "'"}


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _reference(p: Column) -> Column:
    """The character of one reference; text that is none stays as it is."""
    hexa = p.rlike("^&#[xX]")
    digits = F.regexp_extract(p, "^&#[xX]?([0-9A-Fa-f]+)", 1)
    n = F.when(F.length(digits) > 7, F.lit(0)).otherwise(
        F.when(hexa, F.conv(digits, 16, 10)).otherwise(digits).cast("bigint"))
    known = n.between(1, 0xD7FF) | n.between(0xE000, 0x10FFFF)
    char = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    return (F.when(p.startswith("&#") & (F.length(p) > 2), F.when(known, char).otherwise(F.lit("\uFFFD")))
            .when(p.startswith("&"), F.coalesce(F.element_at(F.create_map(*[F.lit(x) for entry in ENTITIES.items() for x in entry]), p), p)).otherwise(p))


def unescape(col) -> Column:
    """Numeric (decimal, hex) and named character references decoded in one pass; unknown names stay."""
    x = _c(col)
    parts = F.transform(F.regexp_extract_all(x, F.lit(REFERENCE_RE), 0), _reference)
    return F.when(x.contains("&"), F.array_join(parts, "")).otherwise(x)


def visible(html) -> Column:
    """Page with comments, scripts and styles replaced by a separator."""
    x = F.coalesce(_c(html), F.lit(""))
    for pat in INVISIBLE_RE:
        x = F.regexp_replace(x, pat, SEPARATOR)
    return x


def text_of(fragment) -> Column:
    """Text pieces of an HTML fragment, decoded, stripped, blanks dropped, joined by ' '."""
    pieces = F.split(_c(fragment), TAG_SPLIT_RE)
    pieces = F.transform(pieces, lambda p: F.regexp_replace(unescape(p), EDGE_WS_RE, ""))
    return F.array_join(F.filter(pieces, lambda p: p != F.lit("")), " ")


def has_article(html) -> Column:
    return visible(html).rlike(HAS_ARTICLE_RE)


def article_body(page) -> Column:
    """What stands between the first ``<article>`` tag of visible HTML and the closing tag that matches it.

    The page is cut before each article tag; one pass over the pieces keeps the depth (+1 for an
    opening, -1 for a closing tag; ``<article/>`` opens nothing) and collects pieces until it is 0 again. A page that
    ends first ends the article.
    """
    parts = F.split(_c(page), ARTICLE_TAG_RE)
    start = F.struct(F.lit(0).alias("depth"), F.lit(False).alias("done"), F.array().cast("array<string>").alias("kept"))

    def step(acc: Column, x: Column) -> Column:
        opens, closes = x.rlike(HAS_ARTICLE_AT_START_RE), x.rlike(END_AT_START_RE)
        empty = opens & x.rlike(EMPTY_AT_START_RE)
        before = acc["depth"]
        depth = before + F.when(opens & ~empty, 1).when(closes & (before > 0), -1).otherwise(0)
        first = opens & (before == 0)
        done = acc["done"] | (closes & (before > 0) & (depth == 0)) | (first & empty)
        kept = (F.when(acc["done"] | done | ((before == 0) & ~first), acc["kept"])
                .otherwise(F.concat(acc["kept"], F.array(F.when(first, F.regexp_replace(x, "^<[^>]*>", "")).otherwise(x)))))
        return F.struct(depth.alias("depth"), done.alias("done"), kept.alias("kept"))

    return F.array_join(F.aggregate(parts, start, step)["kept"], "")


def article_text(html) -> Column:
    """Text of the first ``<article>``, nested ones included ('' when the page has none)."""
    return text_of(article_body(visible(html)))


def _paragraphs(page: Column) -> Column:
    paras = F.regexp_extract_all(page, F.lit(PARAGRAPH_RE), 1)
    return F.array_join(F.transform(paras, text_of), " ")


def paragraph_text(html) -> Column:
    """Texts of all ``<p>`` joined by ' '; an unclosed ``<p>`` ends at the next ``<p>`` or closer."""
    return _paragraphs(visible(html))


def visible_main_text(page) -> Column:
    """``main_text`` of a page that ``visible`` has been applied to."""
    page = _c(page)
    return F.when(page.rlike(HAS_ARTICLE_RE), text_of(article_body(page))).otherwise(_paragraphs(page))


def main_text(html) -> Column:
    """Article text when the page has an ``<article>``, else the paragraph text."""
    return visible_main_text(visible(html))


def image_tag(page) -> Column:
    """The first ``<meta property="og:image">`` of a page that ``visible`` has been applied to, else ''."""
    return F.regexp_extract(_c(page), META_IMAGE_RE, 0)


def main_image(html) -> Column:
    """``content`` of the first ``<meta property="og:image">``, else ''."""
    return tag_image(image_tag(visible(html)))


def tag_image(meta) -> Column:
    """``content`` of a tag that ``image_tag`` has found, else ''."""
    meta = _c(meta)
    dq = F.regexp_extract(meta, CONTENT_DQ_RE, 1)
    sq = F.regexp_extract(meta, CONTENT_SQ_RE, 1)
    value = F.when(meta.rlike(CONTENT_DQ_RE), dq).when(meta.rlike(CONTENT_SQ_RE), sq).otherwise(F.lit(""))
    return unescape(value)
