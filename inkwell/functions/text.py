"""Text cleaning and tokenisation as Column expressions (JVM-side, codegen'd).

All functions take and return ``Column``s and use only built-in Spark functions,
so they stay inside whole-stage code generation and scale with the data.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from inkwell import constants as C


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- clean_text, step by step ------------------------------------------------

def strip_tags(col) -> Column:
    """Replace every '<...>' on one line with a blank."""
    return F.regexp_replace(_c(col), C.TAG_RE, " ")


def strip_urls(col) -> Column:
    """Replace 'http' and the non-blank run after it with a blank."""
    return F.regexp_replace(_c(col), C.URL_RE, " ")


def strip_symbols(col) -> Column:
    """Replace anything but word characters, blanks and the Arabic block."""
    return F.regexp_replace(_c(col), C.SYMBOL_RE, " ")


def collapse_ws(col) -> Column:
    """Collapse runs of (Unicode) blanks to one space and trim the ends."""
    # after the collapse every blank run is one U+0020, so trim() suffices
    return F.trim(F.regexp_replace(_c(col), C.WS_RUN_RE, " "))


def dediac(col) -> Column:
    """Remove Arabic diacritics, tatweel and superscript alef."""
    return F.regexp_replace(_c(col), C.ARABIC_DIACRITICS_RE, "")


def clean_text(col, lang=None, arabic_normalize: bool = False) -> Column:
    """null -> ''; tags, urls, symbols to blanks; blanks collapsed; optional de-diacritisation."""
    x = F.coalesce(_c(col), F.lit(""))
    x = collapse_ws(strip_symbols(strip_urls(strip_tags(x))))
    if arabic_normalize and lang is not None:
        x = F.when(_c(lang) == F.lit("ar"), dediac(x)).otherwise(x)
    return x


# --- tokenisation --------------------------------------------------------------

def _split_contractions(x: Column) -> Column:
    """A blank inside every contraction. They are whole words, so one pass finds what a pass for each would."""
    heads = []
    for first, second in C.CONTRACTIONS:
        tail = "(?=[" + C.WS + "]|$)" if (first, second) == ("wan", "na") else f"(?![{C.WORD}])"
        heads.append(f"{first}(?={second}{tail})")
    initials = "".join(sorted({first[0] for first, _ in C.CONTRACTIONS}))
    # the look at the first letter spares nearly all places the look behind it
    return F.regexp_replace(x, f"(?i)(?=[{initials}])(?<![{C.WORD}])(?:{'|'.join(heads)})", "$0 ")


def tokenize(col, lang=None, arabic_normalize: bool = False) -> Column:
    """Word tokens of a cleaned text (blank split plus the contraction rules).

    With ``arabic_normalize`` the Arabic rows use the Arabic tokeniser, which also
    separates punctuation marks.
    """
    x = _c(col)
    words = F.filter(F.split(_split_contractions(x), " "), lambda t: t != F.lit(""))
    if arabic_normalize and lang is not None:
        return F.when(_c(lang) == F.lit("ar"), tokenize_ar(x)).otherwise(words)
    return words


def tokenize_ar(col) -> Column:
    return F.regexp_extract_all(_c(col), F.lit(C.ARABIC_TOKEN_RE), 0)


def stopword_array(words) -> Column:
    return F.array(*[F.lit(w) for w in words])


def remove_stopwords(tokens, lang=None, english=None, arabic=None) -> Column:
    """Drop tokens whose lower case is a stop word; Arabic list for 'ar', English otherwise.

    ``isin`` over a long literal list becomes a hashed InSet, one lookup per token.
    """
    en = list(english if english is not None else C.ENGLISH_STOPWORDS)
    ar = list(arabic if arabic is not None else C.ARABIC_STOPWORDS)

    def is_stop(t):
        low = F.lower(t)
        if lang is None:
            return low.isin(en)
        return F.when(_c(lang) == F.lit("ar"), low.isin(ar)).otherwise(low.isin(en))

    return F.filter(_c(tokens), lambda t: ~is_stop(t))


def join_tokens(tokens) -> Column:
    return F.array_join(_c(tokens), " ")


def cleaned_text(col, lang=None, arabic_normalize: bool = False) -> Column:
    """The full preprocessing chain: clean -> tokenise -> stop words -> re-join."""
    cleaned = clean_text(col, lang, arabic_normalize)
    return join_tokens(remove_stopwords(tokenize(cleaned, lang, arabic_normalize), lang))


# --- vectoriser analyser -------------------------------------------------------

def terms(col) -> Column:
    """Lower-cased runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(F.coalesce(_c(col), F.lit(""))), F.lit(C.TERM_RE), 0)


def ngrams(term_array) -> Column:
    """Unigrams followed by bigrams (joined by one space) of a term array."""
    t = _c(term_array)
    m = F.greatest(F.size(t) - 1, F.lit(0))
    bigrams = F.zip_with(F.slice(t, 1, m), F.slice(t, 2, m), lambda a, b: F.concat_ws(" ", a, b))
    return F.concat(t, bigrams)


# --- small helpers -----------------------------------------------------------

def first_line(col) -> Column:
    return F.substring_index(_c(col), "\n", 1)


def first_non_empty(*cols) -> Column:
    """First value that is neither null nor '' (Python's ``a or b or ''``)."""
    return F.coalesce(*[F.nullif(_c(c), F.lit("")) for c in cols], F.lit(""))


def non_blank(col) -> Column:
    """Python's ``text.strip() != ''`` (Spark's trim only strips U+0020)."""
    return _c(col).rlike(C.NON_BLANK_RE)
