"""Language identification: character-trigram naive Bayes, trained and applied with joins.

A script rule runs first: a text whose letters are mostly Arabic letters is 'ar'
(the training tables may hold no Arabic). Empty text, or text sharing no trigram
with the model, gives ''.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell import constants as C
from inkwell.operators import naive_bayes as NB
from inkwell.operators import packed

# Fixed patterns (shared spelling with the DuckDB oracle).
NOT_ARABIC_LETTER_RE = r"[^\x{0621}-\x{064A}]"
NOT_LETTER_RE = r"[^\p{L}]"
TRIGRAM_RE = r"(?s)(?=(.{3}))"


def normalized(text) -> Column:
    """Lower case, blank runs collapsed, one blank added at both ends."""
    t = F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), C.WS_RUN_RE, " "))
    return F.concat(F.lit(" "), F.trim(t), F.lit(" "))


def trigrams_of_normalized(s: Column) -> Column:
    """All character trigrams of an already normalized text column.

    ``s`` has no line breaks (blank runs were collapsed).
    """
    # one left-to-right pass: an empty match at every position captures the next
    # three code points (overlapping), so the cost is linear in the text length
    return F.regexp_extract_all(s, F.lit(TRIGRAM_RE), 1)


def is_arabic_script(text) -> Column:
    t = F.coalesce(text, F.lit(""))
    n_ar = F.length(F.regexp_replace(t, NOT_ARABIC_LETTER_RE, ""))
    n_letters = F.length(F.regexp_replace(t, NOT_LETTER_RE, ""))
    return (n_letters > 0) & (n_ar * 2 > n_letters)


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> NB.NBModel:
    """Model from whole labelled texts."""
    d = docs.where(F.col(lang_col).isNotNull() & (F.col(lang_col) != ""))
    d = d.select(F.col(lang_col).alias("lang"), normalized(F.col(text_col)).alias("_s"))
    d = d.select(F.lit(0).alias(NB._ALL), F.col("lang").alias("label"), "_s")
    # characters of two UTF-16 units go by the pattern, which also stops between the units
    wide, by = F.col("_s").rlike(r"[\x{10000}-\x{10FFFF}]"), [NB._ALL, "label"]
    counts = packed.trigram_counts(d.where(~wide), by, "_s").unionByName(
        packed.feature_counts(d.where(wide).withColumn("grams", trigrams_of_normalized(F.col("_s"))), by, "grams"))
    return NB.fit_counts(d, counts, [NB._ALL])


def detect(df: DataFrame, id_col: str, text_col: str, model: NB.NBModel,
           out_col: str = "language") -> DataFrame:
    """df + ``out_col`` (and ``<out_col>_prob``): detected language of ``text_col``."""
    base = df.select(id_col, F.col(text_col).alias("_t"))
    grams = (base.select(id_col, normalized(F.col("_t")).alias("_s"))
             .select(id_col, trigrams_of_normalized(F.col("_s")).alias("grams")))
    chars = base.agg(F.sum(F.length("_t"))).first()[0] or 0
    scored = NB.predict(grams, id_col, "grams", model, 4 * chars)     # a run of three for each character
    out = df.join(scored.select(id_col, F.col("label").alias("_nb"), F.col("prob").alias("_p")),
                  id_col, "left")
    text = F.col(text_col)
    blank = text.isNull() | (text == F.lit(""))
    lang = (F.when(blank, F.lit("")).when(is_arabic_script(text), F.lit("ar"))
            .otherwise(F.coalesce(F.col("_nb"), F.lit(""))))
    prob = (F.when(blank, F.lit(0.0)).when(is_arabic_script(text), F.lit(1.0))
            .otherwise(F.coalesce(F.col("_p"), F.lit(0.0))))
    return out.withColumn(out_col, lang).withColumn(f"{out_col}_prob", prob).drop("_nb", "_p")
