"""Language identification queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.functions.text import first_line
from inkwell.operators import langid
from inkwell.operators.naive_bayes import NBModel
from inkwell.plans.stages import stage
from inkwell.plans import oracle as O
from inkwell.plans.catalog import r6, register
from inkwell.session import spread
from inkwell.sources.tables import table


def langid_model(spark, sf_dir) -> NBModel:
    """The trigram model as two stage tables (trained once per session from the whole documents)."""
    trained = {}

    def model():
        if "m" not in trained:
            trained["m"] = langid.train(spread(table(spark, sf_dir, "documents")))
        return trained["m"]

    cond = stage(spark, sf_dir, "langid_cond", lambda: model().cond)
    priors = stage(spark, sf_dir, "langid_priors", lambda: model().priors)
    return NBModel(cond=cond, priors=priors, group_cols=[c for c in priors.columns if c not in ("label", "log_prior")])


@register("detect_language", sql=O.with_(
    O.LANGID_MODEL,
    "heads AS (SELECT doc_id, split_part(text, chr(10), 1) AS head FROM documents)",
    O.langid_detect("det", "heads", "doc_id", "head"),
) + "SELECT doc_id, language, round(language_prob, 6) AS language_prob FROM det")
def q_detect_language(spark, sf_dir):
    """Language of every document's headline, model trained on the whole labelled texts."""
    heads = spread(table(spark, sf_dir, "documents")).select("doc_id", first_line(F.col("text")).alias("head"))
    out = langid.detect(heads, "doc_id", "head", langid_model(spark, sf_dir))
    return out.select("doc_id", "language", r6("language_prob").alias("language_prob"))
