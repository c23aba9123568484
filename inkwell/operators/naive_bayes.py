"""Multinomial naive Bayes as aggregations and joins.

Training is two grouped counts (feature counts per label, documents per label); the model is a
table ``(group..., feature, label, log_p)`` with a row for every label of the group under each of
its features, plus ``(group..., label, log_prior)``. Scoring brings documents' features and the model's
rows together by the feature, sums ``log_p`` per (document, label) and keeps the arg-max with a
softmax probability. Nothing is collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell.operators import packed
from inkwell.session import cut_lineage, stored


@dataclass
class NBModel:
    cond: DataFrame       # group..., feature, label, log_p
    priors: DataFrame     # group..., label, log_prior
    group_cols: list


def fit(docs: DataFrame, label_col: str, features_col: str, group_cols=(), alpha: float = 1.0) -> NBModel:
    g = list(group_cols) or [_ALL]
    if _ALL in g:
        docs = docs.withColumn(_ALL, F.lit(0))
    docs = docs.withColumn("label", F.col(label_col))
    # counted inside blocks of rows first: a feature comes once for each block and label
    return fit_counts(docs, packed.feature_counts(docs, [*g, "label"], features_col), g, alpha)


def fit_counts(docs: DataFrame, feats: DataFrame, g: list, alpha: float = 1.0) -> NBModel:
    """The model of ``docs`` (group..., label) and counts of their features (group..., label, feature, c), still to be added up."""
    counts = feats.groupBy(*g, "label", "feature").agg(F.sum("c").alias("c"))
    # the count table feeds four aggregates: materialise it once in the shared folder
    counts = cut_lineage(counts)
    n_docs = docs.groupBy(*g, "label").agg(F.count(F.lit(1)).alias("n"))
    w_all = Window.partitionBy(*g)
    priors = n_docs.select(*g, "label", (F.log("n") - F.log(F.sum("n").over(w_all))).alias("log_prior"))
    totals = counts.groupBy(*g, "label").agg(F.sum("c").alias("t"))
    vocab = counts.groupBy(*g).agg(F.countDistinct("feature").alias("v"))
    # one row per group: its labels with their totals (labels are few), and one map of counts per feature
    labels = totals.join(vocab, g).groupBy(*g).agg(F.collect_list(F.struct("label", "t", "v")).alias("labels"))
    by_feature = counts.groupBy(*g, "feature").agg(F.map_from_entries(F.collect_list(F.struct("label", "c"))).alias("m"))
    # the labels are broadcast: joined on the group alone, a group's features would be one task's
    dense = by_feature.join(F.broadcast(labels), g).select(*g, "feature", "m", F.explode("labels").alias("x"))
    count = F.coalesce(F.col("m")[F.col("x.label")], F.lit(0))
    cond = dense.select(*g, "feature", F.col("x.label").alias("label"),
                        (F.log(count + F.lit(alpha)) - F.log(F.col("x.t") + F.lit(alpha) * F.col("x.v"))).alias("log_p"))
    return NBModel(cond=stored(cond, "model"), priors=priors, group_cols=g)


_ALL = "_nb_all"


#: Most rows of a model whose documents' features are looked up one by one.
FEW_ROWS = 10_000


def log_scores(docs: DataFrame, id_col: str, features_col: str, model: NBModel, chars: int | None = None) -> DataFrame:
    """(id, label, score): joint log-likelihood for every label sharing a feature with the document.

    The features of a block of documents go packed to the parts of a model, and its sums come back (``packed``);
    with a small model they stay where they are. ``chars``: about how much text the features are of.
    """
    g = model.group_cols
    if _ALL in g:
        docs = docs.withColumn(_ALL, F.lit(0))
    if model.cond.count() <= FEW_ROWS:
        # every occurrence is looked up by itself: counting them first would hold a row for each (id, feature)
        feats = docs.select(id_col, *g, F.explode(features_col).alias("feature"))
        ll = feats.join(F.broadcast(model.cond), [*g, "feature"]).groupBy(id_col, *g, "label").agg(F.sum("log_p").alias("ll"))
    else:
        if chars is None:
            chars = 8 * (docs.agg(F.sum(F.size(features_col).cast("bigint"))).first()[0] or 0)
        named = lambda df: df.dropna(subset=g).withColumn("grp", F.to_json(F.struct(*g)))  # noqa: E731    a null group has no model
        rows = named(docs).select(id_col, *[c for c in g if c != id_col], "grp", F.col(features_col).alias("terms"))
        cond = named(model.cond).where(F.col("feature").isNotNull()).select("grp", "feature", "label", F.col("log_p").alias("weight"))
        sums = packed.model_sums(rows, cond, packed.parts_of(docs.sparkSession, chars))
        sums = sums.select(id_col, *[c for c in g if c != id_col], F.inline("sums").alias("label", "s"))
        ll = sums.groupBy(id_col, *g, "label").agg(F.sum("s").alias("ll"))      # rows may share an id
    return ll.join(F.broadcast(model.priors), [*g, "label"]).select(
        id_col, "label", (F.col("ll") + F.col("log_prior")).alias("score"))


def best_label(scores: DataFrame, id_col: str) -> DataFrame:
    """(id, label, prob): highest score (label ascending on ties) and its softmax probability."""
    w = Window.partitionBy(id_col)
    s = scores.withColumn("m", F.max("score").over(w))
    return s.groupBy(id_col).agg(
        F.min_by("label", F.struct(-F.col("score"), F.col("label"))).alias("label"),
        (F.lit(1.0) / F.sum(F.exp(F.col("score") - F.col("m")))).alias("prob"),
    )


def predict(docs: DataFrame, id_col: str, features_col: str, model: NBModel, chars: int | None = None) -> DataFrame:
    return best_label(log_scores(docs, id_col, features_col, model, chars), id_col)
