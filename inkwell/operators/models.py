"""Label maps, exact seeded splits, text classifiers and scorers as DataFrame jobs."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell import constants as C
from inkwell.functions.text import non_blank, terms
from inkwell.operators import naive_bayes as NB
from inkwell.operators.labels import decode, encode, label_map  # noqa: F401


# --- M2 exact split -------------------------------------------------------------------------

def split_key(id_col: str, seed: int) -> F.Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def global_rank(df: DataFrame, key: F.Column, tie: str, n: int) -> DataFrame:
    """df + ``rank`` (0-based) in (key, tie) order, without a single-partition window.

    Rows are bucketed by a hex prefix of the (md5) key, sized so a bucket holds
    about 100k rows; each bucket is ranked in its own window and offset by the
    row counts of the buckets before it (a table of at most 16^k rows).
    """
    k = max(1, min(8, math.ceil(math.log(max(n, 1) / 100_000, 16)) if n > 100_000 else 1))
    d = df.withColumn("_key", key).withColumn("_bucket", F.substring("_key", 1, k))
    w = Window.partitionBy("_bucket").orderBy("_key", tie)
    d = d.withColumn("_rn", F.row_number().over(w))
    sizes = d.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    offs = sizes.withColumn("_off", F.coalesce(F.sum("_n").over(
        Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    d = d.join(F.broadcast(offs.select("_bucket", "_off")), "_bucket")
    return d.withColumn("rank", (F.col("_off") + F.col("_rn") - 1).cast("bigint")).drop(
        "_key", "_bucket", "_rn", "_off")


def split(df: DataFrame, id_col: str = "doc_id", seed: int = C.SPLIT_SEED, cuts=C.SPLIT_CUTS) -> DataFrame:
    """df + ``split`` in {train, val, test}: exactly int(c0*n) train and int(c1*n)-int(c0*n) val rows."""
    n = df.count()
    c0, c1 = int(cuts[0] * n), int(cuts[1] * n)
    r = global_rank(df, split_key(id_col, seed), id_col, n)
    s = F.when(F.col("rank") < c0, "train").when(F.col("rank") < c1, "val").otherwise("test")
    return r.withColumn("split", s)


# --- labelled rows ---------------------------------------------------------------------

def labelled_rows(df: DataFrame, text_col: str = "cleaned_text", label_col: str = "label") -> DataFrame:
    """Rows with non-empty text and a valid label (not null, '', EMPTY or ERROR)."""
    lab = F.col(label_col)
    return df.where(F.col(text_col).isNotNull() & (F.col(text_col) != F.lit(""))
                    & lab.isNotNull() & (lab != F.lit(""))
                    & ~lab.isin(C.SENTINEL_EMPTY, C.SENTINEL_ERROR))


def classifiable(df: DataFrame, language: str, text_col: str = "cleaned_text") -> DataFrame:
    """Articles of one language with a non-blank cleaned text."""
    return df.where((F.col("language") == F.lit(language)) & F.col(text_col).isNotNull() & non_blank(text_col))


def valid_predictions(df: DataFrame, sentiment_col: str = "sentiment", topic_col: str = "topic") -> DataFrame:
    bad = [C.SENTINEL_EMPTY, C.SENTINEL_ERROR]
    return df.where(F.col(sentiment_col).isNotNull() & ~F.col(sentiment_col).isin(bad)
                    & F.col(topic_col).isNotNull() & ~F.col(topic_col).isin(bad))


# --- M3/M4 text classifier ----------------------------------------------------------------

def with_terms(df: DataFrame, text_col: str = "cleaned_text") -> DataFrame:
    return df.withColumn("_terms", terms(F.col(text_col)))


def train_nb(train_df: DataFrame, text_col: str = "cleaned_text", label_col: str = "label",
             group_cols=(), alpha: float = 1.0) -> NB.NBModel:
    return NB.fit(with_terms(train_df, text_col), label_col, "_terms", group_cols, alpha)


def predict_nb(df: DataFrame, model: NB.NBModel, id_col: str = "doc_id",
               text_col: str = "cleaned_text") -> DataFrame:
    """(id, prediction, prob) for every row; rows sharing no term with the model get the prior's choice."""
    g = [c for c in model.group_cols if c in df.columns]
    feats = with_terms(df.select(id_col, *g, text_col), text_col)
    chars = df.agg(F.sum(F.length(text_col))).first()[0] or 0
    scored = NB.predict(feats, id_col, "_terms", model, chars)
    out = df.select(id_col, *g).join(scored, id_col, "left")
    prior_best = NB.best_label(model.priors.withColumn("score", F.col("log_prior"))
                               .withColumn("_gid", F.to_json(F.struct(*model.group_cols))), "_gid")
    prior_best = prior_best.select(F.col("_gid"), F.col("label").alias("_pl"), F.col("prob").alias("_pp"))
    gid = F.to_json(F.struct(*[F.col(c) if c in df.columns else F.lit(0).alias(c) for c in model.group_cols]))
    out = out.withColumn("_gid", gid).join(F.broadcast(prior_best), "_gid", "left")
    return out.select(id_col, *[c for c in g if c != id_col],
                      F.coalesce("label", "_pl").alias("prediction"),
                      F.coalesce("prob", "_pp").alias("prob"))


def majority_model(train_df: DataFrame, label_col: str = "label") -> DataFrame:
    """The 'original' baseline: the most frequent training label (label ascending on ties)."""
    counts = train_df.groupBy(F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.min_by("label", F.struct(-F.col("n"), F.col("label"))).alias("prediction"))


def save_model(model: NB.NBModel, path: str) -> None:
    model.cond.write.mode("overwrite").parquet(f"{path}/cond")
    model.priors.write.mode("overwrite").parquet(f"{path}/priors")


def load_model(spark, path: str, group_cols=()) -> NB.NBModel:
    g = list(group_cols) or [NB._ALL]
    return NB.NBModel(cond=spark.read.parquet(f"{path}/cond"), priors=spark.read.parquet(f"{path}/priors"),
                      group_cols=g)
