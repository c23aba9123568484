"""Tuning of stored text classifiers: count tables, warm starts, and predictions of many models at once.

A stored model is its counts: features by (group, label, feature) and documents by (group, label).
Tuning adds the counts of new rows to the stored ones, so a model is updated without its old
training texts. All models of a table (one for each group) are tuned and applied in the same jobs.

A document's score under a label is, over its n known feature occurrences,
``n * log(alpha / (t + alpha * v))`` plus ``log(1 + c / alpha)`` for every occurrence that the label has
counted, plus the label's prior: the same number as a dense table of probabilities gives, but
only counted (feature, label) pairs are stored and joined. Labels that share no feature with a document are
reached through one array of labels for each group, inside the row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from inkwell import constants as C
from inkwell.functions.text import terms
from inkwell.operators import packed
from inkwell.session import cut_lineage


#: Characters of text that a part takes at least, and most rows of a model that it takes.
PART_CHARS, MODEL_ROWS = 8 << 20, 2_000_000


@dataclass
class CountModel:
    """``features``: group columns, label, feature, c; ``documents``: group columns, label, n."""

    features: DataFrame
    documents: DataFrame
    group_cols: list[str]


def count_model(rows: DataFrame, group_cols, text_col: str = "cleaned_text", label_col: str = "label") -> CountModel:
    """Counts of the terms of labelled rows, one model for each group."""
    g = list(group_cols)
    label = F.col(label_col).alias("label")
    feats = packed.feature_counts(rows.select(*g, label, terms(F.col(text_col)).alias("terms")), [*g, "label"], "terms")
    return CountModel(feats.groupBy(*g, "label", "feature").agg(F.sum("c").alias("c")),
                      rows.groupBy(*g, label).agg(F.count(F.lit(1)).alias("n")), g)


def pooled(model: CountModel, group_cols) -> CountModel:
    """The model over fewer group columns: counts of the groups that fall together are added."""
    g = list(group_cols)
    return CountModel(model.features.groupBy(*g, "label", "feature").agg(F.sum("c").alias("c")),
                      model.documents.groupBy(*g, "label").agg(F.sum("n").alias("n")), g)


def spread_to(model: CountModel, groups: DataFrame) -> CountModel:
    """The model for every row of ``groups`` that matches its group columns: a shared start for finer groups."""
    on, g = model.group_cols, groups.columns
    return CountModel(model.features.join(groups, on).select(*g, "label", "feature", "c"),
                      model.documents.join(groups, on).select(*g, "label", "n"), g)


def tune(stored: CountModel, new: CountModel, epochs: int = 1) -> CountModel:
    """The stored counts with ``epochs`` times the new ones; labels and groups of either side are kept."""
    g = stored.group_cols
    add = lambda old, more, key, n: (
        old.select(*g, *key, n).unionByName(more.select(*g, *key, (F.col(n) * epochs).alias(n)))
        .groupBy(*g, *key).agg(F.sum(n).alias(n)))
    return CountModel(add(stored.features, new.features, ["label", "feature"], "c"),
                      add(stored.documents, new.documents, ["label"], "n"), g)


def save(model: CountModel, path: str) -> None:
    """Store the counts under ``path``; a model that was read from there cannot be written over."""
    model.features.write.parquet(f"{path}/features")
    model.documents.write.parquet(f"{path}/documents")


def load(spark, path: str) -> CountModel:
    documents = spark.read.parquet(f"{path}/documents")
    return CountModel(spark.read.parquet(f"{path}/features"), documents,
                      [c for c in documents.columns if c not in ("label", "n")])


def _label_arrays(model: CountModel, alpha: float) -> DataFrame:
    """One row for each group: its labels in ascending order with prior and the weight of an uncounted feature."""
    g = model.group_cols
    totals = model.features.groupBy(*g, "label").agg(F.sum("c").alias("t"))
    vocab = model.features.select(*g, "feature").distinct().groupBy(*g).agg(F.count(F.lit(1)).alias("v"))
    all_docs = model.documents.groupBy(*g).agg(F.sum("n").alias("all"))
    rows = (model.documents.join(all_docs, g).join(totals, [*g, "label"], "left").join(vocab, g, "left")
            .select(*g, "label", (F.log("n") - F.log("all")).alias("prior"),
                    (F.log(F.lit(alpha)) - F.log(F.coalesce("t", F.lit(0)) + F.lit(alpha) * F.coalesce("v", F.lit(1)))).alias("rest")))
    return rows.groupBy(*g).agg(F.array_sort(F.collect_list(F.struct("label", "prior", "rest"))).alias("labels"))


def predict(rows: DataFrame, model: CountModel, id_col: str = "doc_id", text_col: str = "cleaned_text", alpha: float = 1.0) -> DataFrame:
    """(group columns, id, prediction, prob) of every row whose group has a model; ids are unique in a group.

    The best label wins, the smaller one on ties. Rows without known features get the prior's choice.
    """
    g = model.group_cols
    named = lambda df: df.dropna(subset=g).withColumn("grp", F.to_json(F.struct(*g)))  # noqa: E731    a null group has no model
    # a weight for each label that shares the feature, and one for none that counts the occurrence
    weights = model.features.select(*g, "feature", F.concat(F.lit("="), "label").alias("label"), F.log1p(F.col("c") / F.lit(alpha)).alias("weight"))
    weights = weights.unionByName(model.features.select(*g, "feature", F.lit("").alias("label"), F.lit(1.0).alias("weight")).distinct())
    weights = named(weights).where(F.col("feature").isNotNull() & F.col("label").isNotNull()).select("grp", "feature", "label", "weight")
    chars = rows.agg(F.sum(F.length(text_col))).first()[0] or 0
    # every part sends a sum for each row and label: few parts, of as much of the model as a task holds
    parts = max(-(-chars // (4 * packed.PART_CHARS)), -(-model.features.count() // MODEL_ROWS), min(4, -(-chars // PART_CHARS)), 1)
    texts = named(rows).select(*g, id_col, "grp", terms(F.col(text_col)).alias("terms"))
    hits = packed.model_sums(texts, weights, parts)
    if not rows.groupBy(*g, id_col).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").isEmpty():
        hits = (hits.select(*g, id_col, F.inline("sums")).groupBy(*g, id_col, "label").agg(F.sum("s").alias("s"))
                .groupBy(*g, id_col).agg(F.collect_list(F.struct("label", "s")).alias("sums")))
    shared = hits.select(*g, id_col, F.get(F.filter("sums", lambda x: x["label"] == ""), F.lit(0))["s"].alias("_n"), F.map_from_entries(F.transform(
        F.filter("sums", lambda x: x["label"] != ""), lambda x: F.struct(F.substring(x["label"], 2, 1 << 30).alias("label"), x["s"].alias("s")))).alias("_s"))
    base = rows.select(*g, id_col).join(_label_arrays(model, alpha), g)
    every = base.join(shared, [*g, id_col], "left")
    n, s = F.coalesce("_n", F.lit(0.0)), F.col("_s")

    def score(x: Column) -> Column:
        own = F.when(s.isNull(), F.lit(0.0)).otherwise(F.coalesce(s[x["label"]], F.lit(0.0)))
        return x["prior"] + n * x["rest"] + own

    # sums of many terms in any order: equal scores count as ties
    scored = every.withColumn("_scores", F.transform("labels", lambda x: F.round(score(x), 6))).withColumn("_best", F.array_max("_scores"))
    place = F.array_position("_scores", F.col("_best")).cast("int")
    total = F.aggregate("_scores", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("_best")))
    return scored.select(*g, id_col, F.get(F.col("labels"), place - 1)["label"].alias("prediction"), (F.lit(1.0) / total).alias("prob"))


def split_groups(rows: DataFrame, group_cols, id_col: str = "doc_id", seed: int = C.SPLIT_SEED, cuts=C.SPLIT_CUTS) -> DataFrame:
    """``rows`` with ``split``: of each group's n rows in seeded order, int(0.7 n) train, up to int(0.85 n) val, the rest test.

    Ranks come from windows over (group, first two hex digits of the key): a group of any size is
    dealt to 256 windows, whose sizes give the offsets.
    """
    g = list(group_cols)
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))
    ids = rows.select(*g, id_col).withColumn("_key", key).withColumn("_part", F.substring("_key", 1, 2))
    ids = ids.withColumn("_place", F.row_number().over(Window.partitionBy(*g, "_part").orderBy("_key", id_col)))
    sizes = ids.groupBy(*g, "_part").agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy(*g)
    before = group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*g, "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"), F.sum("_n").over(group).alias("_all"))
    rank = F.col("_start") + F.col("_place") - 1
    ends = [F.floor(F.lit(float(c)) * F.col("_all")) for c in cuts]
    split = F.when(rank < ends[0], "train").when(rank < ends[1], "val").otherwise("test")
    ranked = ids.join(sizes, [*g, "_part"]).select(*g, id_col, split.alias("split"))
    return rows.join(ranked, [*g, id_col])


@dataclass
class TuningRun:
    """Outcome of ``tune_and_compare``: test predictions of both models, and the tuned counts."""

    predictions: DataFrame      # group columns, id, label, model ("original" or "finetuned"), prediction, prob
    stored: CountModel
    tuned: CountModel


def tune_and_compare(rows: DataFrame, group_cols=("language", "task"), shared_cols=("task",), stored: CountModel | None = None,
                     epochs: int = C.EPOCHS, id_col: str = "doc_id", text_col: str = "cleaned_text", alpha: float = 1.0) -> TuningRun:
    """Tune a stored model for every group and let both label the group's test rows.

    ``rows``: group columns, id, text, label; several tasks are several rows of a document. The
    stored model has ``shared_cols`` as groups; by default it is made of the training rows of all groups
    together. Groups with fewer than two labels are left out: there is nothing to learn.
    """
    g = list(group_cols)
    wide = rows.select(*g, id_col, text_col, "label")
    labels = wide.groupBy(*g).agg(F.min("label").alias("_a"), F.max("label").alias("_b")).where("_a < _b").select(*g)
    rows = wide.join(labels, g, "left_semi")
    splits = cut_lineage(split_groups(rows.select(*g, id_col, "label"), g, id_col))     # narrow: ids and labels only
    texts = rows.select(*g, id_col, text_col)
    train = splits.where(F.col("split") == "train").join(texts, [*g, id_col])
    test = splits.where(F.col("split") == "test").join(texts, [*g, id_col])
    own = count_model(train, g, text_col)
    own = CountModel(cut_lineage(own.features), cut_lineage(own.documents), g)
    stored = stored or pooled(own, shared_cols)
    start = spread_to(stored, own.documents.select(*g).distinct())
    start = CountModel(cut_lineage(start.features), cut_lineage(start.documents), g)
    tuned = tune(start, own, epochs)
    tuned = CountModel(cut_lineage(tuned.features), cut_lineage(tuned.documents), g)
    # both models are applied in one pass: the model is one more group column
    both = CountModel(
        start.features.withColumn("model", F.lit("original")).unionByName(tuned.features.withColumn("model", F.lit("finetuned"))),
        start.documents.withColumn("model", F.lit("original")).unionByName(tuned.documents.withColumn("model", F.lit("finetuned"))),
        [*g, "model"])
    twice = test.withColumn("model", F.explode(F.array(F.lit("original"), F.lit("finetuned"))))
    found = predict(twice, both, id_col, text_col, alpha)
    return TuningRun(test.select(*g, id_col, "label").join(found, [*g, id_col]), start, tuned)
