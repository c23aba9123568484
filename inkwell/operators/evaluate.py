"""Classification metrics as aggregations: confusion counts, accuracy, F1, per-class report.

Classes are the union of true labels and predictions (a class that is only
predicted has support 0); 0/0 is 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion(pred: DataFrame, label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    """(label, prediction, n)."""
    return pred.groupBy(F.col(label_col).alias("label"), F.col(pred_col).alias("prediction")) \
        .agg(F.count(F.lit(1)).alias("n"))


def _div(a, b):
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def per_class(pred: DataFrame, label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    """(class, tp, fp, fn, support, precision, recall, f1) for every class."""
    cm = confusion(pred, label_col, pred_col)
    hit = F.col("label") == F.col("prediction")
    true_side = cm.groupBy(F.col("label").alias("class")).agg(
        F.sum("n").alias("support"), F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("tp"))
    pred_side = cm.groupBy(F.col("prediction").alias("class")).agg(F.sum("n").alias("predicted"))
    j = true_side.join(pred_side, "class", "full_outer").fillna(0, subset=["support", "tp", "predicted"])
    tp, sup, prd = F.col("tp"), F.col("support"), F.col("predicted")
    fp, fn = prd - tp, sup - tp
    return j.select(
        "class", tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), sup.alias("support"),
        _div(tp, prd).alias("precision"), _div(tp, sup).alias("recall"),
        _div(2.0 * tp, 2.0 * tp + fp + fn).alias("f1"))


def accuracy(pred: DataFrame, label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    return pred.agg(F.avg((F.col(label_col) == F.col(pred_col)).cast("double")).alias("accuracy"))


def summary(pred: DataFrame, label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    """One row: accuracy, weighted_f1, macro_f1, n."""
    pc = per_class(pred, label_col, pred_col)
    tot = F.sum("support")
    return pc.agg(
        _div(F.sum("tp").cast("double"), tot).alias("accuracy"),
        _div(F.sum(F.col("f1") * F.col("support")), tot).alias("weighted_f1"),
        F.avg("f1").alias("macro_f1"),
        tot.cast("bigint").alias("n"))


def report(pred: DataFrame, label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    """(name, precision, recall, f1, support): one row per class, then accuracy, macro avg, weighted avg."""
    pc = per_class(pred, label_col, pred_col).cache()
    tot = F.sum("support")
    rows = pc.select(F.col("class").alias("name"), "precision", "recall", "f1",
                     F.col("support").cast("bigint").alias("support"))
    acc = pc.agg(F.lit("accuracy").alias("name"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"),
                 _div(F.sum("tp").cast("double"), tot).alias("f1"), tot.cast("bigint").alias("support"))
    macro = pc.agg(F.lit("macro avg").alias("name"), F.avg("precision").alias("precision"),
                   F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), tot.cast("bigint").alias("support"))
    weighted = pc.agg(F.lit("weighted avg").alias("name"),
                      *[_div(F.sum(F.col(m) * F.col("support")), tot).alias(m) for m in ("precision", "recall", "f1")],
                      tot.cast("bigint").alias("support"))
    return rows.unionByName(acc).unionByName(macro).unionByName(weighted)


def grouped_report(pred: DataFrame, group_cols, label_col: str = "label", pred_col: str = "prediction") -> DataFrame:
    """(group columns, accuracy, weighted_f1, macro_f1, n, report): one row for each group.

    The rows are counted once, as confusion counts; classes and averages of all groups then come
    from one aggregation over grouping sets. ``report`` lists (name, precision, recall, f1, support)
    of the classes in ascending order, then accuracy, macro avg and weighted avg.
    """
    g = list(group_cols)
    label, guess, n = F.col(label_col), F.col(pred_col), F.col("_n")
    cm = pred.groupBy(*g, label.alias("_l"), guess.alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    zero = F.lit(0).cast("bigint")
    hit = F.when(F.col("_l") == F.col("_p"), n).otherwise(zero)
    sides = F.array(F.struct(F.col("_l").alias("class"), n.alias("support"), zero.alias("predicted"), hit.alias("tp")),
                    F.struct(F.col("_p").alias("class"), zero.alias("support"), n.alias("predicted"), zero.alias("tp")))
    classes = cm.select(*g, F.explode(sides).alias("_x")).groupBy(*g, F.col("_x.class").alias("class")).agg(
        *[F.sum(f"_x.{c}").alias(c) for c in ("support", "predicted", "tp")])
    tp, sup, prd = F.col("tp"), F.col("support"), F.col("predicted")
    scored = classes.select(*g, "class", "support", "tp", _div(tp, prd).alias("precision"), _div(tp, sup).alias("recall"),
                            _div(2.0 * tp, sup + prd).alias("f1"))
    names = ("precision", "recall", "f1")
    levels = scored.groupingSets([[*g, "class"], g], *g, "class").agg(
        F.grouping("class").alias("_all"), F.sum("tp").alias("tp"), F.sum("support").alias("support"),
        *[F.avg(m).alias(m) for m in names], *[F.sum(F.col(m) * sup).alias(f"w_{m}") for m in names])
    accuracy, weighted = _div(tp.cast("double"), sup), [_div(F.col(f"w_{m}"), sup) for m in names]

    def entry(place: int, name, values):
        return F.struct(F.lit(place).alias("place"), F.coalesce(name, F.lit("")).alias("name"),
                        *[v.cast("double").alias(m) for m, v in zip(names, values)], sup.alias("support"))

    none = F.lit(None)
    own = [F.col(m) for m in names]
    lines = F.when(F.col("_all") == 0, F.array(entry(0, F.col("class").cast("string"), own))).otherwise(F.array(
        entry(1, F.lit("accuracy"), [none, none, accuracy]), entry(2, F.lit("macro avg"), own), entry(3, F.lit("weighted avg"), weighted)))
    total = lambda c: F.max(F.when(F.col("_all") == 1, c))
    return levels.groupBy(*g).agg(
        total(accuracy).alias("accuracy"), total(weighted[2]).alias("weighted_f1"), total(F.col("f1")).alias("macro_f1"),
        total(sup).alias("n"),
        F.transform(F.array_sort(F.flatten(F.collect_list(lines))), lambda x: x.dropFields("place")).alias("report"))
