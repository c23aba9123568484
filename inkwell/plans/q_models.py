"""Label, split, classifier and metric queries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from inkwell import constants as C
from inkwell.operators import evaluate as EV
from inkwell.operators import labels as L
from inkwell.operators import models as M
from inkwell.operators import tuning
from inkwell.operators.naive_bayes import NBModel
from inkwell.plans import oracle as O
from inkwell.plans.catalog import big, r6, register
from inkwell.plans.q_tfidf import cleaned_docs
from inkwell.plans.stages import stage
from inkwell.session import cut_lineage, scratch_path, spread
from inkwell.sources.tables import table

TASK = "quality"


def labelled(spark, sf_dir, task: str = TASK, cleaned: DataFrame | None = None) -> DataFrame:
    """Cleaned documents with the task's label (text non-empty, label valid)."""
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col(task).cast("string").alias("label"))
    c = cleaned if cleaned is not None else cleaned_docs(spark, sf_dir)
    return M.labelled_rows(c.join(lab, "doc_id"))


@dataclass
class TaskRun:
    splits: DataFrame
    model: NBModel
    pred: DataFrame      # test rows: doc_id, label, prediction, prob
    base: DataFrame      # test rows: doc_id, label, prediction (majority baseline)


def _build_task(spark, sf_dir, task: str, cleaned: DataFrame | None = None) -> TaskRun:
    # the labelled table feeds a count, the split, training and scoring: cut lineage once
    lab = cut_lineage(spread(labelled(spark, sf_dir, task, cleaned)))
    splits = cut_lineage(M.split(lab))
    train = splits.where(F.col("split") == "train")
    test = splits.where(F.col("split") == "test")
    model = M.train_nb(train)
    pred = test.select("doc_id", "label").join(M.predict_nb(test, model), "doc_id")
    base = test.select("doc_id", "label").join(F.broadcast(M.majority_model(train)))
    return TaskRun(splits, model, pred, base)


def run_task(spark, sf_dir, task: str = TASK, cleaned: DataFrame | None = None) -> TaskRun:
    """Split, model and test-split predictions of one task, as stage tables (built once per session)."""
    built = {}

    def get() -> TaskRun:
        if "r" not in built:
            built["r"] = _build_task(spark, sf_dir, task, cleaned)
        return built["r"]

    splits = stage(spark, sf_dir, f"{task}_splits", lambda: get().splits)
    cond = stage(spark, sf_dir, f"{task}_nb_cond", lambda: get().model.cond)
    priors = stage(spark, sf_dir, f"{task}_nb_priors", lambda: get().model.priors)
    pred = stage(spark, sf_dir, f"{task}_pred", lambda: get().pred)
    base = stage(spark, sf_dir, f"{task}_base", lambda: get().base)
    group_cols = [c for c in priors.columns if c not in ("label", "log_prior")]
    return TaskRun(splits, NBModel(cond=cond, priors=priors, group_cols=group_cols), pred, base)


_BASE = O.with_(O.CLEANED, O.model_ctes("t", TASK))


@register("labelled_rows", sql=_BASE + "SELECT doc_id, label FROM t_labelled")
def q_labelled_rows(spark, sf_dir):
    return labelled(spark, sf_dir).select("doc_id", "label")


@register("filter_classifiable", sql=O.with_(O.CLEANED) + f"""
SELECT doc_id, language FROM cleaned
WHERE language = 'en' AND cleaned_text IS NOT NULL AND {O.non_blank('cleaned_text')}""")
def q_filter_classifiable(spark, sf_dir):
    return M.classifiable(cleaned_docs(spark, sf_dir), "en").select("doc_id", "language")


@register("label_encode", sql=_BASE + """
SELECT label, row_number() OVER (ORDER BY label) - 1 AS id FROM (SELECT DISTINCT label FROM t_labelled)""")
def q_label_encode(spark, sf_dir):
    return M.label_map(labelled(spark, sf_dir))


@register("label_roundtrip", sql="""
WITH l AS (SELECT doc_id, source || '/' || lang AS label FROM documents),
ids AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS label_id FROM (SELECT DISTINCT label FROM l WHERE label IS NOT NULL))
SELECT doc_id, label, label_id, label AS decoded FROM l LEFT JOIN ids USING (label)""")
def q_label_roundtrip(spark, sf_dir):
    """Every document's source and language as one label, encoded to its dense id and decoded again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat_ws("/", "source", "lang").alias("label"))
    lmap = L.label_map(docs)
    return L.decode(L.encode(docs, lmap), lmap, out_col="decoded").select("doc_id", "label", "label_id", "decoded")


@register("split_data", sql=_BASE + "SELECT doc_id, rank, split FROM t_splits")
def q_split_data(spark, sf_dir):
    return M.split(labelled(spark, sf_dir)).select("doc_id", "rank", "split")


@register("split_sizes", sql=_BASE + "SELECT split, count(*) AS n FROM t_splits GROUP BY split")
def q_split_sizes(spark, sf_dir):
    return M.split(labelled(spark, sf_dir)).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@register("nb_train", sql=_BASE + "SELECT label, feature, round(log_p, 6) AS log_p FROM t_nbm_cond")
def q_nb_train(spark, sf_dir):
    return run_task(spark, sf_dir).model.cond.select("label", "feature", r6("log_p").alias("log_p"))


@register("nb_priors", sql=_BASE + "SELECT label, round(log_prior, 6) AS log_prior FROM t_nbm_priors")
def q_nb_priors(spark, sf_dir):
    return run_task(spark, sf_dir).model.priors.select("label", r6("log_prior").alias("log_prior"))


@register("nb_predict", sql=_BASE + "SELECT doc_id, label, prediction, round(prob, 6) AS prob FROM t_pred")
def q_nb_predict(spark, sf_dir):
    return run_task(spark, sf_dir).pred.select("doc_id", "label", "prediction", r6("prob").alias("prob"))


@register("nb_model_roundtrip", sql=_BASE + "SELECT doc_id, prediction FROM t_pred")
def q_nb_model_roundtrip(spark, sf_dir):
    """Model tables written to Parquet, read back, used to score the test split."""
    run = run_task(spark, sf_dir)
    path = scratch_path(spark, "nb-model")
    M.save_model(run.model, path)
    model = M.load_model(spark, path)
    test = run.splits.where(F.col("split") == "test")
    return M.predict_nb(test, model).select("doc_id", "prediction")


_EVAL = _BASE.rstrip() + ",\n" + O.per_class_ctes("e", "t_pred") + "\n"


@register("confusion_matrix", sql=_EVAL + "SELECT label, prediction, n FROM e_cm")
def q_confusion_matrix(spark, sf_dir):
    return EV.confusion(run_task(spark, sf_dir).pred)


@register("accuracy", sql=_BASE + """
SELECT round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM t_pred""")
def q_accuracy(spark, sf_dir):
    return EV.accuracy(run_task(spark, sf_dir).pred).select(r6("accuracy").alias("accuracy"))


@register("weighted_f1", sql=_EVAL + """
SELECT round(sum(f1 * support) / sum(support), 6) AS weighted_f1 FROM e_pc""")
def q_weighted_f1(spark, sf_dir):
    return EV.summary(run_task(spark, sf_dir).pred).select(r6("weighted_f1").alias("weighted_f1"))


@register("classification_report", sql=_EVAL + """
SELECT class AS name, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM e_pc
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM e_pc
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6),
       CAST(sum(support) AS BIGINT) FROM e_pc
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
       round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6),
       CAST(sum(support) AS BIGINT) FROM e_pc""")
def q_classification_report(spark, sf_dir):
    r = EV.report(run_task(spark, sf_dir).pred)
    return r.select("name", *[r6(c).alias(c) for c in ("precision", "recall", "f1")], "support")


def _compare_sql(tasks) -> str:
    ctes = [O.CLEANED]
    sels = []
    for i, task in enumerate(tasks):
        p = f"k{i}"
        ctes.append(O.model_ctes(p, task))
        ctes.append(O.per_class_ctes(f"{p}o", f"{p}_base"))
        ctes.append(O.per_class_ctes(f"{p}f", f"{p}_pred"))
        for model, q in (("original", f"{p}o"), ("finetuned", f"{p}f")):
            sels.append(f"SELECT '{task}' AS task, '{model}' AS model, round(accuracy, 6) AS accuracy, "
                        f"round(weighted_f1, 6) AS weighted_f1, round(macro_f1, 6) AS macro_f1, n "
                        f"FROM ({O.summary_select(q)})")
    return O.with_(*ctes) + "\nUNION ALL\n".join(sels)


def compare(spark, sf_dir, tasks) -> DataFrame:
    out = None
    # the tasks share the cleaned stage table
    for task in tasks:
        run = run_task(spark, sf_dir, task)
        for model, pred in (("original", run.base), ("finetuned", run.pred)):
            s = EV.summary(pred).select(F.lit(task).alias("task"), F.lit(model).alias("model"),
                                        *[r6(c).alias(c) for c in ("accuracy", "weighted_f1", "macro_f1")], "n")
            out = s if out is None else out.unionByName(s)
    return out


@register("model_comparison", sql=_compare_sql([TASK]))
def q_model_comparison(spark, sf_dir):
    """Baseline (majority label, the untuned model) against the trained classifier on the test split."""
    return compare(spark, sf_dir, [TASK])


TASKS = ("quality", "toxic")
_TASK_ROWS = "task_rows AS (" + " UNION ALL ".join(
    f"SELECT c.language, '{t}' AS task, c.doc_id, c.cleaned_text, CAST(l.{t} AS VARCHAR) AS label FROM cleaned c JOIN labels l USING (doc_id) "
    f"WHERE c.cleaned_text <> '' AND l.{t} IS NOT NULL" for t in TASKS) + ")"
_KEYS = "language, task, model"
_TUNING_SQL = O.with_(O.CLEANED, _TASK_ROWS, O.tuning_ctes("task_rows"), O.grouped_class_ctes("tm", "tpred", _KEYS))


def task_rows(spark, sf_dir) -> DataFrame:
    """(language, task, doc_id, cleaned_text, label): the labelled documents of every language and task."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.explode(F.create_map(
        *[x for t in TASKS for x in (F.lit(t), F.col(t).cast("string"))])).alias("task", "label"))
    return M.labelled_rows(cleaned_docs(spark, sf_dir).join(labels, "doc_id")).select("language", "task", "doc_id", "cleaned_text", "label")


def tuned_predictions(spark, sf_dir) -> DataFrame:
    """Test predictions of the stored and the tuned model of every (language, task), as a stage table."""
    return stage(spark, sf_dir, "tuned_pred", lambda: tuning.tune_and_compare(spread(task_rows(spark, sf_dir))).predictions)


@register("train_evaluate", sql=_TUNING_SQL + f"""
SELECT {_KEYS}, round(accuracy, 6) AS accuracy, round(weighted_f1, 6) AS weighted_f1, round(macro_f1, 6) AS macro_f1, n
FROM ({O.grouped_summary('tm', _KEYS)})""")
def q_train_evaluate(spark, sf_dir):
    """For every language and task: split, stored model scored, tuned on the training rows, scored again."""
    r = EV.grouped_report(tuned_predictions(spark, sf_dir), ["language", "task", "model"])
    return r.select("language", "task", "model", *[r6(c).alias(c) for c in ("accuracy", "weighted_f1", "macro_f1")], "n")


def metrics_records(spark, sf_dir, name: str = "naive_bayes", epochs: int = C.EPOCHS) -> DataFrame:
    """One nested record for each (language, task): both models' accuracy, F1 and report, and the parameters."""
    r = EV.grouped_report(tuned_predictions(spark, sf_dir), ["language", "task", "model"])
    metrics = F.struct("accuracy", F.col("weighted_f1").alias("f1"), "report")
    own = lambda m: F.max_by(metrics, F.col("model") == m).alias(f"{m}_model")
    return r.groupBy("language", "task").agg(own("original"), own("finetuned")).withColumns({
        "model_name": F.lit(name), "training_params": F.struct(F.lit(epochs).cast("bigint").alias("epochs"), F.lit(1.0).alias("alpha"))})


def metrics_roundtrip(spark, sf_dir) -> DataFrame:
    """The records written as JSON in folders by language and task, read back in their declared schema."""
    rec = metrics_records(spark, sf_dir)
    path = scratch_path(spark, "metrics")
    rec.write.mode("overwrite").option("ignoreNullFields", False).partitionBy("language", "task").json(path)
    return spark.read.schema(rec.schema).json(path)


@register("metrics_record", sql=_TUNING_SQL + f""", s AS ({O.grouped_summary('tm', _KEYS)}),
nr AS (SELECT {_KEYS}, count(*) AS n_lines FROM ({O.grouped_report('tm', _KEYS)}) GROUP BY {_KEYS})
SELECT o.language, o.task, 'naive_bayes' AS model_name, CAST({C.EPOCHS} AS BIGINT) AS epochs, 1.0::DOUBLE AS alpha,
  round(o.accuracy, 6) AS original_accuracy, round(o.weighted_f1, 6) AS original_f1,
  round(f.accuracy, 6) AS finetuned_accuracy, round(f.weighted_f1, 6) AS finetuned_f1, nr.n_lines AS n_report_lines
FROM s o JOIN s f ON o.language = f.language AND o.task = f.task AND o.model = 'original' AND f.model = 'finetuned'
JOIN nr ON nr.language = f.language AND nr.task = f.task AND nr.model = 'finetuned'""")
def q_metrics_record(spark, sf_dir):
    """The metrics record of every language and task, after its round trip through JSON."""
    m = metrics_roundtrip(spark, sf_dir)
    return m.select("language", "task", "model_name", "training_params.epochs", "training_params.alpha",
                    r6("original_model.accuracy").alias("original_accuracy"), r6("original_model.f1").alias("original_f1"),
                    r6("finetuned_model.accuracy").alias("finetuned_accuracy"), r6("finetuned_model.f1").alias("finetuned_f1"),
                    big(F.size("finetuned_model.report")).alias("n_report_lines"))


@register("metrics_report", sql=_TUNING_SQL + f"""
SELECT {_KEYS}, name, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
  CAST(support AS BIGINT) AS support FROM ({O.grouped_report('tm', _KEYS)})""")
def q_metrics_report(spark, sf_dir):
    """The lines of both reports of every record, after its round trip through JSON."""
    m = metrics_roundtrip(spark, sf_dir)
    both = F.explode(F.array(*[F.struct(F.lit(x).alias("model"), F.col(f"{x}_model.report").alias("report")) for x in ("original", "finetuned")]))
    lines = m.select("language", "task", both.alias("x")).select("language", "task", "x.model", F.explode("x.report").alias("r"))
    return lines.select("language", "task", "model", "r.name", *[r6(f"r.{c}").alias(c) for c in ("precision", "recall", "f1")], "r.support")
