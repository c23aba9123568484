"""The full article run: ingest, preprocess, vectorise, classify, tune; with switches and stored outputs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwell import constants as C
from inkwell.operators import evaluate as EV
from inkwell.operators import models as M
from inkwell.operators import scoring, tfidf, tuning
from inkwell.operators.preprocess import preprocess
from inkwell.operators.scorers import NaiveBayesScorer, apply_scorer
from inkwell.plans import oracle as O
from inkwell.plans.catalog import r6, register
from inkwell.plans.q_ingest import _TARGET_SQL, feed_articles
from inkwell.plans.q_scoring import TASK, sentiment_model
from inkwell.plans.q_tfidf import cleaned_stage
from inkwell.plans.runner import Outcome, Runner, Stage
from inkwell.session import scratch_path, stored
from inkwell.sources.tables import candidate_labels

#: Switches that stand for several stages.
GROUPS = {"classify": ("sentiment", "topic", "classify"), "fine-tune": ("tune",)}


def _scored(cleaned: DataFrame) -> DataFrame:
    rows = cleaned.where(F.col("cleaned_text").isNotNull() & (F.col("cleaned_text") != ""))
    return rows.select("doc_id", "language", scoring.scored_text(rows).alias("text"))


def article_stages(spark: SparkSession, sf_dir: str, languages: Iterable[str] = tuple(C.TARGET_LANGUAGES), epochs: int = C.EPOCHS) -> list[Stage]:
    """The stages of the run over the tables of ``sf_dir``; their parameters count in the fingerprints."""
    languages, root = list(languages), sf_dir.rstrip("/")
    files = lambda *names: tuple(f"{root}/{n}.parquet" for n in names)

    def ingest():
        return feed_articles(spark, sf_dir)

    def vectorize(cleaned: DataFrame) -> DataFrame:
        tf = stored(tfidf.term_frequency(cleaned), "terms")     # counted once for the vocabulary and the weights
        return tfidf.transform(tf, tfidf.fit(cleaned, tf=tf))

    def sentiment(cleaned: DataFrame) -> DataFrame:
        model = sentiment_model(spark, sf_dir, cleaned_stage(spark, sf_dir))
        found = apply_scorer(_scored(cleaned), NaiveBayesScorer(model), "doc_id", "text")
        return found.select("doc_id", F.col("label").alias("sentiment"), F.col("score").alias("sentiment_score"))

    def topic(cleaned: DataFrame) -> DataFrame:
        scorer = scoring.own_topic_scorer(cleaned, candidate_labels(spark, sf_dir))      # a scored text is its row's cleaned text
        found = apply_scorer(_scored(cleaned), scorer, "doc_id", "text")
        return found.select("doc_id", F.col("label").alias("topic"), F.col("score").alias("topic_score"), "label_scores", "absent_score")

    def classify(cleaned: DataFrame, moods: DataFrame, topics: DataFrame) -> DataFrame:
        rows = cleaned.where(F.col("language").isin(languages))
        return M.valid_predictions(rows.join(moods, "doc_id").join(topics, "doc_id"))

    def tune(classified: DataFrame) -> DataFrame:
        task = F.explode(F.create_map(F.lit("sentiment"), F.col("sentiment"), F.lit("topic"), F.col("topic"))).alias("task", "label")
        rows = M.labelled_rows(classified.select("language", "doc_id", "cleaned_text", task))
        found = tuning.tune_and_compare(rows, epochs=epochs).predictions
        return EV.grouped_report(found, ["language", "task", "model"])

    return [
        Stage("ingest", ingest, files=files("documents", "events", "pages")),
        Stage("preprocess", preprocess, ("ingest",)),
        Stage("vectorize", vectorize, ("preprocess",), params={"max_features": C.MAX_FEATURES}),
        Stage("sentiment", sentiment, ("preprocess",), files("documents", "labels"), {"task": TASK}),
        Stage("topic", topic, ("preprocess",), files("benchmark")),
        Stage("classify", classify, ("preprocess", "sentiment", "topic"), params={"languages": languages}),
        Stage("tune", tune, ("classify",), params={"epochs": epochs}),
    ]


def article_run(spark: SparkSession, sf_dir: str, root: str, skip: Iterable[str] = (), resume: bool = True,
                languages: Iterable[str] = tuple(C.TARGET_LANGUAGES), epochs: int = C.EPOCHS) -> tuple[Runner, list[Outcome]]:
    """Run the stages with their outputs under ``root``; ``skip`` names stages or the groups of GROUPS."""
    runner = Runner(spark, root, article_stages(spark, sf_dir, languages, epochs), GROUPS)
    return runner, runner.run(skip, resume)


_TARGETS = "(" + ", ".join(O.q(x) for x in C.TARGET_LANGUAGES) + ")"
_PAGE = "page_by_url AS (SELECT url, arg_min(html, page_id) AS html FROM pages GROUP BY url)"
_BODY = O.first_non_empty("content", "description")
_RUN_SQL = [*_TARGET_SQL, _PAGE, f"""raw AS (
  SELECT s.doc_id, s.language, s.headline_text AS title, s.headline_text AS description,
         CASE WHEN p.html IS NULL THEN '' ELSE {O.main_text('p.html')} END AS content
  FROM selected s LEFT JOIN page_by_url p ON p.url = s.source_url)""",
    f"art AS (SELECT doc_id, language, title, {O.cleaned_text(_BODY, 'language')} AS cleaned_text FROM raw)",
    O.tfidf_ctes("art", max_features=None),
    O.CLEANED[len(O.PAGE_OF_DOC) + 2:], O.sentiment_ctes(TASK), O.seed_ctes(),
    "art_scored AS (SELECT doc_id, doc_id AS id, language AS grp, cleaned_text FROM art WHERE cleaned_text <> '')",
    O.nb_predict_grouped("ap", "smm", "art_scored", "cleaned_text"),
    O.topic_ctes("art_scored"),
    f"""classified AS (SELECT a.doc_id, a.language, a.cleaned_text, p.prediction AS sentiment, t.topic
  FROM art a JOIN ap p ON p.id = a.doc_id JOIN topics t ON t.doc_id = a.doc_id WHERE a.language IN {_TARGETS})"""]


def stored_run(spark: SparkSession, sf_dir: str) -> Runner:
    """A run that is done in two goes: the first leaves out classification and tuning, the second takes the stored outputs."""
    root = scratch_path(spark, "article-run")
    article_run(spark, sf_dir, root, skip=["classify", "fine-tune"])
    return article_run(spark, sf_dir, root, skip=["ingest", "preprocess", "vectorize"])[0]


@register("article_pipeline", sql=O.with_(*_RUN_SQL) + """
SELECT language, topic, sentiment, count(*) AS n_articles FROM classified GROUP BY ALL""")
def q_pipeline(spark, sf_dir):
    """The full run over the feed, in two goes with switches: classified articles by language, topic and sentiment."""
    done = stored_run(spark, sf_dir).output("classify")
    return done.groupBy("language", "topic", "sentiment").agg(F.count(F.lit(1)).alias("n_articles"))


_RUN_TASKS = "run_rows AS (" + " UNION ALL ".join(
    f"SELECT language, '{t}' AS task, doc_id, cleaned_text, {t} AS label FROM classified" for t in ("sentiment", "topic")) + ")"
_KEYS = "language, task, model"


@register("article_tuning", sql=O.with_(*_RUN_SQL, _RUN_TASKS, O.tuning_ctes("run_rows"), O.grouped_class_ctes("rm", "tpred", _KEYS)) + f"""
SELECT {_KEYS}, round(accuracy, 6) AS accuracy, round(weighted_f1, 6) AS weighted_f1, round(macro_f1, 6) AS macro_f1, n
FROM ({O.grouped_summary('rm', _KEYS)})""")
def q_tuning(spark, sf_dir):
    """The tuning stage of the full run: both models of every language and task on the articles' own labels."""
    m = stored_run(spark, sf_dir).output("tune")
    return m.select("language", "task", "model", *[r6(c).alias(c) for c in ("accuracy", "weighted_f1", "macro_f1")], "n")
