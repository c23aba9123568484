"""Scoring and analysis queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from inkwell.functions import text as T
from inkwell.operators import scoring, tfidf
from inkwell.operators import models as M
from inkwell.operators.scorers import NaiveBayesScorer
from inkwell.plans import oracle as O
from inkwell.plans.catalog import r6, register
from inkwell.plans.q_tfidf import cleaned_stage
from inkwell.plans.stages import stage
from inkwell.session import release, scratch_path, spread
from inkwell.sources.classified import read_classified, write_classified
from inkwell.sources.tables import candidate_labels, table

TASK = "quality"
_SCORED_DOCS = f"(SELECT doc_id FROM cleaned WHERE cleaned_text IS NOT NULL AND {O.non_blank('cleaned_text')})"
_BASE = O.with_(O.CLEANED, O.tfidf_ctes(max_features=None), O.sentiment_ctes(TASK), O.seed_ctes(),
                O.topic_ctes(_SCORED_DOCS))
_HEAD = O.first_non_empty("description", "title")
_HEAD_BASE = O.with_(
    O.CLEANED, O.tfidf_ctes(max_features=None), O.sentiment_ctes(TASK), O.seed_ctes(),
    f"""heads AS (SELECT doc_id, language AS grp, title, {O.cleaned_text(_HEAD, 'language')} AS h
  FROM cleaned WHERE {O.non_blank(_HEAD)}),
worded AS (SELECT doc_id AS id, doc_id, grp, h FROM heads WHERE {O.non_blank('h')})""",
    O.nb_predict_grouped("hp", "smm", "worded", "h"),
    f"""h_t AS (SELECT doc_id, {O.terms('h')} AS t FROM worded),
h_g AS (SELECT doc_id, unnest({O.ngrams('t')}) AS term FROM h_t),
h_w AS (SELECT g.doc_id, g.term, count(*) * any_value(v.idf) AS w FROM h_g g JOIN vocab v USING (term) GROUP BY ALL),
h_weights AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM h_w)""",
    O.topic_ctes("(SELECT doc_id FROM worded)", weights="h_weights", p="h_"))


def _cleaned(spark, sf_dir):
    # reused by training, vectorising and scoring: the cleaned stage table
    return cleaned_stage(spark, sf_dir)


def sentiment_model(spark, sf_dir, cleaned):
    lab = table(spark, sf_dir, "labels").select("doc_id", F.col(TASK).cast("string").alias("label"))
    return scoring.train_sentiment(M.labelled_rows(cleaned.join(lab, "doc_id")))


def _topics(spark, sf_dir, cleaned):
    scored = F.col("cleaned_text").isNotNull() & T.non_blank("cleaned_text")
    return scoring.own_topic_scores(cleaned, candidate_labels(spark, sf_dir), scored)


def sentiment_stage(spark, sf_dir):
    """(doc_id, sentiment, sentiment_score) of every cleaned article, as a stage table."""
    def build():
        c = _cleaned(spark, sf_dir)
        return scoring.score_sentiment(c, sentiment_model(spark, sf_dir, c))
    return stage(spark, sf_dir, "sentiment", build)


def topic_stage(spark, sf_dir):
    """(doc_id, topic, topic_score, n_labels, best_cos, n_present) of every non-blank cleaned article, as a stage table."""
    return stage(spark, sf_dir, "topics", lambda: _topics(spark, sf_dir, _cleaned(spark, sf_dir)))


@register("sentiment_scores", sql=_BASE + """
SELECT doc_id, sentiment, round(sentiment_score, 6) AS sentiment_score FROM sentiment""")
def q_sentiment_scores(spark, sf_dir):
    s = sentiment_stage(spark, sf_dir)
    return s.select("doc_id", "sentiment", r6("sentiment_score").alias("sentiment_score"))


@register("topic_scores", sql=_BASE + """
SELECT doc_id, topic, round(topic_score, 6) AS topic_score, n_labels FROM topics""")
def q_topic_scores(spark, sf_dir):
    t = topic_stage(spark, sf_dir)
    return t.select("doc_id", "topic", r6("topic_score").alias("topic_score"), "n_labels")


@register("argmax_label", sql=_BASE + """
SELECT doc_id, topic AS label, round(best_cos, 6) AS score, n_present AS n_labels_matched FROM topics""")
def q_argmax_label(spark, sf_dir):
    """Highest-scoring label of every document (label ascending on ties; the first label at 0 where no
    term is shared) with its cosine and the number of labels that share a term."""
    t = topic_stage(spark, sf_dir)
    return t.select("doc_id", F.col("topic").alias("label"), r6("best_cos").alias("score"),
                    F.col("n_present").alias("n_labels_matched"))


@register("topic_label_scores", sql=_BASE + """, mass AS (
  SELECT d.doc_id, coalesce(p.mass, 0.0) + (nl.n - coalesce(p.n_present, 0)) AS m, nl.n - coalesce(p.n_present, 0) AS n_absent
  FROM """ + _SCORED_DOCS + """ d CROSS JOIN nl LEFT JOIN per_doc p USING (doc_id))
SELECT doc_id, label, round(exp(cos / 0.1) / m, 6) AS score, CAST(1 AS BIGINT) AS n_labels FROM sims JOIN mass USING (doc_id)
UNION ALL SELECT doc_id, '(each other)', round(1 / m, 6), CAST(n_absent AS BIGINT) FROM mass""")
def q_topic_label_scores(spark, sf_dir):
    """The whole distribution over the topics of every document: a row for each label that shares a term
    with it, and one for all others with their shared probability and number. Scores times numbers sum to 1."""
    t = topic_stage(spark, sf_dir)
    own = t.select("doc_id", F.explode("label_scores").alias("label", "score")).withColumn("n_labels", F.lit(1).cast("bigint"))
    rest = t.select("doc_id", F.lit("(each other)").alias("label"), F.col("absent_score").alias("score"),
                    (F.col("n_labels") - F.col("n_present")).alias("n_labels"))
    return own.unionByName(rest).select("doc_id", "label", r6("score").alias("score"), "n_labels")


@register("topic_score_sums", sql=_BASE + """
SELECT doc_id, CAST((SELECT n FROM nl) AS BIGINT) AS n_scores, 1.0::DOUBLE AS total FROM topics""")
def q_topic_score_sums(spark, sf_dir):
    """The expanded map of every document has every label, and its scores sum to 1."""
    labels = F.array_sort(F.collect_list("label"))
    every = candidate_labels(spark, sf_dir).agg(labels).scalar()
    t = topic_stage(spark, sf_dir).withColumn("_labels", every)
    full = t.select("doc_id", scoring.full_scores(F.col("label_scores"), F.col("absent_score"), F.col("_labels")).alias("m"))
    return full.select("doc_id", F.size("m").cast("bigint").alias("n_scores"),
                       r6(F.aggregate(F.map_values("m"), F.lit(0.0), lambda a, x: a + x)).alias("total"))


def classifier(spark, sf_dir):
    """(sentiment scorer, topic scorer) of the cleaned articles: learnt from the labelled ones, topics in the space of all.

    ``classify`` gives them articles with a cleaned text, so a scored text is its article's cleaned text.
    """
    c = _cleaned(spark, sf_dir)
    return NaiveBayesScorer(sentiment_model(spark, sf_dir, c)), scoring.own_topic_scorer(c, candidate_labels(spark, sf_dir))


#: The language that the classified table is run again for.
RERUN = "fr"


@register("classified_articles", sql=_BASE + """
SELECT s.doc_id, c.language, c.title, s.sentiment, round(s.sentiment_score, 6) AS sentiment_score, t.topic,
       round(t.topic_score, 6) AS topic_score, t.n_present AS n_scores
FROM cleaned c JOIN sentiment s USING (doc_id) JOIN topics t USING (doc_id)
WHERE s.sentiment NOT IN ('EMPTY', 'ERROR') AND t.topic NOT IN ('EMPTY', 'ERROR')""")
def q_classified_articles(spark, sf_dir):
    """The table of classified articles by language, written, then written again for one language alone."""
    cleaned, (mood, topic) = _cleaned(spark, sf_dir), classifier(spark, sf_dir)
    path = scratch_path(spark, "classified")
    languages = [r[0] for r in cleaned.select("language").distinct().collect()]
    write_classified(scoring.classify(cleaned, mood, topic), path, languages)
    release(spark)      # what the first go shuffled does not stay on the disks during the second
    again = scoring.classify(cleaned, mood, topic, [RERUN])
    write_classified(again, path, [RERUN])
    back = read_classified(spark, path, again.schema)
    return back.select("doc_id", "language", "title", "sentiment", r6("sentiment_score").alias("sentiment_score"), "topic",
                       r6("topic_score").alias("topic_score"), F.size("label_scores").cast("bigint").alias("n_scores"))


@register("centroid_scores", sql="""
WITH long AS (SELECT vec_id, label, unnest(range(1, len(embedding) + 1)) AS pos, unnest(embedding)::DOUBLE AS x
              FROM embeddings),
cent AS (SELECT label AS c_label, pos, avg(x) AS c FROM long GROUP BY label, pos),
cn AS (SELECT c_label, sqrt(sum(c * c)) AS cn FROM cent GROUP BY c_label),
vn AS (SELECT vec_id, sqrt(sum(x * x)) AS vn FROM long GROUP BY vec_id),
dots AS (SELECT l.vec_id, c.c_label, sum(l.x * c.c) AS dot FROM long l JOIN cent c USING (pos)
         GROUP BY l.vec_id, c.c_label),
cos AS (SELECT d.vec_id, d.c_label, CASE WHEN cn > 0 AND vn > 0 THEN dot / (cn * vn) ELSE 0.0 END AS cos
        FROM dots d JOIN cn USING (c_label) JOIN vn USING (vec_id)),
best AS (SELECT vec_id, c_label AS predicted, cos AS cosine FROM (
           SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY cos DESC, c_label) AS rk FROM cos) WHERE rk = 1)
SELECT e.vec_id, e.label, b.predicted, round(b.cosine, 6) AS cosine FROM embeddings e JOIN best b USING (vec_id)""")
def q_centroid_scores(spark, sf_dir):
    s = scoring.centroid_scores(spread(table(spark, sf_dir, "embeddings")))
    return s.select("vec_id", "label", "predicted", r6("cosine").alias("cosine"))


@register("filter_valid_predictions", sql=_BASE + """
SELECT s.doc_id, s.sentiment, t.topic FROM sentiment s JOIN topics t USING (doc_id)
WHERE s.sentiment NOT IN ('EMPTY', 'ERROR') AND t.topic NOT IN ('EMPTY', 'ERROR')""")
def q_filter_valid_predictions(spark, sf_dir):
    s, t = sentiment_stage(spark, sf_dir), topic_stage(spark, sf_dir)
    return M.valid_predictions(s.join(t, "doc_id")).select("doc_id", "sentiment", "topic")


def _classified(spark, sf_dir):
    return _cleaned(spark, sf_dir), sentiment_stage(spark, sf_dir), topic_stage(spark, sf_dir)


def analysis_stage(spark, sf_dir):
    """(doc_id, title, language, sentiment_analysis, topic_classification) of every article with a headline."""
    def build():
        c = _cleaned(spark, sf_dir)
        heads = scoring.headlines(c)
        vec = tfidf.fit(c, max_features=None)
        a = scoring.analyze(heads, sentiment_model(spark, sf_dir, c), vec, candidate_labels(spark, sf_dir))
        return a.join(c.select("doc_id", "title", "language"), "doc_id")
    return stage(spark, sf_dir, "analysis", build)


@register("analyze_articles", sql=_HEAD_BASE + """
SELECT x.doc_id, s.prediction AS sentiment_label, round(s.prob, 6) AS sentiment_score,
       t.topic, round(t.topic_score, 6) AS topic_confidence
FROM heads x LEFT JOIN hp s ON s.id = x.doc_id LEFT JOIN h_topics t USING (doc_id)""")
def q_analyze_articles(spark, sf_dir):
    """Sentiment and topic of the headline of every article that has one (description, else title)."""
    a = analysis_stage(spark, sf_dir)
    return a.select("doc_id", F.col("sentiment_analysis.label").alias("sentiment_label"),
                    r6("sentiment_analysis.score").alias("sentiment_score"),
                    F.col("topic_classification.topic").alias("topic"),
                    r6("topic_classification.confidence").alias("topic_confidence"))


@register("analysis_summary", sql=_HEAD_BASE + """
SELECT x.doc_id, x.grp AS language, coalesce(x.title, 'N/A') AS title,
       coalesce(s.prediction, 'N/A') AS sentiment, coalesce(t.topic, 'N/A') AS topic
FROM heads x LEFT JOIN hp s ON s.id = x.doc_id LEFT JOIN h_topics t USING (doc_id)""")
def q_analysis_summary(spark, sf_dir):
    """Language, title, sentiment and topic of every analysed article ('N/A' where there is none)."""
    na = F.lit("N/A")
    return analysis_stage(spark, sf_dir).select(
        "doc_id", F.coalesce("language", na).alias("language"), F.coalesce("title", na).alias("title"),
        F.coalesce("sentiment_analysis.label", na).alias("sentiment"),
        F.coalesce("topic_classification.topic", na).alias("topic"))


@register("corpus_summary", sql=_BASE + """
SELECT c.language, t.topic, s.sentiment, count(*) AS n_articles,
       round(avg(s.sentiment_score), 6) AS avg_sentiment_score
FROM cleaned c JOIN sentiment s USING (doc_id) JOIN topics t USING (doc_id)
GROUP BY c.language, t.topic, s.sentiment""")
def q_corpus_summary(spark, sf_dir):
    """Flagship: articles -> cleaned -> sentiment + topic -> per-language, per-topic summary."""
    c, s, t = _classified(spark, sf_dir)
    j = c.select("doc_id", "language").join(s, "doc_id").join(t, "doc_id")
    return j.groupBy("language", "topic", "sentiment").agg(
        F.count(F.lit(1)).alias("n_articles"), r6(F.avg("sentiment_score")).alias("avg_sentiment_score"))
