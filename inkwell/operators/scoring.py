"""Scorers: sentiment (naive Bayes per language), topics over caller-supplied labels, centroids.

A scorer maps ``(id, text)`` rows to ``(id, label, score)`` (see ``scorers``); the defaults are
native joins and aggregations. Label sets may have any size: seeds are joined on the term,
centroids are held in matrices of bounded bytes, one block of labels after the other.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from inkwell import constants as C
from inkwell.functions import text as T
from inkwell.operators import models as M
from inkwell.operators import packed, tfidf
from inkwell.operators.labels import dense_ids
from inkwell.operators.preprocess import preprocess
from inkwell.operators.scorers import FrameScorer, NaiveBayesScorer, apply_scorer
from inkwell.session import cut_lineage, release, stored

TOPIC_TEMPERATURE = 0.1
#: Bytes of centroids that a task holds at a time.
MATRIX_BYTES = 32 << 20


# --- M5 sentiment ---------------------------------------------------------------------------

def train_sentiment(labelled: DataFrame, text_col: str = "cleaned_text", per_language: bool = True):
    """Naive Bayes sentiment model, one per language (joined on language when scoring)."""
    return M.train_nb(labelled, text_col, "label", ["language"] if per_language else ())


def score_sentiment(df: DataFrame, model, id_col: str = "doc_id", text_col: str = "cleaned_text") -> DataFrame:
    """(id, sentiment, sentiment_score): EMPTY/0.0 for blank text, ERROR/0.0 when no model covers the row."""
    out = apply_scorer(df, NaiveBayesScorer(model), id_col, text_col)
    return out.select(id_col, F.col("label").alias("sentiment"), F.col("score").alias("sentiment_score"))


# --- M6 topics ----------------------------------------------------------------------------------

def _seed_articles(candidates: DataFrame) -> DataFrame:
    return candidates.select(F.col("label").alias("doc_id"), F.col("seed_text").alias("content"),
                             F.col("seed_text").alias("description"), F.lit("en").alias("language"),
                             F.lit(None).cast("string").alias("title"), F.lit(None).cast("string").alias("publishedAt"),
                             F.lit(None).cast("struct<id:string,name:string>").alias("source"),
                             F.lit(None).cast("string").alias("url"))


def seed_counts(candidates: DataFrame) -> DataFrame:
    """(doc_id, term, tf): the counted terms of each label's seed text; ``doc_id`` is the label."""
    return tfidf.term_frequency(preprocess(_seed_articles(candidates)))


def seed_weights(candidates: DataFrame, vec: tfidf.Vectorizer) -> DataFrame:
    """(label, term, weight): TF-IDF of each label's seed text in the documents' vector space."""
    w = tfidf.transform(seed_counts(candidates), vec)
    return w.select(F.col("doc_id").alias("label"), "term", F.col("weight").alias("sw"))


def _cosines(tf: DataFrame, norms: DataFrame, candidates: DataFrame, vocabulary, n_docs: int, parts: int) -> DataFrame:
    """(doc_id, label, cos) from counts: only terms of the seeds are weighted, the documents' ``norms`` are given.

    ``vocabulary`` takes the terms of the seeds and gives (term, df, cf) of those. The seeds are stored first, so that
    Spark broadcasts them where their size allows.
    """
    counts = stored(seed_counts(candidates), "seeds")
    known = stored(vocabulary(counts.select("term").distinct()).select(
        "term", F.lit(None).cast("int").alias("term_id"), "cf", "df", tfidf._idf(n_docs).alias("idf")), "seed-terms")
    own = tfidf.Vectorizer(known, n_docs, capped=False, parts=parts)
    sw = tfidf.transform(counts, own).select(F.col("doc_id").alias("label"), "term", F.col("weight").alias("sw"))
    sw = stored(sw.join(known.select("term", "idf"), "term"), "seed-weights")
    dots = tf.join(sw, "term").groupBy("doc_id", "label").agg(F.sum(F.col("tf") * F.col("idf") * F.col("sw")).alias("dot"))
    return dots.join(norms, "doc_id").select("doc_id", "label", (F.col("dot") / F.col("norm")).alias("cos"))


#: Most labels whose names and lengths a task holds; more are joined to the cosines.
LABELS_HELD = 200_000

#: Kinds of a block's sums: squared lengths of its rows, and products with labels; squared lengths of labels.
NORMS, DOTS, LABEL_NORMS = 1, 2, 3


def _weigh(table: pa.Table, n_docs: int) -> pa.Table:
    """A part's share of the squared lengths of the documents and of the labels, and of their products."""
    found, known, _ = packed.pieces(table)
    docs, out = [p for p in found if p.kind == packed.TERMS], packed.passed_on(table)
    df = np.zeros(len(known))
    for p in docs:
        df[p.terms] += p.lengths
    idf = np.log((1.0 + n_docs) / (1.0 + df)) + 1.0
    seeds = [p for p in found if p.kind == packed.SEEDS]
    whole = lambda xs: np.concatenate([np.zeros(0, np.int64), *xs]).astype(np.int64)
    term, label, times = (whole(x) for x in ([np.repeat(p.terms, p.lengths) for p in seeds], [p.rows for p in seeds], [p.times for p in seeds]))
    order = np.argsort(term, kind="stable")
    order = order[df[term[order]] > 0]
    term, label, times = term[order], label[order], times[order]
    n_seeds = np.bincount(term, minlength=len(known))
    first = np.cumsum(n_seeds) - n_seeds
    out.append((-1, LABEL_NORMS, packed.pack(*packed.summed(label, (times * idf[term]) ** 2))))
    wide = int(label.max()) + 1 if len(label) else 1
    for p in docs:
        at = np.repeat(p.terms, p.lengths)
        w, mark = p.times * idf[at], np.array([p.mark])
        out.append((p.block, NORMS, packed.pack(mark, np.bincount(p.rows, weights=w * w, minlength=p.n))))
        hits = np.flatnonzero(n_seeds[at])
        n = n_seeds[at[hits]]
        entry, seed = np.repeat(hits, n), packed.segments(first[at[hits]], n)
        pairs, dots = packed.summed(p.rows[entry].astype(np.int64) * wide + label[seed], w[entry] * idf[at[entry]] * times[seed])
        if len(pairs):
            out.append((p.block, DOTS, packed.pack(mark, *np.divmod(pairs, wide), dots)))
    return packed.sums_table(out)


def _block_dots(table: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(a block's columns, squared length of every row; row, label and product of every pair that shares a term)."""
    own, sums = packed.block_rows(table)
    norms = np.zeros(own.num_rows)
    for _, x in sums.get(NORMS, []):
        norms += x
    row, label, dot = (np.concatenate([np.zeros(0, kind), *xs]) for kind, xs in zip(
        (np.int64, np.int64, np.float64), list(zip(*(x[1:] for x in sums.get(DOTS, [])), strict=True)) or [[]] * 3, strict=True))
    wide = int(label.max()) + 1 if len(label) else 1
    pairs, dot = packed.summed(row.astype(np.int64) * wide + label.astype(np.int64), dot)
    return own, norms, *np.divmod(pairs, wide), dot


def _packed_cosines(docs: DataFrame, candidates: DataFrame, n_docs: int, chars: int, wanted: Column) -> DataFrame:
    """(doc_id, cosines) of the documents of ``wanted``, whose ids are unique: (label, cos) of the labels that share a term.

    Every term goes once for each block of documents to the part that knows its df, with the seeds' terms; the
    sums come back once for each block and part (``packed``).
    """
    spark, parts = docs.sparkSession, packed.parts_of(docs.sparkSession, chars)
    numbers = dense_ids(candidates, "label", "number")
    seeds = preprocess(_seed_articles(candidates)).join(numbers, F.col("doc_id") == F.col("label"))
    # a null parts the texts of a label that has several
    seeds = seeds.groupBy("number").agg(F.flatten(F.collect_list(F.concat(T.terms("cleaned_text"), F.array(F.lit(None).cast("string"))))).alias("terms"))
    rows = docs.select("doc_id", F.coalesce(wanted, F.lit(False)).alias("_wanted"), T.terms("cleaned_text").alias("terms"))
    dealt = packed.deal(rows, parts, pairs=True).unionByName(packed.deal(seeds, parts, pairs=True, kind=packed.SEEDS))
    sums = stored(packed.by_part(dealt, lambda table: _weigh(table, n_docs)), "term-sums")
    release(spark)      # the first exchange does not stay on the disks during the second

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column("data").to_pylist():
                number, norm = packed.unpack(data)
                yield pa.RecordBatch.from_arrays([pa.array(number.astype(np.int64)), pa.array(norm)], ["number", "norm"])

    lengths = sums.where(F.col("kind") == LABEL_NORMS).select("data").mapInArrow(split, "number bigint, norm double")
    labels = numbers.join(lengths.groupBy("number").agg(F.sqrt(F.sum("norm")).alias("norm")), "number")
    kind = docs.schema["doc_id"].dataType.simpleString()
    blocks = sums.where(F.col("kind") != LABEL_NORMS).groupBy("block")

    def lists(own: pa.Table, row: np.ndarray, **columns: pa.Array) -> pa.Table:
        offsets = pa.array(np.searchsorted(row, np.arange(own.num_rows + 1)), pa.int32())
        out = own.select(["doc_id"])
        for name, values in columns.items():
            out = out.append_column(name, pa.ListArray.from_arrays(offsets, values))
        return out.filter(own.column("_wanted"))

    if candidates.count() <= LABELS_HELD:
        held = labels.toArrow().sort_by("number")
        place, names, norm_of = held["number"].to_numpy(), held["label"].combine_chunks(), held["norm"].to_numpy()

        def named(table: pa.Table) -> pa.Table:
            own, norms, row, label, dot = _block_dots(table)
            at = np.searchsorted(place, label)
            cos = pa.array(dot / (np.sqrt(norms)[row] * norm_of[at]))
            pair = pa.StructArray.from_arrays([names.take(pa.array(at)).cast(pa.string()), cos], ["label", "cos"])
            return lists(own, row, cosines=pair)

        return blocks.applyInArrow(named, f"doc_id {kind}, cosines array<struct<label:string,cos:double>>")

    def numbered(table: pa.Table) -> pa.Table:
        own, norms, row, label, dot = _block_dots(table)
        pair = pa.StructArray.from_arrays([pa.array(label), pa.array(dot / np.sqrt(norms)[row])], ["number", "dot"])
        return lists(own, row, pairs=pair)

    every = stored(blocks.applyInArrow(numbered, f"doc_id {kind}, pairs array<struct<number:bigint,dot:double>>"), "dots")
    found = every.select("doc_id", F.inline("pairs")).join(labels, "number").groupBy("doc_id").agg(
        F.collect_list(F.struct("label", (F.col("dot") / F.col("norm")).alias("cos"))).alias("cosines"))
    return every.select("doc_id").join(found, "doc_id", "left")


def own_topic_scores(docs: DataFrame, candidates: DataFrame, rows: DataFrame | Column, temperature: float = TOPIC_TEMPERATURE) -> DataFrame:
    """``topic_scores`` in the vector space of the documents ``docs`` (all terms).

    ``rows``: those of the documents that are scored, as rows with their ids or as a condition on ``docs``.
    """
    n_docs, chars = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("cleaned_text")), F.lit(0))).first()
    # documents of several rows are counted together by their ids, and no id stands for a null one
    unnamed = docs.where(F.col("doc_id").isNull()).select("doc_id").union(tfidf.repeated(docs))
    if unnamed.isEmpty() and candidates.where(F.col("label").isNull()).isEmpty():
        wanted = rows if isinstance(rows, Column) else F.lit(True)
        found = _packed_cosines(docs, candidates, n_docs, chars, wanted)
        if not isinstance(rows, Column):
            found = rows.select("doc_id").join(found, "doc_id", "left")
        return _from_cosines(found, candidates, "doc_id", temperature)
    tf, parts = stored(tfidf.term_frequency(docs), "terms"), tfidf.size(docs)[1]
    sims = _cosines(tf, tfidf.own_norms(tf, n_docs, parts), candidates,
                    lambda terms: tfidf.document_frequency(tf.join(terms, "term", "left_semi")), n_docs, parts)
    return _distribution(sims, docs.where(rows) if isinstance(rows, Column) else rows, candidates, "doc_id", temperature)


def counted_topic_scores(docs: DataFrame, candidates: DataFrame, vec: tfidf.Vectorizer, text_col: str = "cleaned_text",
                         temperature: float = TOPIC_TEMPERATURE) -> DataFrame:
    """``topic_scores`` of the texts of ``docs`` in the vector space of ``vec`` (its vocabulary ``tfidf.kept``)."""
    tf, parts = tfidf.term_frequency(docs, "doc_id", text_col), tfidf.size(docs, text_col)[1]
    sims = _cosines(tf, tfidf.norms(tf, vec, max(parts, vec.parts or 1)), candidates,
                    lambda terms: vec.vocabulary.join(terms, "term", "left_semi"), vec.n_docs, parts)
    return _distribution(sims, docs, candidates, "doc_id", temperature)


def topic_scores(doc_weights: DataFrame, docs: DataFrame, candidates: DataFrame, vec: tfidf.Vectorizer,
                 id_col: str = "doc_id", temperature: float = TOPIC_TEMPERATURE) -> DataFrame:
    """(id, topic, topic_score, n_labels, best_cos, n_present, label_scores, absent_score): cosine to every
    label's seed, softmax over all labels.

    ``label_scores`` maps the labels that share a term with the document to their probabilities;
    every other label has ``absent_score``. Together they are the whole distribution (``full_scores``).

    Only labels sharing a term with the document produce join rows; the others
    have cosine 0 and enter the softmax as exp(0) each, so no document x label
    product is built. Ties go to the smaller label. Any number of labels is taken: the
    seeds are joined on the term, and Spark broadcasts them where their size allows.
    """
    sw = seed_weights(candidates, vec)
    sims = (doc_weights.join(sw, "term")
            .groupBy(id_col, "label").agg(F.sum(F.col("weight") * F.col("sw")).alias("cos")))
    return _distribution(sims, docs, candidates, id_col, temperature)


def _distribution(sims: DataFrame, docs: DataFrame, candidates: DataFrame, id_col: str, temperature: float) -> DataFrame:
    """The columns of ``topic_scores`` from the cosines (id, label, cos) of labels that share a term with the document."""
    per_doc = sims.groupBy(id_col).agg(F.collect_list(F.struct("label", "cos")).alias("cosines"))
    return _from_cosines(docs.select(id_col).join(per_doc, id_col, "left"), candidates, id_col, temperature)


def _from_cosines(found: DataFrame, candidates: DataFrame, id_col: str, temperature: float) -> DataFrame:
    """The columns of ``topic_scores`` from rows (id, cosines): an array of (label, cos), or null."""
    n_labels, first_label = candidates.agg(F.count(F.lit(1)), F.min("label")).first()
    if n_labels == 0:
        raise ValueError("no candidate labels")
    t = F.lit(temperature)
    pairs = F.coalesce("cosines", F.array().cast("array<struct<label:string,cos:double>>"))
    best = F.array_min(F.transform(pairs, lambda x: F.struct((-x["cos"]).alias("cos"), x["label"].alias("label"))))
    out = found.select(id_col, pairs.alias("_pairs"), best.alias("_best"), F.size(pairs).alias("n_present"),
                       F.aggregate(pairs, F.lit(0.0), lambda a, x: a + F.exp(x["cos"] / t)).alias("present_mass"))
    out = out.select("*", (F.col("present_mass") + (F.lit(n_labels) - F.col("n_present"))).alias("_denom"), (-F.col("_best.cos")).alias("best_cos"))
    denom = F.col("_denom")
    top_is_present = F.col("_best").isNotNull() & ((F.col("best_cos") > 0) | (F.col("_best.label") <= F.lit(first_label)))
    topic = F.when(top_is_present, F.col("_best.label")).otherwise(F.lit(first_label))
    score = F.when(top_is_present, F.exp(F.col("best_cos") / t)).otherwise(F.lit(1.0)) / denom
    scores = F.transform("_pairs", lambda x: F.struct(x["label"].alias("key"), (F.exp(x["cos"] / t) / denom).alias("value")))
    return out.select(id_col, topic.alias("topic"), score.alias("topic_score"),
                      F.lit(n_labels).cast("bigint").alias("n_labels"),
                      F.coalesce("best_cos", F.lit(0.0)).alias("best_cos"),
                      F.col("n_present").cast("bigint").alias("n_present"),
                      F.map_from_entries(scores).alias("label_scores"),
                      (F.lit(1.0) / denom).alias("absent_score"))


def full_scores(label_scores, absent_score, labels) -> Column:
    """The probability of every label of the array ``labels``, from the sparse map and the shared probability."""
    return F.map_from_arrays(labels, F.transform(labels, lambda x: F.coalesce(F.element_at(label_scores, x), absent_score)))


def topic_scorer(candidates: DataFrame, vec: tfidf.Vectorizer, temperature: float = TOPIC_TEMPERATURE) -> FrameScorer:
    """The topic model as a scorer: label and score are the topic's, the label scores come beside them."""
    kept = tfidf.kept(vec)

    def score(rows: DataFrame) -> DataFrame:
        found = counted_topic_scores(rows.withColumnRenamed("id", "doc_id"), candidates, kept, "text", temperature)
        return found.select(F.col("doc_id").alias("id"), F.col("topic").alias("label"), F.col("topic_score").alias("score"),
                            "label_scores", "absent_score")

    return FrameScorer(score)


def own_topic_scorer(docs: DataFrame, candidates: DataFrame, temperature: float = TOPIC_TEMPERATURE) -> FrameScorer:
    """``topic_scorer`` of a vectorizer fitted on all terms of ``docs``, for texts that are those of ``docs``.

    The documents' own counts give their norms, so no vocabulary of all terms is stored and joined. These and the
    products with the labels are made once, however often the scorer is asked.
    """
    fitted = []

    def score(rows: DataFrame) -> DataFrame:
        if not fitted:
            fitted.append(own_topic_scores(docs, candidates, F.lit(True), temperature))
        found = rows.select(F.col("id").alias("doc_id")).join(fitted[0], "doc_id")
        return found.select(F.col("doc_id").alias("id"), F.col("topic").alias("label"), F.col("topic_score").alias("score"),
                            "label_scores", "absent_score")

    return FrameScorer(score)


# --- F3, F6, P6 classification ----------------------------------------------------------------

def scored_text(cleaned: DataFrame) -> Column:
    """The text that is classified: the cleaned text, else the title."""
    return T.first_non_empty("cleaned_text", "title")


def classify(cleaned: DataFrame, sentiment, topic, languages=None, valid_only: bool = True, require_text: bool = True) -> DataFrame:
    """``cleaned`` with sentiment, sentiment_score, topic, topic_score, label_scores and absent_score.

    ``sentiment`` and ``topic`` are scorers. Only articles of ``languages`` (default: all) whose cleaned text is not
    blank (``require_text``; else the title stands in) are scored, and with ``valid_only`` only those that got
    both labels are kept.
    """
    rows = cleaned if languages is None else cleaned.where(F.col("language").isin(list(languages)))
    if require_text:
        rows = rows.where(F.col("cleaned_text").isNotNull() & T.non_blank("cleaned_text"))
    texts = rows.select("doc_id", "language", scored_text(rows).alias("text"))
    moods = apply_scorer(texts, sentiment, "doc_id", "text").select(
        "doc_id", F.col("label").alias("sentiment"), F.col("score").alias("sentiment_score"))
    topics = apply_scorer(texts, topic, "doc_id", "text")
    for c, kind in (("label_scores", "map<string,double>"), ("absent_score", "double")):
        if c not in topics.columns:
            topics = topics.withColumn(c, F.lit(None).cast(kind))
    topics = topics.select("doc_id", F.col("label").alias("topic"), F.col("score").alias("topic_score"), "label_scores", "absent_score")
    out = rows.join(moods, "doc_id").join(topics, "doc_id")
    return M.valid_predictions(out) if valid_only else out


# --- M9 analysis ------------------------------------------------------------------------------

def headlines(articles: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, language, cleaned_text) of every article whose headline (description, else title) is not blank."""
    head = T.first_non_empty("description", "title")
    lang = F.coalesce(F.col("language"), F.lit("en"))
    return articles.where(T.non_blank(head)).select(id_col, lang.alias("language"),
                                                    T.cleaned_text(head, lang).alias("cleaned_text"))


def analyze(heads: DataFrame, sentiment_model, vec: tfidf.Vectorizer, candidates: DataFrame) -> DataFrame:
    """(doc_id, sentiment_analysis, topic_classification) of every headline.

    Each struct holds label/score (topic/confidence), or ``error`` and nulls where the headline has
    no words left after cleaning or no model covers it.
    """
    worded = heads.where(T.non_blank("cleaned_text"))
    topics = counted_topic_scores(worded, candidates, tfidf.kept(vec))
    moods = score_sentiment(heads, sentiment_model)
    failed = F.col("sentiment").isNull() | F.col("sentiment").isin(C.SENTINEL_EMPTY, C.SENTINEL_ERROR)
    why = F.when(F.col("sentiment") == F.lit(C.SENTINEL_EMPTY), F.lit("no words")).otherwise(F.lit("no model"))
    return (heads.select("doc_id").join(moods, "doc_id", "left").join(topics, "doc_id", "left").select(
        "doc_id",
        F.struct(F.when(~failed, F.col("sentiment")).alias("label"),
                 F.when(~failed, F.col("sentiment_score")).alias("score"),
                 F.when(failed, why).alias("error")).alias("sentiment_analysis"),
        F.struct(F.col("topic"), F.col("topic_score").alias("confidence"),
                 F.when(F.col("topic").isNull(), F.lit("no words")).alias("error")).alias("topic_classification")))


# --- M7 centroids ---------------------------------------------------------------------------

def centroids(vectors: DataFrame, vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(c_label, c, cn): the mean vector of every label, place by place, and its norm.

    One aggregation with a mean for each place; no vector is taken apart into rows. Places that a
    vector does not have do not count in their mean.
    """
    dims = vectors.agg(F.max(F.size(vec_col))).first()[0] or 0
    place = lambda i: F.avg(F.get(F.col(vec_col), F.lit(i)).cast("double"))
    means = F.array(*[place(i) for i in range(dims)]).cast("array<double>")
    rows = vectors.where(F.col(label_col).isNotNull()).groupBy(F.col(label_col).alias("c_label")).agg(means.alias("c"))
    return rows.withColumn("cn", F.sqrt(_dot(F.col("c"), F.col("c"))))


def _dot(a: Column, b: Column) -> Column:
    """Sum of products; places that one side does not have are left out."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.coalesce(x.cast("double") * y, F.lit(0.0))), F.lit(0.0), lambda s, x: s + x)


def centroid_scores(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    matrix_bytes: int | None = None) -> DataFrame:
    """(id, label, predicted, cosine): nearest label centroid by cosine (label ascending on ties).

    The centroids lie in one array, looked through inside each row. It is held to ``matrix_bytes``;
    more labels are dealt to several arrays, and the vectors are read once for each. Null and empty vectors are left out.
    """
    cent = cut_lineage(centroids(vectors, vec_col, label_col))
    n, width = cent.agg(F.count(F.lit(1)), F.max(F.size("c"))).first()
    blocks = max(1, min(n, -(-n * (8 * (width or 0) + 64) // (matrix_bytes or MATRIX_BYTES))))
    rows = vectors.where(F.size(vec_col) > 0)
    v = F.col(vec_col)
    none = F.struct(F.lit(None).cast(cent.schema["c_label"].dataType).alias("label"), F.lit(None).cast("double").alias("cos"))
    found = None
    for b in range(blocks):
        block = cent.where(F.pmod(F.xxhash64("c_label"), F.lit(blocks)) == b)
        matrix = block.agg(F.array_sort(F.collect_list(F.struct("c_label", "c", "cn")))).scalar()     # one value of bounded size

        def nearer(best: Column, x: Column) -> Column:
            cos = F.when((x["cn"] > 0) & (F.col("_vn") > 0), _dot(v, x["c"]) / (x["cn"] * F.col("_vn"))).otherwise(F.lit(0.0))
            step = F.struct(x["c_label"].alias("label"), cos.alias("cos"))
            return F.when(best["cos"].isNull() | (step["cos"] > best["cos"]), step).otherwise(best)

        best = F.aggregate("_matrix", none, nearer)
        part = rows.withColumn("_matrix", matrix).withColumn("_vn", F.sqrt(_dot(v, v))).select(id_col, F.col(label_col).alias("label"), best.alias("_best"))
        found = part if found is None else found.unionByName(part)
    if blocks > 1:
        order = F.struct(-F.col("_best.cos"), F.col("_best.label"))
        found = found.where("_best.label IS NOT NULL").groupBy(id_col, "label").agg(F.min_by("_best", order).alias("_best"))
    return found.where("_best.label IS NOT NULL").select(
        id_col, "label", F.col("_best.label").alias("predicted"), F.col("_best.cos").alias("cosine"))
