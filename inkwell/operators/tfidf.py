"""TF-IDF over uni- and bigrams: counts, capped vocabulary, smoothed idf, L2-normalised weights.

Plan shape: the n-grams of a document are counted where its row is read (``packed``), so the term
frequencies need no shuffle; the document frequencies need one on term, into as many
partitions as the texts' length asks for; the vocabulary is a top-k (TakeOrderedAndProject) of
at most ``max_features`` rows and is the only broadcast side. Norms are a window on
doc_id over the weighted rows, so no second join is needed; where only norms are asked for
(``norms``, ``own_norms``) no term is shuffled by document.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from inkwell import constants as C
from inkwell.functions.text import terms
from inkwell.operators import packed
from inkwell.session import cut_lineage, stored


#: Characters of text whose terms one task of a shuffle on term takes (about 14 times as much memory).
PART_CHARS = 8 << 20


def _counted(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, term, tf) of every row by itself; the terms of a block of rows are counted at once."""
    return packed.counted(docs.select(F.col(id_col).alias("doc_id"), terms(F.col(text_col)).alias("terms")))


def repeated(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(_id): the ids that several rows share."""
    return docs.groupBy(F.col(id_col).alias("_id")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_id")


def term_frequency(docs: DataFrame, id_col: str = "doc_id", text_col: str = "cleaned_text") -> DataFrame:
    """(doc_id, term, tf). Rows that share an id are one document; only their counts are shuffled."""
    again = repeated(docs, id_col)
    if again.isEmpty():
        return _counted(docs, id_col, text_col)
    again = cut_lineage(again)
    same = docs[id_col].eqNullSafe(again["_id"])
    several = _counted(docs.join(again, same, "left_semi"), id_col, text_col)
    return _counted(docs.join(again, same, "left_anti"), id_col, text_col).unionByName(
        several.groupBy("doc_id", "term").agg(F.sum("tf").alias("tf")))


def size(docs: DataFrame, text_col: str = "cleaned_text") -> tuple[int, int]:
    """(rows, partitions for a shuffle of their terms): the memory of a task does not grow with the texts."""
    n, chars = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length(text_col)), F.lit(0))).first()
    return n, max(docs.sparkSession.sparkContext.defaultParallelism, -(-chars // PART_CHARS))


def document_frequency(tf: DataFrame, parts: int | None = None) -> DataFrame:
    """(term, df, cf): documents containing the term, and its corpus count.

    With ``parts`` the rows are dealt to that many tasks before they are counted: few repeat inside a
    task's share of the documents, so counting them there first fills its memory and saves little.
    """
    tf = tf.repartition(parts, "term") if parts else tf
    return tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


def _idf(n_docs: int):
    return F.log((F.lit(1.0) + F.lit(n_docs)) / (F.lit(1.0) + F.col("df"))) + F.lit(1.0)


@dataclass
class Vectorizer:
    vocabulary: DataFrame   # term, term_id, cf, df, idf  (<= max_features rows; every term when uncapped)
    n_docs: int
    capped: bool = True
    parts: int | None = None    # tasks that rows of terms are dealt to


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "cleaned_text",
        max_features: int | None = C.MAX_FEATURES, tf: DataFrame | None = None) -> Vectorizer:
    """Top ``max_features`` terms by corpus count (count desc, term asc); ids in term order.

    With None every term is kept, without ids; its vectors come from a join on the term.
    """
    tf = tf if tf is not None else term_frequency(docs, id_col, text_col)
    n_docs, parts = size(docs, text_col)
    idf = _idf(n_docs)
    if max_features is None:
        every = document_frequency(tf, parts).select("term", F.lit(None).cast("int").alias("term_id"), "cf", "df",
                                                     idf.alias("idf"))
        return Vectorizer(vocabulary=every, n_docs=n_docs, capped=False, parts=parts)
    top = document_frequency(tf, parts).orderBy(F.desc("cf"), F.asc("term")).limit(max_features)
    # <= max_features rows: a single ordered window is bounded by construction
    vocab = top.select(
        "term",
        (F.row_number().over(Window.orderBy("term")) - 1).cast("int").alias("term_id"),
        "cf", "df",
        idf.alias("idf"),
    )
    return Vectorizer(vocabulary=vocab, n_docs=n_docs, parts=parts)


def transform(tf: DataFrame, vec: Vectorizer) -> DataFrame:
    """(doc_id, term_id, term, weight): tf*idf over the vocabulary, L2-normalised per document.

    A document without vocabulary terms has no rows (the zero vector).
    """
    vocabulary = vec.vocabulary.select("term", "term_id", "idf")
    w = tf.join(F.broadcast(vocabulary) if vec.capped else vocabulary, "term")
    w = w.select("doc_id", "term_id", "term", (F.col("tf") * F.col("idf")).alias("w"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy("doc_id")))
    return w.select("doc_id", "term_id", "term", (F.col("w") / norm).alias("weight"))


def kept(vec: Vectorizer) -> Vectorizer:
    """The vectorizer with its vocabulary as a table of the scratch folder: made once, however often it is joined."""
    return replace(vec, vocabulary=stored(vec.vocabulary, "vocabulary"))


def _lengths(w: DataFrame) -> DataFrame:
    return w.groupBy("doc_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))


def norms(tf: DataFrame, vec: Vectorizer, parts: int | None = None) -> DataFrame:
    """(doc_id, norm): the length of every document's tf*idf vector, of those with terms of the vocabulary."""
    idf = vec.vocabulary.select("term", "idf")
    if parts:
        tf, idf = tf.repartition(parts, "term"), idf.repartition(parts, "term")
    return _lengths(tf.join(idf, "term").select("doc_id", (F.col("tf") * F.col("idf")).alias("w")))


def own_norms(tf: DataFrame, n_docs: int, parts: int) -> DataFrame:
    """``norms`` of the documents that the vectorizer is fitted on: one shuffle, as a term's rows are its df."""
    df = F.count(F.lit(1)).over(Window.partitionBy("term"))
    return _lengths(tf.repartition(parts, "term").withColumn("df", df).select("doc_id", (F.col("tf") * _idf(n_docs)).alias("w")))


def fit_transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "cleaned_text",
                  max_features: int | None = C.MAX_FEATURES) -> tuple[Vectorizer, DataFrame]:
    tf = term_frequency(docs, id_col, text_col)
    vec = fit(docs, id_col, text_col, max_features, tf=tf)
    return vec, transform(tf, vec)


def save_vocabulary(vec: Vectorizer, path: str) -> None:
    vec.vocabulary.withColumn("n_docs", F.lit(vec.n_docs).cast("bigint")).write.mode("overwrite").parquet(path)


def load_vocabulary(spark, path: str) -> Vectorizer:
    v = spark.read.parquet(path)
    n = v.select(F.max("n_docs")).first()[0] or 0
    return Vectorizer(vocabulary=v.drop("n_docs"), n_docs=int(n))
