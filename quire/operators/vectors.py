"""Bag of words, document-frequency filters and TF-IDF.

Long format ``(doc_id, term, tf)`` is the working representation: it is what
a sparse matrix is at scale, and joins on ``term`` / windows on ``doc_id`` are
planned by Catalyst.  Term tables derived from the data carry no broadcast
hint: AQE turns the shuffle join into a broadcast at run time only when the
finished term stage measures small.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from ..functions.ranking import global_row_number
from ..functions.text import explode_rows
from .vocab import term_stats

DENSE_ROWS = 256  # dense vectors filled at once


def attach(big: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join a data-derived term table.  No hint: with AQE the join is planned
    as a shuffle join and switched to a broadcast at run time only when the
    measured size of the finished ``small`` stage is under
    ``spark.sql.adaptive.autoBroadcastJoinThreshold`` -- a size check with the
    shuffle join as the fallback, and no extra counting job."""
    return big.join(small, on, how)


def bow(tokens: DataFrame, *, id_col: str = "doc_id", tokens_col: str = "tokens") -> DataFrame:
    """``(doc_id, term, tf)``, one row per distinct term of a document.
    Documents without tokens have no rows; ``doc_lengths`` keeps them."""
    ex = tokens.select(id_col, explode_rows(tokens_col, "term")).filter(F.col("term").isNotNull())
    return ex.groupBy(id_col, "term").agg(F.count(F.lit(1)).cast("long").alias("tf"))


def doc_lengths(tokens: DataFrame, *, id_col: str = "doc_id", tokens_col: str = "tokens") -> DataFrame:
    return tokens.select(id_col, F.size(tokens_col).cast("long").alias("len"))


def vocabulary(b: DataFrame) -> DataFrame:
    """Dense ``term_id`` (0-based, alphabetical) with tf and df per term."""
    stats = b.groupBy("term").agg(F.sum("tf").cast("long").alias("tf"), F.count(F.lit(1)).cast("long").alias("df"))
    ranked = global_row_number(stats, [F.col("term").asc()], name="term_id")
    return ranked.withColumn("term_id", F.col("term_id") - 1)


def top_terms(tokens: DataFrame, n: int = 5000, *, id_col: str = "doc_id", tokens_col: str = "tokens") -> DataFrame:
    """The ``n`` most frequent terms (ties alphabetical) with their
    position as ``term_id``; a distributed top-k (TakeOrderedAndProject)."""
    stats = term_stats(tokens, id_col=id_col, tokens_col=tokens_col)
    top = stats.orderBy(F.desc("tf"), F.asc("term")).limit(n)
    return top.withColumn("term_id", F.row_number().over(Window.orderBy(F.desc("tf"), F.asc("term"))).cast("long") - 1)


def count_vectors(tokens: DataFrame, n: int = 5000, *, vocab: DataFrame | None = None, id_col: str = "doc_id",
                  tokens_col: str = "tokens") -> DataFrame:
    """Bag of words restricted to the top-``n`` vocabulary (long format
    with ``term_id``); ``vocab`` if that is at hand."""
    if vocab is None:
        vocab = top_terms(tokens, n, id_col=id_col, tokens_col=tokens_col).select("term", "term_id")
    # the top-n table is bounded by ``n``: broadcast
    return bow(tokens, id_col=id_col, tokens_col=tokens_col).join(F.broadcast(vocab), "term")


def mllib_count_vectors(tokens: DataFrame, n: int = 5000, *, tokens_col: str = "tokens", out: str = "features"):
    """X2 on MLlib: sparse ``features`` vectors from ``CountVectorizer``."""
    from pyspark.ml.feature import CountVectorizer

    model = CountVectorizer(inputCol=tokens_col, outputCol=out, vocabSize=n).fit(tokens)
    return model.transform(tokens), model


def doc_freq(b: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    return term_stats_from_bow(b, id_col=id_col)


def term_stats_from_bow(b: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """df per term from a bag of words; counted in every task first, so a term
    of every document sends one row per task."""
    return b.groupBy("term").agg(F.count(F.lit(1)).cast("long").alias("df"))


def filter_df(b: DataFrame, n_docs: DataFrame, *, min_df: float = 0.0, max_df: float = 1.0,
              id_col: str = "doc_id") -> DataFrame:
    """Keep terms whose document count lies in ``[min_df*N, max_df*N]``
    (fractions of the ``N`` documents in the one-row ``n_docs``)."""
    dfs = term_stats_from_bow(b, id_col=id_col).crossJoin(F.broadcast(n_docs))
    keep = dfs.filter((F.col("df") >= F.lit(min_df) * F.col("n_docs")) & (F.col("df") <= F.lit(max_df) * F.col("n_docs")))
    # the kept terms keep their document frequency: a later ``tfidf`` reuses it
    return attach(b, keep.select("term", "df"), "term")


def count_docs(docs: DataFrame) -> DataFrame:
    return docs.agg(F.count(F.lit(1)).cast("long").alias("n_docs"))


def tfidf(b: DataFrame, n_docs: DataFrame, *, variant: str = "ratio", lengths: DataFrame | None = None,
          id_col: str = "doc_id") -> DataFrame:
    """TF-IDF weights ``(doc_id, term, tf, df, weight)``.

    * ``ratio`` (X4): ``tf / len * ln(N / df)``, ``len`` = tokens in the document
    * ``smooth`` (X5): ``tf * (ln((1 + N) / (1 + df)) + 1)``
    * ``plain`` (X6): ``tf * (ln(N / df) + 1)``
    Normalisation is a separate step (``normalize``).  A bag of words that
    already carries ``df`` (from ``filter_df``) is not counted again."""
    j = b
    if variant == "ratio":
        # lengths first, while the rows still lie by document
        if lengths is None:
            j = b.filter(F.col(id_col).isNotNull()).withColumn("len", F.sum("tf").over(Window.partitionBy(id_col)))
        else:
            j = b.join(lengths, id_col)
    if "df" not in b.columns:
        j = attach(j, term_stats_from_bow(b, id_col=id_col), "term")
    j = j.crossJoin(F.broadcast(n_docs))
    N, df, tf = F.col("n_docs").cast("double"), F.col("df").cast("double"), F.col("tf").cast("double")
    if variant == "ratio":
        w = tf / F.col("len").cast("double") * F.ln(N / df)
    elif variant == "smooth":
        w = tf * (F.ln((N + 1.0) / (df + 1.0)) + 1.0)
    elif variant == "plain":
        w = tf * (F.ln(N / df) + 1.0)
    else:
        raise ValueError(variant)
    return j.select(id_col, "term", "tf", "df", w.alias("weight"))


def normalize(w: DataFrame, norm: str = "l2", *, id_col: str = "doc_id", col: str = "weight") -> DataFrame:
    """Per-document ``l2`` / ``l1`` normalisation, or ``minmax`` scaling
    of the weights within each document.  A zero vector stays zero."""
    per_doc = Window.partitionBy(id_col)
    if norm == "l2":
        den = F.sqrt(F.sum(F.col(col) * F.col(col)).over(per_doc))
        return w.withColumn(col, F.coalesce(F.try_divide(F.col(col), den), F.lit(0.0)))
    if norm == "l1":
        den = F.sum(F.abs(F.col(col))).over(per_doc)
        return w.withColumn(col, F.coalesce(F.try_divide(F.col(col), den), F.lit(0.0)))
    if norm == "minmax":
        lo, hi = F.min(col).over(per_doc), F.max(col).over(per_doc)
        return w.withColumn(col, F.coalesce(F.try_divide(F.col(col) - lo, hi - lo), F.lit(0.0)))
    raise ValueError(norm)


def matrix_shape(w: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """Number of documents and of terms with a non-zero weight."""
    return w.agg(F.countDistinct(id_col).cast("long").alias("n_docs"), F.countDistinct("term").cast("long").alias("n_terms"))


def doc_weights(w: DataFrame, doc_id, *, id_col: str = "doc_id", col: str = "weight") -> DataFrame:
    """One document's non-zero weights, largest first."""
    return w.filter((F.col(id_col) == F.lit(doc_id)) & (F.col(col) != 0)).orderBy(F.desc(col), "term")


def concat_vectors(a: DataFrame, b: DataFrame, *, id_col: str = "doc_id", col_a: str = "vec", col_b: str = "vec") -> DataFrame:
    """Concatenation of two vector columns of the same documents."""
    return a.select(id_col, F.col(col_a).alias("_a")).join(b.select(id_col, F.col(col_b).alias("_b")), id_col).select(
        id_col, F.concat("_a", "_b").alias("vec")
    )



def dense_vectors(w: DataFrame, size: int, *, id_col: str = "doc_id", index_col: str = "term_id",
                  value_col: str = "weight", out: str = "features") -> DataFrame:
    """Long ``(doc_id, term_id, weight)`` rows to one ML dense vector per
    document (``size`` columns).  Entries are grouped per document, then a
    numpy scatter over Arrow batches fills the vectors (a map lookup per column
    would be a linear scan per element), DENSE_ROWS at a time, so that a task's
    memory does not depend on the batch it is given."""
    from pyspark.ml.functions import array_to_vector

    def scatter(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, DENSE_ROWS):
                part = batch.slice(at, DENSE_ROWS)
                d = np.zeros((part.num_rows, size))
                for row, i, v in zip(d, part.column(1), part.column(2)):
                    row[i.values.to_numpy()] = v.values.to_numpy(zero_copy_only=False)
                ends = np.arange(part.num_rows + 1, dtype=np.int32) * size
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(ends, d.ravel())], [id_col, "_d"])

    g = w.groupBy(id_col).agg(F.collect_list(index_col).alias("_i"), F.collect_list(F.col(value_col).cast("double")).alias("_v"))
    schema = StructType([StructField(id_col, g.schema[id_col].dataType), StructField("_d", ArrayType(DoubleType()))])
    return g.mapInArrow(scatter, schema).select(id_col, array_to_vector("_d").alias(out))
