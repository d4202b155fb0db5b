"""Vocabulary statistics and text difficulty (V1-V7).

Per-document statistics are array expressions on each row (map-only, no
shuffle).  Corpus maxima are one global aggregate with map-side partials; the
one-row result is broadcast back.  Global orderings use a range shuffle
(``global_row_number``), never a single-partition window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ranking import global_row_number
from ..functions.text import alpha_lower, c, explode_rows, safe_ratio, word_tokens


def vocab_scores(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
                 long_len: int = 8) -> DataFrame:
    """V1: alphabetic token count, vocabulary size, long-word vocabulary
    (length > ``long_len``) and lexical diversity (distinct / total; null for a
    document without alphabetic tokens)."""
    alpha = alpha_lower(word_tokens(text_col))
    return docs.select(c(id_col).alias(id_col), alpha.alias("_alpha")).select(
        id_col,
        F.size("_alpha").cast("long").alias("n_tokens"),
        F.size(F.array_distinct("_alpha")).cast("long").alias("vocab_size"),
        F.size(F.array_distinct(F.filter("_alpha", lambda t: F.length(t) > long_len)))
        .cast("long").alias("vocab_size_long"),
        safe_ratio(F.size(F.array_distinct("_alpha")), F.size("_alpha")).alias("diversity"),
    )


def corpus_max(scores: DataFrame, *, id_col: str = "doc_id",
               cols: tuple[str, ...] = ("vocab_size", "vocab_size_long")) -> DataFrame:
    """V2: corpus maximum of each score and the (smallest) id attaining it.
    One row; computed with partial aggregation on every partition."""
    aggs = []
    for col in cols:
        aggs.append(F.max(col).alias(f"max_{col}"))
        # max_by over (score, -id) picks the smallest id among ties
        aggs.append(F.max_by(id_col, F.struct(F.col(col), -F.col(id_col))).alias(f"max_{col}_{id_col}"))
    return scores.agg(*aggs)


def difficulty(scores: DataFrame) -> DataFrame:
    """V3: ``sqrt(x / max)`` normalisation and the equal-weight mean of
    (norm_vocab, norm_vocab_long, diversity)."""
    maxima = scores.agg(F.max("vocab_size").alias("_mv"), F.max("vocab_size_long").alias("_ml"))
    # one-row table: broadcast, the scores side is never shuffled
    j = scores.crossJoin(F.broadcast(maxima))
    nv = F.sqrt(safe_ratio("vocab_size", "_mv"))
    nl = F.sqrt(safe_ratio("vocab_size_long", "_ml"))
    return j.select(
        *scores.columns,
        nv.alias("norm_vocab"),
        nl.alias("norm_vocab_long"),
        ((nv + nl + F.col("diversity")) / F.lit(3.0)).alias("difficulty"),
    )


def argmax_rows(df: DataFrame, col: str) -> DataFrame:
    """V4: every row attaining the maximum of ``col`` (all ties)."""
    m = df.agg(F.max(col).alias("_m"))
    return df.join(F.broadcast(m), F.col(col) == F.col("_m"), "left_semi")


def difficulty_rank(scored: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """V5: ascending difficulty rank (ties by id) for every document."""
    return global_row_number(
        scored, [F.col("difficulty").asc_nulls_first(), F.col(id_col).asc()], name="rank"
    )


def token_counts(tokens: DataFrame, *, cols: tuple[str, ...]) -> DataFrame:
    """V6: corpus totals of token-array sizes (e.g. before and after a
    stop-word filter)."""
    return tokens.agg(*[F.sum(F.size(c_)).cast("long").alias(f"n_{c_}") for c_ in cols])


def term_stats(tokens: DataFrame, *, id_col: str = "doc_id", tokens_col: str = "tokens") -> DataFrame:
    """V7: term frequency (occurrences) and document frequency per term.

    Counted per document first, which stays in its task when the documents are
    dealt by their id (``by_key``); the aggregate by term then shuffles at
    most one row per term and task, so a term of every document weighs no more
    than a rare one."""
    ex = tokens.select(id_col, explode_rows(tokens_col, "term")).filter(F.col("term").isNotNull())
    per_doc = ex.groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("_tf"))
    return per_doc.groupBy("term").agg(
        F.sum("_tf").cast("long").alias("tf"), F.count(id_col).cast("long").alias("df")
    )
