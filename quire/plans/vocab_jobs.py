"""Registered analyses: vocabulary statistics and difficulty (V1-V7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.partitioning import spread
from ..functions.text import alpha_lower, word_tokens
from ..operators import vocab as V
from . import sqlfrag as S
from .difficulty import rank_by_difficulty
from .registry import Tables, register

_ALPHA = S.alpha_lower(S.word_tokens("text"))

_SCORES_SQL = f"""
  s AS (
    SELECT doc_id, len(a) AS n_tokens, len(list_distinct(a)) AS vocab_size,
           len(list_distinct(list_filter(a, lambda t: length(t) > 8))) AS vocab_size_long,
           {S.ratio('len(list_distinct(a))', 'len(a)')} AS diversity
    FROM (SELECT doc_id, {_ALPHA} AS a FROM documents)
  )"""


@register("V5_difficulty_rank", sql=f"""
WITH {_SCORES_SQL},
  m AS (SELECT max(vocab_size) AS mv, max(vocab_size_long) AS ml FROM s),
  d AS (SELECT s.*, sqrt({S.ratio('vocab_size', 'mv')}) AS nv, sqrt({S.ratio('vocab_size_long', 'ml')}) AS nl
        FROM s CROSS JOIN m)
SELECT doc_id, n_tokens, vocab_size, vocab_size_long, round(diversity, 6) AS diversity,
       round(nv, 6) AS norm_vocab, round(nl, 6) AS norm_vocab_long,
       round((nv + nl + diversity) / 3.0, 6) AS difficulty,
       row_number() OVER (ORDER BY (nv + nl + diversity) / 3.0 ASC NULLS FIRST, doc_id) AS rank
FROM d
""")
def q_difficulty_rank(spark, sf):
    return rank_by_difficulty(Tables(spark, sf).documents)


@register("V1_vocab_scores", sql=f"""
WITH {_SCORES_SQL}
SELECT doc_id, n_tokens, vocab_size, vocab_size_long, round(diversity, 6) AS diversity FROM s
""")
def q_vocab_scores(spark, sf):
    docs = spread(Tables(spark, sf).documents.select("doc_id", "text"), "doc_id")
    return V.vocab_scores(docs).withColumn("diversity", F.round("diversity", 6))


@register("V2_corpus_max", sql=f"""
WITH {_SCORES_SQL}
SELECT max(vocab_size) AS max_vocab_size,
       min(doc_id) FILTER (WHERE vocab_size = (SELECT max(vocab_size) FROM s)) AS max_vocab_size_doc_id,
       max(vocab_size_long) AS max_vocab_size_long,
       min(doc_id) FILTER (WHERE vocab_size_long = (SELECT max(vocab_size_long) FROM s)) AS max_vocab_size_long_doc_id
FROM s
""")
def q_corpus_max(spark, sf):
    docs = spread(Tables(spark, sf).documents.select("doc_id", "text"), "doc_id")
    return V.corpus_max(V.vocab_scores(docs))


@register("V4_argmax_difficulty", sql=f"""
WITH {_SCORES_SQL},
  m AS (SELECT max(vocab_size) AS mv, max(vocab_size_long) AS ml FROM s),
  d AS (SELECT doc_id, (sqrt({S.ratio('vocab_size', 'mv')}) + sqrt({S.ratio('vocab_size_long', 'ml')}) + diversity) / 3.0 AS difficulty
        FROM s CROSS JOIN m)
SELECT doc_id, round(difficulty, 6) AS difficulty FROM d WHERE difficulty = (SELECT max(difficulty) FROM d)
""")
def q_argmax_difficulty(spark, sf):
    docs = spread(Tables(spark, sf).documents.select("doc_id", "text"), "doc_id")
    d = V.difficulty(V.vocab_scores(docs))
    return V.argmax_rows(d, "difficulty").select("doc_id", F.round("difficulty", 6).alias("difficulty"))


@register("V7_term_stats", sql=f"""
SELECT term, count(*) AS tf, count(DISTINCT doc_id) AS df
FROM (SELECT doc_id, unnest({_ALPHA}) AS term FROM documents)
GROUP BY term
""")
def q_term_stats(spark, sf):
    docs = spread(Tables(spark, sf).documents.select("doc_id", "text"), "doc_id")
    toks = docs.select("doc_id", alpha_lower(word_tokens("text")).alias("tokens"))
    return V.term_stats(toks)
