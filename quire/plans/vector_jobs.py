"""Registered analyses: bag of words, TF-IDF and similarity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.partitioning import by_key, is_small
from ..functions.ranking import global_row_number
from ..functions.text import alpha_lower, word_tokens
from ..operators import similarity as Y
from ..operators import text as T
from ..operators import vectors as X
from ..session import stored
from . import sqlfrag as S
from . import sqlfrag_text as ST
from .registry import Tables, register

PAIR_THRESHOLD = 0.5
MIN_DF, MAX_DF = 0.2, 0.8
MAX_WORDS = 50_000  # frequent words named in a filter; above, n-grams of all words are counted

_ALPHA = S.alpha_lower(S.word_tokens("text"))
_TOKS = f"SELECT doc_id, {_ALPHA} AS tokens FROM documents"
_BOW = f"SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(tokens) AS term FROM ({_TOKS})) GROUP BY doc_id, term"
_N = "(SELECT count(*) FROM documents)"


def tokens(spark, sf) -> DataFrame:
    d = by_key(Tables(spark, sf).documents.select("doc_id", "text"), "doc_id")
    return d.select("doc_id", alpha_lower(word_tokens("text")).alias("tokens"))


def ratio_l2(spark, sf) -> DataFrame:
    t = tokens(spark, sf)
    w = X.tfidf(X.bow(t), X.count_docs(t), variant="ratio")
    return X.normalize(w, "l2")


def r6(df: DataFrame, *cols: str) -> DataFrame:
    for c_ in cols:
        df = df.withColumn(c_, F.round(c_, 6))
    return df


@register("X1_bow", sql=_BOW)
def q_bow(spark, sf):
    return X.bow(tokens(spark, sf))


@register("X1_vocabulary", sql=f"""
SELECT term, row_number() OVER (ORDER BY term) - 1 AS term_id, sum(tf)::BIGINT AS tf, count(*) AS df
FROM ({_BOW}) GROUP BY term
""")
def q_vocabulary(spark, sf):
    return X.vocabulary(X.bow(tokens(spark, sf)))


@register("X2_top_terms", sql=f"""
SELECT term, tf, df, term_id FROM (
  SELECT term, sum(tf)::BIGINT AS tf, count(*) AS df,
         row_number() OVER (ORDER BY sum(tf) DESC, term) - 1 AS term_id
  FROM ({_BOW}) GROUP BY term) WHERE term_id < 5000
""")
def q_top_terms(spark, sf):
    return X.top_terms(tokens(spark, sf), 5000)


@register("X2_count_vectors", sql=f"""
WITH top AS (SELECT term, term_id FROM (
  SELECT term, row_number() OVER (ORDER BY sum(tf) DESC, term) - 1 AS term_id FROM ({_BOW}) GROUP BY term) WHERE term_id < 5000)
SELECT b.doc_id, b.term, b.tf, top.term_id FROM ({_BOW}) b JOIN top USING (term)
""")
def q_count_vectors(spark, sf):
    return X.count_vectors(tokens(spark, sf), 5000).select("doc_id", "term", "tf", "term_id")


@register("X3_filter_df", sql=f"""
WITH b AS ({_BOW}), d AS (SELECT term, count(*) AS df FROM b GROUP BY term)
SELECT b.* FROM b JOIN d USING (term) WHERE d.df >= {MIN_DF} * {_N} AND d.df <= {MAX_DF} * {_N}
""")
def q_filter_df(spark, sf):
    t = tokens(spark, sf)
    return X.filter_df(X.bow(t), X.count_docs(t), min_df=MIN_DF, max_df=MAX_DF).select("doc_id", "term", "tf")


_RATIO = f"""
  b AS ({_BOW}),
  d AS (SELECT term, count(*) AS df FROM b GROUP BY term),
  l AS (SELECT doc_id, sum(tf) AS len FROM b GROUP BY doc_id),
  w AS (SELECT b.doc_id, b.term, b.tf, d.df,
               b.tf::DOUBLE / l.len::DOUBLE * ln({_N}::DOUBLE / d.df::DOUBLE) AS weight
        FROM b JOIN d USING (term) JOIN l USING (doc_id)),
  wn AS (SELECT doc_id, term, coalesce(weight / nullif(sqrt(sum(weight * weight) OVER (PARTITION BY doc_id)), 0), 0.0) AS weight FROM w)"""


@register("X4_tfidf_ratio", sql=f"WITH {_RATIO} SELECT doc_id, term, tf, df, round(weight, 6) AS weight FROM w")
def q_tfidf_ratio(spark, sf):
    t = tokens(spark, sf)
    return r6(X.tfidf(X.bow(t), X.count_docs(t), variant="ratio"), "weight")


_EN_GRAMS = f"""
  t AS (SELECT doc_id, {_ALPHA} AS tokens FROM documents),
  g AS (SELECT doc_id, unnest(flatten([{ST.ngrams('tokens', 1)}, {ST.ngrams('tokens', 2)}, {ST.ngrams('tokens', 3)}])) AS term FROM t),
  b AS (SELECT doc_id, term, count(*) AS tf FROM g GROUP BY doc_id, term),
  n AS (SELECT count(*) AS n FROM t),
  d AS (SELECT term, count(*) AS df FROM b GROUP BY term),
  keep AS (SELECT term, df FROM d, n WHERE df >= {MIN_DF} * n AND df <= {MAX_DF} * n),
  w AS (SELECT b.doc_id, b.term, b.tf, keep.df, b.tf * (ln((n + 1.0) / (keep.df + 1.0)) + 1.0) AS weight
        FROM b JOIN keep USING (term), n),
  wn AS (SELECT doc_id, term, tf, df, coalesce(weight / nullif(sqrt(sum(weight * weight) OVER (PARTITION BY doc_id)), 0), 0.0) AS weight FROM w)"""


def en_grams(spark, sf) -> DataFrame:
    """1- to 3-grams that may reach MIN_DF: a document holding one holds each
    of its words, so every word of it must reach MIN_DF by itself.  Those words
    are few: at most 1 / MIN_DF times the distinct words of a mean document."""
    t = tokens(spark, sf)
    known = stored(X.filter_df(X.bow(t), X.count_docs(t), min_df=MIN_DF).select("term").distinct(), "frequent-words")
    words = [r.term for r in known.collect()] if is_small(known, MAX_WORDS) else None
    return T.ngrams(t, 1, 3, out="grams", words=words).select("doc_id", F.col("grams").alias("tokens"))


def smooth_matrix(spark, sf) -> DataFrame:
    g = en_grams(spark, sf)
    n = X.count_docs(g)
    b = X.filter_df(X.bow(g), n, min_df=MIN_DF, max_df=MAX_DF)
    return X.normalize(X.tfidf(b, n, variant="smooth"), "l2")


@register("X5_tfidf_smooth", sql=f"WITH {_EN_GRAMS} SELECT doc_id, term, tf, df, round(weight, 6) AS weight FROM wn")
def q_tfidf_smooth(spark, sf):
    return r6(smooth_matrix(spark, sf), "weight")


@register("X6_tfidf_plain", sql=f"""
WITH b AS ({_BOW}), d AS (SELECT term, count(*) AS df FROM b GROUP BY term),
  w AS (SELECT b.doc_id, b.term, b.tf * (ln({_N}::DOUBLE / d.df::DOUBLE) + 1.0) AS weight FROM b JOIN d USING (term)),
  w2 AS (SELECT doc_id, term, coalesce(weight / nullif(sqrt(sum(weight * weight) OVER (PARTITION BY doc_id)), 0), 0.0) AS weight FROM w),
  w1 AS (SELECT doc_id, term, coalesce(weight / nullif(sum(abs(weight)) OVER (PARTITION BY doc_id), 0), 0.0) AS weight FROM w2)
SELECT doc_id, term, round(weight, 6) AS weight FROM w1
""")
def q_tfidf_plain(spark, sf):
    t = tokens(spark, sf)
    w = X.normalize(X.normalize(X.tfidf(X.bow(t), X.count_docs(t), variant="plain"), "l2"), "l1")
    return r6(w.select("doc_id", "term", "weight"), "weight")


@register("X7_minmax", sql=f"""
WITH {_RATIO}
SELECT doc_id, term, round(coalesce((weight - min(weight) OVER (PARTITION BY doc_id))
       / nullif(max(weight) OVER (PARTITION BY doc_id) - min(weight) OVER (PARTITION BY doc_id), 0), 0.0), 6) AS weight
FROM w
""")
def q_minmax(spark, sf):
    t = tokens(spark, sf)
    w = X.normalize(X.tfidf(X.bow(t), X.count_docs(t), variant="ratio"), "minmax")
    return r6(w.select("doc_id", "term", "weight"), "weight")


@register("X13_matrix_shape", sql=f"WITH {_EN_GRAMS} SELECT count(DISTINCT doc_id) AS n_docs, count(DISTINCT term) AS n_terms FROM wn WHERE weight <> 0")
def q_shape(spark, sf):
    w = smooth_matrix(spark, sf)
    return X.matrix_shape(w.filter(F.col("weight") != 0))


@register("X13_doc_weights", sql=f"""
WITH {_EN_GRAMS}
SELECT doc_id, term, round(weight, 6) AS weight FROM wn
WHERE doc_id = (SELECT min(doc_id) FROM wn) AND weight <> 0
""")
def q_doc_weights(spark, sf):
    w = smooth_matrix(spark, sf)
    first = w.agg(F.min("doc_id").alias("_first"))
    one = w.join(F.broadcast(first), F.col("doc_id") == F.col("_first"), "left_semi")
    return r6(one.filter(F.col("weight") != 0).select("doc_id", "term", "weight"), "weight")


# ---------------------------------------------------------------- similarity

_CLASSES = f"""
  sig AS (SELECT doc_id, list({{'term': term, 'w': round(weight, 9)}} ORDER BY term) AS sig FROM wn WHERE weight <> 0 GROUP BY doc_id),
  grp AS (SELECT sig, min(doc_id) AS rep, count(*) AS n FROM sig GROUP BY sig),
  mem AS (SELECT s.doc_id, g.rep FROM sig s JOIN grp g USING (sig)),
  wr AS (SELECT * FROM wn WHERE weight <> 0 AND doc_id IN (SELECT rep FROM grp)),
  rp AS (SELECT x.doc_id AS a, y.doc_id AS b, sum(x.weight * y.weight) AS score
         FROM wr x JOIN wr y ON x.term = y.term AND x.doc_id < y.doc_id
         GROUP BY x.doc_id, y.doc_id HAVING sum(x.weight * y.weight) >= {PAIR_THRESHOLD} - 1e-12),
  classes AS (SELECT rp.a, rp.b, rp.score, ga.n AS n_a, gb.n AS n_b, ga.n * gb.n AS n_pairs
              FROM rp JOIN grp ga ON ga.rep = rp.a JOIN grp gb ON gb.rep = rp.b
              UNION ALL SELECT rep, rep, 1.0, n, n, n * (n - 1) // 2 FROM grp WHERE n > 1),
  small AS (SELECT rep, doc_id AS m, r FROM (SELECT rep, doc_id, row_number() OVER (PARTITION BY rep ORDER BY doc_id) AS r FROM mem)
            WHERE r <= 6),
  docpairs AS (SELECT least(x.m, y.m) AS a, greatest(x.m, y.m) AS b, c.score FROM classes c
               JOIN small x ON x.rep = c.a JOIN small y ON y.rep = c.b WHERE c.a <> c.b OR x.m < y.m)"""


def classes(spark, sf):
    return Y.pair_classes(ratio_l2(spark, sf), PAIR_THRESHOLD)


@register("Y1_pair_cosine", sql=f"""
WITH {_RATIO}, {_CLASSES}
SELECT a, b, round(score, 6) AS score, n_a, n_b FROM classes WHERE a <> b
""")
def q_pairs(spark, sf):
    c_, _ = classes(spark, sf)
    return r6(c_.filter(F.col("a") != F.col("b")).select("a", "b", "score", "n_a", "n_b"), "score")


@register("Y1_copy_groups", sql=f"""
WITH {_RATIO}, {_CLASSES}
SELECT mem.doc_id, mem.rep FROM mem JOIN grp USING (rep) WHERE grp.n > 1
""")
def q_copy_groups(spark, sf):
    members, groups = Y.copy_groups(ratio_l2(spark, sf))
    return members.join(groups.filter(F.col("n") > 1), "rep", "left_semi").select("doc_id", "rep")


@register("Y2_score_list", sql=f"""
WITH {_RATIO}, {_CLASSES}
SELECT a, b, round(score, 6) AS score, n_pairs, row_number() OVER (ORDER BY round(score, 9), a, b) AS pos FROM classes
""")
def q_score_list(spark, sf):
    c_, _ = classes(spark, sf)
    ranked = global_row_number(c_.select("a", "b", "score", "n_pairs"),
                               [F.round("score", 9).asc(), F.col("a").asc(), F.col("b").asc()], name="pos")
    return r6(ranked, "score")


@register("Y2_pair_count", sql=f"""
WITH {_RATIO}, {_CLASSES}
SELECT (SELECT count(*) * (count(*) - 1) // 2 FROM documents)::BIGINT AS n_pairs, sum(n_pairs)::BIGINT AS n_above FROM classes
""")
def q_pair_count(spark, sf):
    total = Y.pair_count(Tables(spark, sf).documents)
    c_, _ = classes(spark, sf)
    above = c_.agg(F.sum("n_pairs").cast("long").alias("n_above"))
    return total.crossJoin(above)


@register("Y3_top_pairs", sql=f"""
WITH {_RATIO}, {_CLASSES}
SELECT a, b, round(score, 6) AS score FROM docpairs ORDER BY round(score, 9) DESC, a, b LIMIT 5
""")
def q_top_pairs(spark, sf):
    c_, members = classes(spark, sf)
    return r6(Y.top_doc_pairs(c_, members, 5), "score")


@register("Y4_extreme_pair_ranks", sql=f"""
WITH {_RATIO}, {_CLASSES},
  r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rank FROM documents),
  best AS (SELECT a, b, score FROM docpairs ORDER BY round(score, 9) DESC, a, b LIMIT 1)
SELECT best.a, best.b, round(best.score, 6) AS score, ra.rank AS rank_a, rb.rank AS rank_b
FROM best LEFT JOIN r ra ON ra.doc_id = best.a LEFT JOIN r rb ON rb.doc_id = best.b
""")
def q_extreme_pair(spark, sf):
    c_, members = classes(spark, sf)
    ranks = global_row_number(Tables(spark, sf).documents.select("doc_id"), [F.col("doc_id").asc()], name="rank")
    return r6(Y.extreme_pair_ranks(Y.top_doc_pairs(c_, members, 1), ranks), "score")


@register("Y9_cosine_distance", sql=f"""
WITH {_RATIO}, {_CLASSES} SELECT a, b, round(1.0 - score, 6) AS distance, n_pairs FROM classes
""")
def q_distance(spark, sf):
    c_, _ = classes(spark, sf)
    return r6(Y.cosine_distance(c_).select("a", "b", "distance", "n_pairs"), "distance")


# query-to-corpus search: benchmark items are the queries; they join the
# corpus before IDF.  Ids: documents keep doc_id >= 0, queries get -(item_id+1).

_SEARCH = f"""
  t AS (SELECT doc_id, {_ALPHA} AS tokens FROM documents
        UNION ALL SELECT -(item_id + 1) AS doc_id, {S.alpha_lower(S.word_tokens('text'))} AS tokens FROM benchmark),
  b AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(tokens) AS term FROM t) GROUP BY doc_id, term),
  d AS (SELECT term, count(*) AS df FROM b GROUP BY term),
  l AS (SELECT doc_id, sum(tf) AS len FROM b GROUP BY doc_id),
  w AS (SELECT b.doc_id, b.term, b.tf::DOUBLE / l.len::DOUBLE * ln((SELECT count(*) FROM t)::DOUBLE / d.df::DOUBLE) AS weight
        FROM b JOIN d USING (term) JOIN l USING (doc_id)),
  wn AS (SELECT doc_id, term, coalesce(weight / nullif(sqrt(sum(weight * weight) OVER (PARTITION BY doc_id)), 0), 0.0) AS weight FROM w),
  sc AS (SELECT -q.doc_id - 1 AS item_id, d.doc_id, sum(q.weight * d.weight) AS score
         FROM wn q JOIN wn d ON q.term = d.term AND q.doc_id < 0 AND d.doc_id >= 0 GROUP BY q.doc_id, d.doc_id)"""


@register("Y5_search", sql=f"""
WITH {_SEARCH}
SELECT item_id, arg_max(doc_id, (round(score, 9), -doc_id)) AS doc_id, round(max(score), 6) AS score FROM sc GROUP BY item_id
""")
def q_search(spark, sf):
    tb = Tables(spark, sf)
    docs = tb.documents.select("doc_id", "text")
    qs = tb.benchmark.select((-(F.col("item_id") + 1)).alias("doc_id"), "text")
    both = by_key(docs.unionByName(qs), "doc_id").select("doc_id", alpha_lower(word_tokens("text")).alias("tokens"))
    w = X.normalize(X.tfidf(X.bow(both), X.count_docs(both), variant="ratio"), "l2")
    wq = w.filter(F.col("doc_id") < 0).withColumn("query_id", -F.col("doc_id") - 1)
    wd = w.filter(F.col("doc_id") >= 0)
    res = Y.search(wd, wq)
    return r6(res.withColumnRenamed("query_id", "item_id"), "score")


# dense vectors (embeddings)
_COS = ("list_dot_product(a::DOUBLE[], b::DOUBLE[]) / nullif(sqrt(list_dot_product(a::DOUBLE[], a::DOUBLE[]))"
        " * sqrt(list_dot_product(b::DOUBLE[], b::DOUBLE[])), 0)")


def _cos_sql(a: str, b: str) -> str:
    return _COS.replace("a::", f"{a}::").replace("b::", f"{b}::")


@register("Y6_nearest", sql=f"""
WITH q AS (SELECT embedding AS qv FROM embeddings WHERE vec_id = (SELECT min(vec_id) FROM embeddings))
SELECT vec_id, round({_cos_sql('embedding', 'qv')}, 6) AS score FROM embeddings, q
WHERE vec_id <> (SELECT min(vec_id) FROM embeddings)
ORDER BY {_cos_sql('embedding', 'qv')} DESC, vec_id LIMIT 10
""")
def q_nearest(spark, sf):
    e = Tables(spark, sf).embeddings
    first = e.agg(F.min("vec_id")).first()[0]
    return r6(Y.nearest(e, first, 10), "score")


@register("Y7_farthest", sql=f"""
WITH q AS (SELECT embedding AS qv FROM embeddings WHERE vec_id = (SELECT min(vec_id) FROM embeddings))
SELECT vec_id, round({_cos_sql('embedding', 'qv')}, 6) AS score FROM embeddings, q
WHERE vec_id <> (SELECT min(vec_id) FROM embeddings)
ORDER BY {_cos_sql('embedding', 'qv')} ASC, vec_id LIMIT 10
""")
def q_farthest(spark, sf):
    e = Tables(spark, sf).embeddings
    first = e.agg(F.min("vec_id")).first()[0]
    return r6(Y.nearest(e, first, 10, ascending=True), "score")


@register("Y8_similarity", sql=f"""
SELECT x.vec_id AS a, y.vec_id AS b, round({_cos_sql('x.embedding', 'y.embedding')}, 6) AS score
FROM embeddings x, embeddings y
WHERE x.vec_id = (SELECT min(vec_id) FROM embeddings) AND y.vec_id = (SELECT max(vec_id) FROM embeddings)
""")
def q_similarity(spark, sf):
    e = Tables(spark, sf).embeddings
    lo, hi = e.agg(F.min("vec_id"), F.max("vec_id")).first()
    return r6(Y.similarity(e, lo, hi), "score")


@register("Y11_probe_extremes", sql=f"""
WITH r AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS rank FROM embeddings),
  qs AS (SELECT 'first' AS which, (SELECT arg_min(vec_id, rank) FROM r) AS qid
         UNION ALL SELECT 'last', (SELECT arg_max(vec_id, rank) FROM r)),
  s AS (SELECT which, qid, e.vec_id, {_cos_sql('e.embedding', 'q.embedding')} AS score
        FROM qs JOIN embeddings q ON q.vec_id = qs.qid JOIN embeddings e ON e.vec_id <> qs.qid),
  rk AS (SELECT *, row_number() OVER (PARTITION BY which ORDER BY score DESC, vec_id) AS near_rank,
                   row_number() OVER (PARTITION BY which ORDER BY score ASC, vec_id) AS far_rank FROM s)
SELECT which, qid, 'nearest' AS kind, vec_id, round(score, 6) AS score, near_rank AS pos FROM rk WHERE near_rank <= 10
UNION ALL
SELECT which, qid, 'farthest' AS kind, vec_id, round(score, 6) AS score, far_rank AS pos FROM rk WHERE far_rank <= 10
""")
def q_probe(spark, sf):
    e = Tables(spark, sf).embeddings
    ranks = global_row_number(e.select("vec_id"), [F.col("vec_id").asc()], name="rank")
    return r6(Y.probe_extremes(e, ranks, 10), "score")
