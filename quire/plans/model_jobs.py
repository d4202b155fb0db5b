"""Registered analyses: clustering (C1-C9), fitted topic models (M1-M5, M8,
M19), supervised models (L2-L8, L16) and stream scoring (L18).  Fitted
models get rows checks here and property tests in ``tests/``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.partitioning import by_key, spread
from ..functions.text import alpha_lower, word_tokens
from ..operators import cluster as C
from ..operators import learn as L
from ..operators import sentiment as W
from ..operators import topics as M
from ..operators import vectors as X
from ..session import stored
from ..sources.files import corpus_path
from ..streaming.scoring import score_stream, table_stream
from . import sentiment_jobs as SJ
from .registry import Tables, register

_CENTS = """
  ex AS (SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings),
  cd AS (SELECT label, dim, avg(x) AS x FROM ex GROUP BY label, dim),
  cents AS (SELECT label, list(x ORDER BY dim) AS c FROM cd GROUP BY label),
  dist AS (SELECT e.vec_id, e.label AS planted, c.label,
                  list_sum(list_transform(range(1, len(e.embedding) + 1),
                           lambda i: (e.embedding[i]::DOUBLE - c.c[i]) * (e.embedding[i]::DOUBLE - c.c[i]))) AS d
           FROM embeddings e, cents c)"""


def emb(spark, sf) -> DataFrame:
    return spread(Tables(spark, sf).embeddings, "vec_id")


@register("C4_centroids", sql="""
SELECT label, dim, round(avg(x), 6) AS value FROM (
  SELECT label, generate_subscripts(embedding, 1) - 1 AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings)
GROUP BY label, dim
""")
def q_centroids(spark, sf):
    c_ = C.centroids(emb(spark, sf))
    return c_.select("label", F.posexplode("centroid").alias("dim", "value")).select(
        "label", F.col("dim").cast("long").alias("dim"), F.round("value", 6).alias("value"))


@register("C2_assign", sql=f"""
WITH {_CENTS}
SELECT vec_id, arg_min(label, (d, label)) AS cluster, round(min(d), 6) AS sq_dist FROM dist GROUP BY vec_id
""")
def q_assign(spark, sf):
    e = emb(spark, sf)
    return C.assign(e, C.centroids(e)).withColumn("sq_dist", F.round("sq_dist", 6))


@register("C3_cluster_sizes", sql=f"""
WITH {_CENTS}, a AS (SELECT vec_id, arg_min(label, (d, label)) AS cluster FROM dist GROUP BY vec_id)
SELECT cluster, count(*) AS n FROM a GROUP BY cluster
""")
def q_sizes(spark, sf):
    e = emb(spark, sf)
    return C.cluster_members(C.assign(e, C.centroids(e)))


@register("C5_representatives", sql=f"""
WITH {_CENTS}
SELECT label, arg_min(vec_id, (sqrt(d), vec_id)) AS vec_id, round(min(sqrt(d)), 6) AS dist FROM dist
WHERE planted = label GROUP BY label
""")
def q_representatives(spark, sf):
    e = emb(spark, sf)
    r = C.representatives(e, e.select("vec_id", "label"), C.centroids(e))
    return r.withColumn("dist", F.round("dist", 6))


@register("C9_scale01", sql="""
WITH ex AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings),
  r AS (SELECT dim, min(x) AS lo, max(x) AS hi FROM ex GROUP BY dim)
SELECT vec_id, dim, round(coalesce((x - lo) / nullif(hi - lo, 0), 0.0), 6) AS value FROM ex JOIN r USING (dim)
""")
def q_scale01(spark, sf):
    s = C.scale01(emb(spark, sf).select("vec_id", "embedding"), col="embedding")
    return s.select("vec_id", F.posexplode("embedding").alias("dim", "value")).select(
        "vec_id", F.col("dim").cast("long").alias("dim"), F.round("value", 6).alias("value"))


@register("C1_kmeans_sizes")
def q_kmeans(spark, sf):
    _, assigned = C.kmeans(emb(spark, sf), 10, seed=111, max_iter=50)
    return C.cluster_members(assigned)


@register("C8_pca")
def q_pca(spark, sf):
    p = C.project(emb(spark, sf), 3)
    return p.select("vec_id", F.posexplode("coords").alias("dim", "value"))


@register("C6_hierarchical_ward")
def q_ward(spark, sf):
    labels, _ = C.hierarchical(emb(spark, sf), 5, linkage="ward")
    return labels


@register("C7_hierarchical_average")
def q_average(spark, sf):
    labels, _ = C.hierarchical(emb(spark, sf), 5, linkage="average")
    return labels


# ------------------------------------------------------------ topic models

def count_matrix(spark, sf, n_terms: int = 5000):
    """Documents as count vectors over the top ``n_terms`` terms."""
    d = spread(Tables(spark, sf).documents.select("doc_id", "text"), "doc_id")
    t = d.select("doc_id", alpha_lower(word_tokens("text")).alias("tokens"))
    vecs, cv = X.mllib_count_vectors(t, n_terms)
    return vecs.select("doc_id", "features"), cv.vocabulary


def lda(spark, sf, optimizer: str):
    vecs, vocab = count_matrix(spark, sf)
    vecs = vecs.cache()
    model = M.fit_lda(vecs, 5, optimizer=optimizer, max_iter=10, seed=222)
    return model, vecs, vocab


@register("M1_lda_topics")
def q_lda(spark, sf):
    model, _, vocab = lda(spark, sf, "online")
    return M.top_words(M.lda_topics(model, vocab, 10), 10)


@register("M2_lda_em_topics")
def q_lda_em(spark, sf):
    model, _, vocab = lda(spark, sf, "em")
    return M.top_words(M.lda_topics(model, vocab, 10), 10)


@register("M8_perplexity")
def q_perplexity(spark, sf):
    model, vecs, _ = lda(spark, sf, "online")
    return spark.createDataFrame([(5, M.perplexity(model, vecs))], "k int, log_perplexity double")


def tfidf_vectors(spark, sf, n_terms: int = 2000):
    """Plain TF-IDF (L2 then L1) of the top terms as dense vectors."""
    d = by_key(Tables(spark, sf).documents.select("doc_id", "text"), "doc_id")
    t = d.select("doc_id", alpha_lower(word_tokens("text")).alias("tokens"))
    vocab = stored(X.top_terms(t, n_terms).select("term", "term_id"), "top-terms")  # n_terms rows
    cv = X.count_vectors(t, n_terms, vocab=vocab)
    dfs = stored(X.term_stats_from_bow(cv), "top-terms-df")  # n_terms rows
    w = X.normalize(X.normalize(X.tfidf(cv.join(F.broadcast(dfs), "term"), X.count_docs(t), variant="plain"), "l2"), "l1")
    return w.join(F.broadcast(vocab), "term"), vocab


@register("M4_lsi_concepts")
def q_lsi(spark, sf):
    w, vocab = tfidf_vectors(spark, sf, 1000)
    concepts, _, _ = M.lsi(X.dense_vectors(w, 1000), 5)
    named = concepts.join(vocab, "term_id").select("topic", "term", "weight")
    return M.top_words(named, 6, by_abs=True)


@register("M5_nmf_topics")
def q_nmf(spark, sf):
    w, vocab = tfidf_vectors(spark, sf, 500)
    x = w.select("doc_id", "term_id", F.col("weight").alias("value"))
    _, H, _ = M.nmf(x, 5, max_iter=20)
    rows = [(int(k), int(t), float(H[k, t])) for k in range(H.shape[0]) for t in range(H.shape[1]) if H[k, t] > 0]
    topics = spark.createDataFrame(rows, "topic int, term_id long, weight double").join(vocab, "term_id")
    return M.top_words(topics.select("topic", "term", "weight"), 10)


# -------------------------------------------------------------- learning

def labelled_vectors(spark, sf):
    e = emb(spark, sf).withColumn("y", (F.col("label") == 0).cast("double"))
    e = C.to_ml(e, "embedding")
    test = L.sample(e, 0.2, seed=7, id_col="vec_id")
    train = e.join(test.select("vec_id"), "vec_id", "left_anti")
    return train, test


@register("L5_logit_error")
def q_logit(spark, sf):
    train, test = labelled_vectors(spark, sf)
    model = L.fit_logistic(train, reg=0.0)
    return L.error_rate(L.predict(model, test))


@register("L6_logistic_scores")
def q_logistic(spark, sf):
    train, test = labelled_vectors(spark, sf)
    model = L.fit_logistic(train, reg=0.01)
    return L.evaluate(model, {"train": train, "test": test})


@register("L7_mlp_scores")
def q_mlp(spark, sf):
    train, test = labelled_vectors(spark, sf)
    model = L.fit_mlp(train, [64, 64, 32, 16, 8, 2], max_iter=50)
    return L.evaluate(model, {"train": train, "test": test})


@register("L8_predict")
def q_predict(spark, sf):
    train, test = labelled_vectors(spark, sf)
    model = L.fit_logistic(train, reg=0.01)
    return L.predict(model, test)


@register("L16_evaluate_sets")
def q_evaluate(spark, sf):
    train, test = labelled_vectors(spark, sf)
    model = L.fit_logistic(train, reg=0.01)
    return L.evaluate(model, {"train": train, "test": test, "all": train.unionByName(test)})


@register("L2_shuffle", sql="SELECT count(*) AS n, count(DISTINCT doc_id) AS n_ids FROM documents")
def q_shuffle(spark, sf):
    s = L.shuffle(Tables(spark, sf).documents.select("doc_id"), seed=3)
    return s.agg(F.count(F.lit(1)).cast("long").alias("n"), F.countDistinct("doc_id").cast("long").alias("n_ids"))


@register("L3_sample", sql="""
SELECT doc_id, lang FROM documents
WHERE ((doc_id + 11 * 7919)::DOUBLE * 0.6180339887498949) - floor((doc_id + 11 * 7919)::DOUBLE * 0.6180339887498949) < 0.25
""")
def q_sample(spark, sf):
    return L.sample(Tables(spark, sf).documents.select("doc_id", "lang"), 0.25, seed=11)


# ------------------------------------------------------------ streaming

@register("L18_stream_scores", sql=f"WITH {SJ._LEX}, {SJ._W2} SELECT doc_id, score, label FROM w2")
def q_stream(spark, sf):
    lex = SJ.lexicon(spark, sf)

    def scorer(batch: DataFrame) -> DataFrame:
        toks = batch.select("doc_id", "text", alpha_lower(word_tokens("text")).alias("tokens"))
        return W.valence_sum(toks, lex)

    run = uuid.uuid4().hex[:8]
    out = corpus_path(spark, f"stream_scores_{run}")
    q = score_stream(table_stream(spark, f"{sf.rstrip('/')}/documents.parquet"), scorer, out, corpus_path(spark, f"stream_ckpt_{run}"))
    q.awaitTermination()
    return spark.read.parquet(out).select("doc_id", "score", "label")


# ------------------------------------------------------------ oversampling

def _binary(spark, sf) -> DataFrame:
    """Embeddings with an imbalanced binary label: y = 1 for planted cluster 0."""
    return emb(spark, sf).withColumn("y", (F.col("label") == 0).cast("int")).select("vec_id", "embedding", "y")


_OVERSAMPLE = """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v, label = 0 AS minor FROM embeddings),
c AS (SELECT count(*) FILTER (minor) AS n_min, count(*) FILTER (NOT minor) AS n_maj FROM e),
near(id, nid, rank, maj) AS (
  SELECT a.vec_id, b.vec_id, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id), NOT b.minor
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.minor{among}),
nn AS (SELECT * FROM near WHERE rank <= 5),"""
_MINOR_NN = """
own(id, nid, rank) AS (
  SELECT a.vec_id, b.vec_id, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.v, b.v), b.vec_id)
  FROM e a JOIN e b ON a.vec_id <> b.vec_id WHERE a.minor AND b.minor),"""
_INTERPOLATED = """
k AS (SELECT id, count(*) AS kk FROM {nn} WHERE rank <= 5 GROUP BY id),
jobs AS (SELECT id, kk, unnest(range(0, cnt)) AS j FROM given JOIN k USING (id)),
placed AS (
  SELECT id, j, a.v AS x, b.v AS y, ((id * 7919 + j * 104729) % 1000003)::DOUBLE / 1000003.0 AS u
  FROM jobs JOIN {nn} nb USING (id) JOIN e a ON a.vec_id = id JOIN e b ON b.vec_id = nid WHERE nb.rank = j % kk + 1)
SELECT id AS base_id, j::BIGINT AS j, [p[1] + u * (p[2] - p[1]) for p in list_zip(x, y)] AS embedding FROM placed
"""


@register("L13_smote", sql=_OVERSAMPLE.format(among=" AND b.minor") + """
g AS (SELECT n_min, greatest(n_maj - n_min, 0) AS total FROM c),
given AS (
  SELECT vec_id AS id, total // n_min + (row_number() OVER (ORDER BY vec_id) - 1 < total % n_min)::INTEGER AS cnt
  FROM e, g WHERE minor),""" + _INTERPOLATED.format(nn="nn"))
def q_smote(spark, sf):
    from ..operators.knn import smote

    return smote(_binary(spark, sf), k=5).select("base_id", "j", "embedding")


@register("L14_adasyn", sql=_OVERSAMPLE.format(among="") + _MINOR_NN + """
ratio AS (SELECT id, avg(maj::INTEGER::DOUBLE) AS ri FROM nn GROUP BY id),
given AS (
  SELECT id, CASE WHEN sr > 0 THEN round(ri / sr * greatest(n_maj - n_min, 0))::BIGINT ELSE 0 END AS cnt
  FROM ratio, (SELECT sum(ri) AS sr FROM ratio), c),""" + _INTERPOLATED.format(nn="own"))
def q_adasyn(spark, sf):
    from ..operators.knn import adasyn

    return adasyn(_binary(spark, sf), k=5).select("base_id", "j", "embedding")


@register("L15_smote_class_counts", sql="""
SELECT cls, n FROM (
  SELECT 0 AS cls, count(*) FILTER (WHERE label <> 0) AS n FROM embeddings
  UNION ALL SELECT 1, count(*) FILTER (WHERE label = 0) + greatest(count(*) FILTER (WHERE label <> 0) - count(*) FILTER (WHERE label = 0), 0)
  FROM embeddings)
""")
def q_smote_counts(spark, sf):
    from ..operators.knn import smote

    b = _binary(spark, sf)
    synth = smote(b, k=5).select(F.lit(1).alias("y"))
    return L.class_counts(b.select("y").unionByName(synth), col="y").withColumn("cls", F.col("cls").cast("int"))
