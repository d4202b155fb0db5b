"""Fitted models against numpy, planted structure and hand counts (L5-L8, L14,
L16, C8, M2, M8, M19, X11)."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from quire.operators import cluster as C
from quire.operators import learn as L
from quire.operators import topics as M
from quire.operators import vectors as X
from quire.operators.knn import adasyn, knn
from quire.plans.more_jobs import mean_vectors


def labelled(spark, n=300, dim=3, seed=1, noise=1.0):
    rnd = np.random.default_rng(seed)
    x = rnd.normal(size=(n, dim))
    y = (x @ np.arange(1, dim + 1) + noise * rnd.normal(size=n) * 2 > 0.5).astype(float)
    df = spark.createDataFrame([(i, v.tolist(), float(t)) for i, (v, t) in enumerate(zip(x, y))], "vec_id long, e array<double>, y double")
    return x, y, df.select("vec_id", array_to_vector("e").alias("features"), "y").cache()


def newton(x, y, steps=50):
    """Maximum-likelihood logistic regression with an intercept."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-a @ w))
        w += np.linalg.solve((a * (p * (1 - p))[:, None]).T @ a, a.T @ (y - p))
    return w


def test_unregularised_logistic_is_the_maximum_likelihood_fit(spark):
    x, y, df = labelled(spark)
    model = L.fit_logistic(df, reg=0.0)
    w = newton(x, y)
    assert np.allclose([*model.coefficients.toArray(), model.intercept], w, rtol=1e-3, atol=1e-3)
    p = 1 / (1 + np.exp(-(x @ w[:-1] + w[-1])))
    got = {r.vec_id: r for r in L.predict(model, df).collect()}
    assert all(abs(got[i].p - p[i]) < 1e-3 for i in got)
    wrong = np.mean([round(got[i].p) != y[i] for i in got])
    assert 0 < wrong < 0.25 and L.error_rate(L.predict(model, df)).first()[0] == pytest.approx(wrong)


def test_penalty_shrinks_and_threshold_moves_predictions(spark):
    _, y, df = labelled(spark)
    sizes = [np.linalg.norm(L.fit_logistic(df, reg=r).coefficients.toArray()) for r in (0.0, 0.1, 1.0)]
    assert sizes[0] > sizes[1] > sizes[2] > 0
    model = L.fit_logistic(df, reg=0.1)
    for t in (0.2, 0.5, 0.9):
        rows = L.predict(model, df, threshold=t).collect()
        assert all(r.yhat == int(r.p > t) for r in rows)
    parts = {"low": df.filter("vec_id < 100"), "high": df.filter("vec_id >= 100")}
    rows = {r.vec_id: r.yhat == y[r.vec_id] for r in L.predict(model, df).collect()}
    got = {r.set: (r.accuracy, r.n) for r in L.evaluate(model, parts).collect()}
    assert got == {"low": (pytest.approx(np.mean([rows[i] for i in range(100)])), 100),
                   "high": (pytest.approx(np.mean([rows[i] for i in range(100, 300)])), 200)}
    assert got["high"][0] > max(np.mean(y), 1 - np.mean(y)) + 0.1


def test_network_learns_what_no_line_separates(spark):
    rnd = np.random.default_rng(4)
    x = rnd.uniform(-1, 1, (400, 2))
    y = ((x[:, 0] > 0) != (x[:, 1] > 0)).astype(float)
    df = spark.createDataFrame([(i, v.tolist(), float(t)) for i, (v, t) in enumerate(zip(x, y))], "vec_id long, e array<double>, y double")
    df = df.select("vec_id", array_to_vector("e").alias("features"), "y")
    train, test = df.filter("vec_id < 300"), df.filter("vec_id >= 300")
    linear = L.evaluate(L.fit_logistic(train, reg=0.01), {"t": test}).first().accuracy
    deep = L.evaluate(L.fit_mlp(train, [2, 8, 2], max_iter=200), {"t": test}).first().accuracy
    assert linear < 0.7 and deep > 0.9


def test_projection_equals_principal_components(spark):
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(80, 5)) * [5, 3, 1, 0.5, 0.1]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = np.array([r.coords for r in C.project(df, 2).orderBy("vec_id").collect()])
    _, _, vt = np.linalg.svd(x - x.mean(0), full_matrices=False)
    want = x @ vt[:2].T
    assert np.allclose(np.abs(got), np.abs(want), atol=1e-6)
    assert all(np.allclose(got[:, j], want[:, j], atol=1e-6) or np.allclose(got[:, j], -want[:, j], atol=1e-6) for j in range(2))


def test_adasyn_counts_and_points(spark):
    rnd = np.random.default_rng(5)
    x = np.vstack([rnd.normal(size=(60, 4)), rnd.normal(size=(15, 4)) + 1])
    y = [0] * 60 + [1] * 15
    df = spark.createDataFrame([(i, v.tolist(), t) for i, (v, t) in enumerate(zip(x, y))], "vec_id long, embedding array<double>, y int")
    k = 5
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    np.fill_diagonal(d, np.inf)
    share = {i: np.mean([y[j] == 0 for j in np.argsort(d[i])[:k]]) for i in range(60, 75)}
    got = adasyn(df, k=k, leaf_size=20).collect()
    want = {i: int(np.floor(s / sum(share.values()) * 45 + 0.5)) for i, s in share.items()}
    counts = {i: sum(r.base_id == i for r in got) for i in share}
    assert counts == want
    own = np.arange(60, 75)
    for r in got:
        near = own[np.argsort(d[r.base_id, own])[:k]]
        base, new = x[r.base_id], np.array(r.embedding)
        on = []
        for j in near:
            u = (new - base) @ (x[j] - base) / ((x[j] - base) @ (x[j] - base))
            on.append(-1e-9 <= u <= 1 + 1e-9 and np.allclose(new, base + u * (x[j] - base)))
        assert any(on)
    # the neighbour table itself
    table = {(r.vec_id, r["rank"]): r.nid for r in knn(df.filter("y = 1"), df, k).collect()}
    assert table == {(i, a + 1): int(j) for i in share for a, j in enumerate(np.argsort(d[i], kind="stable")[:k])}


def planted_topics(spark, n=120, seed=7):
    rnd = np.random.default_rng(seed)
    words = [[f"a{i}" for i in range(12)], [f"b{i}" for i in range(12)]]
    rows = [(i, rnd.choice(words[i % 2], 30).tolist()) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, tokens array<string>")


def test_em_topics_find_the_planted_ones(spark):
    vecs, cv = X.mllib_count_vectors(planted_topics(spark), 100)
    vecs = vecs.cache()
    model = M.fit_lda(vecs, 2, optimizer="em", max_iter=30, seed=222)
    top = {}
    for r in M.top_words(M.lda_topics(model, cv.vocabulary), 8).collect():
        top.setdefault(r.topic, set()).add(r.term[0])
    assert sorted(map(sorted, top.values())) == [["a"], ["b"]]
    weights = M.lda_doc_topics(model, vecs).groupBy("doc_id").agg(F.sum("weight").alias("s"), F.max("weight").alias("m")).collect()
    assert all(abs(r.s - 1) < 1e-6 and r.m > 0.6 for r in weights)


def test_perplexity_prefers_documents_of_the_topics(spark):
    vecs, _ = X.mllib_count_vectors(planted_topics(spark), 100)
    vecs = vecs.cache()
    model = M.fit_lda(vecs, 2, max_iter=30, seed=222)
    like = M.perplexity(model, vecs)
    # documents of one topic need log 12 nats a word, mixed ones log 24
    rnd = np.random.default_rng(1)
    mixed = spark.createDataFrame([(i, rnd.permutation(24).tolist()) for i in range(60)], "doc_id long, order array<int>")
    from pyspark.ml.linalg import Vectors

    even = spark.createDataFrame([(r.doc_id, Vectors.dense([1.25] * 24)) for r in mixed.collect()], ["doc_id", "features"])
    assert 2.3 < like < 3.0 and M.perplexity(model, even) > like + 0.3


def test_svd_projection_keeps_inner_products(spark):
    rnd = np.random.default_rng(3)
    x = rnd.random((40, 6)) @ np.diag([9, 5, 3, 0.01, 0.01, 0.01])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "doc_id long, e array<double>")
    _, s, docs = M.lsi(df.select("doc_id", array_to_vector("e").alias("features")), 3)
    _, want, _ = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(sorted(s, reverse=True), want[:3], rtol=1e-6)
    u = np.zeros((40, 3))
    for r in docs.collect():
        u[r.doc_id, r.topic] = r.weight
    assert np.allclose(u.T @ u, np.eye(3), atol=1e-6)
    scaled = u * np.array(s)
    assert np.allclose(scaled @ scaled.T, x @ x.T, atol=0.05)


def test_mean_vectors_by_hand(spark):
    t = spark.createDataFrame([(1, ["a", "b", "a", "zz"]), (2, ["b"]), (3, []), (4, ["zz"])], "doc_id long, tokens array<string>")
    v = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [4.0, -1.0])], "word string, e array<double>").select(
        "word", array_to_vector("e").alias("vector"))
    got = {(r.doc_id, r.dim): r.value for r in mean_vectors(t, v).collect()}
    assert got == {(1, 0): 2.0, (1, 1): 1.0, (2, 0): 4.0, (2, 1): -1.0}


def test_hdp_keeps_the_vocabulary_off_the_driver(spark, monkeypatch):
    """Planted topics come back, and no collected result grows with the words (F1)."""
    from pyspark.sql.classic.dataframe import DataFrame as Classic

    from quire.operators.hdp import hdp

    sizes = []
    collect = Classic.collect
    monkeypatch.setattr(Classic, "collect", lambda self: (lambda rows: (sizes.append(len(rows)), rows)[1])(collect(self)))
    rows = [(i, [f"{'ab'[i % 2]}{(i * 7 + j * 3) % 40}" for j in range(30)] + [None]) for i in range(60)]
    rows += [(None, ["a1", "b1"]), (3, ["a2", "once"]), (61, []), (62, None)]
    toks = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    topics, usage = hdp(toks, T=8, K=4, passes=3, n_words=5, block_docs=20)
    assert max(sizes, default=0) <= 8
    top = [(r.topic, r.term, r.weight) for r in topics.orderBy("topic", F.desc("weight")).collect()]
    assert len(top) == 8 * 5 and "once" not in {t for _, t, _ in top}
    used = [r.usage for r in usage.orderBy("topic").collect()]
    assert used == sorted(used, reverse=True) and abs(sum(used) - 4 * 61) < 1e-6  # K per document with words
    for k in (0, 1):  # each of the two heaviest topics holds the words of one class
        assert len({t[0] for topic, t, _ in top if topic == k}) == 1


def test_knn_memory_does_not_grow_with_the_queries_of_a_leaf():
    """All queries against one leaf: matrices of ``STEP`` rows, brute-force results."""
    import tracemalloc

    from quire.operators import knn as K

    rng = np.random.default_rng(5)
    P, Q = rng.normal(size=(256, 16)), rng.normal(size=(20000, 16))
    Q[:256] = P
    P[7] = P[9]  # equal distances: the smaller id first
    ph, qh = rng.permutation(256) + 100, np.arange(20000) + 10_000
    qh[:256] = ph
    tracemalloc.start()
    i, j, d = K._nearest(Q, qh, P, ph, 5)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40e6 and np.array_equal(i, np.repeat(np.arange(20000), 5))
    for q in (*range(300), 19_999):
        dist = np.sqrt(((Q[q] - P) ** 2).sum(-1))
        want = [x for x in np.lexsort((ph, dist)) if ph[x] != qh[q]][:5]
        assert list(j[i == q]) == want and np.array_equal(d[i == q], dist[want])
