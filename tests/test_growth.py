"""Queries whose time or disk grew faster than their input: the same results with less moved."""

import numpy as np
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.operators import topics as M
from quire.operators import vectors as X
from quire.plans import flows
from quire.plans import more_jobs as J


@pytest.fixture
def joins(monkeypatch):
    """The tables that were joined, left side first."""
    seen = []
    join = DataFrame.join

    def noted(self, other, *a, **k):
        seen.append(self)
        return join(self, other, *a, **k)

    monkeypatch.setattr(DataFrame, "join", noted)
    return seen


def test_nmf_joins_nothing_and_equals_numpy(spark, joins):
    """F32: an iteration reads the documents once and moves k x V sums."""
    rng = np.random.default_rng(4)
    a = np.round(rng.random((9, 6)) * (rng.random((9, 6)) < 0.6), 3)
    a[0, 5] = 0.5
    rows = [(i if i else None, j, float(a[i, j])) for i in range(9) for j in range(6) if a[i, j]]
    x = spark.createDataFrame(rows, "doc_id long, term_id long, value double").repartition(3)
    W, H, hist = M.nmf(x, 2, max_iter=6, tol=0.0)
    assert joins == [] and len(hist) == 6
    u = lambda j: (F.pmod(F.xxhash64(F.col("doc_id"), F.lit(222), F.lit(j)), F.lit(1_000_003)) / 1_000_003.0 + 0.01)
    start = {r[0]: [r[1], r[2]] for r in x.select("doc_id").distinct().select("doc_id", u(0), u(1)).collect()}
    ids = sorted(start, key=lambda i: i or 0)
    w = np.array([start[i] for i in ids])
    b = np.array([a[i] if i else np.zeros(6) for i in ids])  # no id: no document
    h = np.random.default_rng(222).random((2, 6)) + 0.01
    for want in hist:
        h = h * (w.T @ b) / (w.T @ w @ h + 1e-9)
        w = w * (b @ h.T) / (w @ h @ h.T + 1e-9)
        assert want == pytest.approx((a * a).sum() - 2 * np.sum((w.T @ b) * h) + np.sum((w.T @ w) * (h @ h.T)))
    assert np.allclose(H, h)
    got = {r.doc_id: r.w for r in W.collect()}
    assert set(got) == set(ids) and all(np.allclose(got[i], w[n]) for n, i in enumerate(ids))


def test_lda_sweep_reads_its_tokens_once(spark, monkeypatch):
    """tokens are made once for all k and measures; same scores."""
    def topics(k, vocab=None, n=None):
        return spark.createDataFrame([(t, f"{'ab'[t % 2]}{(t + 3 * j) % 12}", 1.0 / (j + 1)) for t in range(k) for j in range(5)],
                                     "topic int, term string, weight double")

    monkeypatch.setattr(M, "fit_lda", lambda vecs, k, **_: vecs.count() and k)
    monkeypatch.setattr(M, "lda_topics", topics)
    read = spark.sparkContext.accumulator(0)

    def note(words):
        read.add(1)
        return words

    rng = np.random.default_rng(1)
    rows = [(i, [f"{'ab'[i % 2]}{j}" for j in rng.integers(0, 12, 40)]) for i in range(30)] + [(30, [])]
    plain = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    noted = F.udf(note, "array<string>").asNondeterministic()
    got = {(r.k, r.measure): r.score for r in flows.lda_sweep(plain.select("doc_id", noted("tokens").alias("tokens")),
                                                              (2, 3), n_terms=20, n_top=4, max_iter=3).collect()}
    assert read.value == len(rows)
    for k in (2, 3):
        top = M.top_words(topics(k), 4)
        assert got.pop((k, "u_mass")) == pytest.approx(M.coherence_umass(top, X.bow(plain)).agg(F.avg("coherence")).first()[0])
        assert got.pop((k, "c_v")) == pytest.approx(M.coherence_cv(top, plain).agg(F.avg("coherence")).first()[0])
    assert not got


def test_derived_stopwords_of_given_tokens(spark):
    from quire.plans.text_jobs import derived_stopwords

    toks = spark.createDataFrame([(1, ["b", "a", "b"]), (None, ["c", "c", "c"]), (2, []), (3, None), (1, ["a", "d"])],
                                 "doc_id long, tokens array<string>")
    assert sorted(r.word for r in derived_stopwords(spark, "", 3, tokens=toks).collect()) == ["a", "b", "c"]


def test_mean_vectors_make_no_row_per_dimension_of_a_word(spark):
    """a row per word, whatever its dimensions; the model's size decides how it is joined."""
    from pyspark.ml.linalg import Vectors

    t = spark.createDataFrame([(1, ["a", "b", "a", "x"]), (2, ["x"]), (3, None), (4, []), (None, ["b"])], "doc_id long, tokens array<string>")
    v = spark.createDataFrame([("a", Vectors.dense(1.0, 2.0)), ("b", Vectors.dense(4.0, -1.0))], ["word", "vector"])
    want = {(1, 0): 2.0, (1, 1): 1.0, (None, 0): 4.0, (None, 1): -1.0}
    for cells in (J.MODEL_CELLS, 0):
        m = J.mean_vectors(t, v, max_cells=cells)
        plan = m._jdf.queryExecution().optimizedPlan().toString()
        assert plan.index("posexplode") < plan.index("Aggregate") and ("broadcast" in plan) == bool(cells)
        assert {(r.doc_id, r.dim): r.value for r in m.collect()} == want


def test_word_vectors_train_in_as_many_tasks_as_their_words_ask_for(spark, tmp_path, monkeypatch):
    """one training task for every TRAIN_WORDS words of the corpus."""
    from pyspark.ml.feature import Word2Vec

    seen = []
    monkeypatch.setattr(Word2Vec, "fit", lambda self, t: seen.append((self.getNumPartitions(), t)) or seen)
    spark.createDataFrame([(i, "a b c d") for i in range(10)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    J.word_vectors(spark, str(tmp_path))
    monkeypatch.setattr(J, "TRAIN_WORDS", 15)
    J.word_vectors(spark, str(tmp_path))
    assert [n for n, _ in seen] == [1, 3] and seen[0][1].count() == 10


def test_folding_goes_by_the_tables_in_one_pass(spark):
    """every character of the Unicode database alone and between others, as the
    tables say, without a pattern of the tables' characters."""
    from quire.operators import text as T

    one, many = dict(zip(T.FOLD_FROM, T.FOLD_TO)), T.FOLD_MULTI
    chars = [chr(i) for i in range(0x110000) if not 0xD800 <= i <= 0xDFFF]
    rows = [(i, "".join(f"{x}á" for x in chars[i:i + 999])) for i in range(0, len(chars), 999)] + [(-1, None), (-2, ""), (-3, "plain")]
    rows += [(-4, "q̣̇ﬁ̣̇z\U0001d400")]
    fold = lambda t: t if t is None else "".join(x if x < "\x80" else one.get(x, many.get(x, "")) for x in t)
    found = T.ascii_fold(spark.createDataFrame(rows, "doc_id long, text string"))
    assert len(found._jdf.queryExecution().optimizedPlan().toString()) < 5000
    assert {r.doc_id: r.text for r in found.collect()} == {i: fold(t) for i, t in rows}
