"""Steps over documents' words: few shuffles, bounded memory, the same rows."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quire.functions.partitioning import by_key
from quire.operators import docvec as D
from quire.operators import text as T
from quire.operators import topics as M
from quire.operators import vectors as X
from quire.operators import vocab as V

DOCS = {1: "a b a c", 2: "a b d", 3: "b b e a", 4: "", 5: "f a b c c", 6: "a b a c"}


@pytest.fixture(scope="module")
def toks(spark):
    d = spark.createDataFrame(list(DOCS.items()), "doc_id long, text string")
    return by_key(d, "doc_id").select("doc_id", F.filter(F.split("text", " "), lambda t: t != "").alias("tokens"))


def shuffles(df):
    """Shuffles by columns in the plan before it runs (none is reused yet)."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(")


def test_documents_are_dealt_by_key_however_many_partitions_they_have(spark):
    d = spark.range(100).withColumnRenamed("id", "doc_id").repartition(40)
    dealt = by_key(d, "doc_id")
    assert dealt.rdd.getNumPartitions() >= 40
    at = dealt.unionByName(d.limit(0)).select("doc_id").groupBy("doc_id").count()
    assert dealt.count() == at.count() == 100
    assert shuffles(dealt.groupBy("doc_id").count()) == 1


def test_term_stats_shuffle_terms_once(toks):
    stats = V.term_stats(toks)
    assert shuffles(stats) == 2  # the documents, the terms
    words = {i: t.split() for i, t in DOCS.items()}
    tf = Counter(w for t in words.values() for w in t)
    df = Counter(w for t in words.values() for w in set(t))
    assert {r.term: (r.tf, r.df) for r in stats.collect()} == {w: (tf[w], df[w]) for w in tf}


def test_tfidf_ratio_moves_word_rows_once(toks):
    b = X.bow(toks)
    w = X.tfidf(b, X.count_docs(toks), variant="ratio")
    # documents for rows, counts and their number; term counts; word rows by term
    assert shuffles(w) == 5
    got = {(r.doc_id, r.term): r.weight for r in w.collect()}
    df = Counter(x for t in DOCS.values() for x in set(t.split()))
    for i, t in DOCS.items():
        for x, n in Counter(t.split()).items():
            assert got.pop((i, x)) == pytest.approx(n / len(t.split()) * math.log(len(DOCS) / df[x]))
    assert not got


def test_ngrams_of_given_words(toks):
    all_grams = {r.doc_id: r.grams for r in T.ngrams(toks, 1, 3).collect()}
    some = {r.doc_id: r.grams for r in T.ngrams(toks, 1, 3, words=["a", "b"]).collect()}
    assert some == {i: [g for g in gs if set(g.split()) <= {"a", "b"}] for i, gs in all_grams.items()}


def test_frequent_ngrams_equal_those_counted_over_all(spark, tmp_path, monkeypatch):
    from quire.plans import vector_jobs as J

    spark.createDataFrame(list(DOCS.items()), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    pruned = sorted(map(tuple, J.smooth_matrix(spark, str(tmp_path)).collect()))
    grams = {r[0] for r in J.en_grams(spark, str(tmp_path)).select(F.explode("tokens")).collect()}
    assert "d" not in grams and "a b" in grams  # d is in one of six documents
    monkeypatch.setattr(J, "MAX_WORDS", 0)
    assert pruned == sorted(map(tuple, J.smooth_matrix(spark, str(tmp_path)).collect())) != []


def test_coherence_pairs_stay_by_document(spark, toks):
    top = spark.createDataFrame([(0, "a"), (0, "b"), (0, "c")], "topic int, term string")
    plan = M.coherence_cv(top, toks, window=2)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(doc_id" in plan
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning(doc_id" in line]
    assert all("topic" not in line and "term" not in line for line in moved)


def test_gram_matrix_and_dense_vectors_in_slices(spark, monkeypatch):
    monkeypatch.setattr(M, "GRAM_ROWS", 2)
    monkeypatch.setattr(X, "DENSE_ROWS", 3)
    rng = np.random.default_rng(3)
    a = rng.random((11, 4)) * (rng.random((11, 4)) < 0.7)
    a[:, 0] += 0.1
    rows = [(i, j, float(a[i, j])) for i in range(11) for j in range(4) if a[i, j]]
    v = X.dense_vectors(spark.createDataFrame(rows, "doc_id long, term_id long, weight double"), 4)
    assert {r.doc_id: list(r.features) for r in v.collect()} == {i: list(a[i]) for i in range(11)}
    _, s, _ = M.lsi(v.coalesce(1), 2)
    assert np.allclose(s, np.linalg.svd(a, compute_uv=False)[:2])


def test_dbow_blocks_get_no_context_vectors(toks):
    words = D.word_table(toks, 4, 1)
    docs = D.document_blocks(toks, 4, 2, "doc_id", "tokens")
    assert D._block_words(docs, words, False).columns == ["term", "of", "n", "u"]
    assert D._block_words(docs, words, True).columns == ["term", "of", "n", "w", "u"]
    vecs, table = D.train_doc_vectors(toks, dim=4, epochs=1, min_count=1)
    start = {r.term: r.w for r in words.collect()}
    assert {r.term: r.w for r in table.collect()} == start and vecs.count() == len(DOCS)


def test_sense_scores_join_a_row_per_word_of_a_document(spark):
    """A word repeated in a document reaches the lexicon join once."""
    from quire.operators import sentiment as W

    toks = spark.createDataFrame([(1, ["good"] * 5000 + ["bad", "x"]), (2, []), (None, ["good"]), (3, None), (4, ["x"]),
                                  (5, ["bad"]), (5, ["good", "good"])], "doc_id long, tokens array<string>")
    lex = spark.createDataFrame([("good", 2), ("bad", -4)], "word string, valence long")
    seen = []
    join = type(toks).join
    try:
        type(toks).join = lambda self, other, *a, **k: seen.append(self) or join(self, other, *a, **k)
        got = {r.doc_id: r for r in W.sense_scores(toks, W.derive_senses(lex)).collect()}
    finally:
        type(toks).join = join
    assert len(seen) == 1 and seen[0].count() == 9
    assert set(got) == {1, 2, 3, 4, 5, None} and [got[i].score for i in (2, 3, 4)] == [None] * 3
    assert got[1].pos_score == 0.75 and got[1].label == 1 and got[None].score == 0.75
    assert got[5].score == 0.0 and got[5].pos_score == 0.5 and got[5].neg_score == 0.5


def test_tagger_joins_a_row_per_word_of_a_document(spark, monkeypatch, tmp_path):
    """Places of a word travel as one array; copies and null ids keep their rows."""
    from quire.operators import annotate as A
    from quire.plans import word_jobs as J

    docs = [(1, "the cat sat the cat sat the cat"), (1, "the dog"), (None, "running the dog"), (2, ""), (3, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    seen, apply = [], A.apply_tagger
    monkeypatch.setattr(A, "apply_tagger", lambda rows, model, **k: seen.append(rows) or apply(rows, model, **k))
    got = sorted(((r.doc_id or 0, r.pos, r.token, r.tag) for r in J.q_apply(spark, str(tmp_path)).collect()))
    assert seen[0].count() == 4 + 3
    assert [g[:3] for g in got if g[0] == 0] == [(0, 0, "running"), (0, 1, "the"), (0, 2, "dog")]
    assert [g[:3] for g in got if g[0] == 1] == [(1, 0, "the"), (1, 0, "the"), (1, 1, "cat"), (1, 1, "dog"), (1, 2, "sat"),
                                               (1, 3, "the"), (1, 4, "cat"), (1, 5, "sat"), (1, 6, "the"), (1, 7, "cat")]
    assert len(got) == 13 and {g[3] for g in got} == {"DT", "NN"}
