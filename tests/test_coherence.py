"""Coherence (M9-M12): counts made inside the documents' tasks equal brute force."""

import glob
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quire.operators import topics as M
from quire.operators import vectors as X
from quire.session import ensure_checkpoint_dir, freed_shuffles

WORDS = list("abcdef")
BY = [[(0,), (1,), (2,)], [(2,), (4,), (5,)]]


def documents(seed=2):
    rng = np.random.default_rng(seed)
    docs = [(i, [str(x) for x in rng.choice(list("abcdefxyz"), n)]) for i, n in enumerate([0, 1, 3, 9, 40, 2, 17, 5])]
    return [*docs[:4], (3, ["a", "x", "c"]), (3, docs[3][1]), *docs[4:], (20, None), (None, ["a", "b"]), (None, ["f", "c", "a", "e"])]


def windows(docs, window):
    """(id, window) -> words, and the number of windows."""
    held, total = {}, 0
    for i, t in docs:
        t = t or []
        total += max(len(t) - window + 1, 1)
        for s in range(max(len(t) - window, 0) + 1):
            held.setdefault((i, s), set()).update(t[s:s + window])
    return held, total


@pytest.mark.parametrize("rows, tokens, batch", [(1, 1, 2), (4, 10, 3), (4096, 1 << 18, 100)])
def test_windows_equal_brute_force(monkeypatch, rows, tokens, batch):
    """few windows or documents at a time, ids that go on in the next batch."""
    monkeypatch.setattr(M, "CV_ROWS", rows)
    monkeypatch.setattr(M, "CV_TOKENS", tokens)
    docs = documents()
    n = [sum(j == i for j, _ in docs) for i, _ in docs]
    t = pa.table({"doc_id": pa.array([i for i, _ in docs], pa.int64()), "tokens": pa.array([t for _, t in docs], pa.list_(pa.string())),
                  "_n": pa.array(n, pa.int64())})
    got, = M._window_counts(WORDS, BY, 4)(iter(t.to_batches(max_chunksize=batch)))
    got = {(i, j): c for i, j, c in zip(*(c.to_pylist() for c in got.columns))}
    held, total = windows(docs, 4)
    want = {(-1, -1): total}
    for own in BY:
        for (i,) in own:
            for (j,) in own:
                if c := sum(WORDS[i] in w and WORDS[j] in w for w in held.values()):
                    want[i, j] = c
    assert got == want


def test_scores_equal_brute_force(spark):
    docs = documents(5)
    toks = spark.createDataFrame(docs, "doc_id long, tokens array<string>").repartition(3)
    top = spark.createDataFrame([(t, WORDS[w], r + 1) for t, own in enumerate(BY) for r, (w,) in enumerate(own)] + [(7, "none", 1)],
                                "topic int, term string, rank long")
    held, n = windows(docs, 4)
    p = lambda *w: sum(x.issuperset(w) for x in held.values()) / n
    want = {7: 0.0}
    for t, own in enumerate(BY):
        w = [WORDS[i] for (i,) in own]
        v = np.array([[np.log((p(x, y) + 1e-12) / (p(x) * p(y))) / -np.log(p(x, y) + 1e-12) for y in w] for x in w])
        want[t] = np.mean([x @ v.sum(0) / np.linalg.norm(x) / np.linalg.norm(v.sum(0)) for x in v])
    assert {r.topic: r.coherence for r in M.coherence_cv(top, toks, window=4).collect()} == pytest.approx(want)
    sets = {}
    for i, t in docs:
        sets.setdefault(i, set()).update(t or [])
    d = lambda *w: sum(s.issuperset(w) for i, s in sets.items() if len(w) == 1 or i is not None)
    want = {t: np.mean([np.log((d(WORDS[own[a][0]], WORDS[own[b][0]]) + 1) / d(WORDS[own[b][0]])) for a in range(3) for b in range(a)])
            for t, own in enumerate(BY)}
    assert {r.topic: r.coherence for r in M.coherence_umass(top, X.bow(toks)).collect()} == pytest.approx(want)


def test_occurrences_are_not_multiplied_by_pairs(spark):
    """no row per occurrence and pair, no join of the words of a document."""
    toks = spark.createDataFrame(documents(), "doc_id long, tokens array<string>")
    top = spark.createDataFrame([(t, w, r) for t in range(20) for r, w in enumerate("abc")], "topic int, term string, rank long")
    for found in (M.coherence_cv(top, toks), M.coherence_umass(top, X.bow(toks))):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "MapInArrow" in plan and plan.count("Join") <= 2 and plan.count("Generate") <= 1


def test_shuffle_files_go_with_their_action(spark, tmp_path):
    d = spark.range(100).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count()
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    own = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = lambda: {f for d in own for f in glob.glob(f"{d}/*/shuffle_*")}
    was, before = spark.conf.get(key), files()
    ensure_checkpoint_dir(spark)
    with freed_shuffles(spark):
        assert spark.conf.get(key) == "true" and d.select("k").checkpoint().rdd.count() == 7
    until = time.time() + 10  # they go in the background
    while (left := files() - before) and time.time() < until:
        time.sleep(0.1)
    assert spark.conf.get(key) == was and not left
