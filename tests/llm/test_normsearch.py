import math
import random

import numpy as np
import pytest

from quire.llm.normsearch import Block, top_k_products


def brute(rows, k=20, every=20):
    ok = []
    for i, e in ((i, None if e is None else tuple(e)) for i, e in rows):
        if i is None or e is None or any(x is None or not math.isfinite(np.float32(x)) for x in e):
            continue
        ok.append((i, [math.floor(64 * float(np.float32(x))) for x in e]))
    out = []
    for qi, q in dict.fromkeys((i, tuple(v)) for i, v in ok):
        if qi % every:
            continue
        s = sorted((-min(max(sum(a * b for a, b in zip(q, c)), -2**63), 2**63 - 1), ci)
                   for ci, c in ok if ci != qi and len(c) == len(q))
        out += [(qi, r + 1, ci, -x) for r, (x, ci) in enumerate(s[:k])]
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 0, "n") for r in rows], "vec_id long, embedding array<float>, dim int, norm string")
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in top_k_products(df, **kw).collect())


def rows(seed=1, n=600, dim=8):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        centre = rnd.choice([-1, 0, 3])
        size = rnd.choice([0.1, 1, 1, 5])
        out.append((i, [size * rnd.gauss(centre if j < 2 else 0, 1) for j in range(dim)]))
    return out


@pytest.mark.parametrize("kw", [{}, {"block": 16, "query_block": 3, "seeds": 64}, {"seeds": 4}])
def test_matches_brute_force(spark, kw):
    data = rows()
    same = [(1000 + i, data[5][1]) for i in range(40)]
    odd = [(2000, None), (2020, [None] * 8), (2040, [float("nan")] * 8), (2060, [float("inf")] * 8), (None, [1.0] * 8),
           (2080, [1.0, 2.0]), (2081, [3.0, 4.0]), (2100, []), (2101, []), (20, data[20][1]), (40, data[41][1]),
           (7, data[7][1]), (7, data[7][1]), (7, data[8][1]), (1003, data[5][1]),
           (2120, [0.0] * 8), (2140, [1e30] * 8), (2160, [-1e30] * 8)]
    assert run(spark, data + same + odd, **kw) == brute(data + same + odd)


def test_few_and_none(spark):
    assert run(spark, []) == []
    assert run(spark, [(0, [1.0]), (3, [2.0])]) == [(0, 1, 3, 64 * 128)]
    assert run(spark, [(20, [1.0])]) == []


def test_pruning_keeps_every_candidate():
    rnd = np.random.default_rng(3)
    v = np.floor(64 * rnd.normal(size=(3000, 6)) * rnd.choice([0.2, 1, 4], (3000, 1)))
    norms = np.sqrt((v**2).sum(1))
    blk = Block(np.arange(3000), v, norms)
    pruned = 0
    for q in np.floor(64 * rnd.normal(size=(60, 6))):
        s = blk.v @ q
        for floor in np.sort(s)[[-1, -5, -50, -500]]:
            for start in (0.0, 0.5, 2.0):
                c = blk.candidates(q, float(np.sqrt(q @ q)), float(floor), start, 4)
                assert set(np.flatnonzero(s >= floor)) <= set(c) or floor <= 0
                pruned += 3000 - len(c)
    assert pruned > 100_000
