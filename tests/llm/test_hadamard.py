import hashlib
import math
import random

import numpy as np
import pytest

from quire.llm.hadamard import compress_vectors, label_errors, nearest, sequency
from quire.llm import hadamard


def brute(rows, parts, entries, rounds, scale):
    kept = [(i, [math.floor(scale * x) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = max(1, -(-max((len(v) for _, v, _ in kept), default=0) // parts))
    cut = [[(v + [0] * (parts * width - len(v)))[p * width:(p + 1) * width] for p in range(parts)] for _, v, _ in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def best(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(books[p]))

    for _ in range(rounds if kept else 0):
        for p in range(parts):
            own = [best(p, c[p])[1] for c in cut]
            for k in set(own):
                mine = [c[p] for c, o in zip(cut, own) if o == k]
                books[p][k] = [sum(col) // len(mine) for col in zip(*mine)]
    out, totals = [], {}
    for (i, _, lab), c in zip(kept, cut):
        found = [best(p, c[p]) for p in range(parts)]
        out.append([i, lab, [k for _, k in found], min(2 ** 63 - 1, sum(d for d, _ in found))])
        totals[lab] = totals.get(lab, 0) + out[-1][3]
    return sorted(((*r, min(2 ** 63 - 1, totals[r[1]])) for r in out), key=repr), books


def run(spark, rows, **kw):
    d = spark.createDataFrame([(*r, 1, "x") for r in rows],
                              "vec_id long, embedding array<float>, label int, part int, ints string")
    got, books = compress_vectors(d, **kw)
    return sorted(((r.vec_id, r.label, r.codes, r.error, r.label_error) for r in got.collect()), key=repr), books.tolist()


def vectors(n, dim, seed=2):
    rnd = random.Random(seed)
    out = [(i * 3 % 101, [rnd.choice([-1.5, 0.25, 0.5, rnd.gauss(0, 1)]) for _ in range(dim)], rnd.choice([None, 0, 1, 2])) for i in range(n)]
    bad = list(out[0][1])
    for x in (None, float("nan"), float("inf"), float("-inf")):
        out.append((200, [x, *bad[1:]], 1))
    out += [(201, None, 1), (None, bad, None), (None, bad[::-1], 2), (7, bad, 0), (7, bad, 0), (7, bad[::-1], 0)]
    return out


@pytest.mark.parametrize("dim,parts,entries", [(64, 16, 64), (12, 4, 5), (7, 3, 8), (1, 2, 1)])
def test_matches_brute_force(spark, dim, parts, entries):
    """Unusable vectors, ties, repeated rows, missing ids and labels."""
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], lab) for i, v, lab in vectors(120, dim)]
    assert run(spark, rows, parts=parts, entries=entries) == brute(rows, parts, entries, 2, 256.0)


def test_odd_shapes(spark):
    rows = [(1, [1.0] * 5, 1), (2, [], 1), (3, [2.0] * 9, None), (4, [-3.0], None)]
    assert run(spark, rows, parts=4, entries=3) == brute(rows, 4, 3, 2, 256.0)
    big = [(1, [1e9, -1e9, 5.0], 1), (2, [-4e9, 0.5, 1.0], 1), (3, [0.0, 1.0, 2.0], 2)]
    big = [(i, [float(np.float32(x)) for x in v], lab) for i, v, lab in big]
    assert run(spark, big, parts=2, entries=2) == brute(big, 2, 2, 2, 256.0)


def test_empty(spark):
    assert run(spark, []) == ([], [[] for _ in range(16)])
    assert run(spark, [(1, None, 1), (2, [float("nan")], 1)])[0] == []


def test_many_labels_are_joined_by_salt(spark, monkeypatch):
    monkeypatch.setattr(hadamard, "FEW", 0)
    rows = vectors(50, 8)
    assert run(spark, rows, parts=2, entries=4)[0] == [
        r for r in brute([(i, v and [x if x is None else float(np.float32(x)) for x in v], lab) for i, v, lab in rows], 2, 4, 2, 256.0)[0]]


@pytest.mark.parametrize("width", [1, 2, 3, 4, 7, 8, 16])
@pytest.mark.parametrize("kind", [np.int64, object])
def test_nearest_is_exact(width, kind):
    rnd = np.random.default_rng(width)
    points = rnd.integers(-4, 5, (200, width)).astype(kind)
    entries = rnd.integers(-4, 5, (17, width)).astype(kind)
    index, dist = nearest(points, entries)
    whole = ((points[:, None] - entries[None]) ** 2).sum(2)
    assert index.tolist() == [min(range(17), key=lambda k: (row[k], k)) for row in whole.tolist()]
    assert dist.tolist() == [min(row) for row in whole.tolist()]


def test_sequency_order():
    t = sequency(np.eye(8, dtype=np.int64)).T  # row j: the j-th Walsh function
    assert (np.abs(t) == 1).all() and (t @ t.T == 8 * np.eye(8)).all()
    assert [int((r[1:] != r[:-1]).sum()) for r in t] == list(range(8))


def test_query(spark, tmp_path):
    from quire.llm.queries import QUERIES

    rows = [(i, v and [x if x is None else float(np.float32(x)) for x in v], lab) for i, v, lab in vectors(150, 32)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = QUERIES["op12_hadamard_codes"](spark, str(tmp_path)).collect()
    want, books = brute(rows, 16, 64, 2, 256.0)
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    assert sorted([(r.vec_id, r.code, r.error, r.label_error) for r in got], key=repr) == sorted(
        [(i, "".join(f"{k:02x}" for k in c), e, t) for i, _, c, e, t in want], key=repr)
    assert {r.codebooks_sha256 for r in got} == {digest}
