import itertools
import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from quire.llm.components import connected_components
from quire.llm.simhash import lattice_cells, links_within, manhattan, near_duplicate_classes, segment_counts


def brute_fp(text, k=4):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text or "") if w]
    words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words]
    if not words:
        return 0
    sh = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(rows, max_bits=4):
    fps = [(i, brute_fp(t)) for i, t in rows]
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(range(len(fps)), 2):
        if bin(fps[a][1] ^ fps[b][1]).count("1") <= max_bits:
            parent[find(a)] = find(b)
    out = []
    for k, (i, fp) in enumerate(fps):
        ids = [fps[j][0] for j in range(len(fps)) if find(j) == find(k) and fps[j][0] is not None]
        out.append((i, f"{fp:016x}", min(ids) if ids else None))
    return sorted(out, key=repr)


def corpus(seed=3, n=120):
    rnd = random.Random(seed)
    vocab = [f"w{i}é" if i % 7 == 0 else f"W{i}" for i in range(300)]
    rows = []
    for i in range(n):
        if rows and rnd.random() < 0.4:
            words = rnd.choice(rows)[1].split() or ["x"]
            for _ in range(rnd.randint(0, 2)):
                words[rnd.randrange(len(words))] = rnd.choice(vocab)
        else:
            words = [rnd.choice(vocab) for _ in range(rnd.randint(1, 150))]
        rows.append((i, rnd.choice([" ", "\n", "\t "]).join(words)))
    return rows


def test_classes_match_brute_force(spark):
    rows = corpus() + [(500, None), (501, ""), (502, " \n\t"), (7, "again the same id"), (7, "again the same id"),
                       (None, "again the same id"), (503, "one"), (504, "One"), (505, "a b c d e " * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {"fp": F.lit(1), "cell": F.lit("x"), "component_id": F.lit(None).cast("int")})
    got = near_duplicate_classes(df, block=3).select("doc_id", "fingerprint", "component_id").collect()
    assert sorted(map(tuple, got), key=repr) == brute_components(rows)


def test_empty_table(spark):
    assert near_duplicate_classes(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_bound_and_cells_cover_every_close_pair():
    rnd = np.random.default_rng(1)
    base = rnd.integers(0, 2**63, 300).astype(np.uint64)
    other = base.copy()
    for _ in range(4):
        other ^= np.uint64(1) << rnd.integers(0, 64, 300).astype(np.uint64)
    dist = np.bitwise_count(base ^ other)
    assert (manhattan(segment_counts(base), segment_counts(other)) <= dist).all()
    for groups in (1, 2):
        radius = -(-(4 // groups) // 2)
        a, b = lattice_cells(base[:40], groups, radius), lattice_cells(other[:40], groups, radius)
        for i in range(40):
            assert set(a[0][a[1] == i]) & set(b[0][b[1] == i])


def test_forest_keeps_components():
    rnd = np.random.default_rng(2)
    centre = rnd.integers(0, 2**63, 5).astype(np.uint64)
    m = np.unique(np.concatenate([c ^ (np.uint64(1) << rnd.integers(0, 64, 60).astype(np.uint64)) for c in centre]))
    a, b = links_within(m, 4)
    assert len(a) == len(m) - 5


def test_components_long_path_and_hub(spark):
    path = [(i, i + 1) for i in range(0, 200)]
    hub = [(1000, 1000 + i) for i in range(1, 300)]
    df = spark.createDataFrame(path + hub + [(5, 5), (None, 4), (3, None)], "a long, b long")
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert all(got[i] == 0 for i in range(201)) and all(got[1000 + i] == 1000 for i in range(300))
    assert len(got) == 201 + 300
