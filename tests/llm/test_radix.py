import random

import numpy as np
import pytest

from quire.llm.radix import Runs, equal_windows, first_digits, remove_repeats, words_at


def brute(rows, depth=50):
    least = {}
    for i, t in rows:
        raw = (t or "").encode()
        if i is not None:
            for p in range(len(raw) - depth + 1):
                w = raw[p:p + depth]
                least[w] = min(i, least.get(w, i))
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        if i is not None:
            for p in range(len(raw) - depth + 1):
                if least[raw[p:p + depth]] < i:
                    gone[p:p + depth] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((i, len(raw), int(gone.sum()), spans, bytes(b for b, g in zip(raw, gone) if not g)))
    return sorted(out, key=repr)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, 3, "y") for r in rows], "doc_id long, text string, rk int, digit string")
    got = remove_repeats(df, **kw).collect()
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in got), key=repr)


def corpus(seed=1, n=80):
    rnd = random.Random(seed)
    vocab = ["the", "ción", "une", "été", "of", "and", "x1"] + [f"w{i}" for i in range(60)]
    line = "This very common line, é, stands in a third of all the documents here."
    passages = [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(8, 60))) for _ in range(6)]
    rows = []
    for i in range(n):
        words = [" ".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 60)))]
        if rnd.random() < 0.35:
            words.insert(rnd.randint(0, 1), line)
        if rnd.random() < 0.5:
            p = rnd.choice(passages)
            a = rnd.randint(0, 10)
            words.append(p[a:a + rnd.randint(40, 400)])
        if rnd.random() < 0.2 and rows:
            words = [rnd.choice(rows)[1]]
        rows.append((rnd.randint(-10**12, 10**12) if i % 9 == 0 else i, rnd.choice(["\n", " "]).join(words)))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("kw", [{}, {"bucket_bytes": 2000, "sample_one_in": 1, "frequent_least": 4},
                                {"depth": 20, "bucket_bytes": 5000, "sample_one_in": 2, "frequent_least": 8}])
def test_matches_brute_force(spark, kw):
    rows = corpus()
    rows += [(500, None), (501, ""), (502, "short"), (None, rows[0][1]), (None, "z" * 300), (503, "z" * 300), (504, "z" * 120),
             (504, "z" * 120), (504, "another text, same id, " + rows[3][1]), (505, "ab" * 4000), (506, "q" * 7 + "ab" * 100),
             (507, rows[1][1] * 2), (508, "0123456789" * 5), (509, "0123456789" * 5), (510, "0123456789" * 4 + "012345678")]
    assert run(spark, rows, **kw) == brute(rows, kw.get("depth", 50))


def test_empty_and_alone(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, "a" * 500)]) == brute([(1, "a" * 500)])
    with pytest.raises(ValueError):
        remove_repeats(spark.createDataFrame([(1, "a")], "doc_id long, text string"), depth=16)


def test_digits_and_runs(monkeypatch):
    from quire.llm import radix

    rnd = np.random.default_rng(0)
    buf = rnd.integers(97, 100, 4000).astype(np.uint8)
    assert words_at(buf[:23]).tolist() == [int.from_bytes(buf[i:i + 8].tobytes(), "little") for i in range(16)]
    m = first_digits(buf, 50)
    assert len(m) == 4000 - 49 and (first_digits(buf[100:150], 50) == m[100:101]).all()
    raws = [buf[:700].tobytes(), b"", buf[700:749].tobytes(), b"s" * 500, buf[749:].tobytes()]
    for size in (1 << 20, 300):
        monkeypatch.setattr(radix, "PIECE", size)
        r = Runs(raws, 50)
        seen = sorted((d, p + k) for d, p, n in zip(r.doc.tolist(), r.pos.tolist(), r.count.tolist()) for k in range(n))
        assert seen == [(d, p) for d, x in enumerate(raws) for p in range(len(x) - 49)]
        for d, p, n, h in zip(r.doc, r.pos, r.count, r.digit):
            assert n <= 64 and (first_digits(np.frombuffer(raws[d][p:p + n + 49], np.uint8), 50) == h).all()


def test_passes_find_equal_windows():
    rnd = np.random.default_rng(1)
    buf = rnd.integers(0, 2, 600).astype(np.uint8)
    at = np.arange(580)
    owner = rnd.integers(0, 50, 580)
    for depth in (3, 8, 13):
        least = equal_windows(buf, at, np.zeros(580, np.int64), owner, depth)
        best = {}
        for p in at:
            w = buf[p:p + depth].tobytes()
            best[w] = min(best.get(w, 99), owner[p])
        assert least.tolist() == [best[buf[p:p + depth].tobytes()] for p in at]
