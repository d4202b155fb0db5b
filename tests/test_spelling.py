import random

import pytest
from conftest import SF01
from pyspark.sql import functions as F

import __spark_entry__ as E
from quire.functions.text import alpha_lower, word_tokens
from quire.operators import fuzzy as FZ
from quire.plans import word_jobs as J


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_words_of_every_language_are_corrected(spark):
    """100 words of each language, with and without accents, against all
    frequent words of the table; the vocabulary is read from the table itself."""
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    counts = docs.select("lang", F.explode(alpha_lower(word_tokens("text"))).alias("word")).groupBy("lang", "word").count().collect()
    words = {}
    for r in counts:
        words[r.word] = words.get(r.word, 0) + r["count"]
    got = {r.word: (r.corrected, r.distance) for r in E.queries()["T16_correct_spelling_all"](spark, SF01).collect()}
    assert set(got) == set(words)
    frequent = [w for w, n in words.items() if n >= J.SPELL_MIN]
    rnd = random.Random(1)
    for lang in sorted({r.lang for r in counts}):
        own = sorted({r.word for r in counts if r.lang == lang and words[r.word] < J.SPELL_MIN})
        odd = [w for w in own if not w.isascii()]
        for w in rnd.sample(own, 60) + rnd.sample(odd, min(40, len(odd))):
            near = [(d, -words[f], f) for f in frequent if abs(len(f) - len(w)) <= J.SPELL_DIST
                    and (d := distance(w, f)) <= J.SPELL_DIST]
            assert got[w] == ((min(near)[2], min(near)[0]) if near else (w, 0)), w


def mutated(rnd, w, edits, alphabet):
    for _ in range(edits):
        i = rnd.randint(0, len(w))
        w = rnd.choice([w[:i] + rnd.choice(alphabet) + w[i:], w[:i] + w[i + 1:], w[:i] + rnd.choice(alphabet) + w[i + 1:]])
    return w


@pytest.mark.parametrize("max_dist,prefix", [(1, 2), (1, 4), (2, 3), (2, 5), (2, 10), (3, 5)])
def test_index_loses_no_pair(spark, max_dist, prefix):
    """Short and long strings over a tiny alphabet, one of 300 characters, the
    empty string, nulls and repeats."""
    rnd = random.Random(max_dist * 100 + prefix)
    alphabet = "abé𝄞"
    base = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 14))) for _ in range(60)] + ["ab" * 150]
    left = base + [mutated(rnd, w, rnd.randint(1, max_dist), alphabet) for w in base] + ["", None, "a", "a"]
    right = base + [mutated(rnd, w, rnd.randint(1, max_dist + 1), alphabet) for w in base] + ["", None, "b"]
    a = spark.createDataFrame([(x, 1) for x in left], "name string, key int")
    b = spark.createDataFrame([(x, "z") for x in right], "name string, distance string")
    got = sorted((r.l, r.r, r.distance) for r in FZ.fuzzy_join(a, b, max_dist, prefix=prefix).collect())
    want = sorted((x, y, d) for x in set(left) - {None} for y in set(right) - {None} if (d := distance(x, y)) <= max_dist)
    assert got == want


def test_many_words_under_one_key(spark):
    words = [("sameprefix" + format(i, "03d"), 1 if i % 2 else 9) for i in range(600)]
    counts = dict(words)
    got = {r.word: (r.corrected, r.distance) for r in
           FZ.correct_spelling(spark.createDataFrame(words, "word string, n long")).collect()}
    for w, n in words[:60]:
        near = [(d, -counts[f], f) for f, m in words if m >= 5 and (d := distance(w, f)) <= 2]
        assert got[w] == ((w, 0) if n >= 5 else (min(near)[2], min(near)[0]))


def test_empty_vocabulary(spark):
    assert FZ.correct_spelling(spark.createDataFrame([], "word string, n long")).collect() == []


def test_names_that_begin_alike_do_not_all_meet(spark, monkeypatch):
    """Long common beginnings: a key is shared by close names only (F16)."""
    names = [f"Customer#{i:09d}" for i in range(0, 3000, 3)] + ["Customer#", "", None]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    used, close = [], FZ.close_pairs
    monkeypatch.setattr(FZ, "close_pairs", lambda l, r, d, prefix: used.append(prefix) or close(l, r, d, prefix))
    got = {(r.l, r.r) for r in FZ.fuzzy_join(df, df, 1).filter("l < r").collect()}
    close_by = lambda a, b: sum(x != y for x, y in zip(a, b)) == 1  # noqa: E731  (equal lengths)
    full = [n for n in names if n and len(n) == 18]
    assert got == {(a, b) for a in full for b in full if a < b and close_by(a, b)}
    keyed = FZ.delete_keys(df.filter("name is not null"), "name", 1, used[0])
    assert keyed.groupBy("key").count().agg({"count": "max"}).first()[0] <= 20
