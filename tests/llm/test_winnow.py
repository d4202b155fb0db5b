import random
import re

import pytest

from quire.llm.winnow import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in (t or "")))


def brute(docs, items, window=10):
    wins = {}
    for item, text in items:
        w = words(text)
        n = min(len(w), window)
        for i in range(len(w) - n + 1 if w else 0):
            wins.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, ids = words(text), set(), set()
        for n in {len(k) for k in wins}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in wins:
                    hit |= set(range(i, i + n))
                    ids |= {str(x) for x in wins[tuple(w[i:i + n])] if x is not None}
        out.append((doc, len(w), len(hit), len(ids), sorted(ids) or None))
    return sorted(out, key=repr)


def run(spark, docs, items, **kw):
    d = spark.createDataFrame([(*r, 1, "z") for r in docs], "doc_id long, text string, w int, fingerprint string")
    b = spark.createDataFrame([(*r, 2) for r in items], "item_id long, text string, len int")
    got = decontaminate(d, b, **kw).collect()
    for r in got:
        assert sum(s.last - s.first + 1 for s in r.spans or []) == r.n_hit
    return sorted(((r.doc_id, r.n_words, r.n_hit, r.n_items, sorted(r["items"]) if r["items"] else None) for r in got), key=repr)


def tables(seed=5):
    rnd = random.Random(seed)
    vocab = ["der", "Éa", "éa", "the", "3rd", "K", "İx", "naïve"] + [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randint(11, 40)))) for i in range(12)]
    items += [(20, "three short Words"), (21, "three short words!"), (22, "one"), (23, None), (24, "..."), (25, ""),
              (None, "an item without any id but with more than ten words in it"), (3, "a second text of item 3, of nine words"),
              (26, "a a a a a a a a a a a a")]
    docs = []
    for i in range(30):
        w = [rnd.choice(vocab) for _ in range(rnd.randint(1, 80))]
        if rnd.random() < 0.6:
            src = (rnd.choice(items)[1] or "").split()
            a = rnd.randrange(len(src) or 1)
            w[rnd.randrange(len(w)):0] = [x.upper() if x.isascii() else x for x in src[a:a + rnd.randint(5, 30)]]
        docs.append((i, rnd.choice([" ", ", ", "\n"]).join(w)))
    docs += [(100, None), (101, ""), (102, "?!"), (None, items[0][1]), (5, items[1][1]), (5, items[1][1]),
             (103, "a " * 3000), (104, "One " * 50), (105, "x " * 4000 + items[2][1])]
    return docs, items


@pytest.mark.parametrize("limit", [500_000, 0])
def test_matches_brute_force(spark, limit):
    docs, items = tables()
    assert run(spark, docs, items, max_broadcast=limit) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = tables()
    assert run(spark, [], items) == []
    assert run(spark, docs[:5], []) == brute(docs[:5], [])
    assert run(spark, docs[:5], [(1, None), (2, "--")]) == brute(docs[:5], [])
