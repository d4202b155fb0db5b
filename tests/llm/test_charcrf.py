import random
import re

import numpy as np

from conftest import SF01
from quire.llm.charcrf import (CLASSES, KINDS, TAGS, Tagger, base_spans, char_classes, find_personal_data, joined, redacted,
                               tag_texts, train_tagger, training_windows, windows_near)

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+".replace(r"\x20-", r"\x20\-"))
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_luhn(d):
    s = 0
    for i, c in enumerate(d[::-1]):
        x = int(c) * (1 + i % 2)
        s += x // 10 + x % 10
    return s % 10 == 0


def brute(text):
    text = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    return {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and plain_luhn(digits(m))],
        "phone": [m.span() for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15]}


def noisy(seed, n=400):
    rnd = random.Random(seed)
    bits = ["a@b.c", "x.y%z@d-e.f.g", "@", "..", ".", "1", "255", "256", "1.2.3.4", "0001.2.3.004", "+1 (486) 555-3667", "+",
            "+44.20.7946.0958", "4587121519400672", "4111 1111 1111 1111", "4111-1111-1111-1111", "-", " ", "é", "word", "\n",
            "a@b", "@x.y", "%", "12345678901234567890123", "(", ")", "٣", "1.2.3.4.5.6.7.8.9"]
    return ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 25))) for _ in range(n)]


def test_base_spans_match_plain_patterns():
    for t in noisy(1, 3000) + [None, "", "9" * 5000, "a" * 50_000, "a." * 20_000, "1." * 20_000, "+1" * 5000]:
        if t is None or len(t) < 6000 or set(t) <= set("1+"):
            assert base_spans(t) == brute(t), t
        else:
            base_spans(t)  # long runs stay linear


def test_gradient_is_right():
    rnd = np.random.default_rng(0)
    m = Tagger(hidden=3)
    x, y = rnd.integers(0, CLASSES, (2, 7)), rnd.integers(0, TAGS, (2, 7))
    m.p["trans"] = rnd.normal(size=(TAGS, TAGS))
    _, grad = m.loss_gradient(x, y)
    for k, g in grad.items():
        for _ in range(4):
            at = tuple(rnd.integers(0, s) for s in g.shape)
            keep = m.p[k][at]
            m.p[k][at] = keep + 1e-5
            up = m.loss_gradient(x, y)[0]
            m.p[k][at] = keep - 1e-5
            down = m.loss_gradient(x, y)[0]
            m.p[k][at] = keep
            assert abs((up - down) / 2e-5 - g[at]) < 1e-6 * max(1, abs(g[at])) + 1e-7


def test_viterbi_is_the_best_path():
    import itertools

    rnd = np.random.default_rng(1)
    m = Tagger(hidden=2)
    m.p["trans"] = rnd.normal(size=(TAGS, TAGS))
    e = rnd.normal(size=(3, 4, TAGS))
    for k in range(3):
        best = max(itertools.product(range(TAGS), repeat=4), key=lambda p: sum(e[k, t, p[t]] for t in range(4))
                   + sum(m.p["trans"][a, b] for a, b in zip(p, p[1:])))
        assert m.viterbi(e)[k].tolist() == list(best)


def test_windows_cover_every_anchor():
    rnd = random.Random(3)
    for _ in range(200):
        t = "".join(rnd.choice("abcdefgh     \n") for _ in range(rnd.randint(0, 400)))
        for _ in range(rnd.randint(0, 4)):
            k = rnd.randint(0, len(t))
            t = t[:k] + rnd.choice(["1", "@", "12345", "@" * 90]) + t[k:]
        seen = {p for s in windows_near(t) for p in range(s, s + 64)}
        assert {i for i, c in enumerate(t) if c in "0123456789@"} <= seen


def test_tagger_learns_held_out_spans(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    model = train_tagger(docs.filter("doc_id % 2 = 0"))
    texts = [r.text for r in docs.filter("doc_id % 2 = 1").collect()]
    want = {(i, k, *s) for i, t in enumerate(texts) for k, v in base_spans(t).items() for s in v}
    got = {(i, k, a, z) for i, x in enumerate(tag_texts(model, texts)) for k, a, z, sure in x if sure >= 0.5}
    assert len(want) > 20 and len(want & got) >= 0.6 * len(want) and len(want & got) >= 0.9 * len(got), (len(want), len(want & got), len(got))


def test_operator(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text").limit(200)
    rows = [(i + 10_000, t) for i, t in enumerate(noisy(2))] + [(None, "mail a@b.c"), (1, None), (2, ""), (3, "x"), (3, "x"),
                                                                (4, "q" * 300_000 + " call +1 (486) 555-3667")]
    df = docs.union(spark.createDataFrame(rows, "doc_id long, text string")).selectExpr("*", "1 base", "'s' spans", "2 n_ip")
    kept = df.collect()
    got = find_personal_data(df, redact=True).collect()
    assert len(got) == len(kept)
    texts = {}
    for r in kept:
        texts.setdefault(r.doc_id, []).append(r.text)
    for r in got:
        options = [brute(t) for t in texts[r.doc_id]]
        assert any(r.base == joined(b) and [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(b[k]) for k in KINDS] for b in options)
        assert set(filter(None, r.base.split(","))) <= set(filter(None, r.spans.split(",")))
        assert r.redacted is None or not base_spans(r.redacted)["email"]


def test_empty_and_nothing_to_learn(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert find_personal_data(df).count() == 0
    got = find_personal_data(spark.createDataFrame([(1, "no numbers"), (2, None)], "doc_id long, text string")).collect()
    assert [(r.doc_id, r.spans, r.base) for r in got] == [(1, "", ""), (2, "", "")]


def test_redaction_merges_overlaps():
    t = "call +1 (486) 555-3667 or a@b.c."
    assert redacted(t, base_spans(t)) == "call <PHONE> or <EMAIL>."
    x, y, _ = training_windows(t, 10)
    assert x.shape == y.shape and (char_classes(t)[:10] == x[0][:10]).all()


def test_training_windows_come_from_the_whole_text():
    rnd = random.Random(2)
    t = "; ".join("".join(rnd.choice("abcXYZ .,-;") for _ in range(90)) + f" {rnd.randrange(10**6)}" for _ in range(200))
    x, y, keys = training_windows(t, 8)
    everything = training_windows(t, 10**6)
    at = windows_near(t)
    assert len(x) == len(y) == len(keys) == 8 and keys == sorted(everything[2])[:8] and len(everything[2]) == len(at)
    classes = char_classes(t)
    place = {classes[a:a + x.shape[1]].tobytes(): i for i, a in enumerate(at)}
    found = [place[r.astype(classes.dtype).tobytes()] for r in x]
    assert max(found) >= 8 and training_windows("no mark", 8)[2] == []
