import os
import random
import re
from itertools import permutations

import pytest

from quire.llm.filteraudit import audit_filters, order_report
from quire.llm.queries import AUDIT_CONDITIONS, QUERIES


def mask_of(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    return ((len(w) < 200) + 2 * (100 * len(set(w)) < 50 * len(w)) + 4 * (100 * len(re.findall("[A-Z]", t)) > 3 * len(t))
            + 8 * bool(re.search(r"[#$%&*|]", t)))


def brute(docs, labels):
    least = {}
    for d, t, _ in docs:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, x in labels if x == 1 and d is not None}
    rows = {}
    for d, t, part in docs:
        m = mask_of(t or "") + 16 * (d is not None and d > least[t or ""])
        rows.setdefault(part or "", []).append((m, d in good, d in toxic))
    out = []
    for part, own in rows.items():
        removed_of, lines = dict.fromkeys("ABCDE", 0), []
        for order in permutations("ABCDE"):
            before = 0
            for k, letter in enumerate(order):
                b = 1 << "ABCDE".index(letter)
                gone = [r for r in own if r[0] & b and not r[0] & before]
                removed_of[letter] += len(gone)
                lines.append([part, "".join(order), k + 1, sum(not r[0] & (before | b) for r in own), len(gone),
                              sum(bool(r[0] & b and r[0] & before) for r in own), sum(r[0] == b for r in own),
                              sum(r[1] for r in gone), sum(r[2] for r in gone), letter])
                before |= b
        out += [(*x[:-1], removed_of[x[-1]]) for x in lines]
    return sorted(out)


COLUMNS = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()
DOCS = "doc_id long, text string, lang string, mask int, key string, id long"


def report(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def corpus(seed=4):
    rnd = random.Random(seed)
    words = ["der", "Éa", "the", "THE", "3rd", "a|b", "x", "y\x0bz", "w\x1cw"] + [f"w{i}" for i in range(300)]
    texts = [rnd.choice([" ", "\n", "\t "]).join(rnd.choices(words, k=rnd.choice([0, 3, 150, 220, 400]))) for _ in range(60)]
    texts += ["", None, "a " * 300, "Q" * 40, " \t\n", "100 %"]
    docs = [(i, rnd.choice(texts), rnd.choice(["en", "de", None, ""])) for i in rnd.sample(range(400), 250)]
    docs += [(None, texts[0], "en"), (None, texts[0], "en"), (None, None, None), (9, texts[0], "en"), (9, texts[0], "de"),
             (9, texts[0], "de"), (-5, texts[0], None), (3, "one long word " + "z" * 100_000, "fr")]
    labels = [(d, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for d, _, _ in rnd.sample(docs, 120)]
    return docs, labels + labels[:10] + [(None, 1, 1), (10_000, 1, 1), (9, 1, 1)]


def write(spark, rows, schema, path, mode="append"):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode(mode).parquet(str(path))


def tables(spark, path, files, labels):
    for rows in files:
        write(spark, [(*r, 1, "k", 2) for r in rows], DOCS, path / "documents.parquet")
    write(spark, labels, "doc_id long, quality int, toxic int", path / "labels.parquet")
    return spark.read.parquet(str(path / "labels.parquet"))


@pytest.mark.parametrize("direction", [1, -1])
def test_every_file_its_own_batch(spark, tmp_path, direction):
    """Files arrive by rising and by falling id: smaller ids retract earlier rows."""
    docs, labels = corpus()
    docs.sort(key=lambda r: direction * (r[0] or 0))
    files = [docs[i:i + 60] for i in range(0, len(docs), 60)]
    lab = tables(spark, tmp_path, files, labels)
    got = audit_filters(spark, str(tmp_path / "documents.parquet"), AUDIT_CONDITIONS, lab, "E",
                        work=str(tmp_path / "work"), bytes_per_core=1)
    assert report(got) == brute(docs, labels)
    assert len([x for x in os.listdir(tmp_path / "work/counters") if x.startswith("batch-")]) == len(files)
    moves = spark.read.parquet(str(tmp_path / "work/moves/batch-*"))
    assert (moves.filter("first < 0").count() > 10) == (direction < 0)


def test_goes_on_with_new_files(spark, tmp_path):
    docs, labels = corpus(5)
    lab = tables(spark, tmp_path, [docs[:100]], labels)
    path, work = str(tmp_path / "documents.parquet"), str(tmp_path / "work")
    assert report(audit_filters(spark, path, AUDIT_CONDITIONS, lab, "E", work=work)) == brute(docs[:100], labels)
    write(spark, [(*r, 1, "k", 2) for r in docs[100:]], DOCS, path)
    for _ in range(2):  # the second run finds nothing new
        assert report(audit_filters(spark, path, AUDIT_CONDITIONS, lab, "E", work=work)) == brute(docs, labels)


def test_query_on_a_single_file_and_empty_tables(spark, tmp_path):
    docs, labels = corpus(6)
    tables(spark, tmp_path, [docs], labels)
    assert report(QUERIES["op11_filter_audit"](spark, str(tmp_path))) == brute(docs, labels)
    one = next(x for x in os.listdir(tmp_path / "documents.parquet") if x.endswith(".parquet"))
    (tmp_path / "single").mkdir()
    os.link(tmp_path / "documents.parquet" / one, tmp_path / "single/documents.parquet")
    write(spark, [], "doc_id long, quality int, toxic int", tmp_path / "single/labels.parquet")
    assert report(QUERIES["op11_filter_audit"](spark, str(tmp_path / "single"))) == brute(docs, [])
    (tmp_path / "none").mkdir()
    tables(spark, tmp_path / "none", [[]], [])
    assert report(QUERIES["op11_filter_audit"](spark, str(tmp_path / "none"))) == []


def test_other_numbers_of_filters(spark):
    rows = [("en", 0, 1, 0, 4, 1), ("en", 1, 0, 0, 2, 3)]
    c = spark.createDataFrame(rows, "part string, mask int, good int, toxic int, first long, copies long")
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.shapley) for r in order_report(c, ["A", "E"]).collect()}
    assert got == {("AE", 1): (5, 5, 0, 2, 7), ("AE", 2): (4, 1, 3, 1, 5), ("EA", 1): (6, 4, 0, 1, 5), ("EA", 2): (4, 2, 3, 2, 7)}
