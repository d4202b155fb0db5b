import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from conftest import SF001
from quire.llm.charcrf import base_spans

from .test_simhash import brute_components
from .test_tokens import check_packing
from .test_winnow import brute as brute_hits


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("sf"))
    for t in ("documents", "labels", "benchmark"):
        df = spark.read.parquet(f"{SF001}/{t}.parquet")
        if t == "documents":
            docs = df.orderBy("doc_id").collect()
            bench = spark.read.parquet(f"{SF001}/benchmark.parquet").first().text
            more = [(9001, docs[3].text, "en", "src1", 1), (9002, docs[3].text + " end", "en", "src1", 1),
                    (9003, None, "en", None, 0), (9004, "", None, "src1", 0), (9005, "see " + bench, "en", "new", 9),
                    (9006, "mail me at some.one@example.org or call +1 (486) 555-3667 today my friend", "en", "src2", 9),
                    (9006, "mail me at some.one@example.org or call +1 (486) 555-3667 today my friend", "en", "src2", 9),
                    (None, "no id but a text", "en", "src2", 9)]
            df = df.union(spark.createDataFrame(more, df.schema)).withColumn("keep", F.lit(1)).withColumn("fp", F.lit("z"))
        df.write.parquet(f"{root}/{t}.parquet")
    return root


def test_stages_against_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = [n for n, _ in C.STAGES]
    assert names == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "personal_data", "best_fit_packing"]
    held = {}
    for name, stage in C.STAGES:
        docs = C.written(stage(spark, docs, folder), name)
        held[name] = docs.collect()
        if name != names[-1]:
            assert docs.columns == C.COLUMNS
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    before = spark.read.parquet(f"{folder}/documents.parquet").collect()
    stay = [(r.doc_id, r.text) for r in held[names[0]]]
    kept = {d for d, _ in stay}
    wrong = [d for d, q in labels.items() if (d in kept) != (q == 1) and any(r.doc_id == d for r in before)]
    assert len(wrong) <= 0.05 * len(labels)
    classes = brute_components(stay)
    want = {c for _, _, c in classes if c is not None}
    got = [r.doc_id for r in held[names[1]] if r.doc_id is not None]
    assert sorted(got) == sorted(want)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    rows = [(r.doc_id, r.text) for r in held[names[1]]]
    clean = sorted((r[0] for r in brute_hits(rows, items) if r[2] == 0), key=repr)
    assert sorted((r.doc_id for r in held[names[2]]), key=repr) == clean and 9005 not in clean
    texts = {r.doc_id: r.text for r in held[names[2]]}
    assert sorted((r.doc_id for r in held[names[3]]), key=repr) == clean
    for r in held[names[3]]:
        if texts[r.doc_id] is None:
            assert r.text is None
        else:
            assert r.n_chars == len(r.text) and not any(base_spans(r.text).values())
            if not any(base_spans(texts[r.doc_id]).values()) and "<" not in r.text:
                assert r.text == texts[r.doc_id]
    check_packing([(r.doc_id, r.text) for r in held[names[3]]], held[names[4]], 1024)


def test_empty_documents(spark, folder):
    empty = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for name, stage in C.STAGES:
        empty = stage(spark, empty, folder)
        assert empty.count() == 0
