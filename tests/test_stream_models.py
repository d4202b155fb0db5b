import random

import pytest
from pyspark.sql import functions as F

from quire.plans.flows import _tokenized, quality_pipeline
from quire.streaming.models import fitted_scorer, read_model, versions, write_model
from quire.streaming.scoring import score_stream, table_stream

SCHEMA = "doc_id long, text string, lang string"


def documents(lo, hi, seed=1):
    rnd = random.Random(seed + lo)
    rows = []
    for i in range(lo, hi):
        y = i % 2
        words = [rnd.choice(["good", "fine", "well"] if y else ["bad", "poor", "ill"]) if rnd.random() < 0.5
                 else rnd.choice(["a", "the", "of"]) for _ in range(20)]
        rows.append((i, " ".join(words), "en"))
    return rows


def put(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def fitted(spark, lo, hi):
    d = spark.createDataFrame(documents(lo, hi), SCHEMA)
    return quality_pipeline(_tokenized(d).withColumn("y", (F.col("doc_id") % 2).cast("double")), buckets=1 << 10)


def test_store_numbers_versions_and_reads_them_back(spark, tmp_path):
    store = str(tmp_path / "store")
    assert versions(spark, store).count() == 0
    with pytest.raises(ValueError):
        read_model(spark, store)
    first = fitted(spark, 0, 60)
    assert [write_model(first, store), write_model(fitted(spark, 0, 30), store)] == [1, 2]
    (tmp_path / "store/v3").mkdir()  # a writer that did not finish: no row in the table
    assert read_model(spark, store)[0] == 2 and read_model(spark, store, 1)[0] == 1
    with pytest.raises(ValueError):
        read_model(spark, store, 3)
    assert write_model(first, store) == 3
    test = _tokenized(spark.createDataFrame(documents(100, 140), SCHEMA))
    p = [[r.probability[1] for r in m.transform(test).orderBy("doc_id").collect()] for m in (first, read_model(spark, store, 1)[1])]
    assert p[0] == p[1]


def test_stream_scores_with_the_stored_model_and_resumes(spark, tmp_path):
    path, store, out, ck = (str(tmp_path / x) for x in ("documents.parquet", "store", "out", "ck"))
    put(spark, path, documents(100, 130))
    put(spark, path, documents(130, 160) + [(500, None, None), (501, "", "en")])
    write_model(fitted(spark, 0, 60), store)

    def run(version=None):
        scorer = fitted_scorer(spark, store, _tokenized, version)
        score_stream(table_stream(spark, path, bytes_per_batch=1), scorer, out, ck).awaitTermination()
        return {r.doc_id: (r.p, r.yhat, r.version, r.batch_id) for r in spark.read.parquet(out).collect()}

    first = run()
    assert set(first) == {*range(100, 160), 500, 501} and {x[3] for x in first.values()} == {0, 1}
    assert all(x[1] == i % 2 for i, x in first.items() if i < 500)
    offline = fitted_scorer(spark, store, _tokenized)(spark.read.parquet(path)).collect()
    assert {r.doc_id: (r.p, r.yhat, r.version) for r in offline} == {i: x[:3] for i, x in first.items()}
    write_model(fitted(spark, 0, 30), store)
    assert run() == first  # nothing new: nothing is scored again, old rows keep their version
    put(spark, path, documents(160, 170))
    later = run()
    assert {i: x for i, x in later.items() if i not in range(160, 170)} == first
    assert {later[i][2] for i in range(160, 170)} == {2}


def test_lexicon_scores_of_a_table_in_several_files(spark, tmp_path):
    """The table is a folder of files with any names."""
    from quire.plans.model_jobs import q_stream

    rows = [(i, text, lang, "web", len(text)) for i, text, lang in documents(0, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, i % 2, 0) for i in range(40)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    scored = q_stream(spark, str(tmp_path))
    assert sorted(r.doc_id for r in scored.collect()) == list(range(40))
