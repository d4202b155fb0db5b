import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from quire.llm.ebayes import fit_logistic, score_quality, strength
from quire.llm.ordinal import fit_cumulative_link, likelihood_ratio, score_severity, severity_grades, text_features


@pytest.fixture(scope="module")
def tables(spark):
    return tuple(spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))


def held_out(spark, tables, score, label, flag):
    docs, labels = tables
    train, test = labels.filter("doc_id % 3 <> 0"), labels.filter("doc_id % 3 = 0")
    got = score(docs, train).select("doc_id", F.col(flag).alias("said")).join(test, "doc_id").select(label, "said").collect()
    hit = [r for r in got if r[0] == 1]
    rest = [r for r in got if r[0] == 0]
    return np.mean([r[1] for r in hit]), np.mean([r[1] for r in rest]), len(hit), len(rest)


def test_quality_beats_majority_on_held_out_labels(spark, tables):
    kept, wrong, *_ = held_out(spark, tables, score_quality, "quality", "keep")
    assert kept >= 0.98 and wrong <= 0.1


def test_severity_on_held_out_labels(spark):
    # sf0.01 has under 30 toxic training documents, too few to meet each language's words
    larger = tuple(spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    caught, wrong, *_ = held_out(spark, larger, score_severity, "toxic", "toxic")
    assert caught >= 0.75 and wrong <= 0.02


@pytest.mark.xfail(strict=True, reason="8 of 13 caught: the 3 German and 2 Spanish ones share no significant word "
                                       "with the 3 and 2 toxic training documents of their languages")
def test_severity_on_held_out_labels_sf001(spark, tables):
    caught, wrong, *_ = held_out(spark, tables, score_severity, "toxic", "toxic")
    assert caught >= 0.75 and wrong <= 0.02


def test_severity_is_found_in_every_language(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    got = score_severity(docs, labels.filter("doc_id % 3 <> 0")).select("doc_id", F.col("toxic").alias("said"))
    test = labels.filter("doc_id % 3 = 0 AND toxic = 1").join(docs.select("doc_id", "lang"), "doc_id")
    share = {r.lang: r.x for r in got.join(test, "doc_id").groupBy("lang").agg(F.avg(F.col("said").cast("int")).alias("x")).collect()}
    assert set(share) == {"en", "de", "fr", "es"} and min(share.values()) >= 0.5, share


def test_rare_but_significant_words_count():
    # 8 of 400 toxic documents are in the rarer language and share one word
    clean = [{"ab"[i % 20 == 0], f"c{i % 50}"} for i in range(2000)]
    toxic = [{"a", "vile"} for _ in range(392)] + [{"b", "ruin"} for _ in range(8)]
    m = fit_cumulative_link(clean + toxic, np.array([0] * 2000 + [1 + i % 2 for i in range(400)]), 2, 100)
    assert m.weights["ruin"] > 0 and min(m.weights.values()) > 0
    p = m.exceed(np.array([m.weights["ruin"], 0.0]))[:, 0]
    assert p[0] >= m.toxic_from > p[1]


def test_sparse_sites_shrink(spark, tables):
    docs, labels = tables
    got = score_quality(docs, labels).collect()
    assert len(got) == docs.count()
    assert all(0 < r.path_rate < 1 and 0 < r.quality < 1 for r in got)
    lone = docs.limit(1).selectExpr("99999 doc_id", "text", "'xx' lang", "'new site' source", "n_chars")
    site = [r for r in score_quality(docs.union(lone), labels).collect() if r.doc_id == 99999][0]
    mean = np.mean([r.host_rate for r in got])
    assert abs(site.path_rate - mean) < 0.1


ODD = [(1, None, None, None), (2, "", "en", "s"), (2, "", "en", "s"), (None, "!!! ???", "en", None), (3, "x" * 200_000, "", ""),
       (4, "a b " * 50_000, "en", "s")]


def odd(spark):
    d = spark.createDataFrame([(*r, 1.0, True) for r in ODD], "doc_id long, text string, lang string, source string, p double, toxic boolean")
    return d, spark.createDataFrame([], "doc_id long, quality int, toxic int")


def test_odd_rows_without_labels(spark):
    d, none = odd(spark)
    got = score_quality(d, none).collect()
    assert len(got) == len(ODD) and all(r.keep and r.evidence == 0 and r.quality == pytest.approx(0.5) for r in got)
    got = score_severity(d, none).collect()
    assert len(got) == len(ODD) and not any(r.toxic or r.expected_severity for r in got)


def test_odd_rows_with_labels(spark, tables):
    d, _ = odd(spark)
    lab = tables[1].union(spark.createDataFrame([(None, 1, 1), (1, None, None), (2, 0, 1), (2, 1, 0)], "doc_id long, quality int, toxic int"))
    docs = tables[0].select("doc_id", "text", "lang", "source").union(d.select("doc_id", "text", "lang", "source"))
    assert score_quality(docs, lab).count() == docs.count()
    got = score_severity(docs, lab).filter("doc_id is null").collect()
    assert len(got) == 1 and not got[0].toxic


def test_empty_tables(spark):
    d, none = odd(spark)
    assert score_quality(d.limit(0), none).count() == 0
    assert score_severity(d.limit(0), none).count() == 0


def test_logistic_recovers_a_known_boundary():
    rnd = np.random.default_rng(0)
    x = np.c_[rnd.normal(size=(4000, 2)), np.ones(4000)]
    y = (rnd.random(4000) < 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1] + 0.5)))).astype(float)
    assert np.allclose(fit_logistic(x, y, ridge=0.01), [2, -1, 0.5], atol=0.25)
    assert strength(0.5, 0.0) == 1e4 and strength(0.5, 0.25) == 1.0


def test_ordinal_orders_severity():
    rnd = random.Random(1)
    sets, toxic = [], []
    for i in range(1500):
        words = {rnd.choice(["red", "blue", "green", "grey"]) for _ in range(3)} | {f"w{rnd.randrange(200)}"}
        t = i % 5 == 0
        if t:
            words |= {rnd.choice(["vile", "foul", "nasty", "rotten"]) for _ in range(rnd.randint(1, 6))}
        sets.append(words)
        toxic.append(int(t))
    grade = severity_grades(sets, np.array(toxic), 3)
    assert sorted(set(grade)) == [0, 1, 2, 3]
    m = fit_cumulative_link(sets, grade, 3, 1000)
    assert m.thresholds == sorted(m.thresholds) and set(m.weights) <= {"vile", "foul", "nasty", "rotten"}
    p = m.exceed(np.array([sum(m.weights.get(f, 0) for f in s) for s in sets]))
    assert ((p[:, 0] >= m.toxic_from) == np.array(toxic, bool)).mean() > 0.99
    mean = [p[grade == g].sum(1).mean() for g in range(4)]
    assert mean == sorted(mean) and (np.diff(p, axis=1) <= 0).all()
    assert likelihood_ratio(10, 100, 100, 1000) == pytest.approx(0, abs=1e-9)
    assert text_features("Lowei, lowei X1 abcdef!") == {"lowei", "x", "abcdef", "lowe-", "abcd-", "abcde-"}
