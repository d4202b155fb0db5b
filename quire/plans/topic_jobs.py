"""Registered analyses: topic reports and coherence (M6-M18) on a
deterministic topic table (topic = document language, weight = the term's
share of that language's tokens), plus fitted topic models (rows checks)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.partitioning import by_key, spread
from ..functions.text import alpha_lower, word_tokens
from ..operators import topics as M
from ..operators import vectors as X
from ..session import stored
from . import sqlfrag as S
from .registry import Tables, register

N_TOP = 20
N_COH = 10
CV_WINDOW = 110
SWEEP_GROUPS = ("lang", "source")
_ALPHA = S.alpha_lower(S.word_tokens("text"))


def tokens(spark, sf) -> DataFrame:
    d = by_key(Tables(spark, sf).documents.select("doc_id", "text", "lang", "source"), "doc_id")
    return d.select("doc_id", "lang", "source", alpha_lower(word_tokens("text")).alias("tokens"))


def model(spark, sf, group: str = "lang"):
    t = tokens(spark, sf)
    b = X.bow(t)
    topics = M.term_shares(b, t.select("doc_id", F.col(group).alias("topic")))
    return t, b, topics


_BASE = f"""
  t AS (SELECT doc_id, lang, source, {_ALPHA} AS tokens FROM documents),
  b AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(tokens) AS term FROM t) GROUP BY doc_id, term)"""


def _topics_sql(group: str) -> str:
    return f"""
  tp_{group} AS (SELECT topic, term, tf::DOUBLE / sum(tf) OVER (PARTITION BY topic) AS weight FROM (
    SELECT t.{group} AS topic, b.term, sum(b.tf) AS tf FROM b JOIN t USING (doc_id) GROUP BY ALL))"""


def _top_sql(src: str, n: int, by_abs: bool = False) -> str:
    key = "abs(weight)" if by_abs else "weight"
    return f"""SELECT * FROM (SELECT topic, term, weight, row_number() OVER (PARTITION BY topic ORDER BY {key} DESC, term) AS rank
            FROM {src}) WHERE rank <= {n}"""


_LANG = f"{_BASE}, {_topics_sql('lang')}"


@register("M6_topic_words", sql=f"WITH {_LANG} SELECT topic, term, round(weight, 6) AS weight, rank FROM ({_top_sql('tp_lang', N_TOP)})")
def q_topic_words(spark, sf):
    _, _, topics = model(spark, sf)
    return M.top_words(topics, N_TOP).withColumn("weight", F.round("weight", 6))


def _lang_ids(spark, sf) -> list[str]:
    # the topic ids name the output columns; a handful of values
    return sorted(r[0] for r in Tables(spark, sf).documents.select("lang").distinct().collect())


@register("M6_topic_words_wide", sql=f"""
WITH {_LANG}, tw AS ({_top_sql('tp_lang', N_TOP)}),
  tn AS (SELECT *, dense_rank() OVER (ORDER BY topic) AS k FROM tw)
SELECT rank, max(term) FILTER (WHERE k = 1) AS "Topic # 01", max(term) FILTER (WHERE k = 2) AS "Topic # 02",
       max(term) FILTER (WHERE k = 3) AS "Topic # 03", max(term) FILTER (WHERE k = 4) AS "Topic # 04"
FROM tn GROUP BY rank
""")
def q_topic_words_wide(spark, sf):
    _, _, topics = model(spark, sf)
    return M.topic_words_wide(M.top_words(topics, N_TOP), _lang_ids(spark, sf))


def signed(topics: DataFrame) -> DataFrame:
    """Signed loadings: weight minus the term's mean weight over topics."""
    return topics.withColumn("weight", F.col("weight") - F.avg("weight").over(Window.partitionBy("term")))


_SIGNED = "(SELECT topic, term, weight - avg(weight) OVER (PARTITION BY term) AS weight FROM tp_lang)"


@register("M7_concept_terms", sql=f"WITH {_LANG} SELECT topic, term, round(weight, 6) AS weight, rank FROM ({_top_sql(_SIGNED, 6, True)})")
def q_concept_terms(spark, sf):
    _, _, topics = model(spark, sf)
    return M.top_words(signed(topics), 6, by_abs=True).withColumn("weight", F.round("weight", 6))


def _umass_sql(tp: str) -> str:
    return f"""
  tw_{tp} AS ({_top_sql(tp, N_COH)}),
  inc_{tp} AS (SELECT DISTINCT b.doc_id, b.term FROM b WHERE b.term IN (SELECT term FROM tw_{tp})),
  d1_{tp} AS (SELECT term, count(*) AS d FROM inc_{tp} GROUP BY term),
  it_{tp} AS (SELECT inc_{tp}.doc_id, tw_{tp}.topic, tw_{tp}.term, tw_{tp}.rank FROM inc_{tp} JOIN tw_{tp} USING (term)),
  co_{tp} AS (SELECT a.topic, a.term AS wi, b2.term AS wj, count(*) AS dij FROM it_{tp} a JOIN it_{tp} b2
              ON a.doc_id = b2.doc_id AND a.topic = b2.topic AND a.rank > b2.rank GROUP BY ALL),
  um_{tp} AS (SELECT x.topic, avg(ln((coalesce(co.dij, 0) + 1.0) / d1.d)) AS coherence
              FROM tw_{tp} x JOIN tw_{tp} y ON x.topic = y.topic AND x.rank > y.rank
              LEFT JOIN co_{tp} co ON co.topic = x.topic AND co.wi = x.term AND co.wj = y.term
              JOIN d1_{tp} d1 ON d1.term = y.term GROUP BY x.topic)"""


@register("M9_coherence_umass", sql=f"WITH {_LANG}, {_umass_sql('tp_lang')} SELECT topic, round(coherence, 6) AS coherence FROM um_tp_lang")
def q_umass(spark, sf):
    _, b, topics = model(spark, sf)
    return M.coherence_umass(M.top_words(topics, N_COH), b).withColumn("coherence", F.round("coherence", 6))


def _cv_sql(tp: str) -> str:
    w = CV_WINDOW
    return f"""
  cvw_{tp} AS ({_top_sql(tp, N_COH)}),
  nw_{tp} AS (SELECT sum(greatest(len(tokens) - {w} + 1, 1)) AS N FROM t),
  hits_{tp} AS (SELECT doc_id, L, p, term FROM (
      SELECT doc_id, len(tokens) AS L, generate_subscripts(tokens, 1) - 1 AS p, unnest(tokens) AS term FROM t)
      WHERE term IN (SELECT term FROM cvw_{tp})),
  wins_{tp} AS (SELECT DISTINCT doc_id, term, unnest(range(greatest(p - {w} + 1, 0), least(p, greatest(L - {w}, 0)) + 1)) AS s FROM hits_{tp}),
  p1_{tp} AS (SELECT term, count(*) AS c1 FROM wins_{tp} GROUP BY term),
  aw_{tp} AS (SELECT wins_{tp}.doc_id, wins_{tp}.s, cvw_{tp}.topic, wins_{tp}.term FROM wins_{tp} JOIN cvw_{tp} USING (term)),
  co2_{tp} AS (SELECT a.topic, a.term AS wi, b2.term AS wj, count(*) AS c2 FROM aw_{tp} a JOIN aw_{tp} b2
               ON a.doc_id = b2.doc_id AND a.s = b2.s AND a.topic = b2.topic GROUP BY ALL),
  g_{tp} AS (SELECT x.topic, x.term AS wi, y.term AS wj,
                 coalesce(ln((coalesce(co.c2, 0)::DOUBLE / N + 1e-12) / nullif((coalesce(pa.c1, 0)::DOUBLE / N) * (coalesce(pb.c1, 0)::DOUBLE / N), 0))
                          / nullif(-ln(coalesce(co.c2, 0)::DOUBLE / N + 1e-12), 0), 0.0) AS v
             FROM cvw_{tp} x JOIN cvw_{tp} y ON x.topic = y.topic CROSS JOIN nw_{tp}
             LEFT JOIN co2_{tp} co ON co.topic = x.topic AND co.wi = x.term AND co.wj = y.term
             LEFT JOIN p1_{tp} pa ON pa.term = x.term LEFT JOIN p1_{tp} pb ON pb.term = y.term),
  tv_{tp} AS (SELECT topic, wj, sum(v) AS tv FROM g_{tp} GROUP BY topic, wj),
  dots_{tp} AS (SELECT g.topic, g.wi, sum(g.v * tv.tv) AS dot, sqrt(sum(g.v * g.v)) AS nv
                FROM g_{tp} g JOIN tv_{tp} tv ON tv.topic = g.topic AND tv.wj = g.wj GROUP BY g.topic, g.wi),
  tn_{tp} AS (SELECT topic, sqrt(sum(tv * tv)) AS nt FROM tv_{tp} GROUP BY topic),
  cv_{tp} AS (SELECT d.topic, avg(coalesce(d.dot / nullif(d.nv * tn.nt, 0), 0.0)) AS coherence
              FROM dots_{tp} d JOIN tn_{tp} tn USING (topic) GROUP BY d.topic)"""


@register("M10_coherence_cv", sql=f"WITH {_LANG}, {_cv_sql('tp_lang')} SELECT topic, round(coherence, 6) AS coherence FROM cv_tp_lang")
def q_cv(spark, sf):
    t, _, topics = model(spark, sf)
    return M.coherence_cv(M.top_words(topics, N_COH), t, window=CV_WINDOW).withColumn("coherence", F.round("coherence", 6))


def sweep_scores(spark, sf) -> DataFrame:
    """(k, measure, score) of the topics by language and by source.  The topics
    of both groups are counted and scored together: one pass over the documents
    for the topics and one for both measures, which share the dealt tokens."""
    d = spread(Tables(spark, sf).documents.select("doc_id", "text", "lang", "source"), "doc_id")
    # dealt as one string a document, half the bytes of an array of its words
    d = d.select("doc_id", "lang", "source", F.array_join(alpha_lower(word_tokens("text")), " ").alias("_t"))
    words = F.when(F.col("_t") == "", F.array().cast("array<string>")).otherwise(F.split("_t", " "))
    t = by_key(d, "doc_id").select("doc_id", "lang", "source", words.alias("tokens"))
    b = X.bow(t)
    kinds = [F.struct(F.lit(g).alias("by"), F.col(g).alias("topic")) for g in SWEEP_GROUPS]
    groups = t.select("doc_id", F.explode(F.array(*kinds)).alias("topic")).filter("topic.topic IS NOT NULL")
    top = stored(M.top_words(M.term_shares(b, groups), N_COH), "sweep-topics")  # N_COH words a topic
    ks = top.groupBy(F.col("topic.by").alias("by")).agg(F.countDistinct("topic.topic").cast("long").alias("k"))
    out = spark.createDataFrame([(g, m) for g in SWEEP_GROUPS for m in ("u_mass", "c_v")], "by string, measure string")
    scores = None
    for measure, found in (("u_mass", M.coherence_umass(top, b)), ("c_v", M.coherence_cv(top, t, window=CV_WINDOW))):
        s = found.groupBy(F.col("topic.by").alias("by")).agg(F.avg("coherence").alias("score")).withColumn("measure", F.lit(measure))
        scores = s if scores is None else scores.unionByName(s)
    out = out.join(F.broadcast(scores), ["by", "measure"], "left").join(F.broadcast(ks), "by", "left")
    return out.select("score", "measure", F.coalesce("k", F.lit(0).cast("long")).alias("k"))


_SWEEP_SQL = f"""
WITH {_BASE}, {_topics_sql('lang')}, {_topics_sql('source')}, {_umass_sql('tp_lang')}, {_umass_sql('tp_source')},
  {_cv_sql('tp_lang')}, {_cv_sql('tp_source')}
SELECT (SELECT count(DISTINCT topic) FROM tp_lang) AS k, 'u_mass' AS measure, round(avg(coherence), 6) AS score FROM um_tp_lang
UNION ALL SELECT (SELECT count(DISTINCT topic) FROM tp_lang), 'c_v', round(avg(coherence), 6) FROM cv_tp_lang
UNION ALL SELECT (SELECT count(DISTINCT topic) FROM tp_source), 'u_mass', round(avg(coherence), 6) FROM um_tp_source
UNION ALL SELECT (SELECT count(DISTINCT topic) FROM tp_source), 'c_v', round(avg(coherence), 6) FROM cv_tp_source
"""


@register("M11_sweep_scores", sql=_SWEEP_SQL)
def q_sweep(spark, sf):
    return sweep_scores(spark, sf).select("k", "measure", F.round("score", 6).alias("score"))


@register("M12_best_k", sql=f"""
WITH sw AS ({_SWEEP_SQL}),
  per AS (SELECT measure, k, score FROM (
    SELECT *, row_number() OVER (PARTITION BY measure ORDER BY score DESC, k) AS r FROM sw) WHERE r = 1)
SELECT measure, k, score FROM per ORDER BY score DESC, k LIMIT 1
""")
def q_best_k(spark, sf):
    return M.best_k(sweep_scores(spark, sf)).withColumn("score", F.round("score", 6))


@register("M13_topic_distribution", sql=f"""
WITH {_LANG}, s AS {_SIGNED},
  mm AS (SELECT topic, term, coalesce((weight - min(weight) OVER (PARTITION BY topic))
                / nullif(max(weight) OVER (PARTITION BY topic) - min(weight) OVER (PARTITION BY topic), 0), 0.0) AS m FROM s)
SELECT topic, term, round(coalesce(m / nullif(sum(m) OVER (PARTITION BY topic), 0), 0.0), 6) AS weight FROM mm
""")
def q_distribution(spark, sf):
    _, _, topics = model(spark, sf)
    return M.topic_distribution(signed(topics)).select("topic", "term", F.round("weight", 6).alias("weight"))


@register("M14_topic_distances", sql=f"""
WITH {_LANG},
  bc AS (SELECT x.topic AS a, y.topic AS b, sum(sqrt(x.weight) * sqrt(y.weight)) AS bc FROM tp_lang x JOIN tp_lang y
         ON x.term = y.term AND x.topic < y.topic GROUP BY ALL),
  ids AS (SELECT DISTINCT topic FROM tp_lang)
SELECT x.topic AS a, y.topic AS b, round(sqrt(greatest(1.0 - coalesce(bc.bc, 0.0), 0.0)), 6) AS hellinger
FROM ids x JOIN ids y ON x.topic < y.topic LEFT JOIN bc ON bc.a = x.topic AND bc.b = y.topic
""")
def q_distances(spark, sf):
    _, _, topics = model(spark, sf)
    return M.topic_distances(topics).withColumn("hellinger", F.round("hellinger", 6))


_MIX = f"""
  lens AS (SELECT doc_id, sum(tf) AS len FROM b GROUP BY doc_id),
  raw AS (SELECT b.doc_id, tp.topic, sum(b.tf::DOUBLE / lens.len * tp.weight) AS w FROM b JOIN lens USING (doc_id)
          JOIN tp_lang tp USING (term) GROUP BY ALL),
  mix AS (SELECT doc_id, topic, w / sum(w) OVER (PARTITION BY doc_id) AS weight FROM raw),
  kw AS (SELECT topic, string_agg(term, ', ' ORDER BY rank) AS keywords FROM ({_top_sql('tp_lang', N_COH)}) GROUP BY topic),
  dom AS (SELECT doc_id, topic FROM (
            SELECT doc_id, topic, row_number() OVER (PARTITION BY doc_id ORDER BY weight DESC, topic) AS r FROM mix) WHERE r = 1),
  domw AS (SELECT m.doc_id, m.topic, {S.stable_round('m.weight', 4)} AS contribution FROM mix m JOIN dom USING (doc_id, topic)),
  dk AS (SELECT domw.*, kw.keywords FROM domw LEFT JOIN kw USING (topic))"""


def dominant(spark, sf):
    _, b, topics = model(spark, sf)
    mix = M.doc_topic_mix(b, topics)
    kw = M.topic_keywords(M.top_words(topics, N_COH))
    return M.dominant_topic(mix, kw)


@register("M15_dominant_topic", sql=f"WITH {_LANG}, {_MIX} SELECT doc_id, topic, contribution, keywords FROM dk")
def q_dominant(spark, sf):
    return dominant(spark, sf).select("doc_id", "topic", "contribution", "keywords")


@register("M16_representative_docs", sql=f"""
WITH {_LANG}, {_MIX}
SELECT doc_id, topic, contribution, keywords, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY topic ORDER BY contribution DESC, doc_id) AS rank FROM dk) WHERE rank <= 1
""")
def q_representative(spark, sf):
    return M.representative_docs(dominant(spark, sf), 1).select("doc_id", "topic", "contribution", "keywords", "rank")


@register("M17_topic_shares", sql=f"""
WITH {_LANG}, {_MIX},
  cnt AS (SELECT topic, count(*) AS n_docs FROM dk GROUP BY topic)
SELECT cnt.topic, cnt.n_docs, {S.stable_round('cnt.n_docs * 100.0 / (SELECT sum(n_docs) FROM cnt)', 4)} AS pct, kw.keywords
FROM cnt LEFT JOIN kw USING (topic)
""")
def q_shares(spark, sf):
    _, _, topics = model(spark, sf)
    kw = M.topic_keywords(M.top_words(topics, N_COH))
    return M.topic_shares(dominant(spark, sf).select("doc_id", "topic"), kw)


@register("M18_head_dominant", sql=f"WITH {_LANG}, {_MIX} SELECT doc_id, topic, contribution FROM dk ORDER BY doc_id LIMIT 30")
def q_head(spark, sf):
    return dominant(spark, sf).select("doc_id", "topic", "contribution").orderBy("doc_id").limit(30)
