"""Registered analyses: page-table sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.partitioning import spread
from ..operators import learn as L
from ..sources import files as SF
from ..sources import pages as SP
from . import sqlfrag_text as ST
from .registry import Tables, register

_Q = P.sql_str
CAP_HREF = "^/[A-Z]"
TITLE_RE = r"(?s)<title>(.*?)</title>"
FALLBACK = "{origin}/files/{n}/{n}-0.txt"


def pages(spark, sf) -> DataFrame:
    return spread(Tables(spark, sf).pages, "page_id")


def _tag_text(x: str) -> str:
    stripped = f"regexp_replace({x}, {_Q(SP.TAG)}, '', 'g')"
    return f"trim(regexp_replace({ST.replace_many(stripped, SP.ENTITIES)}, '\\s+', ' ', 'g'))"


_HREFS = (f"list_transform(regexp_extract_all({{}}, {_Q(P.ANCHOR)}, 1), "
          f"lambda v: regexp_replace(v, {_Q(P.QUOTES)}, '', 'g'))")


def _links_sql(filter_re: str | None = None) -> str:
    z = "list_transform(h, lambda x, i: {'href': x, 'anchor': a[i]})"
    if filter_re:
        z = f"list_filter({z}, lambda s: regexp_matches(s.href, {_Q(filter_re)}))"
    return f"""
SELECT page_id, pos, l.href AS href, {_tag_text('l.anchor')} AS anchor FROM (
  SELECT page_id, generate_subscripts(z, 1) - 1 AS pos, unnest(z) AS l FROM (
    SELECT page_id, {z} AS z FROM (
      SELECT page_id, {_HREFS.format('html')} AS h, regexp_extract_all(html, {_Q(P.ANCHOR)}, 2) AS a FROM pages)))"""


def _resolve_sql(h: str, b: str) -> str:
    return (f"CASE WHEN regexp_matches({h}, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN {h} "
            f"WHEN starts_with({h}, '//') THEN regexp_extract({b}, '^([a-zA-Z][a-zA-Z0-9+.-]*:)', 1) || {h} "
            f"WHEN starts_with({h}, '/') THEN regexp_extract({b}, {_Q(P.URL_ORIGIN)}, 1) || {h} "
            f"WHEN starts_with({h}, '?') THEN regexp_replace({b}, '[?#].*$', '') || {h} "
            f"WHEN starts_with({h}, '#') THEN regexp_replace({b}, '#.*$', '') || {h} "
            f"ELSE regexp_replace(regexp_replace({b}, '[?#].*$', ''), '[^/]*$', '') || {h} END")


@register("S1_extract_links", sql=_links_sql())
def q_links(spark, sf):
    return SP.extract_links(pages(spark, sf))


@register("S1_extract_links_filtered", sql=_links_sql(CAP_HREF))
def q_links_filtered(spark, sf):
    return SP.extract_links(pages(spark, sf), CAP_HREF)


@register("S2_resolve_url", sql=f"""
WITH l AS ({_links_sql()})
SELECT l.page_id, l.pos, {_resolve_sql('l.href', 'p.url')} AS url FROM l JOIN pages p USING (page_id)
""")
def q_resolve(spark, sf):
    p = pages(spark, sf)
    links = SP.extract_links(p).join(p.select("page_id", F.col("url").alias("base")), "page_id")
    return links.select("page_id", "pos", SP.resolve_url("href", "base").alias("url"))


def _seeds_sql() -> str:
    return f"SELECT page_id AS seed_id, {_tag_text(f'regexp_extract(html, {_Q(TITLE_RE)}, 1)')} AS title, url FROM pages"


def _hop_sql(prev: str, pat: str) -> str:
    first = f"list_filter({_HREFS.format('p.html')}, lambda x: regexp_matches(x, {_Q(pat)}))[1]"
    return (f"SELECT c.seed_id, c.title, {_resolve_sql(first, 'c.url')} AS url FROM ({prev}) c JOIN pages p ON p.url = c.url "
            f"WHERE {first} IS NOT NULL")


@register("S3_follow_links", sql=f"""
WITH h0 AS ({_seeds_sql()}), h1 AS ({_hop_sql('SELECT * FROM h0', '^/')}), h2 AS ({_hop_sql('SELECT * FROM h1', '^/')})
SELECT seed_id, title, 0::BIGINT AS hop, url FROM h0
UNION ALL SELECT seed_id, title, 1::BIGINT, url FROM h1
UNION ALL SELECT seed_id, title, 2::BIGINT, url FROM h2
""")
def q_follow(spark, sf):
    p = pages(spark, sf)
    seeds = p.select(F.col("page_id").alias("seed_id"), "url",
                     SP.tag_text(F.regexp_extract("html", TITLE_RE, 1)).alias("title"))
    return SP.follow_links(p, seeds, ["^/", "^/"]).select("seed_id", "title", "hop", "url")


@register("S4_first_distinct_links", sql=f"""
WITH l AS ({_links_sql()}),
  f AS (SELECT page_id, href, min(pos) AS pos FROM l WHERE pos < 6 GROUP BY page_id, href)
SELECT page_id, href, pos, row_number() OVER (PARTITION BY page_id ORDER BY pos) AS rank FROM f
""")
def q_first_distinct(spark, sf):
    return SP.first_distinct_links(SP.extract_links(pages(spark, sf)), 3)


def _element_sql(tag: str, class_re: str | None = None) -> str:
    pat = _Q(SP.element_pattern(tag))
    body = f"regexp_replace(html, {_Q(SP.HIDDEN)}, '', 'g')"
    z = "list_transform(ats, lambda x, i: {'attrs': x, 'inner': inn[i]})"
    if class_re:
        z = f"list_filter({z}, lambda s: regexp_matches(regexp_extract(s.attrs, 'class=\"([^\"]*)\"', 1), {_Q(class_re)}))"
    return f"""
SELECT page_id, pos, {_tag_text('e.inner')} AS text FROM (
  SELECT page_id, generate_subscripts(z, 1) - 1 AS pos, unnest(z) AS e FROM (
    SELECT page_id, {z} AS z FROM (
      SELECT page_id, regexp_extract_all(b, {pat}, 1) AS ats, regexp_extract_all(b, {pat}, 2) AS inn
      FROM (SELECT page_id, {body} AS b FROM pages))))"""


@register("S5_element_text_h1", sql=_element_sql("h1"))
def q_h1(spark, sf):
    return SP.element_text(pages(spark, sf), "h1")


@register("S5_element_text_p", sql=_element_sql("p"))
def q_p(spark, sf):
    return SP.element_text(pages(spark, sf), "p")


@register("S5_element_text_ad", sql=_element_sql("div", "^ad"))
def q_ad(spark, sf):
    return SP.element_text(pages(spark, sf), "div", "^ad")


@register("S6_rating_or_default", sql="""
SELECT page_id, coalesce(TRY_CAST(regexp_extract(url, 'page=([0-9]+)', 1) AS DOUBLE), 5.0) AS stars FROM pages
""")
def q_rating(spark, sf):
    return SP.rating_or_default(pages(spark, sf), "url", "page=([0-9]+)").select("page_id", "stars")


@register("L4_binarize_rating", sql="""
SELECT page_id, stars, (stars > 5.0)::INTEGER AS label FROM (
  SELECT page_id, coalesce(TRY_CAST(regexp_extract(url, 'page=([0-9]+)', 1) AS DOUBLE), 5.0) AS stars FROM pages)
WHERE stars <> 5.0
""")
def q_binarize(spark, sf):
    r = SP.rating_or_default(pages(spark, sf), "url", "page=([0-9]+)").select("page_id", "stars")
    return L.binarize_rating(r)


@register("S7_union_ranked", sql=f"""
WITH l AS ({_links_sql()}),
  u AS (SELECT 1 AS page, l.page_id, l.pos, l.href FROM l JOIN pages p USING (page_id) WHERE starts_with(p.url, 'https:')
        UNION ALL SELECT 2 AS page, l.page_id, l.pos, l.href FROM l JOIN pages p USING (page_id) WHERE NOT starts_with(p.url, 'https:'))
SELECT page, page_id, pos, href, row_number() OVER (ORDER BY page, page_id, pos) AS rank FROM u
""")
def q_union_ranked(spark, sf):
    p = pages(spark, sf)
    links = SP.extract_links(p).join(p.select("page_id", "url"), "page_id")
    secure = links.filter(F.col("url").startswith("https:")).select(F.lit(1).alias("page"), "page_id", "pos", "href")
    plain = links.filter(~F.col("url").startswith("https:")).select(F.lit(2).alias("page"), "page_id", "pos", "href")
    return SP.union_ranked([secure, plain], order=("page", "page_id", "pos"))


@register("S11_assign_split", sql="""
SELECT doc_id, CASE WHEN doc_id // 250 = 0 THEN 'train' WHEN doc_id // 250 = 1 THEN 'test' ELSE 'extra' END AS split,
       CASE WHEN doc_id // 250 < 2 THEN (1 - (doc_id // 125) % 2)::DOUBLE END AS sentiment
FROM documents
""")
def q_split(spark, sf):
    d = Tables(spark, sf).documents.select("doc_id")
    return L.assign_split(d, split_size=250, label_size=125)


@register("L1_by_split", sql="""
SELECT split, count(*) AS n FROM (
  SELECT CASE WHEN doc_id // 250 = 0 THEN 'train' WHEN doc_id // 250 = 1 THEN 'test' ELSE 'extra' END AS split FROM documents)
WHERE split IN ('train', 'test') GROUP BY split
""")
def q_by_split(spark, sf):
    d = L.assign_split(Tables(spark, sf).documents.select("doc_id"), split_size=250, label_size=125)
    return L.by_split(d, ["train", "test"]).groupBy("split").agg(F.count(F.lit(1)).cast("long").alias("n"))


@register("S10_write_corpus", sql="""
SELECT row_number() OVER (ORDER BY source, doc_id) - 1 AS id, doc_id, md5(text) AS digest FROM documents
""")
def q_write_corpus(spark, sf):
    d = Tables(spark, sf).documents
    back = SF.write_corpus(d, SF.corpus_path(spark, "corpus"), order=["source", "doc_id"])
    return back.select("id", "doc_id", F.md5("text").alias("digest"))


@register("S12_decode_counts", sql="SELECT 'utf8' AS status, count(*) AS n FROM pages UNION ALL SELECT 'failed', count(*) FROM pages")
def q_decode(spark, sf):
    p = pages(spark, sf)
    blobs = p.select(F.encode("html", "UTF-8").alias("content")).unionByName(
        p.select(F.encode("html", "UTF-16").alias("content")))
    return SF.decode_counts(SF.decode_text(blobs))


@register("S13_fallback_url", sql="""
WITH f AS (SELECT page_id, url,
  CASE WHEN regexp_extract(url, '([0-9]+)', 1) <> '' THEN
    regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]+)', 1) || '/files/' || regexp_extract(url, '([0-9]+)', 1)
    || '/' || regexp_extract(url, '([0-9]+)', 1) || '-0.txt' END AS fallback FROM pages)
SELECT f.page_id, f.fallback, coalesce(q.url, f.url) AS chosen FROM f LEFT JOIN pages q ON q.url = f.fallback
""")
def q_fallback(spark, sf):
    p = pages(spark, sf)
    f = SP.fallback_url(p.select("page_id", "url"), FALLBACK)
    known = p.select(F.col("url").alias("fallback"), F.col("url").alias("_found"))
    j = f.join(known, "fallback", "left")
    return j.select("page_id", "fallback", F.coalesce("_found", "url").alias("chosen"))


@register("S8_xml_roundtrip", sql=f"SELECT lower(text) AS text FROM ({_element_sql('h1')})")
def q_xml(spark, sf):
    h1 = SP.element_text(pages(spark, sf), "h1")
    path = SF.corpus_path(spark, "h1_records")
    SF.write_records(h1, path, "title")
    return SF.read_records(spark, path, "row", value_col="title").select("text")
