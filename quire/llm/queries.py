"""Registered queries of this subpackage."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from .charcrf import find_personal_data
from .ebayes import score_quality
from .eliasfano import token_files
from .filteraudit import audit_filters
from .fingerprints import fingerprint_documents, printed
from .hadamard import compress_vectors
from .normsearch import top_k_products
from .ordinal import score_severity
from .packing import pack_documents
from .radix import remove_repeats
from .redirects import judge_urls, rules_table
from .simhash import near_duplicate_classes
from .winnow import decontaminate

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


@query("op1_simhash_near_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents: 4-word shingles, 4 bits."""
    return near_duplicate_classes(table(spark, sf_dir, "documents"), shingle=4, max_bits=4).select(
        "doc_id", "fingerprint", "component_id")


#: (host, path, verdict)
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]

OP2_SQL = r"""
WITH RECURSIVE parts AS (
  SELECT page_id, url, html,
         CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest
  FROM pages),
own AS (
  SELECT page_id, url, html,
         coalesce(translate(regexp_extract(rest, '^[^/?#]*'),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
         CASE WHEN rest IS NOT NULL THEN lower(substr(url, 1, strpos(url, '://') + 2))
              || lower(regexp_extract(rest, '^[^/?#]*'))
              || regexp_extract(rest, '^[^/?#]*([^#]*)', 1) END AS node
  FROM parts),
rules(rhost, rpath, verdict) AS (VALUES
  ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
  ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fits AS (
  SELECT o.page_id, o.node, r.rhost || r.rpath AS rule, r.verdict,
         row_number() OVER (PARTITION BY o.page_id ORDER BY length(r.rhost || r.rpath) DESC, r.verdict) AS rn
  FROM own o JOIN rules r
    ON (o.host = r.rhost OR ends_with(o.host, '.' || r.rhost)) AND starts_with(o.path, r.rpath)),
ruled AS (SELECT * FROM fits WHERE rn = 1),
links AS (
  SELECT node AS a, unnest(regexp_extract_all(html,
    '(?i)<link[^>]*rel\s*=\s*["'']?canonical[^>]*href\s*=\s*["'']?([^"''\s>#]+)', 1)) AS b FROM own
  UNION
  SELECT node, unnest(regexp_extract_all(html,
    '(?i)<meta[^>]*http-equiv\s*=\s*["'']?refresh[^>]*url\s*=\s*["'']?([^"''\s>#]+)', 1)) FROM own),
edges AS (SELECT a, b FROM links WHERE a <> b UNION SELECT b, a FROM links WHERE a <> b),
reach AS (SELECT a AS node, b AS other FROM edges
          UNION SELECT r.node, e.b FROM reach r JOIN edges e ON r.other = e.a),
passed AS (
  SELECT r.node, CASE WHEN bool_or(f.verdict = 'allow') THEN 'allow' ELSE 'block' END AS verdict
  FROM reach r JOIN ruled f ON f.node = r.other GROUP BY r.node)
SELECT o.page_id, o.host, o.path, f.rule, coalesce(f.verdict, p.verdict, 'allow') AS verdict
FROM own o LEFT JOIN ruled f ON f.page_id = o.page_id LEFT JOIN passed p ON p.node = o.node
"""


@query("op2_redirect_url_filter", OP2_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict of every page url under the five rules and its aliases."""
    return judge_urls(table(spark, sf_dir, "pages"), rules_table(spark, URL_RULES)).select(
        "page_id", "host", "path", "rule", "verdict")


OP3_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i + 1:i + n], ' ') AS content
  FROM (SELECT item_id, w, least(len(w), 10) AS n, unnest(range(0, len(w) - least(len(w), 10) + 1)) AS i
        FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM wins),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i + 1:i + n], ' ') AS content
  FROM (SELECT doc_id, w, n, unnest(range(0, greatest(0, len(w) - n + 1))) AS i FROM d, lens)),
hit AS (SELECT doc_id, n, i, item_id FROM dw JOIN wins USING (n, content)),
hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


@query("op3_benchmark_decontamination", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside a 10-word window of a benchmark item."""
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@query("op6_elias_fano_token_files")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids (end id 0) written to token files and read back."""
    return token_files(table(spark, sf_dir, "documents"), VOCABULARY, 0).select(
        "doc_id", "start", "n_tokens", "ids_crc32")


@query("op8_residual_packing")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents (end id 2) packed into sequences of at most 1024 tokens."""
    return pack_documents(table(spark, sf_dir, "documents"), VOCABULARY, 2, capacity=1024)


OP9_SQL = """
WITH v AS (
  SELECT vec_id, [floor(64 * x::DOUBLE) for x in embedding] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT q.vec_id AS query_id, q.e, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
  FROM (SELECT DISTINCT * FROM v WHERE vec_id % 20 = 0) q JOIN v c ON q.vec_id <> c.vec_id),
ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id, e ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""


@query("op9_norm_bucket_topk", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products of every 20th vector over all vectors."""
    return top_k_products(table(spark, sf_dir, "embeddings"), k=20, every=20, scale=64.0)


@query("op4_ordinal_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected toxicity severity of every document."""
    return score_severity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_empirical_bayes_quality")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality posterior of every document from its text and its site."""
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP10_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
wins AS (
  SELECT doc_id, p, substr(x, 2 * p + 1, 100) AS w
  FROM (SELECT doc_id, x, unnest(range(0, greatest(0, length(x) // 2 - 49))) AS p FROM d)),
least AS (SELECT w, min(doc_id) AS m FROM wins GROUP BY w HAVING min(doc_id) <> max(doc_id)),
starts AS (SELECT wins.doc_id, wins.p FROM wins JOIN least USING (w) WHERE wins.doc_id > least.m),
steps AS (
  SELECT doc_id, p, CASE WHEN p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50 THEN 1 ELSE 0 END AS new FROM starts),
labelled AS (SELECT doc_id, p, sum(new) OVER (PARTITION BY doc_id ORDER BY p) AS g FROM steps),
spans AS (SELECT doc_id, g, min(p) AS a, max(p) + 50 AS z FROM labelled GROUP BY doc_id, g),
pieces AS (
  SELECT s.doc_id, s.a, substr(d.x, 2 * coalesce(lag(s.z) OVER w, 0) + 1,
                               2 * (s.a - coalesce(lag(s.z) OVER w, 0))) AS piece
  FROM spans s JOIN d USING (doc_id) WINDOW w AS (PARTITION BY s.doc_id ORDER BY s.a)),
heads AS (SELECT doc_id, string_agg(piece, '' ORDER BY a) AS x FROM pieces GROUP BY doc_id),
totals AS (SELECT doc_id, sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans, max(z) AS z FROM spans GROUP BY doc_id)
SELECT d.doc_id, (length(d.x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(heads.x, '') || substr(d.x, 2 * coalesce(totals.z, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN totals USING (doc_id) LEFT JOIN heads USING (doc_id)
"""


@query("op10_radix_passage_dedup", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without 50-byte passages of earlier ones."""
    return remove_repeats(table(spark, sf_dir, "documents"), depth=50).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


@query("op5_char_crf_personal_data")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: fixed patterns and tagged spans."""
    return find_personal_data(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


@query("op13_winnow_fingerprints")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winnowed fingerprints of every document and its edited text."""
    found = fingerprint_documents(table(spark, sf_dir, "documents"), gram=10, window=12)
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        printed("fingerprint").alias("fingerprint"), printed("edited_fingerprint").alias("edited_fingerprint"),
        "near_edited", "near_next")


#: failure conditions over a text and its measures, in the order of their letters
AUDIT_CONDITIONS = {
    "A": "n_words < 200",
    "B": "100L * n_distinct < 50L * n_words",
    "C": "100L * n_upper > 3L * n_chars",
    "D": "text RLIKE '[#$%&*|]'",
}

OP11_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS x,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
l AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
rated AS (
  SELECT doc_id, part,
         CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
         + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
         + CASE WHEN 100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 3 * length(x) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(x, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY x) THEN 16 ELSE 0 END AS mask
  FROM t),
counts AS (
  SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
  FROM rated LEFT JOIN l USING (doc_id) GROUP BY part, mask),
f(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
  FROM f a JOIN f b ON b.letter <> a.letter JOIN f c ON c.letter NOT IN (a.letter, b.letter)
  JOIN f d ON d.letter NOT IN (a.letter, b.letter, c.letter)
  JOIN f e ON e.letter NOT IN (a.letter, b.letter, c.letter, d.letter)),
steps AS (
  SELECT filter_order, step, f.bit AS own,
         (SELECT coalesce(sum(g.bit), 0) FROM f g WHERE strpos(filter_order, g.letter) < step)::INTEGER AS before
  FROM orders CROSS JOIN (SELECT unnest(range(1, 6)) AS step) JOIN f ON f.letter = substr(filter_order, step::INTEGER, 1))
SELECT part, filter_order, step::INTEGER AS step,
       coalesce(sum(n) FILTER (mask & (before | own) = 0), 0)::BIGINT AS kept,
       coalesce(sum(n) FILTER (mask & before = 0 AND mask & own <> 0), 0)::BIGINT AS removed,
       coalesce(sum(n) FILTER (mask & before <> 0 AND mask & own <> 0), 0)::BIGINT AS redundant,
       coalesce(sum(n) FILTER (mask = own), 0)::BIGINT AS unique_fails,
       coalesce(sum(good) FILTER (mask & before = 0 AND mask & own <> 0), 0)::BIGINT AS good_lost,
       coalesce(sum(toxic) FILTER (mask & before = 0 AND mask & own <> 0), 0)::BIGINT AS toxic_lost,
       coalesce(sum(n * 120 // greatest(bit_count(mask), 1)) FILTER (mask & own <> 0), 0)::BIGINT AS shapley
FROM counts CROSS JOIN steps GROUP BY part, filter_order, step
"""


@query("op11_filter_audit", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove in every order, per language."""
    return audit_filters(spark, f"{sf_dir.rstrip('/')}/documents.parquet", AUDIT_CONDITIONS,
                         table(spark, sf_dir, "labels"), copy_filter="E")


def _round_sql(k: int) -> str:
    """Nearest entries of codebook ``k``, and codebook ``k + 1`` from them."""
    return f"""
a{k} AS (
  SELECT row, p, min(list_sum([(z[1] - z[2]) * (z[1] - z[2]) for z in list_zip(v, c)])::BIGINT * 64 + entry) AS best
  FROM cut JOIN b{k} USING (p) GROUP BY row, p),
s{k} AS (
  SELECT p, best % 64 AS entry, pos, sum(v[pos]) AS total, count(*) AS n
  FROM a{k} JOIN cut USING (row, p), (SELECT unnest(range(1, (SELECT max(len(v)) FROM cut) + 1)) AS pos) GROUP BY ALL),
m{k} AS (
  SELECT p, entry, list((total - ((total % n) + n) % n) // n ORDER BY pos)::BIGINT[] AS c FROM s{k} GROUP BY p, entry),
b{k + 1} AS (SELECT p, entry, coalesce(m{k}.c, b{k}.c) AS c FROM b{k} LEFT JOIN m{k} USING (p, entry)),"""


OP12_SQL = f"""
WITH v AS (
  SELECT vec_id, label, [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS ints FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
r AS (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, ints) AS row FROM v),
cut AS (
  SELECT row, p, ints[p * (len(ints) // 16) + 1:(p + 1) * (len(ints) // 16)] AS v
  FROM (SELECT row, ints, unnest(range(0, 16)) AS p FROM r)),
b0 AS (SELECT p, row - 1 AS entry, v AS c FROM cut WHERE row <= 64),{_round_sql(0)}{_round_sql(1)}{_round_sql(2).split("s2 AS")[0]}
codes AS (
  SELECT row, string_agg(printf('%02x', best % 64), '' ORDER BY p) AS code, sum(best // 64)::BIGINT AS error FROM a2 GROUP BY row),
book AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, entry)) AS codebooks_sha256 FROM b2)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM r JOIN codes USING (row), book
"""


@query("op12_hadamard_codes", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors: 16 parts, 64 entries each, two rounds."""
    rows, books = compress_vectors(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2, scale=256.0)
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    code = F.array_join(F.transform("codes", lambda c: F.lpad(F.lower(F.hex(c)), 2, "0")), "")
    return rows.select("vec_id", code.alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
