"""URL filter rules with decisions carried over redirect equivalence.

A rule is (host, path, verdict).  It fits its host and all subdomains when the
url's path starts with the rule's path; the longest fitting rule decides.  A
url that no rule fits takes the decision of its aliases: pages that redirect
to each other (``<meta http-equiv=refresh>``), that name each other canonical
(``<link rel=canonical>``), or that a given redirect table joins, form one
connected component.  Inside a component an explicit allow on any member beats
a block on another; a component with a block and no allow is blocked; one
without any decision is allowed.

Rules are matched per distinct host, not per page: hosts are split into their
domain suffixes (no longer than the longest rule host), joined with the rules
on equality, and each host keeps the array of its rules, longest first.  Pages
join their host's array with a salt, since one host may hold a third of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, written
from .components import connected_components

ALLOW, BLOCK = "allow", "block"
SALT = 32


def host_of(url: Column) -> Column:
    """Text after the first ``://`` up to ``/ ? #`` or the end, A-Z lowered;
    empty for null or without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(url, "://", 1)).otherwise(None)
    tail = F.substr(url, F.length(rest) + 4)
    return F.coalesce(ascii_lower(F.regexp_extract(tail, r"^[^/?#]*", 0)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``? #`` or the end."""
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(url, "://", 1)).otherwise(None)
    tail = F.substr(url, F.length(rest) + 4)
    return F.coalesce(F.regexp_extract(tail, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rules_table(spark, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in rules], "host string, path string, verdict string")


def host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules array<struct<n, rule, path, verdict>>), longest first, for
    the distinct hosts that any rule fits.  Of equal rules an allow wins."""
    r = rules.select(ascii_lower(F.col("host")).alias("suffix"), "path", "verdict").filter(
        "suffix IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL")
    depth = r.agg(F.max(F.size(F.split("suffix", r"\."))).alias("depth"))  # one row
    parts = F.split("host", r"\.")
    suffixes = (hosts.filter("host <> ''").crossJoin(F.broadcast(depth)).filter("depth IS NOT NULL")
                .withColumn("parts", parts)
                .withColumn("suffix", F.explode(F.expr(
                    "transform(sequence(1, least(size(parts), depth)), k -> array_join(slice(parts, -k, k), '.'))")))
                .select("host", "suffix", F.expr(f"CAST(pmod(xxhash64(host), {SALT}) AS INT)").alias("salt")))
    salted = r.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    entry = F.struct(
        (-F.length(F.concat("suffix", "path"))).alias("n"), F.col("verdict"),
        F.concat("suffix", "path").alias("rule"), F.col("path"))
    return (suffixes.join(salted, ["suffix", "salt"])
            .groupBy("host").agg(F.array_sort(F.collect_set(entry)).alias("rules")))


def normal_url(url: Column) -> Column:
    """Fragment dropped, scheme and host lowered: the identity of an alias."""
    bare = F.regexp_replace(url, r"#.*$", "")
    scheme = F.regexp_extract(bare, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)
    rest = F.regexp_extract(bare, r"^[^/?#]*//[^/?#]*([\s\S]*)$", 1)
    return F.when(scheme != "", F.concat(F.lower(scheme), F.lit("://"), host_of(bare), rest))


def absolute(target: Column, base: Column) -> Column:
    """A link target against the page's url: absolute, scheme-relative, rooted,
    query-only or relative to the folder of the page."""
    root = F.regexp_extract(base, r"^[^:/?#]+://[^/?#]*", 0)
    folder = F.regexp_extract(path_of(base), r"^[\s\S]*/", 0)
    t = F.trim(target)
    return (F.when(t.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), t)
            .when(t.startswith("//"), F.concat(F.regexp_extract(base, r"^[^:/?#]+:", 0), t))
            .when(t.startswith("/"), F.concat(root, t))
            .when(t.startswith("?"), F.concat(root, path_of(base), t))
            .when((t == "") | t.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
            .otherwise(F.concat(root, F.when(folder == "", "/").otherwise(folder), t)))


LINK_TAG = r"(?i)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
META_TAG = r"(?i)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
HREF = r"(?i)\shref\s*=\s*[\"']?([^\"'\s>]+)"
REFRESH = r"(?i)\bcontent\s*=\s*[\"']?\s*[0-9.]*\s*[;,]\s*(?:url\s*=\s*)?[\"']?([^\"'\s>]+)"


def alias_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(a, b) normal urls joined by a canonical link or a meta refresh of a
    page's html.  Pages without either tag are dropped by a plain match."""
    p = pages.select(F.col(url_col).alias("url"), F.col(html_col).alias("html")).filter(
        F.col("html").rlike(r"(?i)canonical|http-equiv"))
    tags = F.concat(
        F.transform(F.regexp_extract_all("html", F.lit(LINK_TAG), F.lit(0)), lambda t: F.regexp_extract(t, HREF, 1)),
        F.transform(F.regexp_extract_all("html", F.lit(META_TAG), F.lit(0)), lambda t: F.regexp_extract(t, REFRESH, 1)))
    to = (p.select("url", F.explode(tags).alias("target"))
          .select(normal_url(F.col("url")).alias("a"),
                  normal_url(absolute(F.col("target"), F.col("url"))).alias("b")))
    return to.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").distinct()


def judge_urls(pages: DataFrame, rules: DataFrame, redirects: DataFrame | None = None,
               id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, host, path, rule, verdict, alias_of), one row per page row.

    ``redirects`` (src, dst) adds redirect edges beyond those in the html.
    Null urls and urls without ``://`` have empty host and path, fit no rule
    and are allowed.  Repeated urls are one node and share their decision.
    Pages with null html bring no edges.  ``alias_of`` is the smallest url of
    the page's component, or null.  Rules with a null part are ignored; an
    empty table gives an empty table."""
    own = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                       host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    by_host = host_rules(own.select("host").distinct(), rules)
    salted = by_host.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    ruled = (own.withColumn("salt", F.expr(f"CAST(pmod(xxhash64(page_id, path), {SALT}) AS INT)"))
             .join(salted, ["host", "salt"], "left")
             .withColumn("hit", F.expr("get(filter(rules, r -> startswith(path, r.path)), 0)"))
             .select("page_id", "url", "host", "path", F.col("hit.rule").alias("rule"),
                     F.col("hit.verdict").alias("own"), normal_url(F.col("url")).alias("node")))
    ruled = written(ruled, "ruled-urls")
    edges = alias_edges(pages, url_col, html_col)
    if redirects is not None:
        edges = edges.union(redirects.select(normal_url(F.col(redirects.columns[0])).alias("a"),
                                             normal_url(F.col(redirects.columns[1])).alias("b")))
    cc = connected_components(edges).checkpoint()
    decided = (ruled.filter("own IS NOT NULL").join(cc, "node")
               .groupBy("component").agg(
                   F.when(F.max(F.col("own") == ALLOW), ALLOW).otherwise(BLOCK).alias("passed")))
    aliases = cc.join(decided, "component", "left")
    return (ruled.join(aliases, "node", "left")
            .select("page_id", "url", "host", "path", "rule",
                    F.coalesce("own", "passed", F.lit(ALLOW)).alias("verdict"),
                    F.col("component").alias("alias_of")))
