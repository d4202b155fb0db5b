"""Stored web pages as a table ``(page_id, url, html)``.

Fetching is outside the library: a crawl lands pages in a table, and every
step that the reference did per page with an HTML parser is a regex
projection over the ``html`` column (map-only), or an equi-join between link
rows and page rows on the URL (one shuffle per hop).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.ranking import global_row_number
from ..functions.text import c, explode_rows, squash_space
from ..operators.text import replace_many_col

# The HTML entities decoded in element text.
ENTITIES = {"&amp;": "&", "&lt;": "<", "&gt;": ">", "&quot;": '"', "&#39;": "'", "&nbsp;": " ",
            "&copy;": "©", "&middot;": "·"}
# Blocks whose content is never text.
HIDDEN = r"(?s)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
TAG = r"<[^>]*>"


def visible_html(html) -> Column:
    return F.regexp_replace(c(html), HIDDEN, "")


def tag_text(fragment) -> Column:
    """Inner text of an HTML fragment: tags removed, entities decoded,
    white space squashed."""
    return squash_space(replace_many_col(F.regexp_replace(c(fragment), TAG, ""), ENTITIES))


def element_pattern(tag: str) -> str:
    t = re.escape(tag)
    return rf"<{t}((?:\s[^>]*)?)>((?s:.*?))</{t}>"


def hrefs(html) -> Column:
    """Link targets in page order: tags in any case, values in either quote or
    none."""
    return F.transform(F.regexp_extract_all(c(html), F.lit(P.ANCHOR), 1), lambda x: F.regexp_replace(x, P.QUOTES, ""))


def extract_links(pages: DataFrame, href_regex: str | None = None, *, id_col: str = "page_id",
                  html_col: str = "html") -> DataFrame:
    """Anchors ``(page_id, pos, href, anchor)`` in page order; with
    ``href_regex`` only matching hrefs, ``pos`` counting the kept ones."""
    h = hrefs(html_col)
    a = F.regexp_extract_all(c(html_col), F.lit(P.ANCHOR), 2)
    z = F.zip_with(h, a, lambda x, y: F.struct(x.alias("href"), y.alias("anchor")))
    if href_regex is not None:
        z = F.filter(z, lambda s: s["href"].rlike(href_regex))
    rows = pages.select(id_col, explode_rows(z, "pos", "l")).filter(F.col("pos").isNotNull())
    return rows.select(id_col, F.col("pos").cast("long").alias("pos"), F.col("l.href").alias("href"),
                       tag_text(F.col("l.anchor")).alias("anchor"))


def origin(url) -> Column:
    return F.regexp_extract(c(url), P.URL_ORIGIN, 1)


def resolve_url(href, base_url) -> Column:
    """Absolute URL of ``href`` seen on ``base_url``: hrefs with a scheme
    stay (``mailto:`` too), ``//host`` gets the base scheme, ``/path`` the base
    origin, ``?query`` and ``#fragment`` the base without its own, and a
    relative path the base directory, ``./`` and leading ``../`` resolved."""
    h, b = c(href), c(base_url)
    scheme = F.regexp_extract(b, r"^([a-zA-Z][a-zA-Z0-9+.-]*:)", 1)
    base_dir = F.regexp_replace(F.regexp_replace(b, r"[?#].*$", ""), r"[^/]*$", "")
    bare = F.regexp_replace(h, r"^(\./)+", "")
    ups = F.length(F.regexp_extract(bare, r"^((?:\.\./)*)", 1)) / 3
    # one folder less for every ../, never above the root
    folders = F.split(F.regexp_replace(F.substr(base_dir, F.length(origin(b)) + 1), r"^/|/$", ""), "/")
    kept = F.slice(folders, F.lit(1), F.greatest(F.size(folders) - ups.cast("int"), F.lit(0)))
    climbed = F.concat(origin(b), F.lit("/"), F.array_join(kept, "/"), F.when(F.size(kept) > 0, "/").otherwise(""),
                       F.regexp_replace(bare, r"^(\.\./)+", ""))
    return (F.when(h.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), h)
            .when(h.startswith("//"), F.concat(scheme, h))
            .when(h.startswith("/"), F.concat(origin(b), h))
            .when(h.startswith("?"), F.concat(F.regexp_replace(b, r"[?#].*$", ""), h))
            .when(h.startswith("#"), F.concat(F.regexp_replace(b, r"#.*$", ""), h))
            .when(ups > 0, climbed)
            .otherwise(F.concat(base_dir, bare)))


def follow_links(pages: DataFrame, seeds: DataFrame, patterns: list[str], *, url_col: str = "url",
                 html_col: str = "html") -> DataFrame:
    """S3: multi-hop link following.  ``seeds`` is ``(seed_id, url, title)``;
    hop k joins the current URL to the page table, takes the first link whose
    href matches ``patterns[k]`` and resolves it.  One row per seed and hop
    reached: ``(seed_id, title, hop, url)``; the title is carried along."""
    cur = seeds.select("seed_id", "title", F.col(url_col).alias("url"))
    out = cur.withColumn("hop", F.lit(0))
    pg = pages.select(F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    for k, pat in enumerate(patterns, start=1):
        here = cur.join(pg, "url")
        h = F.filter(hrefs("html"), lambda x: x.rlike(pat))
        nxt = here.select("seed_id", "title", resolve_url(F.try_element_at(h, F.lit(1)), F.col("url")).alias("url"))
        cur = nxt.filter(F.col("url").isNotNull())
        out = out.unionByName(cur.withColumn("hop", F.lit(k)))
    return out.withColumn("hop", F.col("hop").cast("long"))


def first_distinct_links(links: DataFrame, n: int, *, id_col: str = "page_id") -> DataFrame:
    """Of the first ``2n`` links of each page keep each href once (its
    first position) and number the survivors in order."""
    first = links.filter(F.col("pos") < 2 * n).groupBy(id_col, "href").agg(F.min("pos").alias("pos"))
    w = Window.partitionBy(id_col).orderBy("pos")
    return first.withColumn("rank", F.row_number().over(w).cast("long"))


def element_text(pages: DataFrame, tag: str, class_regex: str | None = None, *, id_col: str = "page_id",
                 html_col: str = "html") -> DataFrame:
    """Text of every ``tag`` element (optionally whose class attribute
    matches ``class_regex``), scripts, styles and comments removed first,
    inner tags stripped, entities decoded.  ``(page_id, pos, text)``."""
    pat = element_pattern(tag)
    body = visible_html(html_col)
    attrs = F.regexp_extract_all(body, F.lit(pat), 1)
    inner = F.regexp_extract_all(body, F.lit(pat), 2)
    z = F.zip_with(attrs, inner, lambda a, t: F.struct(a.alias("attrs"), t.alias("inner")))
    if class_regex is not None:
        z = F.filter(z, lambda s: F.regexp_extract(s["attrs"], r'class="([^"]*)"', 1).rlike(class_regex))
    rows = pages.select(id_col, explode_rows(z, "pos", "e")).filter(F.col("pos").isNotNull())
    return rows.select(id_col, F.col("pos").cast("long").alias("pos"), tag_text(F.col("e.inner")).alias("text"))


def rating_or_default(df: DataFrame, col: str, pattern: str, *, default: float = 5.0, out: str = "stars") -> DataFrame:
    """Number captured by ``pattern`` (group 1) as a double, ``default``
    when absent or not a number."""
    got = F.expr(f"try_cast(regexp_extract({col}, '{pattern}', 1) AS DOUBLE)")
    return df.withColumn(out, F.coalesce(got, F.lit(float(default))))


def union_ranked(parts: list[DataFrame], *, order: tuple[str, ...] = ("page", "pos")) -> DataFrame:
    """Result pages appended; ``rank`` = position over all pages in
    ``order`` (page number first, then position on the page)."""
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    return global_row_number(u, [F.col(o).asc() for o in order], name="rank")


def fallback_url(df: DataFrame, template: str, *, url_col: str = "url", out: str = "fallback") -> DataFrame:
    """A second candidate URL built from the first number in the URL;
    ``template`` uses ``{origin}`` and ``{n}``."""
    n = F.regexp_extract(c(url_col), P.FIRST_NUMBER, 1)
    parts = re.split(r"(\{origin\}|\{n\})", template)
    cols = []
    for p in parts:
        if p == "{origin}":
            cols.append(origin(url_col))
        elif p == "{n}":
            cols.append(n)
        elif p:
            cols.append(F.lit(p))
    return df.withColumn(out, F.when(n != "", F.concat(*cols)))
