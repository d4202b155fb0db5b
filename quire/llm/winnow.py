"""Benchmark decontamination by winnowing, in DataFrame functions only.

A benchmark item is the set of its windows of ``window`` consecutive words (an
item with fewer words, but not none, is one window of its own length).  Every
document word inside an occurrence of any window counts as hit.

* *Fingerprints.*  A window of L words holds L - k + 1 k-grams; its
  fingerprint is the smallest k-gram hash.  Equal windows have equal
  fingerprints, so joining fingerprints misses no shared span of L words.
  Neighbouring document windows mostly share their minimum and are kept as
  one run (fingerprint, first window, last window), about two runs per L - k + 2
  words.
* *Join.*  Document runs meet the benchmark's fingerprints.  The benchmark
  side is counted first and broadcast only up to ``max_broadcast`` rows; above
  it the same join shuffles, with the document side salted.
* *Extension.*  A run carries its own words, so texts are never shuffled; the
  windows of the runs that met are compared as exact word sequences, and
  overlapping hits grow into maximal spans.

Words are hashed lowered by Unicode (a cheap fold that can only merge more
windows); the exact comparison lowers A-Z alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, row_key, spread_scan, written

#: everything that is not a word character: ASCII other than digits and letters
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SALT = 32


def words_of(text: Column) -> Column:
    """Words of a text, an empty array for null or wordless text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), NOT_WORD), lambda w: w != "")


def gram_size(length: int) -> int:
    """Words in a k-gram of a window of ``length`` words."""
    return (length + 1) // 2


def window_minima(words: str, length: int) -> str:
    """SQL for the array of fingerprints of all windows, given columns
    ``words`` and ``{words}_g{length}`` (its k-gram hashes)."""
    span = length - gram_size(length) + 1
    grams = f"{words}_g{length}"
    terms = ", ".join(f"get({grams}, i + {d})" for d in range(span))
    least = f"least({terms})" if span > 1 else f"get({grams}, i)"
    return f"IF(size({words}) < {length}, array(), transform(sequence(0, size({words}) - {length}), i -> {least}))"


def gram_hashes(words: str, length: int) -> str:
    k = gram_size(length)
    terms = ", ".join(f"get({words}, i + {d})" for d in range(k))
    return f"IF(size({words}) < {k}, array(), transform(sequence(0, size({words}) - {k}), i -> xxhash64({terms})))"


def benchmark_windows(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """(len, content, fingerprint, items array<string>): distinct windows with
    the ids of the items that hold them.  A null id leaves no entry in ``items``
    but its windows count."""
    t = items.select(F.col(id_col).cast("string").alias("item"), words_of(ascii_lower(F.col(text_col))).alias("w"))
    t = t.filter(F.size("w") > 0).withColumn("len", F.least(F.size("w"), F.lit(window)))
    wins = t.select("item", "len", F.explode(F.expr(
        "transform(sequence(0, size(w) - len), i -> array_join(slice(w, i + 1, len), ' '))")).alias("content"))
    wins = wins.groupBy("len", "content").agg(F.collect_set("item").alias("items"))
    # the fingerprint of a window, from its folded words; one branch per length
    w = wins.withColumn("h", F.transform(F.split("content", " "), lambda x: F.xxhash64(F.lower(x))))
    fp = F.lit(None).cast("long")
    for n in range(1, window + 1):
        k = gram_size(n)
        grams = [F.xxhash64(*[F.get("h", F.lit(i + d)) for d in range(k)]) for i in range(n - k + 1)]
        fp = F.when(F.col("len") == n, F.least(*grams) if len(grams) > 1 else grams[0]).otherwise(fp)
    return w.select("len", "content", fp.alias("fingerprint"), "items")


def document_runs(docs: DataFrame, lengths: list[int]) -> DataFrame:
    """(doc_id, rk, len, fingerprint, first, last, span array<string>): runs of
    windows that share a fingerprint, for each window length, with the words
    from the first window's start to the last one's end."""
    d = docs.select("doc_id", "rk", words_of(F.col("text")).alias("w"))
    d = d.withColumn("h", F.transform("w", lambda x: F.xxhash64(F.lower(x))))
    for n in lengths:
        d = d.withColumn(f"h_g{n}", F.expr(gram_hashes("h", n)))
    for n in lengths:
        d = d.withColumn(f"m{n}", F.expr(window_minima("h", n)))
    per_length = []
    for n in lengths:
        m = f"m{n}"
        starts = f"filter(sequence(0, size({m}) - 1), i -> i = 0 OR get({m}, i) <> get({m}, i - 1))"
        d = d.withColumn(f"s{n}", F.expr(f"IF(size({m}) = 0, array(), {starts})"))
        per_length.append(
            f"transform(s{n}, (s, j) -> struct({n} AS len, get({m}, s) AS fingerprint, s AS first, "
            f"coalesce(get(s{n}, j + 1), size({m})) - 1 AS last, "
            f"slice(w, s + 1, coalesce(get(s{n}, j + 1), size({m})) - s - 1 + {n}) AS span))")
    runs = per_length[0] if len(per_length) == 1 else f"concat({', '.join(per_length)})"
    return d.select("doc_id", "rk", F.explode(F.expr(runs)).alias("r")).select("doc_id", "rk", "r.*")


def met_runs(runs: DataFrame, marks: DataFrame, max_broadcast: int) -> DataFrame:
    """Runs whose (len, fingerprint) occurs in ``marks`` (a written table)."""
    if marks.count() <= max_broadcast:
        return runs.join(F.broadcast(marks), ["len", "fingerprint"], "left_semi")
    salt = F.expr(f"CAST(pmod(xxhash64(doc_id, first), {SALT}) AS INT)")
    spread = marks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    return runs.withColumn("salt", salt).join(spread, ["len", "fingerprint", "salt"], "left_semi").drop("salt")


def decontaminate(docs: DataFrame, items: DataFrame, window: int = 10, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                  max_broadcast: int = 500_000) -> DataFrame:
    """(doc_id, rk, n_words, n_hit, n_items, items array<string>, spans
    array<struct<first, last>>), one row per row of ``docs``; spans are the
    maximal hit word ranges, ends included.

    Null and wordless texts have no words and no hits; wordless items have no
    window.  Items that repeat an id or a text count once per id.  Rows that
    repeat a document each get the same result.  Without documents the result
    is empty, without items nothing is hit."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).withColumn(
        "rk", row_key("doc_id", "text"))
    own = spread_scan(own)
    wins = written(benchmark_windows(items, window, item_col, item_text), "benchmark-windows")
    lengths = sorted(r.len for r in wins.select("len").distinct().collect())  # at most ``window`` rows
    counted = own.select("doc_id", "rk", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_words"))
    none = (F.lit(0).cast("long").alias("n_hit"), F.lit(0).cast("long").alias("n_items"),
            F.lit(None).cast("array<string>").alias("items"),
            F.lit(None).cast("array<struct<first:int,last:int>>").alias("spans"))
    if not lengths:
        return counted.select("*", *none)
    met = met_runs(document_runs(own, lengths), wins.select("len", "fingerprint").distinct(), max_broadcast)
    tried = (met.select("doc_id", "rk", F.explode(F.expr(
        "transform(sequence(0, last - first), i -> struct(len, CAST(first + i AS INT) AS first, "
        "array_join(slice(span, i + 1, len), ' ') AS content))")).alias("t"))
        .select("doc_id", "rk", "t.len", "t.first", ascii_lower(F.col("t.content")).alias("content")))
    known = wins.select("len", "content", "items")
    if wins.count() <= max_broadcast // 10:
        known = F.broadcast(known)
    hits = tried.join(known, ["len", "content"])
    per_doc = hits.groupBy("doc_id", "rk").agg(
        F.collect_set(F.struct("first", (F.col("first") + F.col("len") - 1).alias("last"))).alias("hit"),
        F.collect_set("items").alias("sets"))
    grown = F.expr("""
        aggregate(array_sort(hit), CAST(array() AS array<struct<first:int,last:int>>), (acc, h) ->
          IF(size(acc) > 0 AND h.first <= acc[size(acc) - 1].last + 1,
             concat(slice(acc, 1, size(acc) - 1), array(struct(acc[size(acc) - 1].first AS first,
                    greatest(acc[size(acc) - 1].last, h.last) AS last))),
             concat(acc, array(struct(h.first AS first, h.last AS last)))))""")
    done = (per_doc.withColumn("spans", grown)
            .withColumn("items", F.array_sort(F.array_distinct(F.flatten("sets"))))
            .select(F.col("doc_id").alias("d"), F.col("rk").alias("k"), "items", "spans",
                    F.expr("aggregate(spans, 0L, (n, s) -> n + s.last - s.first + 1)").alias("n_hit"),
                    F.size("items").cast("long").alias("n_items")))
    return (counted.join(done, counted["doc_id"].eqNullSafe(done["d"]) & (counted["rk"] == done["k"]), "left")
            .select("doc_id", "rk", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                    F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"), "items", "spans"))
