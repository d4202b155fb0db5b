"""String distance, fuzzy joins and spelling correction.

Candidate pairs come from a prefix-bounded delete index.  Cut both strings to
their first ``prefix`` characters.  An optimal alignment of two strings within
edit distance d matches a common subsequence of the cut strings, and whatever
it leaves over on either side is at most d characters: a character matched
beyond the other side's cut takes the place of one that had to be edited.  So
the cut strings share a string that is left of each after at most d deletions.
A string has ``O(prefix^d)`` such keys however long it is.

Keys are 64-bit hashes; those that only one side has are dropped before the
shuffle by bitmaps of a fixed size.  Pairs that meet under a key are compared by length and
``levenshtein`` in the stage of the join, before anything is shuffled again, so
the index costs its keys and the result, not its candidates.  A key that many
strings share makes a skewed join partition, which AQE splits.
"""

from __future__ import annotations

from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import c, explode_rows
from ..session import stored


def edit_distance(a, b, max_dist: int | None = None) -> Column:
    """Levenshtein distance (characters); with ``max_dist`` the value
    is -1 beyond it."""
    if max_dist is None:
        return F.levenshtein(c(a), c(b))
    return F.levenshtein(c(a), c(b), max_dist)


def lcs_length(a, b) -> Column:
    """Longest common subsequence length by the row-by-row dynamic program,
    as nested ``aggregate`` over the two character arrays (JVM side)."""
    ca = F.split(c(a), "")
    cb = F.split(c(b), "")
    ca = F.when(c(a) == "", F.array().cast("array<string>")).otherwise(ca)
    cb = F.when(c(b) == "", F.array().cast("array<string>")).otherwise(cb)
    zero_row = F.array_repeat(F.lit(0), F.size(cb) + 1)

    def next_row(prev, x):
        # new[0] = 0; new[j] = prev[j-1] + 1 if equal else max(prev[j], new[j-1])
        def step(acc, j):
            left = F.element_at(acc, j)  # new[j-1] (1-based position j)
            diag = F.element_at(prev, j)  # prev[j-1]
            up = F.element_at(prev, j + 1)  # prev[j]
            val = F.when(F.element_at(cb, j) == x, diag + 1).otherwise(F.greatest(up, left))
            return F.concat(acc, F.array(val))

        return F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(cb), F.lit(1))), F.array(F.lit(0)),
                           lambda acc, j: F.when(j <= F.size(cb), step(acc, j)).otherwise(acc))

    last = F.aggregate(ca, zero_row, next_row)
    return F.element_at(last, -1)


def fuzzy_ratio(a, b) -> Column:
    """``round(100 * 2 * lcs / (len a + len b))``; null for two empty
    strings."""
    total = F.length(c(a)) + F.length(c(b))
    return F.round(F.try_divide(F.lit(200.0) * lcs_length(a, b), total.cast("double"))).cast("long")


PREFIX = 10      # characters that the delete index looks at
KEYS = 45        # keys of a string of ``PREFIX`` characters at distance 2
FILTER = 1 << 27  # bits of the filter by which keys of one side only are dropped


def delete_keys(strings: DataFrame, col: str, max_dist: int, prefix: int) -> DataFrame:
    """``strings`` with one row per key of ``col``, as ``key``: hashes of what is
    left of its first ``prefix`` characters after deletions.  A cut string of
    ``prefix`` characters loses exactly ``max_dist`` of them (two that share a
    longer string share its shorter ones), a shorter one up to ``max_dist``."""
    if prefix <= max_dist:
        raise ValueError("the prefix must be longer than the distance")
    level = f"array(named_struct('s', substring({col}, 1, {prefix}), 'i', 1))"
    levels = [level]
    for _ in range(max_dist):  # positions never fall, so no set of deletions comes twice
        level = (f"flatten(transform({level}, v -> transform(IF(v.i > length(v.s), array(), sequence(v.i, length(v.s))), "
                 "i -> named_struct('s', concat(substring(v.s, 1, i - 1), substring(v.s, i + 1)), 'i', i))))")
        levels.append(level)
    keys = f"IF(length({col}) >= {prefix}, {level}, concat({', '.join(levels)}))"
    keyed = strings.select("*", explode_rows(F.expr(f"array_distinct(transform({keys}, v -> xxhash64(v.s)))"), "key"))
    return keyed.filter(F.col("key").isNotNull())


def _bit(key) -> Column:
    return F.pmod(key, F.lit(FILTER)) + 1


def _seen(keyed: DataFrame) -> DataFrame:
    """Which keys occur, as at most FILTER / 32768 bitmaps of 4 KB (16 MB)."""
    return keyed.groupBy(F.bitmap_bucket_number(_bit(F.col("key"))).alias("at")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(_bit(F.col("key")))).alias("bits"))


def _known(keyed: DataFrame, seen: DataFrame) -> DataFrame:
    """Rows whose key may occur in ``seen``: none that does is lost.  The
    broadcast has a fixed size; the more keys there are, the less it drops."""
    bit = F.bitmap_bit_position(_bit(F.col("key"))).cast("int")
    byte = F.conv(F.hex(F.substring("bits", F.shiftright(bit, 3) + 1, F.lit(1))), 16, 10).cast("int")
    return (keyed.join(F.broadcast(seen), F.bitmap_bucket_number(_bit(F.col("key"))) == F.col("at"))
            .filter(F.getbit(byte, F.pmod(bit, F.lit(8))) == 1).drop("at", "bits"))


def close_pairs(left: DataFrame, right: DataFrame, max_dist: int, prefix: int = PREFIX) -> DataFrame:
    """Rows of ``left`` (with string ``l``) and ``right`` (with string ``r``) within
    ``max_dist`` edits, with ``distance``.  A pair appears once for every key
    that its strings share; null strings pair with nothing.  Both sides are
    read twice: first for the bitmaps of their keys."""
    lk = delete_keys(left.filter(F.col("l").isNotNull()), "l", max_dist, prefix)
    rk = delete_keys(right.filter(F.col("r").isNotNull()), "r", max_dist, prefix)
    seen_l, seen_r = stored(_seen(lk), "keys-left"), stored(_seen(rk), "keys-right")
    lk, rk = _known(lk, seen_r), _known(rk, seen_l)
    met = lk.join(rk, (lk["key"] == rk["key"]) & (F.abs(F.length("l") - F.length("r")) <= max_dist)).drop("key")
    return met.withColumn("distance", F.levenshtein("l", "r", max_dist)).filter("distance >= 0")


def longest_prefix(max_dist: int) -> int:
    """The most characters (``PREFIX`` at least) with no more than ``KEYS`` keys
    to a string: names often begin alike, and one edit can afford keys of nearly
    all their characters, which only close names share."""
    n = PREFIX
    while 0 < max_dist and comb(n + 1, max_dist) <= KEYS:
        n += 1
    return n


def fuzzy_join(left: DataFrame, right: DataFrame, max_dist: int = 1, *, left_col: str = "name",
               right_col: str = "name", prefix: int | None = None) -> DataFrame:
    """all (left, right, distance) with ``levenshtein <= max_dist``.  Inputs
    are de-duplicated first; ``prefix`` defaults to ``longest_prefix``."""
    prefix = prefix or max(longest_prefix(max_dist), max_dist + 1)
    lv = left.select(F.col(left_col).alias("l")).distinct()
    rv = right.select(F.col(right_col).alias("r")).distinct()
    return close_pairs(lv, rv, max_dist, prefix).select("l", "r", "distance").distinct()


def correct_spelling(counts: DataFrame, *, min_count: int = 5, max_dist: int = 2, word_col: str = "word",
                     count_col: str = "n", prefix: int = PREFIX) -> DataFrame:
    """Map each rare word (count < ``min_count``) to the frequent word
    within ``max_dist`` edits with the least distance, then the greatest
    count, then alphabetical; words without a candidate map to themselves.
    ``counts`` is the distinct vocabulary ``(word, n)``; returns ``(word,
    corrected, distance)`` for every word.

    Distances are tried in turn: a word that has a candidate at distance 1 is
    settled, and only the others get the many keys of distance 2."""
    vocab = stored(counts.select(F.col(word_col).alias("word"), F.col(count_col).alias("n")), "vocabulary")
    frequent = vocab.filter(F.col("n") >= min_count).select(F.col("word").alias("r"), F.col("n").alias("rn"))
    left = vocab.filter(F.col("n") < min_count).select(F.col("word").alias("l"))
    kept = vocab.filter(F.col("n") >= min_count).select("word", F.col("word").alias("corrected"), F.lit(0).cast("long").alias("distance"))
    for d in range(1, max_dist + 1):
        best = close_pairs(left, frequent, d, prefix).groupBy("l").agg(
            F.min_by(F.struct("r", "distance"), F.struct(F.col("distance"), -F.col("rn"), F.col("r"))).alias("b"))
        best = stored(best.select("l", "b.r", F.col("b.distance").cast("long").alias("distance")), "corrections")
        kept = kept.union(best)
        left = left.join(best, "l", "left_anti")
    return kept.union(left.select("l", "l", F.lit(0).cast("long")))
