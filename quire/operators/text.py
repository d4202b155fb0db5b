"""Text normalisation and tokenisation.

Every operator is a projection over the document row (array and regex
built-ins), so it runs map-side with no shuffle.  Tokens stay as one
``array<string>`` per document; ``explode_tokens`` turns them into rows only
where a corpus-wide join or aggregate needs them.
"""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import patterns as P
from ..functions.partitioning import is_small
from ..functions.text import c, explode_rows, pattern_tokens, sentences, squash_space, word_tokens, ws_tokens

# ---------------------------------------------------------------------------
# T1 review normaliser
# The characters padded with spaces, and the line-break tag.
PAD_CHARS = '.",()!?;:'
BREAK_TAG = "<br />"
PAD_PATTERN = "([" + re.escape(PAD_CHARS) + "])"


def normalize_text_col(text) -> Column:
    low = F.replace(F.lower(c(text)), F.lit(BREAK_TAG), F.lit(" "))
    return F.regexp_replace(low, PAD_PATTERN, " $1 ")


def normalize_text(df: DataFrame, *, col: str = "text", out: str | None = None) -> DataFrame:
    """Lower-case, ``<br />`` to a space, pad ``. " , ( ) ! ? ; :`` with spaces."""
    return df.withColumn(out or col, normalize_text_col(col))


# ---------------------------------------------------------------------------
# T2 ASCII folding (NFKD, then drop everything outside ASCII).
# The table is derived from the Unicode database by rule: every character
# whose compatibility decomposition keeps exactly one ASCII character maps to
# it (``translate``); those keeping several ASCII characters (ligatures,
# fractions, ellipsis) go through a single-pass replacement.


def _fold_tables() -> tuple[str, str, dict[str, str]]:
    src, dst, multi = [], [], {}
    for cp in range(0x80, 0x110000):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        kept = "".join(x for x in unicodedata.normalize("NFKD", ch) if ord(x) < 128)
        if len(kept) == 1:
            src.append(ch)
            dst.append(kept)
        elif len(kept) > 1:
            multi[ch] = kept
    return "".join(src), "".join(dst), multi


FOLD_FROM, FOLD_TO, FOLD_MULTI = _fold_tables()


def _folded(texts: pa.Array) -> pa.Array:
    """The tables' rule itself: what the compatibility decomposition of each
    character has in ASCII.  The marks that a decomposition of the whole text may
    reorder are not ASCII."""
    fold = lambda t: unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode("ascii")
    return pa.array((None if t is None else fold(t) for t in texts.to_pylist()), pa.string())


def ascii_fold_col(text) -> Column:
    """The tables have some two thousand characters, too many for a pattern or
    a map to be tried at every position: Python decomposes in one pass.  Texts
    of ASCII only stay in the JVM."""
    ascii_only = F.octet_length(c(text)) == F.length(c(text))
    fold = F.arrow_udf(_folded, "string")
    return F.when(ascii_only, c(text)).otherwise(fold(F.when(~ascii_only, c(text))))


def ascii_fold(df: DataFrame, *, col: str = "text", out: str | None = None) -> DataFrame:
    """Compatibility decomposition, non-ASCII removed."""
    return df.withColumn(out or col, ascii_fold_col(col))


# ---------------------------------------------------------------------------
# T3 simultaneous multi-string replacement
def replace_pattern(keys) -> str:
    keys = sorted(keys, key=len, reverse=True)
    if all(len(k) == 1 for k in keys):
        return "([" + "".join(re.escape(k) for k in keys) + "])"
    return "(" + "|".join(re.escape(k) for k in keys) + ")"


def pieces_pattern(keys) -> str:
    """Cuts a text without loss: a key (longest first), a run of characters
    that start no key, or one character that starts a key without being one."""
    starts = "".join(sorted({re.escape(k[0]) for k in keys}))
    return f"(?s){replace_pattern(keys)}|[^{starts}]+|."


def replace_many_col(text, mapping: dict[str, str]) -> Column:
    """Single left-to-right pass; at each position the longest key wins.
    The text is cut into keys and what lies between; keys are looked up, any
    other piece stays (it cannot equal a key)."""
    if not mapping:
        return c(text)
    if all(len(k) == 1 and len(v) <= 1 for k, v in mapping.items()):
        # one character to at most one: ``translate`` (unmatched tail deletes)
        keys = sorted(mapping, key=lambda k: mapping[k] == "")  # deletions last
        return F.translate(c(text), "".join(keys), "".join(mapping[k] for k in keys))
    lookup = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    longest = max(map(len, mapping))
    pieces = F.regexp_extract_all(c(text), F.lit(pieces_pattern(mapping)), F.lit(0))
    swapped = F.transform(pieces, lambda x: F.when(
        F.length(x) <= longest, F.coalesce(F.try_element_at(lookup, x), x)).otherwise(x))
    return F.array_join(swapped, "")


def replace_many(df: DataFrame, mapping: dict[str, str], *, col: str = "text", out: str | None = None) -> DataFrame:
    """Replace every key of ``mapping`` at once (longest key first)."""
    return df.withColumn(out or col, replace_many_col(col, mapping))


# ---------------------------------------------------------------------------
# T4-T6, T21 simple projections
CONTROL_CHARS = "\u0085"


def strip_control(df: DataFrame, *, col: str = "text", out: str | None = None) -> DataFrame:
    """T4: control characters (U+0085) to spaces."""
    return df.withColumn(out or col, F.translate(c(col), CONTROL_CHARS, " " * len(CONTROL_CHARS)))


def between_pattern(start: str, end: str) -> str:
    return "(?s)" + re.escape(start) + "(.*?)" + re.escape(end)


def slice_between(df: DataFrame, start: str, end: str, *, id_col: str = "doc_id", col: str = "text") -> DataFrame:
    """T5: every non-overlapping text span between ``start`` and ``end``
    (non-greedy, dot matches newline), one row per span with its position."""
    spans = F.regexp_extract_all(c(col), F.lit(between_pattern(start, end)), 1)
    out = df.select(id_col, explode_rows(spans, "pos", "span")).filter(F.col("pos").isNotNull())
    return out.withColumn("pos", F.col("pos").cast("long"))


def squash(df: DataFrame, *, col: str = "text", out: str | None = None) -> DataFrame:
    """White-space runs (newlines included) to one space, trimmed."""
    return df.withColumn(out or col, squash_space(col))


def excerpt(df: DataFrame, n: int = 250, *, col: str = "text", out: str = "excerpt") -> DataFrame:
    """The first ``n`` characters."""
    return df.withColumn(out, F.left(c(col), F.lit(n)))


# ---------------------------------------------------------------------------
# T7-T11 tokenisers (array per document)


def tokenize(df: DataFrame, *, how: str = "words", col: str = "text", out: str = "tokens") -> DataFrame:
    """T7 ``words`` (words, numbers, punctuation marks), T8 ``ws`` (white
    space), T9 ``pattern`` (lower-cased ``[\\p{L}\\p{N}_-]+``)."""
    fn = {"words": word_tokens, "ws": ws_tokens, "pattern": pattern_tokens}[how]
    return df.withColumn(out, fn(col))


def split_sentences(df: DataFrame, *, id_col: str = "doc_id", col: str = "text") -> DataFrame:
    """One row per sentence, ``sent_id`` counts from 0 in text order."""
    out = df.select(id_col, explode_rows(sentences(col), "sent_id", "sentence"))
    return out.filter(F.col("sent_id").isNotNull()).withColumn("sent_id", F.col("sent_id").cast("long"))


def alpha_tokens(df: DataFrame, *, col: str = "tokens", out: str | None = None, lower: bool = True) -> DataFrame:
    """Keep alphabetic tokens (lower-cased unless ``lower=False``)."""
    kept = F.filter(c(col), lambda t: t.rlike("^" + P.ALPHA + "$"))
    return df.withColumn(out or col, F.transform(kept, lambda t: F.lower(t)) if lower else kept)


def explode_tokens(df: DataFrame, *, id_col: str = "doc_id", col: str = "tokens", out: str = "token") -> DataFrame:
    rows = df.select(id_col, explode_rows(col, "pos", out)).filter(F.col("pos").isNotNull())
    return rows.withColumn("pos", F.col("pos").cast("long"))


# ---------------------------------------------------------------------------
# T12 stop words

SMALL_LIST = 5000  # largest word list kept as an in-row array


def remove_stopwords(df: DataFrame, stop_df: DataFrame, *, col: str = "tokens", out: str | None = None,
                     id_col: str = "doc_id", word_col: str = "word", case_sensitive: bool = True) -> DataFrame:
    """Drop tokens found in ``stop_df``.  ``case_sensitive=True`` tests
    the token as written; ``False`` tests its lower-case form.

    A stop list proven small (size check) becomes one array attached to every
    row through a broadcast one-row join (map-only).  A larger list is joined
    token by token (broadcast or shuffle left-anti join chosen by Catalyst)
    and the surviving tokens regrouped in order."""
    out = out or col
    key = (lambda t: t) if case_sensitive else (lambda t: F.lower(t))
    if is_small(stop_df, SMALL_LIST):
        stops = stop_df.agg(F.collect_set(word_col).alias("_stops"))
        j = df.crossJoin(F.broadcast(stops))
        return j.withColumn(out, F.filter(c(col), lambda t: ~F.array_contains(F.col("_stops"), key(t)))).drop("_stops")
    ex = df.select(id_col, explode_rows(col, "_pos", "_tok")).filter(F.col("_pos").isNotNull())
    ex = ex.withColumn("_key", key(F.col("_tok")))
    kept = ex.join(stop_df.select(F.col(word_col).alias("_key")), "_key", "left_anti")
    regrouped = kept.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("_pos", "_tok"))).alias("_s"))
    regrouped = regrouped.select(id_col, F.transform("_s", lambda s: s["_tok"]).alias("_new"))
    res = df.join(regrouped, id_col, "left").withColumn(out, F.coalesce("_new", F.array().cast("array<string>")))
    return res.drop("_new")


# ---------------------------------------------------------------------------
# T13, T14 punctuation and the hyphen rule
# Fixed value: ASCII punctuation as one string (tokens that are a substring of
# it are dropped whole).
ASCII_PUNCT = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def remove_punct_col(tokens) -> Column:
    kept = F.filter(c(tokens), lambda t: F.instr(F.lit(ASCII_PUNCT), t) == 0)
    cleaned = F.transform(kept, lambda t: F.regexp_replace(t, P.PUNCT_OR_SYMBOL, " "))
    pieces = F.flatten(F.transform(cleaned, lambda t: F.split(F.trim(t), " +")))
    return F.filter(pieces, lambda t: t != "")


def remove_punct(df: DataFrame, *, col: str = "tokens", out: str | None = None) -> DataFrame:
    """Drop tokens that are a substring of the ASCII punctuation string,
    blank out punctuation and symbols inside the others and re-split."""
    return df.withColumn(out or col, remove_punct_col(col))


HYPHEN_PATTERN = r"\(?" + P.HYPHEN_CORE + r"\)?"


def hyphen_core_col(tokens) -> Column:
    return F.transform(
        c(tokens), lambda t: F.when(t.contains("-"), F.regexp_extract(t, HYPHEN_PATTERN, 1)).otherwise(t)
    )


def hyphen_core(df: DataFrame, *, col: str = "tokens", out: str | None = None) -> DataFrame:
    """A token with a dash keeps only its first ``[0-9A-Za-z-]+`` run."""
    return df.withColumn(out or col, hyphen_core_col(col))


# ---------------------------------------------------------------------------
# T15 contractions
# Common English contractions and their expansions.
CONTRACTIONS = {
    "ain't": "am not", "aren't": "are not", "can't": "cannot", "couldn't": "could not",
    "didn't": "did not", "doesn't": "does not", "don't": "do not", "hadn't": "had not",
    "hasn't": "has not", "haven't": "have not", "he'd": "he would", "he'll": "he will",
    "he's": "he is", "i'd": "i would", "i'll": "i will", "i'm": "i am", "i've": "i have",
    "isn't": "is not", "it'd": "it would", "it'll": "it will", "it's": "it is",
    "let's": "let us", "mightn't": "might not", "mustn't": "must not", "shan't": "shall not",
    "she'd": "she would", "she'll": "she will", "she's": "she is", "shouldn't": "should not",
    "that's": "that is", "there's": "there is", "they'd": "they would", "they'll": "they will",
    "they're": "they are", "they've": "they have", "wasn't": "was not", "we'd": "we would",
    "we'll": "we will", "we're": "we are", "we've": "we have", "weren't": "were not",
    "what's": "what is", "where's": "where is", "who's": "who is", "won't": "will not",
    "wouldn't": "would not", "you'd": "you would", "you'll": "you will", "you're": "you are",
    "you've": "you have",
}


def contractions_df(spark):
    return spark.createDataFrame(sorted(CONTRACTIONS.items()), "short string, long string")


def expand_contractions(df: DataFrame, contractions: DataFrame | None = None, *, col: str = "tokens",
                        out: str | None = None) -> DataFrame:
    """Replace tokens found in a contraction table (case-insensitive key)
    by their expansion, split into words.  The table is size-checked and
    attached as one map per row (broadcast one-row join)."""
    out = out or col
    if contractions is None:
        lookup = F.create_map(*[F.lit(x) for kv in sorted(CONTRACTIONS.items()) for x in kv])
        expanded = F.transform(c(col), lambda t: F.coalesce(F.element_at(lookup, F.lower(t)), t))
        return df.withColumn(out, F.flatten(F.transform(expanded, lambda t: F.split(t, " "))))
    if not is_small(contractions, SMALL_LIST):
        raise ValueError("contraction table too large to attach per row")
    m = contractions.agg(F.map_from_entries(F.collect_list(F.struct(F.lower("short"), "long"))).alias("_m"))
    j = df.crossJoin(F.broadcast(m))
    expanded = F.transform(c(col), lambda t: F.coalesce(F.element_at(F.col("_m"), F.lower(t)), t))
    return j.withColumn(out, F.flatten(F.transform(expanded, lambda t: F.split(t, " ")))).drop("_m")


# ---------------------------------------------------------------------------
# T19, T20


def join_tokens(df: DataFrame, *, col: str = "tokens", out: str = "joined", sep: str = " ") -> DataFrame:
    """Tokens back to one string."""
    return df.withColumn(out, F.array_join(c(col), sep))


def ngrams_col(tokens, n: int) -> Column:
    t = c(tokens)
    starts = F.when(F.size(t) >= n, F.sequence(F.lit(0), F.size(t) - n)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(t, i + 1, n), " "))


def _whole_ngrams(tokens, n: int) -> Column:
    """n-grams by position; null where a token is null."""
    t = c(tokens)
    starts = F.when(F.size(t) >= n, F.sequence(F.lit(0), F.size(t) - n)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.concat(F.get(t, i), *[x for j in range(1, n) for x in (F.lit(" "), F.get(t, i + j))]))


def ngrams(df: DataFrame, lo: int = 1, hi: int = 3, *, col: str = "tokens", out: str = "grams",
           words: list[str] | None = None) -> DataFrame:
    """All n-grams for n in [lo, hi], in order of n then position.  With
    ``words``, only those made of these words."""
    if words is None:
        return df.withColumn(out, F.flatten(F.array(*[ngrams_col(col, n) for n in range(lo, hi + 1)])))
    d = df.withColumn("_known", F.transform(c(col), lambda t: F.when(t.isin(words), t)))
    grams = F.flatten(F.array(*[_whole_ngrams("_known", n) for n in range(lo, hi + 1)]))
    return d.withColumn(out, F.filter(grams, lambda g: g.isNotNull())).drop("_known")
