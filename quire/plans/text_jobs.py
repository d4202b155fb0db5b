"""Registered analyses: text normalisation and tokenisation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.partitioning import by_key, spread
from ..functions.text import alpha_lower, explode_rows, word_tokens
from ..operators import text as T
from ..operators.vocab import term_stats, token_counts
from . import sqlfrag as S
from . import sqlfrag_text as ST
from ..session import stored
from .registry import Tables, register

# Fixed value: the reference's substitution map (carriage return removed,
# line feed to a space).
NEWLINE_MAP = {"\r": "", "\n": " "}
# A multi-character map exercising the longest-key-first single pass.
SUFFIX_MAP = {"tion": "TION", "ti": "T1", "on": "0N", "ment": "MENT", "en": "EN"}
N_STOP = 50


def docs(spark, sf, *cols) -> DataFrame:
    return spread(Tables(spark, sf).documents.select("doc_id", *cols), "doc_id")


@register("T1_normalize_text", sql=f"SELECT doc_id, {ST.normalize_text('text')} AS text FROM documents")
def q_normalize(spark, sf):
    return T.normalize_text(docs(spark, sf, "text"))


@register("T2_ascii_fold", sql=f"SELECT doc_id, {ST.ascii_fold('text')} AS text FROM documents")
def q_ascii_fold(spark, sf):
    return T.ascii_fold(docs(spark, sf, "text"))


@register("T3_replace_newlines", sql=f"SELECT doc_id, {ST.replace_many('text', NEWLINE_MAP)} AS text FROM documents")
def q_replace_newlines(spark, sf):
    return T.replace_many(docs(spark, sf, "text"), NEWLINE_MAP)


@register("T3_replace_many", sql=f"SELECT doc_id, {ST.replace_many('text', SUFFIX_MAP)} AS text FROM documents")
def q_replace_many(spark, sf):
    return T.replace_many(docs(spark, sf, "text"), SUFFIX_MAP)


@register("T4_strip_control", sql=f"SELECT conv_id, turn, translate(text, chr(133), ' ') AS text FROM conversations")
def q_strip_control(spark, sf):
    return T.strip_control(Tables(spark, sf).conversations.select("conv_id", "turn", "text"))


@register("T5_slice_between", sql=f"""
SELECT page_id AS doc_id, generate_subscripts(s, 1) - 1 AS pos, unnest(s) AS span
FROM (SELECT page_id, regexp_extract_all(html, {S.sql_str(T.between_pattern('<article>', '</article>'))}, 1) AS s FROM pages)
""")
def q_slice_between(spark, sf):
    pages = spread(Tables(spark, sf).pages.select(F.col("page_id").alias("doc_id"), F.col("html").alias("text")), "doc_id")
    return T.slice_between(pages, "<article>", "</article>")


@register("T6_squash_space", sql=f"SELECT doc_id, {S.squash_space('text')} AS text FROM documents")
def q_squash(spark, sf):
    return T.squash(docs(spark, sf, "text"))


@register("T7_word_tokens", sql=f"""
SELECT doc_id, generate_subscripts(t, 1) - 1 AS pos, unnest(t) AS token
FROM (SELECT doc_id, {S.word_tokens('text')} AS t FROM documents)
""")
def q_word_tokens(spark, sf):
    return T.explode_tokens(T.tokenize(docs(spark, sf, "text"), how="words"))


@register("T8_ws_tokens", sql=f"""
SELECT doc_id, len(t) AS n_tokens, len(list_distinct(t)) AS n_distinct
FROM (SELECT doc_id, {S.ws_tokens('text')} AS t FROM documents)
""")
def q_ws_tokens(spark, sf):
    d = T.tokenize(docs(spark, sf, "text"), how="ws")
    return d.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"),
                    F.size(F.array_distinct("tokens")).cast("long").alias("n_distinct"))


@register("T9_pattern_tokens", sql=f"""
SELECT doc_id, len(t) AS n_tokens, len(list_distinct(t)) AS n_distinct
FROM (SELECT doc_id, {S.pattern_tokens('text')} AS t FROM documents)
""")
def q_pattern_tokens(spark, sf):
    d = T.tokenize(docs(spark, sf, "text"), how="pattern")
    return d.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"),
                    F.size(F.array_distinct("tokens")).cast("long").alias("n_distinct"))


@register("T10_sentences", sql=f"""
SELECT doc_id, generate_subscripts(s, 1) - 1 AS sent_id, unnest(s) AS sentence
FROM (SELECT doc_id, {S.sentences('text')} AS s FROM documents)
""")
def q_sentences(spark, sf):
    return T.split_sentences(docs(spark, sf, "text"))


@register("T11_alpha_tokens", sql=f"""
SELECT doc_id, len(t) AS n_tokens, len({S.alpha_lower('t')}) AS n_alpha,
       array_to_string({S.alpha_lower('t')}, ' ') AS alpha
FROM (SELECT doc_id, {S.word_tokens('text')} AS t FROM documents)
""")
def q_alpha(spark, sf):
    d = T.tokenize(docs(spark, sf, "text"), how="words")
    d = T.alpha_tokens(d, out="alpha")
    return d.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"),
                    F.size("alpha").cast("long").alias("n_alpha"), F.array_join("alpha", " ").alias("alpha"))


# ----- stop words: the list is derived from the corpus (most frequent words
# of all documents) so both engines share it.

def en_alpha(spark, sf, lower=True) -> DataFrame:
    d = by_key(Tables(spark, sf).documents.select("doc_id", "text"), "doc_id")
    toks = word_tokens("text")
    if lower:
        return d.select("doc_id", alpha_lower(toks).alias("tokens"))
    return d.select("doc_id", F.filter(toks, lambda t: t.rlike(r"^\p{L}+$")).alias("tokens"))


def derived_stopwords(spark, sf, n=N_STOP, tokens: DataFrame | None = None) -> DataFrame:
    """The ``n`` most frequent words; from ``tokens``, if ``en_alpha``'s are at
    hand in any layout: counted without a shuffle by document."""
    if tokens is None:
        stats = term_stats(en_alpha(spark, sf))
    else:
        words = tokens.select(explode_rows("tokens", "term")).filter(F.col("term").isNotNull())
        stats = words.groupBy("term").agg(F.count(F.lit(1)).alias("tf"))
    return stored(stats.orderBy(F.desc("tf"), F.asc("term")).limit(n).select(F.col("term").alias("word")), "stop-words")


_EN = f"SELECT doc_id, {S.alpha_lower(S.word_tokens('text'))} AS tokens FROM documents"
_EN_RAW = (f"SELECT doc_id, list_filter({S.word_tokens('text')}, lambda t: regexp_full_match(t, '\\p{{L}}+')) AS tokens "
           "FROM documents")
_STOPS = f"""stops AS (SELECT list(term) AS sl FROM (
    SELECT term FROM (SELECT unnest(tokens) AS term FROM ({_EN})) GROUP BY term
    ORDER BY count(*) DESC, term LIMIT {N_STOP}))"""


@register("T12_remove_stopwords", sql=f"""
WITH {_STOPS}
SELECT doc_id, len(tokens) AS n_before, len(list_filter(tokens, lambda t: NOT list_contains(sl, t))) AS n_after,
       array_to_string(list_filter(tokens, lambda t: NOT list_contains(sl, t)), ' ') AS kept
FROM ({_EN}) CROSS JOIN stops
""")
def q_stopwords(spark, sf):
    d = T.remove_stopwords(en_alpha(spark, sf), derived_stopwords(spark, sf), out="kept")
    return d.select("doc_id", F.size("tokens").cast("long").alias("n_before"),
                    F.size("kept").cast("long").alias("n_after"), F.array_join("kept", " ").alias("kept"))


@register("T12_remove_stopwords_cased", sql=f"""
WITH {_STOPS}
SELECT doc_id, len(list_filter(tokens, lambda t: NOT list_contains(sl, t))) AS n_after_cased,
       len(list_filter(tokens, lambda t: NOT list_contains(sl, lower(t)))) AS n_after_lower
FROM ({_EN_RAW}) CROSS JOIN stops
""")
def q_stopwords_cased(spark, sf):
    stops = derived_stopwords(spark, sf)
    d = en_alpha(spark, sf, lower=False)
    d = T.remove_stopwords(d, stops, out="cased", case_sensitive=True)
    d = T.remove_stopwords(d, stops, out="lowered", case_sensitive=False)
    return d.select("doc_id", F.size("cased").cast("long").alias("n_after_cased"),
                    F.size("lowered").cast("long").alias("n_after_lower"))


@register("V6_token_counts", sql=f"""
WITH {_STOPS}
SELECT sum(len(tokens))::BIGINT AS n_tokens, sum(len(list_filter(tokens, lambda t: NOT list_contains(sl, t))))::BIGINT AS n_kept
FROM ({_EN}) CROSS JOIN stops
""")
def q_token_counts(spark, sf):
    d = T.remove_stopwords(en_alpha(spark, sf), derived_stopwords(spark, sf), out="kept")
    return token_counts(d, cols=("tokens", "kept"))


@register("T13_remove_punct", sql=f"""
SELECT doc_id, len(p) AS n_tokens, array_to_string(p, ' ') AS joined
FROM (SELECT doc_id, {ST.remove_punct(S.word_tokens('text'))} AS p FROM documents)
""")
def q_remove_punct(spark, sf):
    d = T.remove_punct(T.tokenize(docs(spark, sf, "text"), how="words"))
    return T.join_tokens(d).select("doc_id", F.size("tokens").cast("long").alias("n_tokens"), "joined")


@register("T14_hyphen_core", sql=f"""
SELECT doc_id, array_to_string({ST.hyphen_core(S.ws_tokens('text'))}, ' ') AS joined FROM documents
""")
def q_hyphen(spark, sf):
    d = T.hyphen_core(T.tokenize(docs(spark, sf, "text"), how="ws"))
    return T.join_tokens(d).select("doc_id", "joined")


def _contraction_sql(tokens: str) -> str:
    pairs = ", ".join(f"{S.sql_str(k)}: {S.sql_str(v)}" for k, v in sorted(T.CONTRACTIONS.items()))
    expanded = f"list_transform({tokens}, lambda t: coalesce(MAP {{{pairs}}}[lower(t)], t))"
    return f"flatten(list_transform({expanded}, lambda t: string_split(t, ' ')))"


@register("T15_expand_contractions", sql=f"""
SELECT doc_id, len(e) AS n_tokens, array_to_string(e, ' ') AS joined
FROM (SELECT doc_id, {_contraction_sql(S.ws_tokens('lower(text)'))} AS e FROM documents)
""")
def q_contractions(spark, sf):
    d = docs(spark, sf, "text").withColumn("text", F.lower("text"))
    d = T.expand_contractions(T.tokenize(d, how="ws"))
    return T.join_tokens(d).select("doc_id", F.size("tokens").cast("long").alias("n_tokens"), "joined")


@register("T20_ngram_counts", sql=f"""
WITH toks AS ({_EN}),
grams AS (
  SELECT doc_id, 1 AS n, unnest({ST.ngrams('tokens', 1)}) AS gram FROM toks
  UNION ALL SELECT doc_id, 2 AS n, unnest({ST.ngrams('tokens', 2)}) AS gram FROM toks
  UNION ALL SELECT doc_id, 3 AS n, unnest({ST.ngrams('tokens', 3)}) AS gram FROM toks)
SELECT gram AS term, count(*) AS tf, count(DISTINCT doc_id) AS df FROM grams GROUP BY gram
""")
def q_ngrams(spark, sf):
    d = T.ngrams(en_alpha(spark, sf), 1, 3)
    return term_stats(d, tokens_col="grams")


@register("T21_excerpt", sql="SELECT doc_id, left(text, 250) AS excerpt FROM documents")
def q_excerpt(spark, sf):
    return T.excerpt(docs(spark, sf, "text")).select("doc_id", "excerpt")
