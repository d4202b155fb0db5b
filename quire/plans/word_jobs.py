"""Registered analyses: word forms, tagging, chunking, fuzzy matching
(N1-N7, A1-A5, F1-F3, T16)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.partitioning import by_key, spread
from ..functions.text import alpha_lower, explode_rows, word_tokens
from ..operators import annotate as A
from ..operators import fuzzy as FZ
from ..operators import text as T
from ..operators import words as N
from . import sqlfrag as S
from ..session import stored
from .registry import Tables, register

_Q = S.sql_str
LEX_MIN = 3
SPELL_MIN, SPELL_DIST = 5, 2
_ALPHA = S.alpha_lower(S.word_tokens("text"))


def _list(words) -> str:
    return "[" + ", ".join(_Q(w) for w in words) + "]"


# ------------------------------------------------------------ vocabularies

def en_tokens(spark, sf) -> DataFrame:
    d = spread(Tables(spark, sf).documents.filter(F.col("lang") == "en").select("doc_id", "text"), "doc_id")
    return d.select("doc_id", alpha_lower(word_tokens("text")).alias("tokens"))


def vocab(spark, sf) -> DataFrame:
    return N.vocabulary(en_tokens(spark, sf))


def corpus_vocab(spark, sf) -> DataFrame:
    """(word, n) over the documents of every language."""
    d = spread(Tables(spark, sf).documents.select("doc_id", "text"), "doc_id")
    return N.vocabulary(d.select("doc_id", alpha_lower(word_tokens("text")).alias("tokens")))


def lexicon(spark, sf) -> DataFrame:
    """Valid words: seen at least ``LEX_MIN`` times in the English documents."""
    return vocab(spark, sf).filter(F.col("n") >= LEX_MIN).select("word")


_VOCAB = f"SELECT word, count(*) AS n FROM (SELECT unnest({_ALPHA}) AS word FROM documents WHERE lang = 'en') GROUP BY word"
_LEXW = f"SELECT word FROM ({_VOCAB}) WHERE n >= {LEX_MIN}"


def _stem_sql(w: str, rules=N.STEM_RULES) -> str:
    parts = [f"WHEN ends_with({w}, {_Q(s)}) AND length({w}) - {len(s)} >= {m} THEN left({w}, length({w}) - {len(s)}) || {_Q(r)}"
             for s, r, m in rules]
    return "CASE " + " ".join(parts) + f" ELSE {w} END"


@register("N1_conflate", sql=f"SELECT word, {_stem_sql('word')} AS stem FROM ({_VOCAB})")
def q_conflate(spark, sf):
    return N.conflate(vocab(spark, sf))


@register("N1_conflation_stats", sql=f"""
SELECT stem, count(*) AS n_words, array_to_string(list_sort(list(word)), ' ') AS words
FROM (SELECT word, {_stem_sql('word')} AS stem FROM ({_VOCAB})) GROUP BY stem
""")
def q_conflation_stats(spark, sf):
    return N.conflation_stats(N.conflate(vocab(spark, sf)))


def _prefix_chain_sql(src: str) -> str:
    """Unrolled candidate chain: one nested SELECT per prefix."""
    q = f"SELECT word, word AS w, []::VARCHAR[] AS cands FROM ({src})"
    for p in sorted(N.PREFIXES, key=len, reverse=True):
        stripped = f"regexp_replace(w, {_Q(p + '-?')}, '', 'g')"
        q = (f"SELECT word, CASE WHEN starts_with(w, {_Q(p)}) THEN {stripped} ELSE w END AS w, "
             f"CASE WHEN starts_with(w, {_Q(p)}) THEN list_append(cands, {stripped}) ELSE cands END AS cands FROM ({q})")
    return q


def _strip_sql(src: str, lex: str) -> str:
    return f"""
  SELECT v.word, coalesce(f.s, v.word) AS stripped FROM (SELECT DISTINCT word FROM ({src})) v LEFT JOIN (
    SELECT word, arg_min(cand, i) AS s FROM (
      SELECT word, generate_subscripts(cands, 1) AS i, unnest(cands) AS cand FROM ({_prefix_chain_sql(src)}))
    WHERE cand IN ({lex}) GROUP BY word) f USING (word)"""


@register("N2_strip_prefix", sql=_strip_sql(_VOCAB, _LEXW))
def q_strip(spark, sf):
    return N.strip_prefix(vocab(spark, sf), lexicon(spark, sf))


def _lemma_cands_sql(w: str, cls: str) -> str:
    items = [f"CASE WHEN ends_with({w}, {_Q(s)}) AND length({w}) > {len(s)} THEN left({w}, length({w}) - {len(s)}) || {_Q(r)} END"
             for s, r in N.LEMMA_RULES[cls]]
    return "[" + ", ".join(items) + "]::VARCHAR[]" if items else "[]::VARCHAR[]"


_EXC = "MAP {" + ", ".join(f"{_Q(k)}: {_Q(v)}" for k, v in sorted(N.LEMMA_EXCEPTIONS.items())) + "}"


def _lemma_sql(src: str, lex: str, with_pos: bool) -> str:
    if with_pos:
        cands = ("CASE " + " ".join(f"WHEN pos = {_Q(k)} THEN {_lemma_cands_sql('word', k)}" for k in ("n", "v", "a", "r"))
                 + " ELSE []::VARCHAR[] END")
        keys = "word, pos"
    else:
        cands = _lemma_cands_sql("word", "n")
        keys = "word"
    return f"""
  SELECT {keys}, coalesce({_EXC}[word], f.l, word) AS lemma FROM (SELECT DISTINCT {keys} FROM ({src})) v LEFT JOIN (
    SELECT {keys}, arg_min(cand, i) AS l FROM (
      SELECT {keys}, generate_subscripts(c, 1) AS i, unnest(c) AS cand FROM (
        SELECT {keys}, list_filter(list_prepend(word, {cands}), lambda x: x IS NOT NULL) AS c FROM (SELECT DISTINCT {keys} FROM ({src}))))
    WHERE cand IN ({lex}) GROUP BY {keys}) f USING ({keys})"""


@register("N3_lemmatize", sql=_lemma_sql(_VOCAB, _LEXW, False))
def q_lemma(spark, sf):
    return N.lemmatize(vocab(spark, sf), lexicon(spark, sf))


# ----------------------------------------------------------- rule tagging

def _rule_tag_sql(t: str, p: str) -> str:
    closed = "MAP {" + ", ".join(f"{_Q(w)}: {_Q(tag)}" for tag, ws in A.CLOSED_CLASS.items() for w in ws) + "}"
    low = f"lower({t})"
    parts = [f"WHEN NOT regexp_matches({t}, '[\\p{{L}}\\p{{N}}]') THEN CASE WHEN {t} IN ({', '.join(_Q(x) for x in A.PUNCT_TAGS)}) THEN {t} ELSE 'SYM' END",
             f"WHEN regexp_full_match({t}, '\\p{{N}}+') THEN 'CD'",
             f"WHEN {closed}[{low}] IS NOT NULL THEN {closed}[{low}]"]
    after_det = f"coalesce(lower({p}) IN ({', '.join(_Q(x) for x in A.CLOSED_CLASS['DT'])}), false)"
    for suf, tag in A.SUFFIX_TAGS:
        cond = f"ends_with({low}, {_Q(suf)}) AND length({low}) > {len(suf) + 1}"
        if tag == "VBD":
            parts.append(f"WHEN {cond} AND {after_det} THEN 'JJ'")
        parts.append(f"WHEN {cond} THEN {_Q(tag)}")
    parts.append(f"WHEN ends_with({low}, 's') AND length({low}) > 3 THEN 'NNS'")
    sent_start = f"({p} IS NULL OR {p} IN ({', '.join(_Q(x) for x in A.SENTENCE_PUNCT)}))"
    parts.append(f"WHEN regexp_matches({t}, '^\\p{{Lu}}') AND NOT {sent_start} THEN 'NNP'")
    return "CASE " + " ".join(parts) + " ELSE 'NN' END"


def _tagged_sql(where: str = "") -> str:
    return f"""
  SELECT doc_id, (z).pos AS pos, (z).token AS token, (z).tag AS tag FROM (
    SELECT doc_id, unnest(list_transform(t, lambda x, i: {{'pos': i - 1, 'token': x,
        'tag': {_rule_tag_sql('x', 'CASE WHEN i > 1 THEN t[i - 1] END')}}})) AS z
    FROM (SELECT doc_id, {S.word_tokens('text')} AS t FROM documents {where}))"""


def rule_tagged(docs: DataFrame) -> DataFrame:
    t = docs.select("doc_id", word_tokens("text").alias("tokens"))
    return A.tagged_rows(t.withColumn("tags", A.rule_tags("tokens")))


def all_docs(spark, sf) -> DataFrame:
    return spread(Tables(spark, sf).documents.select("doc_id", "text"), "doc_id")


@register("A1_rule_tags", sql=_tagged_sql())
def q_rule_tags(spark, sf):
    return rule_tagged(all_docs(spark, sf))


_TRAIN = "WHERE doc_id IN (SELECT doc_id FROM labels)"


def _model_sql(key: str, name: str, cond: str = "") -> str:
    return f"""
  SELECT {name}, arg_min(tag, (-n, tag)) AS tag_{name} FROM (
    SELECT {key} AS {name}, tag, count(*) AS n FROM tr {cond} GROUP BY ALL) GROUP BY {name}"""


_MODEL = f"""
  tr AS MATERIALIZED ({_tagged_sql(_TRAIN)}),
  mw AS ({_model_sql('token', 'word')}),
  m3 AS ({_model_sql('right(token, 3)', 'suf3', 'WHERE length(token) >= 3')}),
  m2 AS ({_model_sql('right(token, 2)', 'suf2', 'WHERE length(token) >= 2')}),
  rt AS MATERIALIZED ({_tagged_sql()}),
  mt AS MATERIALIZED (SELECT rt.doc_id, rt.pos, rt.token, coalesce(mw.tag_word, m3.tag_suf3, m2.tag_suf2, 'NN') AS tag
         FROM rt LEFT JOIN mw ON mw.word = rt.token
         LEFT JOIN m3 ON m3.suf3 = CASE WHEN length(rt.token) >= 3 THEN right(rt.token, 3) END
         LEFT JOIN m2 ON m2.suf2 = CASE WHEN length(rt.token) >= 2 THEN right(rt.token, 2) END)"""


def train_docs(spark, sf) -> DataFrame:
    """The labelled documents, dealt before they become words: a file has few splits."""
    tb = Tables(spark, sf)
    return by_key(tb.documents.select("doc_id", "text").join(tb.labels.select("doc_id"), "doc_id", "left_semi"), "doc_id")


def tagger(spark, sf):
    model = {k: stored(m, f"tagger-{k}") for k, m in A.train_tagger(rule_tagged(train_docs(spark, sf))).items()}
    rows = rule_tagged(by_key(Tables(spark, sf).documents.select("doc_id", "text"), "doc_id"))
    # a word of a document meets the model once, with all its places
    words = rows.groupBy("doc_id", "token").agg(F.collect_list("pos").alias("at"))
    tagged = A.apply_tagger(words, model).select("doc_id", explode_rows("at", "pos"), "token", "tag")
    return rows, tagged


@register("A1_train_tagger", sql=f"WITH {_MODEL} SELECT word, tag_word FROM mw")
def q_train(spark, sf):
    return A.train_tagger(rule_tagged(train_docs(spark, sf)))["word"]


@register("A1_apply_tagger", sql=f"WITH {_MODEL} SELECT doc_id, pos, token, tag FROM mt")
def q_apply(spark, sf):
    return tagger(spark, sf)[1].select("doc_id", "pos", "token", "tag")


def _map_sql(t: str, variant: str) -> str:
    if variant == "wordnet":
        return (f"CASE WHEN starts_with({t}, 'J') THEN 'a' WHEN starts_with({t}, 'V') THEN 'v' WHEN starts_with({t}, 'N') THEN 'n' "
                f"WHEN starts_with({t}, 'R') THEN 'r' WHEN starts_with({t}, 'E') THEN 'r' WHEN starts_with({t}, 'P') THEN 'n' END")
    return (f"CASE WHEN starts_with({t}, 'J') THEN 'ADJ' WHEN {t} = 'VGB' THEN 'NOUN' WHEN {t} = 'V' THEN 'VERB' "
            f"WHEN starts_with({t}, 'N') THEN 'NOUN' WHEN starts_with({t}, 'R') THEN 'ADJ' WHEN starts_with({t}, 'P') THEN 'NOUN' END")


@register("A2_map_tags", sql=f"""
SELECT tag, {_map_sql('tag', 'wordnet')} AS wordnet, {_map_sql('tag', 'spacy')} AS spacy, count(*) AS n
FROM ({_tagged_sql()}) GROUP BY tag
""")
def q_map_tags(spark, sf):
    r = rule_tagged(all_docs(spark, sf))
    g = r.groupBy("tag").agg(F.count(F.lit(1)).cast("long").alias("n"))
    return g.select("tag", A.map_tags("tag", "wordnet").alias("wordnet"), A.map_tags("tag", "spacy").alias("spacy"), "n")


_CMP = f"""{_MODEL},
  cmp AS (SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, coalesce(a.pos, b.pos) AS pos, coalesce(a.token, b.token) AS token,
                 a.tag AS tag_a, b.tag AS tag_b, coalesce(a.tag = b.tag, false) AS agree
          FROM rt a FULL OUTER JOIN mt b ON a.doc_id = b.doc_id AND a.pos = b.pos)"""


def compared(spark, sf):
    rule_rows, model_rows = tagger(spark, sf)
    return A.compare_tags(rule_rows, model_rows)


@register("A3_tag_confusion", sql=f"WITH {_CMP} SELECT tag_a, tag_b, count(*) AS n FROM cmp GROUP BY ALL")
def q_confusion(spark, sf):
    return A.tag_confusion(compared(spark, sf))


@register("A3_tag_agreement", sql=f"""
WITH {_CMP} SELECT count(*) AS n, sum(agree::INTEGER)::BIGINT AS n_agree, round(avg(agree::INTEGER), 6) AS share FROM cmp
""")
def q_agreement(spark, sf):
    c_ = compared(spark, sf)
    return c_.agg(F.count(F.lit(1)).cast("long").alias("n"), F.sum(F.col("agree").cast("int")).cast("long").alias("n_agree"),
                  F.round(F.avg(F.col("agree").cast("int")), 6).alias("share"))


@register("A3_tag_mismatches", sql=f"WITH {_CMP} SELECT doc_id, pos, token, tag_a, tag_b FROM cmp WHERE NOT agree")
def q_mismatch(spark, sf):
    return compared(spark, sf).filter(~F.col("agree")).select("doc_id", "pos", "token", "tag_a", "tag_b")


def _chunks_sql() -> str:
    def code(g: str) -> str:
        return f"CASE WHEN {g} = 'DT' THEN 'D' WHEN starts_with({g}, 'JJ') THEN 'J' WHEN starts_with({g}, 'NN') THEN 'N' ELSE 'x' END"

    atom = f"({code('tags[i]')}) || chr(2) || tok || chr(3)"
    return f"""
  tg AS (SELECT doc_id, t, list_transform(t, lambda x, i: {_rule_tag_sql('x', 'CASE WHEN i > 1 THEN t[i - 1] END')}) AS tags
         FROM (SELECT doc_id, {S.word_tokens('text')} AS t FROM documents)),
  atm AS (SELECT doc_id, array_to_string(list_transform(t, lambda tok, i: {atom}), '') AS s FROM tg),
  mt AS (SELECT doc_id, list_transform(regexp_extract_all(s, {_Q(A.ATOM_CHUNK)}, 0),
                lambda m: trim(regexp_replace(regexp_replace(m, '[DJN]' || chr(2), '', 'g'), chr(3), ' ', 'g'))) AS cs FROM atm),
  chunks AS (SELECT doc_id, generate_subscripts(cs, 1) - 1 AS chunk_id, unnest(cs) AS text FROM mt)"""


@register("A4_noun_chunks", sql=f"WITH {_chunks_sql()} SELECT doc_id, chunk_id, text FROM chunks")
def q_chunks(spark, sf):
    t = all_docs(spark, sf).select("doc_id", word_tokens("text").alias("tokens"))
    return A.noun_chunks(t.withColumn("tags", A.rule_tags("tokens")))


@register("A4_chunk_list", sql=f"""
WITH {_chunks_sql()}
SELECT doc_id, string_agg(text, ' | ' ORDER BY chunk_id) AS chunks FROM chunks GROUP BY doc_id
""")
def q_chunk_list(spark, sf):
    t = all_docs(spark, sf).select("doc_id", word_tokens("text").alias("tokens"))
    return A.chunk_list(A.noun_chunks(t.withColumn("tags", A.rule_tags("tokens"))))


@register("A5_rank_sentences", sql=f"""
WITH s AS (SELECT doc_id, generate_subscripts(ss, 1) - 1 AS sent_id, unnest(ss) AS sentence
           FROM (SELECT doc_id, {S.sentences('text')} AS ss FROM documents)),
  n AS (SELECT doc_id, sent_id, len({S.word_tokens('sentence')}) AS n_tokens FROM s)
SELECT doc_id, sent_id, n_tokens,
       row_number() OVER (PARTITION BY doc_id ORDER BY n_tokens, sent_id) AS rank_asc,
       count(*) OVER (PARTITION BY doc_id) - row_number() OVER (PARTITION BY doc_id ORDER BY n_tokens, sent_id) + 1 AS rank_desc
FROM n
""")
def q_rank_sentences(spark, sf):
    s = T.split_sentences(all_docs(spark, sf))
    s = s.select("doc_id", "sent_id", F.size(word_tokens("sentence")).cast("long").alias("n_tokens"))
    return A.rank_sentences(s)


# ------------------------------------------------ word forms, continued

def tagged_vocab(spark, sf) -> DataFrame:
    """(word, pos) of alphabetic English tokens, class from the rule tags."""
    d = spread(Tables(spark, sf).documents.filter(F.col("lang") == "en").select("doc_id", "text"), "doc_id")
    r = rule_tagged(d).filter(F.col("token").rlike(r"^\p{L}+$"))
    r = r.select(F.lower("token").alias("word"), A.map_tags("tag", "wordnet").alias("pos"))
    return r.filter(F.col("pos").isNotNull()).groupBy("word", "pos").agg(F.count(F.lit(1)).cast("long").alias("n"))


_TVOCAB = f"""
  SELECT lower(token) AS word, {_map_sql('tag', 'wordnet')} AS pos, count(*) AS n FROM ({_tagged_sql("WHERE lang = 'en'")})
  WHERE regexp_full_match(token, '\\p{{L}}+') AND {_map_sql('tag', 'wordnet')} IS NOT NULL GROUP BY ALL"""


@register("N4_lemmatize_pos", sql=_lemma_sql(_TVOCAB, _LEXW, True))
def q_lemma_pos(spark, sf):
    return N.lemmatize(tagged_vocab(spark, sf), lexicon(spark, sf), pos_col="pos")


@register("N5_prefix_then_stem", sql=f"""
SELECT word, {_stem_sql('stripped')} AS form FROM ({_strip_sql(_VOCAB, _LEXW)})
""")
def q_prefix_stem(spark, sf):
    s = N.strip_prefix(vocab(spark, sf), lexicon(spark, sf))
    return s.select("word", N.stem_col("stripped").alias("form"))


def _reps_spark(spark, sf):
    v = vocab(spark, sf)
    lex = lexicon(spark, sf)
    stems = N.conflate(v).select("word", F.col("stem").alias("form"))
    lemmas = N.lemmatize(v, lex).select("word", F.col("lemma").alias("form"))
    stripped = N.strip_prefix(v, lex)
    pstem = stripped.select("word", N.stem_col("stripped").alias("form"))
    plemma = N.lemmatize(stripped.select(F.col("stripped").alias("word")).distinct(), lex) \
        .join(stripped.withColumnRenamed("word", "orig").withColumnRenamed("stripped", "word"), "word") \
        .select(F.col("orig").alias("word"), F.col("lemma").alias("form"))
    forms = {"raw": v.select("word", F.col("word").alias("form")), "stem": stems, "lemma": lemmas,
             "prefix_stem": pstem, "prefix_lemma": plemma}
    reps = None
    for name, f in forms.items():
        r = v.join(f, "word").groupBy("form").agg(F.sum("n").cast("long").alias("tf")) \
            .select(F.col("form").alias("term"), "tf", F.lit(name).alias("method"))
        reps = r if reps is None else reps.unionByName(r)
    tv = tagged_vocab(spark, sf)
    tl = N.lemmatize(tv, lex, pos_col="pos")
    target = tv.join(tl, ["word", "pos"]).groupBy("lemma").agg(F.sum("n").cast("long").alias("tf")) \
        .select(F.col("lemma").alias("term"), "tf")
    return reps, target, stems, lemmas


_REPS = f"""
  v AS ({_VOCAB}),
  st AS (SELECT word, {_stem_sql('word')} AS form FROM v),
  lm AS (SELECT word, lemma AS form FROM ({_lemma_sql(_VOCAB, _LEXW, False)})),
  sp AS ({_strip_sql(_VOCAB, _LEXW)}),
  ps AS (SELECT word, {_stem_sql('stripped')} AS form FROM sp),
  pl AS (SELECT sp.word, l.lemma AS form FROM sp JOIN ({_lemma_sql('SELECT DISTINCT stripped AS word FROM sp', _LEXW, False)}) l
         ON l.word = sp.stripped),
  forms AS (SELECT 'raw' AS method, word, word AS form FROM v UNION ALL SELECT 'stem', word, form FROM st
            UNION ALL SELECT 'lemma', word, form FROM lm UNION ALL SELECT 'prefix_stem', word, form FROM ps
            UNION ALL SELECT 'prefix_lemma', word, form FROM pl),
  reps AS (SELECT method, form AS term, sum(n)::BIGINT AS tf FROM forms JOIN v USING (word) GROUP BY method, form),
  tv AS ({_TVOCAB}),
  tl AS ({_lemma_sql(_TVOCAB, _LEXW, True)}),
  target AS (SELECT lemma AS term, sum(n)::BIGINT AS tf FROM tv JOIN tl USING (word, pos) GROUP BY lemma)"""


@register("N6_compare_normalizers", sql=f"""
WITH {_REPS},
  dots AS (SELECT method, sum(reps.tf * target.tf) AS dot FROM reps JOIN target USING (term) GROUP BY method),
  norms AS (SELECT method, sqrt(sum(tf * tf)) AS nrm FROM reps GROUP BY method),
  tn AS (SELECT sqrt(sum(tf * tf)) AS tnrm FROM target),
  sc AS (SELECT method, coalesce(dot::DOUBLE / (nrm * tnrm), 0.0) AS score FROM norms LEFT JOIN dots USING (method), tn)
SELECT method, round(score, 6) AS score, rank() OVER (ORDER BY round(score, 9) DESC) AS rank FROM sc
""")
def q_compare(spark, sf):
    reps, target, _, _ = _reps_spark(spark, sf)
    return N.compare_normalizers(reps, target).withColumn("score", F.round("score", 6))


@register("N7_accuracy_share", sql=f"""
WITH {_REPS}
SELECT round(avg((st.form = lm.form)::INTEGER) * 100.0, 6) AS pct_correct, count(*) AS n FROM st JOIN lm USING (word)
""")
def q_accuracy_share(spark, sf):
    _, _, stems, lemmas = _reps_spark(spark, sf)
    pairs = stems.join(lemmas.withColumnRenamed("form", "target"), "word")
    return N.accuracy_share(pairs).withColumn("pct_correct", F.round("pct_correct", 6))


# ------------------------------------------------------------ fuzzy

@register("F1_edit_distance", sql="""
SELECT a.c_custkey, levenshtein(a.c_name, b.c_name) AS distance
FROM customer a JOIN customer b ON b.c_custkey = a.c_custkey + 1
""")
def q_edit(spark, sf):
    c_ = Tables(spark, sf).customer.select("c_custkey", "c_name")
    nxt = c_.select((F.col("c_custkey") - 1).alias("c_custkey"), F.col("c_name").alias("next_name"))
    j = c_.join(nxt, "c_custkey")
    return j.select("c_custkey", FZ.edit_distance("c_name", "next_name").cast("long").alias("distance"))


def _lcs_sql(a: str, b: str) -> str:
    return (f"list_reduce(string_split({a}, ''), lambda prev, x: list_reduce(range(1, length({b}) + 1), "
            f"lambda acc, j: list_append(acc, CASE WHEN {b}[j] = x THEN prev[j] + 1 ELSE greatest(prev[j + 1], acc[j]) END), [0]), "
            f"list_transform(range(0, length({b}) + 1), lambda i: 0))[-1]")


@register("F2_fuzzy_ratio", sql=f"""
SELECT a.p_partkey, a.p_name, b.p_name AS next_name,
       round(200.0 * {_lcs_sql('a.p_name', 'b.p_name')} / nullif(length(a.p_name) + length(b.p_name), 0))::BIGINT AS ratio
FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1
""")
def q_ratio(spark, sf):
    p = Tables(spark, sf).part.select("p_partkey", "p_name")
    nxt = p.select((F.col("p_partkey") - 1).alias("p_partkey"), F.col("p_name").alias("next_name"))
    j = p.join(nxt, "p_partkey")
    return j.select("p_partkey", "p_name", "next_name", FZ.fuzzy_ratio("p_name", "next_name").alias("ratio"))


@register("F3_fuzzy_join", sql="""
SELECT a.c_name AS l, b.c_name AS r, levenshtein(a.c_name, b.c_name) AS distance
FROM (SELECT DISTINCT c_name FROM customer) a, (SELECT DISTINCT c_name FROM customer) b
WHERE a.c_name < b.c_name AND levenshtein(a.c_name, b.c_name) <= 1
""")
def q_fuzzy_join(spark, sf):
    names = Tables(spark, sf).customer.select(F.col("c_name").alias("name"))
    return FZ.fuzzy_join(names, names, 1).filter(F.col("l") < F.col("r")).withColumn("distance", F.col("distance").cast("long"))


_ASCII_VOCAB = (f"SELECT word, count(*) AS n FROM (SELECT unnest({_ALPHA}) AS word FROM documents) "
                "WHERE regexp_full_match(word, '[a-z]+') GROUP BY word")


@register("T16_correct_spelling", sql=f"""
WITH v AS ({_ASCII_VOCAB}),
  c AS (SELECT a.word, b.word AS r, b.n AS rn, levenshtein(a.word, b.word) AS d
        FROM v a JOIN v b ON abs(length(a.word) - length(b.word)) <= {SPELL_DIST}
        WHERE a.n < {SPELL_MIN} AND b.n >= {SPELL_MIN} AND levenshtein(a.word, b.word) <= {SPELL_DIST}),
  best AS (SELECT word, arg_min(r, (d, -rn, r)) AS corrected, min(d) AS distance FROM c GROUP BY word)
SELECT v.word, coalesce(best.corrected, v.word) AS corrected, coalesce(best.distance, 0)::BIGINT AS distance
FROM v LEFT JOIN best USING (word)
""")
def q_spelling(spark, sf):
    """T16 over the words of a-z of all documents, beside its twin."""
    v = corpus_vocab(spark, sf).filter(F.col("word").rlike("^[a-z]+$"))
    return FZ.correct_spelling(v, min_count=SPELL_MIN, max_dist=SPELL_DIST)


@register("T16_correct_spelling_all")
def q_spelling_all(spark, sf):
    """T16 over the whole vocabulary of all documents.  No twin: DuckDB's
    ``levenshtein`` counts bytes, so only the words of a-z
    (``T16_correct_spelling``) can be compared."""
    return FZ.correct_spelling(corpus_vocab(spark, sf), min_count=SPELL_MIN, max_dist=SPELL_DIST)
