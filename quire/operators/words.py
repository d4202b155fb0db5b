"""Word-form normalisation.

A stemmer or lemmatiser is a per-word function, so it runs once per
*distinct* word of the vocabulary (a small table next to the token table) and
is joined back to the tokens.  Rules and lexicons are tables or fixed rule
lists; candidates are generated with array built-ins, exploded, checked
against the lexicon with a semi join and the first valid one kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import c, explode_rows

# English prefixes, in the reference's order (27 entries).
PREFIXES = [
    "anti", "auto", "dis", "down", "extra", "hyper", "il", "im", "ir", "inter", "mega", "mid", "mis",
    "non", "over", "out", "post", "pro", "re", "semi", "sub", "super", "tele", "trans", "ultra", "un", "up",
]

# Suffix rules of the conflating stemmer, tried in order; the
# first suffix that matches with at least ``min_stem`` letters left wins.
STEM_RULES = [
    ("sses", "ss", 1), ("ies", "i", 1), ("ational", "ate", 2), ("tional", "tion", 2), ("ization", "ize", 2),
    ("fulness", "ful", 2), ("ousness", "ous", 2), ("iveness", "ive", 2), ("biliti", "ble", 2),
    ("ements", "", 3), ("ement", "", 3), ("ments", "", 3), ("ment", "", 3), ("ations", "ate", 2),
    ("ation", "ate", 2), ("ness", "", 3), ("ings", "", 3), ("ing", "", 3), ("edly", "", 3), ("ed", "", 3),
    ("ly", "", 3), ("ers", "", 3), ("er", "", 3), ("est", "", 3), ("ful", "", 3), ("ous", "", 3), ("es", "", 3),
    ("s", "", 3),
]

# Detachment rules per word class (WordNet morphology), tried in order.
LEMMA_RULES = {
    "n": [("s", ""), ("ses", "s"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y")],
    "v": [("s", ""), ("ies", "y"), ("es", "e"), ("es", ""), ("ed", "e"), ("ed", ""), ("ing", "e"), ("ing", "")],
    "a": [("er", ""), ("est", ""), ("er", "e"), ("est", "e")],
    "r": [],
}
# Irregular forms looked up before the rules.
LEMMA_EXCEPTIONS = {
    "children": "child", "men": "man", "women": "woman", "feet": "foot", "teeth": "tooth", "mice": "mouse",
    "geese": "goose", "people": "person", "was": "be", "were": "be", "is": "be", "are": "be", "been": "be",
    "am": "be", "had": "have", "has": "have", "did": "do", "does": "do", "done": "do", "went": "go",
    "gone": "go", "better": "good", "best": "good", "worse": "bad", "worst": "bad", "made": "make",
    "said": "say", "took": "take", "taken": "take", "saw": "see", "seen": "see", "came": "come",
}


def _rule_chain(word: Column, rules) -> Column:
    expr = None
    for suf, rep, min_stem in rules:
        cond = word.endswith(suf) & (F.length(word) - len(suf) >= min_stem)
        stem = F.concat(F.substring(word, F.lit(1), F.length(word) - len(suf)), F.lit(rep))
        expr = F.when(cond, stem) if expr is None else expr.when(cond, stem)
    return expr.otherwise(word) if expr is not None else word


def stem_col(word, rules=STEM_RULES) -> Column:
    """The stem of one word under ordered suffix rules."""
    return _rule_chain(c(word), rules)


def vocabulary(tokens: DataFrame, *, tokens_col: str = "tokens") -> DataFrame:
    """Distinct words with their occurrence counts."""
    ex = tokens.select(explode_rows(tokens_col, "word")).filter(F.col("word").isNotNull())
    return ex.groupBy("word").agg(F.count(F.lit(1)).cast("long").alias("n"))


def conflate(vocab: DataFrame, rules=STEM_RULES, *, word_col: str = "word") -> DataFrame:
    """``(word, stem)`` for each distinct word."""
    return vocab.select(F.col(word_col).alias("word"), stem_col(word_col, rules).alias("stem"))


def conflation_stats(stems: DataFrame) -> DataFrame:
    """One row per stem class: size and members (sorted)."""
    return stems.groupBy("stem").agg(F.count(F.lit(1)).cast("long").alias("n_words"),
                                     F.array_join(F.array_sort(F.collect_list("word")), " ").alias("words"))


def prefix_candidates(word, prefixes=PREFIXES) -> Column:
    """N2 candidate chain: prefixes by length descending (ties in list
    order); while the current form starts with a prefix, every occurrence of
    ``prefix-?`` is removed and the result is the next candidate (the form
    stays stripped between attempts)."""
    ordered = sorted(prefixes, key=len, reverse=True)
    w = c(word)
    acc0 = F.struct(w.alias("w"), F.array().cast("array<string>").alias("cands"))
    arr = F.array(*[F.lit(p) for p in ordered])

    def step(acc, p):
        stripped = F.regexp_replace(acc["w"], F.concat(p, F.lit("-?")), F.lit(""))
        hit = acc["w"].startswith(p)
        return F.struct(F.when(hit, stripped).otherwise(acc["w"]).alias("w"),
                        F.when(hit, F.concat(acc["cands"], F.array(stripped))).otherwise(acc["cands"]).alias("cands"))

    return F.aggregate(arr, acc0, step)["cands"]


def strip_prefix(vocab: DataFrame, lexicon: DataFrame, prefixes=PREFIXES, *, word_col: str = "word",
                 lex_col: str = "word") -> DataFrame:
    """``(word, stripped)``: the first candidate found in the lexicon, else
    the word itself."""
    v = vocab.select(F.col(word_col).alias("word")).distinct()
    cands = v.select("word", explode_rows(prefix_candidates("word", prefixes), "i", "cand")).filter(F.col("i").isNotNull())
    valid = cands.join(lexicon.select(F.col(lex_col).alias("cand")).distinct(), "cand", "left_semi")
    first = valid.groupBy("word").agg(F.min_by("cand", "i").alias("_s"))
    return v.join(first, "word", "left").select("word", F.coalesce("_s", "word").alias("stripped"))


def lemma_candidates(word, pos=None) -> Column:
    """N3/N4 candidates in rule order for the given class (noun when none)."""
    w = c(word)

    def rules_for(cls):
        return [F.when(w.endswith(s) & (F.length(w) > len(s)),
                       F.concat(F.substring(w, F.lit(1), F.length(w) - len(s)), F.lit(r))) for s, r in LEMMA_RULES[cls]]

    if pos is None:
        arr = F.array(*rules_for("n")) if LEMMA_RULES["n"] else F.array().cast("array<string>")
    else:
        p = c(pos)
        arr = F.array().cast("array<string>")
        for cls in ("n", "v", "a", "r"):
            branch = F.array(*rules_for(cls)) if LEMMA_RULES[cls] else F.array().cast("array<string>")
            arr = F.when(p == cls, branch).otherwise(arr)
    return F.filter(arr, lambda x: x.isNotNull())


def lemmatize(vocab: DataFrame, lexicon: DataFrame, *, word_col: str = "word", pos_col: str | None = None,
              lex_col: str = "word") -> DataFrame:
    """N3 (no class) / N4 (``pos_col`` with classes n, v, a, r): exceptions
    first; a word already in the lexicon is its own lemma; otherwise the first
    rule candidate in the lexicon; otherwise the word."""
    keys = ["word"] + (["pos"] if pos_col else [])
    v = vocab.select(F.col(word_col).alias("word"), *([F.col(pos_col).alias("pos")] if pos_col else [])).distinct()
    exc = F.create_map(*[F.lit(x) for kv in sorted(LEMMA_EXCEPTIONS.items()) for x in kv])
    lex = lexicon.select(F.col(lex_col).alias("cand")).distinct()
    cands = v.select(*keys, explode_rows(F.concat(F.array(F.col("word")), lemma_candidates("word", F.col("pos") if pos_col else None)),
                                         "i", "cand")).filter(F.col("i").isNotNull())
    valid = cands.join(lex, "cand", "left_semi")
    first = valid.groupBy(*keys).agg(F.min_by("cand", "i").alias("_l"))
    out = v.join(first, keys, "left")
    return out.select(*keys, F.coalesce(F.element_at(exc, F.col("word")), F.col("_l"), F.col("word")).alias("lemma"))


def apply_forms(tokens: DataFrame, forms: DataFrame, *, id_col: str = "doc_id", tokens_col: str = "tokens",
                word_col: str = "word", form_col: str = "form", out: str = "forms") -> DataFrame:
    """Replace every token by its normalised form (join on the distinct
    vocabulary; order kept)."""
    ex = tokens.select(id_col, explode_rows(tokens_col, "_pos", "_w")).filter(F.col("_pos").isNotNull())
    j = ex.join(forms.select(F.col(word_col).alias("_w"), F.col(form_col).alias("_f")), "_w", "left")
    g = j.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("_pos", F.coalesce("_f", "_w").alias("_f")))).alias("_s"))
    return g.select(id_col, F.transform("_s", lambda s: s["_f"]).alias(out))


def term_vector(tokens: DataFrame, *, method: str, tokens_col: str = "forms") -> DataFrame:
    """Corpus term frequencies of one representation: ``(method, term, tf)``."""
    ex = tokens.select(explode_rows(tokens_col, "term")).filter(F.col("term").isNotNull())
    return ex.groupBy("term").agg(F.count(F.lit(1)).cast("long").alias("tf")).withColumn("method", F.lit(method))


def compare_normalizers(reps: DataFrame, target: DataFrame) -> DataFrame:
    """Cosine between each representation's term vector and the target
    vector, best first (``rank``, ties share)."""
    from pyspark.sql import Window

    t = target.select("term", F.col("tf").alias("tt"))
    dots = reps.join(t, "term").groupBy("method").agg(F.sum(F.col("tf") * F.col("tt")).alias("_dot"))
    norms = reps.groupBy("method").agg(F.sqrt(F.sum(F.col("tf") * F.col("tf"))).alias("_n"))
    tn = t.agg(F.sqrt(F.sum(F.col("tt") * F.col("tt"))).alias("_tn"))
    out = norms.join(dots, "method", "left").crossJoin(F.broadcast(tn))
    score = F.coalesce(F.try_divide(F.col("_dot").cast("double"), F.col("_n") * F.col("_tn")), F.lit(0.0))
    out = out.select("method", score.alias("score"))
    # one row per method: ranked in one task
    return out.withColumn("rank", F.rank().over(Window.orderBy(F.desc(F.round("score", 9)))).cast("long"))


def accuracy_share(pairs: DataFrame, *, form_col: str = "form", target_col: str = "target") -> DataFrame:
    """Percentage of forms equal to the target form."""
    return pairs.agg((F.avg((F.col(form_col) == F.col(target_col)).cast("double")) * 100.0).alias("pct_correct"),
                     F.count(F.lit(1)).cast("long").alias("n"))
