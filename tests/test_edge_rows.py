"""The edge rows every test set should carry: empty token list, one token,
identical texts, no lexicon hit, tied scores, non-ASCII text, a label
without a document and a document without a label."""

import pytest
from pyspark.sql import functions as F

from quire.functions.text import alpha_lower, word_tokens
from quire.operators import learn as L
from quire.operators import sentiment as W
from quire.operators import similarity as Y
from quire.operators import text as T
from quire.operators import vectors as X
from quire.operators import vocab as V

DOCS = [
    (1, ""),                                   # empty text
    (2, "word"),                               # one token
    (3, "good film, GREAT cast!"),             # lexicon hits, caps, '!'
    (4, "good film, GREAT cast!"),             # identical text
    (5, "zzz qqq"),                            # no lexicon hit
    (6, "Café naïve résumé déjà vu"),          # non-ASCII
    (7, "bad film but good cast"),             # 'but' shift
]
LEXICON = [("good", 2, 0.5, 0.5), ("great", 3, 0.75, 0.75), ("bad", -2, -0.5, 0.5)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string")


@pytest.fixture(scope="module")
def toks(docs):
    return docs.select("doc_id", "text", alpha_lower(word_tokens("text")).alias("tokens"))


@pytest.fixture(scope="module")
def lex(spark):
    return spark.createDataFrame(LEXICON, "word string, valence long, polarity double, subjectivity double")


def test_every_document_gets_a_score(toks, docs, lex):
    pol = {r.doc_id: r for r in W.polarity(toks, lex).collect()}
    val = {r.doc_id: r for r in W.valence_sum(toks, lex).collect()}
    sen = {r.doc_id: r for r in W.sense_scores(toks, W.derive_senses(lex)).collect()}
    com = {r.doc_id: r for r in W.compound(docs, lex).collect()}
    for scores in (pol, val, sen, com):
        assert set(scores) == {d for d, _ in DOCS}
    # empty text and no lexicon hit: neutral scores, not missing rows
    for d in (1, 5):
        assert pol[d].polarity == 0.0 and pol[d].n_matched == 0 and pol[d].terms == ""
        assert val[d].score == 0 and val[d].label == 0
        assert sen[d].score is None and sen[d].label is None
        assert com[d].compound == 0.0
    # identical texts score identically
    assert tuple(pol[3])[1:] == tuple(pol[4])[1:]
    assert val[3].score == val[4].score == 5
    # caps and '!' raise the compound score of the same words
    plain = W.compound(docs.sparkSession.createDataFrame([(9, "good film, great cast")], "doc_id long, text string"), lex)
    assert com[3].compound > plain.first().compound
    # words after 'but' weigh more: the positive clause wins
    assert com[7].compound > 0


def test_vocabulary_edges(toks, docs):
    s = {r.doc_id: r for r in V.vocab_scores(docs).collect()}
    assert s[1].n_tokens == 0 and s[1].diversity is None
    assert s[2].n_tokens == 1 and s[2].diversity == 1.0
    assert s[6].vocab_size == 5  # non-ASCII letters are word characters
    folded = {r.doc_id: r.text for r in T.ascii_fold(docs).collect()}
    assert folded[6] == "Cafe naive resume deja vu"


def test_copies_and_ties_in_similarity(toks):
    w = X.normalize(X.tfidf(X.bow(toks), X.count_docs(toks), variant="smooth"), "l2")
    classes, members = Y.pair_classes(w, 0.3)
    rows = {(r.a, r.b): r for r in classes.collect()}
    assert (3, 3) in rows and rows[(3, 3)].n_pairs == 1 and rows[(3, 3)].score == 1.0
    top = Y.top_doc_pairs(classes, members, 2).collect()
    assert (top[0].a, top[0].b) == (3, 4)
    rep = {r.doc_id: r.rep for r in members.collect()}
    assert rep[3] == rep[4] == 3


def test_labels_without_documents_and_documents_without_labels(spark, toks, lex):
    labels = spark.createDataFrame([(3, 1), (5, 0), (99, 1)], "doc_id long, quality int")  # 99 has no document
    pred = W.valence_sum(toks, lex).join(labels, "doc_id").select(F.col("quality").alias("y"), F.col("label").alias("yhat"))
    assert pred.count() == 2  # documents without a label and the orphan label drop out of the evaluation
    cm = {(r.actual, r.predicted): r.n for r in L.confusion(pred).collect()}
    assert cm == {(1, 1): 1, (0, 0): 1, (1, 0): 0, (0, 1): 0}  # empty cells appear as 0
    rep = {r.cls: r for r in L.class_report(pred).collect()}
    assert rep["1"].precision == 1.0 and rep["macro avg"].f1 == 1.0
