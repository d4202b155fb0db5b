"""Documents ranked by text difficulty (flagship analysis).

documents -> word tokens -> alphabetic lower-case -> per-document vocabulary
scores -> corpus maxima -> normalised difficulty -> ascending rank.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.partitioning import spread
from ..operators.vocab import difficulty, difficulty_rank, vocab_scores


def rank_by_difficulty(documents: DataFrame, *, digits: int = 6) -> DataFrame:
    docs = spread(documents.select("doc_id", "text"), "doc_id")
    # difficulty needs the corpus maxima before it can normalise: write the
    # per-document scores (a few numbers per document) once, so the texts are
    # tokenized in one pass and the maxima and the ranking read the small table
    scores = vocab_scores(docs).checkpoint()
    scored = difficulty(scores)
    ranked = difficulty_rank(scored)
    return ranked.select(
        "doc_id", "n_tokens", "vocab_size", "vocab_size_long",
        F.round("diversity", digits).alias("diversity"),
        F.round("norm_vocab", digits).alias("norm_vocab"),
        F.round("norm_vocab_long", digits).alias("norm_vocab_long"),
        F.round("difficulty", digits).alias("difficulty"),
        "rank",
    )
