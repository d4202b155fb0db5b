"""Importing this module registers every analysis."""

from . import (  # noqa: F401
    flows,
    model_jobs,
    more_jobs,
    page_jobs,
    sentiment_jobs,
    text_jobs,
    topic_jobs,
    vector_jobs,
    vocab_jobs,
    word_jobs,
)
