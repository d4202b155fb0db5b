"""Toxicity severity by cumulative-link ordinal regression.

Severity grades 0 < 1 < ... < K share one weight per text feature; only the
thresholds between grades differ:

    P(grade >= k) = sigmoid(w . x - t_k),   t_1 < t_2 < ... < t_K

Features are the distinct words of a text and their 4- and 5-character
beginnings, so a new inflection of a known stem still counts.  Only features
whose share of the toxic documents of the sample is ``min_lift`` times that of
the clean ones, significantly so (log-likelihood ratio of at least
``min_ratio``), are kept, which leaves a sparse model.  No share of all toxic
documents is asked for: words of a language with few of them would never reach
it.  Every kept feature speaks for toxicity, so weights are not negative.  The
expected severity is the sum of P(grade >= k).

Labels hold one bit (toxic or not).  For training, toxic documents are graded
1..K by how much of their vocabulary is made of features that are far more
common in toxic than in clean documents of the sample, in K equal parts.

The model is fitted in numpy on a bounded, documented sample of labelled rows;
scoring is a map over whole texts with the weights in the task closure, at most
``max_features`` of them.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spread_scan
from .ebayes import labelled_sample

WORD = re.compile(r"[^\W\d_]+")


def text_features(text: str | None) -> set[str]:
    words = set(WORD.findall((text or "").lower()))
    stems = {w[:4] + "-" for w in words if len(w) > 4} | {w[:5] + "-" for w in words if len(w) > 5}
    return words | stems


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


class CumulativeLink:
    """Weights by feature, ordered thresholds, and the P(grade >= 1) from which
    a text is called toxic (the cut that separates the sample best)."""

    def __init__(self, weights: dict[str, float], thresholds: list[float], toxic_from: float = 0.5):
        self.weights, self.thresholds, self.toxic_from = weights, thresholds, toxic_from

    def exceed(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1..K, one row per score."""
        return sigmoid(scores[:, None] - np.array(self.thresholds))

    def score(self, text: str | None) -> float:
        get = self.weights.get
        return sum(get(f, 0.0) for f in text_features(text))


def likelihood_ratio(bad: int, n_bad: int, good: int, n_good: int) -> float:
    """G-squared of a 2x2 table of feature presence by class."""
    total, have = n_bad + n_good, bad + good
    out = 0.0
    for seen, row, col in ((bad, n_bad, have), (n_bad - bad, n_bad, total - have),
                           (good, n_good, have), (n_good - good, n_good, total - have)):
        if seen:
            out += 2 * seen * math.log(seen * total / (row * col))
    return out


def severity_grades(sets: list[set[str]], toxic: np.ndarray, grades: int) -> np.ndarray:
    """0 for clean documents, 1..grades for toxic ones by their marked share."""
    n1, n0 = max(1, toxic.sum()), max(1, (1 - toxic).sum())
    bad, good = Counter(), Counter()
    for s, t in zip(sets, toxic):
        (bad if t else good).update(s)
    marked = {f for f, c in bad.items() if c >= 3 and (c + 0.5) / n1 > 7 * (good[f] + 0.5) / n0}
    share = np.array([len(s & marked) / max(1, len(s)) for s in sets])
    out = np.zeros(len(sets), int)
    hot = np.flatnonzero(toxic)
    rank = np.argsort(np.argsort(share[hot], kind="stable"), kind="stable")
    out[hot] = 1 + rank * grades // max(1, len(hot))
    return out


def fit_cumulative_link(sets: list[set[str]], grade: np.ndarray, grades: int, max_features: int,
                        min_ratio: float = 16.0, min_lift: float = 60.0,
                        ridge: float = 0.002, rounds: int = 1500, rate: float = 0.05) -> CumulativeLink:
    """Adam on the mean log-likelihood.  Thresholds are a start and positive
    steps, so their order holds throughout; every threshold's error flows into
    the same weights, which are kept at zero or above after each step."""
    good = Counter(f for s, g in zip(sets, grade) if not g for f in s)
    bad = Counter(f for s, g in zip(sets, grade) if g for f in s)
    n_bad = int((grade > 0).sum())
    ratio = {f: likelihood_ratio(bad[f], n_bad, good[f], len(sets) - n_bad) for f in good.keys() | bad.keys()}
    n_good = len(sets) - n_bad
    kept = sorted((f for f, x in ratio.items()
                   if x >= min_ratio and bad[f] * n_good >= min_lift * good[f] * n_bad),
                  key=lambda f: (-ratio[f], f))[:max_features]
    index = {f: i for i, f in enumerate(kept)}
    rows = [np.array(sorted(index[f] for f in s if f in index), np.int64) for s in sets]
    cols = np.concatenate(rows) if rows else np.empty(0, np.int64)
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    n, k = len(rows), np.arange(1, grades + 1)
    target = (grade[:, None] >= k).astype(float)
    share = np.clip(target.mean(0), 1e-4, 1 - 1e-4)
    start = -np.log(share / (1 - share))
    theta = np.concatenate([np.zeros(len(kept)), start[:1], np.log(np.maximum(np.diff(start), 0.05))])
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    nf = len(kept)
    # a rare class weighs as much as the common one
    balance = np.where(grade > 0, 0.5 / max(1, (grade > 0).sum()), 0.5 / max(1, (grade == 0).sum()))
    for step in range(1, rounds + 1):
        steps = np.exp(theta[nf + 1:])
        cuts = theta[nf] + np.concatenate([[0.0], np.cumsum(steps)])
        z = np.bincount(at, theta[:nf][cols], n)
        err = (sigmoid(z[:, None] - cuts) - target) * balance[:, None]
        grad = np.empty_like(theta)
        grad[:nf] = np.bincount(cols, err.sum(1)[at], nf) + ridge * theta[:nf] / max(1, nf) ** 0.5
        cut_grad = -err.sum(0)
        grad[nf] = cut_grad.sum()
        grad[nf + 1:] = np.cumsum(cut_grad[::-1])[::-1][1:] * steps
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        theta -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        theta[:nf] = np.maximum(theta[:nf], 0.0)
    cuts = theta[nf] + np.concatenate([[0.0], np.cumsum(np.exp(theta[nf + 1:]))])
    p = sigmoid(np.bincount(at, theta[:nf][cols], n) - cuts[0])
    tries = np.unique(np.round(p, 3))
    gain = [(p[grade > 0] >= t).mean() - (p[grade == 0] >= t).mean() for t in tries]
    top = np.flatnonzero(np.array(gain) >= max(gain) - 1e-9)
    cut = min(0.5, float(tries[top].mean())) if len(top) else 0.5
    return CumulativeLink({f: float(theta[i]) for f, i in index.items() if abs(theta[i]) > 1e-4}, cuts.tolist(), cut)


def train_severity(docs: DataFrame, labels: DataFrame, grades: int = 3, limit: int = 6_000,
                   max_features: int = 20_000) -> CumulativeLink | None:
    """Fit on at most ``limit`` labelled documents; None when a class is missing."""
    def run(batches):
        for b in batches:
            sets = [sorted(text_features(t)) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([" ".join(s) for s in sets]), b.column(1).cast(pa.int32())], ["fs", "y"])

    got = (labelled_sample(docs, labels, "toxic", limit).select("text", F.col("y").cast("int"))
           .mapInArrow(run, "fs string, y int").toLocalIterator(prefetchPartitions=True))
    sets, y = [], []
    names: dict[str, str] = {}  # one string object per feature
    for r in got:
        sets.append({names.setdefault(f, f) for f in r.fs.split()})
        y.append(r.y)
    toxic = np.array(y, int)
    if not len(toxic) or toxic.min() == toxic.max():
        return None
    return fit_cumulative_link(sets, severity_grades(sets, toxic, grades), grades, max_features)


def score_severity(docs: DataFrame, labels: DataFrame, grades: int = 3, limit: int = 6_000,
                   max_features: int = 20_000) -> DataFrame:
    """(doc_id, expected_severity, grade, p_toxic, toxic), one row per row of
    ``docs``; ``grade`` is the largest k with P(grade >= k) of at least half.

    Null and wordless texts have no features and severity 0; so has everything
    when the labels lack a class.  Repeated rows are scored as rows; an empty
    table gives an empty table."""
    model = train_severity(docs, labels, grades, limit, max_features)
    slim = spread_scan(docs.select("doc_id", "text"))
    id_type = slim.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            texts = [b.column(1)[i].as_py() for i in range(b.num_rows)]
            if model is None:
                p = np.zeros((len(texts), grades))
            else:
                p = model.exceed(np.array([model.score(t) for t in texts]))
                p[[not (t and WORD.search(t)) for t in texts]] = 0.0
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(p.sum(1)), pa.array((p >= 0.5).sum(1), pa.int32()), pa.array(p[:, 0]),
                 pa.array(p[:, 0] >= (model.toxic_from if model else 2.0))], ["doc_id", "expected_severity", "grade", "p_toxic", "toxic"])

    return slim.mapInArrow(
        run, f"doc_id {id_type}, expected_severity double, grade int, p_toxic double, toxic boolean")
