"""Document quality by hierarchical empirical Bayes.

* *Document evidence.*  A logistic regression on surface statistics of the
  whole text (case, symbols, repeats, line and word shape), fitted on a bounded
  sample of labelled documents, gives each document a log-likelihood ratio:
  its logit less the logit of the training share.
* *Sites.*  Grouped sums of the documents' probabilities over hosts and over
  (host, path) give site posteriors.  A host's rate has a Beta prior with the
  global mean, a path's a Beta prior with its host's posterior mean.  The prior
  strengths come from the spread of the site means (method of moments), so
  sparse sites shrink towards what is known above them.
* *Combination.*  A document's posterior log-odds are its own log-likelihood
  ratio plus the logit of its path's posterior without its own share.

Site sums are partial aggregates; a host with a third of all documents joins
its sums back with a salt.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import spread_scan, written

SALT = 32
FEATURES = ("upper share", "symbol share", "mark share", "digit share", "bar share", "word repeats", "distinct words",
            "line repeats", "mean word", "long words", "log words", "bias")
SYMBOLS = re.compile(r"[#$%&*^~=<>{}\[\]\\@_]")
MARKS = re.compile(r"[!?]")
DIGITS = re.compile(r"[0-9]")


def features(text: str | None) -> list[float]:
    """Surface statistics of a whole text; null and wordless texts give zeros."""
    words = (text or "").split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    chars = sum(map(len, words))
    letters = sum(map(str.isalpha, text)) or 1
    upper = sum(map(str.isupper, text))
    lines = [x.strip() for x in text.split("\n") if x.strip()]
    same = sum(a == b for a, b in zip(words, words[1:]))
    return [
        upper / letters,
        min(1.0, 10 * len(SYMBOLS.findall(text)) / chars),
        min(1.0, 10 * len(MARKS.findall(text)) / chars),
        min(1.0, 10 * len(DIGITS.findall(text)) / chars),
        min(1.0, 5 * sum(w == "|" for w in words) / n),
        same / n,
        min(2.0, len(set(words)) / n ** 0.8),
        1 - len(set(lines)) / len(lines),
        min(3.0, chars / n / 5),
        sum(len(w) > 25 for w in words) / n,
        min(2.0, float(np.log1p(n)) / 5),
        1.0,
    ]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 25) -> np.ndarray:
    """Newton steps for ridge logistic regression (the last column is the bias
    and not penalised)."""
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (p - y) + penalty * w
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, limit: int) -> DataFrame:
    """(text, y): at most ``limit`` labelled documents, chosen by a hash of the
    id; ids labelled twice count by their smaller label."""
    chosen = (labels.filter(F.col(label_col).isNotNull() & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.min(label_col).alias("y"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit))
    # ``limit`` rows of two numbers: a bounded broadcast
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "y")


def train_evidence(docs: DataFrame, labels: DataFrame, limit: int = 10_000) -> tuple[np.ndarray, float] | None:
    """(weights, training logit), or None when a class is missing.  Only the
    feature rows of the bounded sample reach the driver."""
    def run(batches):
        for b in batches:
            rows = [features(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), b.column(1).cast(pa.int32())],
                                             ["x", "y"])

    got = (labelled_sample(docs, labels, "quality", limit).select("text", F.col("y").cast("int"))
           .mapInArrow(run, "x array<double>, y int").collect())
    y = np.array([r.y for r in got], float)
    if not len(y) or y.min() == y.max():
        return None
    share = y.mean()
    return fit_logistic(np.array([r.x for r in got]), y), float(np.log(share / (1 - share)))


def document_evidence(docs: DataFrame, model: tuple[np.ndarray, float] | None, host: Column, path: Column,
                      carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, host, path, llr, p, *carry) per row; empty texts have no evidence."""
    slim = spread_scan(docs.select("doc_id", host.alias("host"), path.alias("path"), "text",
                                   *(F.col(c).alias(f"carry_{i}") for i, c in enumerate(carry))))
    kinds = {f.name: f.dataType.simpleString() for f in slim.schema}
    weights, base = model if model else (np.zeros(len(FEATURES)), 0.0)
    extra = [f"carry_{i}" for i in range(len(carry))]

    def run(batches):
        for b in batches:
            llr = np.zeros(b.num_rows)
            for i in range(b.num_rows):
                x = np.array(features(b.column(3)[i].as_py()))
                if x[-1]:
                    llr[i] = x @ weights - base
            p = 1 / (1 + np.exp(-np.clip(llr + base, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:3], pa.array(np.clip(llr, -30, 30)), pa.array(p), *b.columns[4:]],
                ["doc_id", "host", "path", "llr", "p", *extra])

    return slim.mapInArrow(run, f"doc_id {kinds['doc_id']}, host string, path string, llr double, p double"
                           + "".join(f", {c} {kinds[c]}" for c in extra))


def strength(mean: float, between: float) -> float:
    """Beta prior strength for site rates with that mean and variance."""
    if between <= 0 or not 0 < mean < 1:
        return 1e4
    return float(min(1e4, max(1.0, mean * (1 - mean) / between - 1)))


def score_quality(docs: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None,
                  limit: int = 10_000, keep_from: float = 0.5, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, host, path, evidence, host_rate, path_rate, quality, keep,
    *carried), one row per row of ``docs``; ``carry`` names further columns to pass
    through, prefixed ``carried_`` (the evidence is then computed again beside them, which is cheaper
    than moving texts).

    ``host`` and ``path`` default to ``source`` and ``lang``; nulls in them are
    the empty name.  A null or wordless text has evidence 0 and gets its site's
    rate.  Without labels of both classes all evidence is 0 and everything is
    kept at quality 0.5.  Repeated rows count and are scored as rows; an empty
    table gives an empty table."""
    host = F.coalesce((F.col("source") if host is None else host).cast("string"), F.lit(""))
    path = F.coalesce((F.col("lang") if path is None else path).cast("string"), F.lit(""))
    model = train_evidence(docs, labels, limit)
    own = written(document_evidence(docs, model, host, path), "evidence")
    paths = own.groupBy("host", "path").agg(F.sum("p").alias("s"), F.count(F.lit(1)).alias("n")).checkpoint()
    hosts = paths.groupBy("host").agg(F.sum("s").alias("hs"), F.sum("n").alias("hn"))
    total = hosts.agg(F.sum("hs").alias("s"), F.sum("hn").alias("n")).first()
    mean = min(0.999, max(0.001, total.s / total.n)) if total.n else 0.5
    spread = hosts.agg((F.sum(F.col("hn") * F.pow(F.col("hs") / F.col("hn") - mean, 2)) / F.sum("hn")).alias("v")).first()
    k_host = strength(mean, spread.v or 0.0)
    hosts = hosts.withColumn("host_rate", (F.col("hs") + k_host * mean) / (F.col("hn") + k_host))
    sites = paths.join(hosts, "host")
    inner = sites.agg((F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - F.col("host_rate"), 2)) / F.sum("n")).alias("v")).first()
    k_path = strength(mean, inner.v or 0.0)
    salted = written(sites.select("host", "path", "s", "n", "host_rate",
                                  F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))).alias("salt")), "sites")
    if carry:
        own = document_evidence(docs, model, host, path, carry)
    # the document's own share leaves its site before the site speaks for it
    rate = (F.col("s") - F.col("p") + k_path * F.col("host_rate")) / (F.col("n") - 1 + k_path)
    rate = F.least(F.greatest(rate, F.lit(1e-6)), F.lit(1 - 1e-6))
    odds = F.col("llr") + F.log(F.col("path_rate") / (1 - F.col("path_rate")))
    return (own.withColumn("salt", F.expr(f"CAST(pmod(xxhash64(doc_id, llr), {SALT}) AS INT)"))
            .join(salted, ["host", "path", "salt"])
            .withColumn("path_rate", rate).withColumn("quality", 1 / (1 + F.exp(-odds)))
            .select("doc_id", "host", "path", F.col("llr").alias("evidence"), "host_rate", "path_rate", "quality",
                    (F.col("quality") >= keep_from).alias("keep"),
                    *(F.col(f"carry_{i}").alias(f"carried_{c}") for i, c in enumerate(carry))))
