"""Supervised learning, evaluation and resampling.

Evaluation works on a long predictions table ``(id, y, yhat[, p])``: every
metric is a grouped aggregate (partial aggregation per partition, one tiny
result), so it scales with the number of predictions, not with a driver
loop.  Models are MLlib estimators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import c


# ----------------------------------------------------------------- splits


def assign_split(df: DataFrame, *, id_col: str = "doc_id", split_size: int, label_size: int,
                 names: tuple[str, ...] = ("train", "test")) -> DataFrame:
    """Split from ``id // split_size`` (past the named splits: ``extra``)
    and label from ``(id // label_size) % 2`` inverted (first half of each
    split positive, as the line ranges of the labelled corpus); null label in
    ``extra``."""
    k = F.floor(c(id_col) / split_size).cast("int")
    split = F.element_at(F.array(*[F.lit(n) for n in names]), k + 1)
    split = F.when(k < len(names), split).otherwise(F.lit("extra"))
    label = F.when(k < len(names), (1 - F.pmod(F.floor(c(id_col) / label_size), F.lit(2))).cast("double"))
    return df.withColumn("split", split).withColumn("sentiment", label)


def by_split(df: DataFrame, splits, *, col: str = "split") -> DataFrame:
    """L1: rows of the given splits."""
    return df.filter(F.col(col).isin(list(splits)))


def binarize_rating(df: DataFrame, *, col: str = "stars", neutral: float = 5.0, out: str = "label") -> DataFrame:
    """L4: drop neutral ratings (== neutral), label = rating > neutral."""
    return df.filter(F.col(col) != neutral).withColumn(out, (F.col(col) > neutral).cast("int"))


def shuffle(df: DataFrame, seed: int = 0, *, id_col: str = "doc_id") -> DataFrame:
    """L2: reproducible shuffle (order by a seeded hash of the id)."""
    return df.orderBy(F.xxhash64(c(id_col), F.lit(seed)), c(id_col))


GOLDEN = 0.6180339887498949  # fractional part of the golden ratio


def sample_key(id_col, seed: int = 0):
    """u in [0, 1): fractional part of (id + 7919 seed) * 0.618...; one
    double multiply and a floor, so every engine and every retry agrees."""
    x = (c(id_col) + F.lit(seed * 7919)).cast("double") * F.lit(GOLDEN)
    return x - F.floor(x)


def sample(df: DataFrame, fraction: float, seed: int = 0, *, id_col: str = "doc_id") -> DataFrame:
    """L3: reproducible sample of about ``fraction`` of the rows: a row is
    kept when its ``sample_key`` is below the fraction (an evenly spread,
    low-discrepancy choice over the ids; the same rows on every run)."""
    return df.filter(sample_key(id_col, seed) < fraction)


# ----------------------------------------------------------------- metrics


def confusion(pred: DataFrame, *, y: str = "y", yhat: str = "yhat", group: tuple[str, ...] = ()) -> DataFrame:
    """Counts on the full label grid (empty cells are 0).  The label set
    is tiny (distinct values), so the grid cross join is bounded."""
    gcols = list(group)
    labels = pred.select(F.col(y).alias("l")).union(pred.select(F.col(yhat).alias("l"))).distinct()
    grid = labels.withColumnRenamed("l", "actual").crossJoin(F.broadcast(labels.withColumnRenamed("l", "predicted")))
    if gcols:
        # groups x labels x labels: all three are distinct-value tables
        grid = pred.select(*gcols).distinct().crossJoin(F.broadcast(grid))
    counts = pred.groupBy(*gcols, F.col(y).alias("actual"), F.col(yhat).alias("predicted")).agg(
        F.count(F.lit(1)).cast("long").alias("n"))
    return grid.join(counts, gcols + ["actual", "predicted"], "left").fillna(0, subset=["n"])


def class_report(pred: DataFrame, *, y: str = "y", yhat: str = "yhat", digits: int = 6) -> DataFrame:
    """Precision, recall, F1 and support per class, then the macro and
    support-weighted averages (zero denominators give 0).  Computed from the
    confusion counts (one row per (actual, predicted) pair), so only that
    tiny table is regrouped."""
    cm = pred.groupBy(F.col(y).alias("a"), F.col(yhat).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    same = F.col("a") == F.col("p")
    as_pred = cm.select(F.col("p").alias("cls"), F.when(same, F.col("n")).otherwise(0).alias("tp"),
                        F.when(same, 0).otherwise(F.col("n")).alias("fp"), F.lit(0).cast("long").alias("fn"))
    as_true = cm.select(F.col("a").alias("cls"), F.lit(0).cast("long").alias("tp"), F.lit(0).cast("long").alias("fp"),
                        F.when(same, 0).otherwise(F.col("n")).alias("fn"))
    per = as_pred.unionByName(as_true).groupBy("cls").agg(*[F.sum(m).alias(m) for m in ("tp", "fp", "fn")])
    p = F.coalesce(F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fp")).cast("double")), F.lit(0.0))
    r = F.coalesce(F.try_divide(F.col("tp").cast("double"), (F.col("tp") + F.col("fn")).cast("double")), F.lit(0.0))
    per = per.select(F.col("cls").cast("string").alias("cls"), p.alias("precision"), r.alias("recall"),
                     (F.col("tp") + F.col("fn")).cast("long").alias("support"))
    per = per.withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                                       F.col("precision") + F.col("recall")), F.lit(0.0)))
    avg = per.agg(F.avg("precision").alias("precision"), F.avg("recall").alias("recall"), F.avg("f1").alias("f1"),
                  F.sum("support").cast("long").alias("support"))
    wavg = per.agg(*[F.try_divide(F.sum(F.col(m) * F.col("support")), F.sum("support").cast("double")).alias(m)
                     for m in ("precision", "recall", "f1")], F.sum("support").cast("long").alias("support"))
    out = per.select("cls", "precision", "recall", "f1", "support").unionByName(
        avg.select(F.lit("macro avg").alias("cls"), "precision", "recall", "f1", "support")).unionByName(
        wavg.select(F.lit("weighted avg").alias("cls"), "precision", "recall", "f1", "support"))
    return out.select("cls", *[F.round(m, digits).alias(m) for m in ("precision", "recall", "f1")], "support")


def accuracy(pred: DataFrame, *, y: str = "y", yhat: str = "yhat", group: tuple[str, ...] = ()) -> DataFrame:
    """Share of correct predictions (per group)."""
    acc = F.avg((F.col(y) == F.col(yhat)).cast("double")).alias("accuracy")
    n = F.count(F.lit(1)).cast("long").alias("n")
    return pred.groupBy(*group).agg(acc, n) if group else pred.agg(acc, n)


def error_rate(pred: DataFrame, *, y: str = "y", p: str = "p") -> DataFrame:
    """Share of rows whose rounded probability differs from the target."""
    return pred.agg(F.avg((F.round(F.col(p)) != F.col(y)).cast("double")).alias("error_rate"))


def misclassified(pred: DataFrame, docs: DataFrame, *, id_col: str = "doc_id", y: str = "y", yhat: str = "yhat",
                  text_col: str = "text", n_chars: int = 250) -> DataFrame:
    """False positives and false negatives with an excerpt of the text."""
    wrong = pred.filter(F.col(y) != F.col(yhat)).withColumn(
        "kind", F.when(F.col(yhat) > F.col(y), F.lit("false_positive")).otherwise(F.lit("false_negative")))
    return wrong.join(docs.select(id_col, F.left(c(text_col), F.lit(n_chars)).alias("excerpt")), id_col)


def class_counts(df: DataFrame, *, col: str = "label") -> DataFrame:
    """Rows per class."""
    return df.groupBy(F.col(col).alias("cls")).agg(F.count(F.lit(1)).cast("long").alias("n"))


def leaderboard(preds: DataFrame, *, method: str = "method", y: str = "y", yhat: str = "yhat") -> DataFrame:
    """Accuracy per method, best first, with its rank (ties share)."""
    acc = preds.groupBy(method).agg(F.avg((F.col(y) == F.col(yhat)).cast("double")).alias("accuracy"),
                                    F.count(F.lit(1)).cast("long").alias("n"))
    # one row per method: a small table, ranked in one task
    return acc.withColumn("rank", F.rank().over(Window.orderBy(F.desc("accuracy"))).cast("long"))


def prob_histogram(pred: DataFrame, width: float = 0.05, *, p: str = "p", y: str = "y") -> DataFrame:
    """Counts of predicted probabilities per bin of ``width``, by true class."""
    nbins = int(round(1.0 / width))
    b = F.least(F.floor(F.col(p) / width), F.lit(nbins - 1)).cast("long")
    return pred.groupBy(b.alias("bin"), F.col(y).alias("cls")).agg(F.count(F.lit(1)).cast("long").alias("n"))


# ----------------------------------------------------------------- models


def fit_logistic(train: DataFrame, *, features: str = "features", label: str = "y", reg: float = 0.0,
                 max_iter: int = 100):
    """L5 (``reg=0``: maximum likelihood with intercept) / L6 (``reg>0``)."""
    from pyspark.ml.classification import LogisticRegression

    return LogisticRegression(featuresCol=features, labelCol=label, regParam=reg, maxIter=max_iter).fit(train)


def fit_mlp(train: DataFrame, layers: list[int], *, features: str = "features", label: str = "y",
            max_iter: int = 100, seed: int = 599, block_size: int = 32):
    """Feed-forward network (sigmoid hidden layers, softmax output,
    L-BFGS); ``layers`` = [inputs, hidden..., classes]."""
    from pyspark.ml.classification import MultilayerPerceptronClassifier

    return MultilayerPerceptronClassifier(featuresCol=features, labelCol=label, layers=layers, maxIter=max_iter,
                                          seed=seed, blockSize=block_size).fit(train)


def predict(model, df: DataFrame, *, threshold: float = 0.5, id_col: str = "vec_id", label: str = "y") -> DataFrame:
    """Probability of class 1 and the thresholded prediction."""
    from pyspark.ml.functions import vector_to_array

    out = model.transform(df).select(id_col, F.col(label).alias("y"),
                                     vector_to_array("probability")[1].alias("p"))
    return out.withColumn("yhat", (F.col("p") > threshold).cast("int"))


def evaluate(model, sets: dict[str, DataFrame], **kw) -> DataFrame:
    """One fitted model scored on several sets in one grouped
    evaluation ``(set, accuracy, n)``."""
    parts = None
    for name, df in sets.items():
        p = predict(model, df, **kw).withColumn("set", F.lit(name))
        parts = p if parts is None else parts.unionByName(p)
    return accuracy(parts, group=("set",))
