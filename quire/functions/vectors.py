"""Dense-vector arithmetic on ``array<float|double>`` columns with higher-order
functions (JVM side, no Python)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import c


def as_double(v) -> Column:
    return F.transform(c(v), lambda x: x.cast("double"))


def dot(a, b) -> Column:
    prods = F.zip_with(as_double(a), as_double(b), lambda x, y: x * y)
    return F.aggregate(prods, F.lit(0.0), lambda acc, x: acc + x)


def norm2(a) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a, b) -> Column:
    return F.try_divide(dot(a, b), norm2(a) * norm2(b))


def sq_dist(a, b) -> Column:
    diffs = F.zip_with(as_double(a), as_double(b), lambda x, y: (x - y) * (x - y))
    return F.aggregate(diffs, F.lit(0.0), lambda acc, x: acc + x)
