"""Partitioning helpers.

Inputs at cluster scale arrive as thousands of file splits and need no extra
shuffle before per-row work.  Test tables are single parquet files that scan as
one partition; ``spread`` hashes those out so CPU-heavy projections run on every
core, and by the document key so that later per-document windows and
aggregates reuse the same partitioning instead of shuffling again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def target_partitions(df: DataFrame) -> int:
    spark = df.sparkSession
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def cores(df: DataFrame) -> int:
    return int(df.sparkSession.sparkContext.defaultParallelism)


def spread(df: DataFrame, *keys: str, min_partitions: int | None = None) -> DataFrame:
    """Repartition by ``keys`` only when the input has fewer partitions than
    there are cores to run it (planning only, no job).  The count is explicit
    on purpose: the data may be small in bytes but heavy in CPU (regexes over
    whole texts), which AQE's size-based coalescing would squeeze back into
    one task."""
    want = min_partitions or min(target_partitions(df), cores(df))
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want, *keys) if keys else df.repartition(want)


def by_key(df: DataFrame, *keys: str) -> DataFrame:
    """Whole rows dealt by hash of ``keys``, whatever the input's partitions.
    For documents that are exploded into words afterwards: one shuffle of the
    texts, after which aggregates, joins and windows by document stay in their
    tasks, instead of a shuffle of the many times larger word rows at each."""
    return df.repartition(max(target_partitions(df), df.rdd.getNumPartitions()), *keys)


def is_small(df: DataFrame, max_rows: int) -> bool:
    """Size check that reads at most ``max_rows + 1`` rows: the guard that
    must pass before a table is broadcast or collected into an array."""
    return df.limit(max_rows + 1).count() <= max_rows
