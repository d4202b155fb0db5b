"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, every other character untouched (``lower`` folds all of
    Unicode, which the digests here must not)."""
    return F.translate(c, UPPER, UPPER.lower())


def scratch_path(df: DataFrame, name: str) -> str:
    """A new folder below the shared checkpoint folder of the session."""
    root = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: the
    lineage is cut, every later reader sees the same rows, and a lost executor
    costs a re-read, not a recomputation."""
    path = scratch_path(df, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread_scan(df: DataFrame) -> DataFrame:
    """Deal out a scan that has fewer partitions than the cluster has cores
    (single-file test tables); a cluster scan is left alone.  Only for inputs
    that are plain scans, where counting partitions runs no job."""
    want = int(df.sparkSession.sparkContext.defaultParallelism)
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want)


def row_key(*cols: str) -> Column:
    """64-bit key of a row's contents.  Used next to the document id, so that
    rows that repeat an id with another text stay apart; rows equal in both
    have equal results and may share one."""
    return F.xxhash64(*[F.col(c) for c in cols])
