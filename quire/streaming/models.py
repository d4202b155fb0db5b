"""Stored fitted pipelines and their use on a stream.

A model store is a folder with one sub-folder per version and a table of
finished versions, which gets its row after the model is completely written; a
reader never sees half a model.  A stream loads one version when it starts and
scores every micro-batch with it, so all rows of a run come from the same
model; the version is part of every scored row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSIONS = "version long, path string"


def versions(spark: SparkSession, store: str) -> DataFrame:
    """(version, path) of the finished models; empty for a new store."""
    try:
        return spark.read.schema(VERSIONS).parquet(f"{store.rstrip('/')}/versions")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], VERSIONS)


def write_model(model: PipelineModel, store: str) -> int:
    """Write a fitted pipeline as the next version; returns its number.  One
    writer at a time.  A folder that an unfinished writer left is replaced."""
    spark = SparkSession.getActiveSession()
    version = (versions(spark, store).agg(F.max("version")).first()[0] or 0) + 1
    path = f"{store.rstrip('/')}/v{version}"
    model.write().overwrite().save(path)
    spark.createDataFrame([(version, path)], VERSIONS).coalesce(1).write.mode("append").parquet(f"{store.rstrip('/')}/versions")
    return version


def read_model(spark: SparkSession, store: str, version: int | None = None) -> tuple[int, PipelineModel]:
    """(version, model): the given version, else the newest finished one."""
    found = versions(spark, store)
    if version is not None:
        found = found.filter(F.col("version") == version)
    row = found.orderBy(F.desc("version")).first()
    if row is None:
        raise ValueError(f"no finished model{'' if version is None else f' of version {version}'} in {store}")
    return row["version"], PipelineModel.load(row["path"])


def fitted_scorer(spark: SparkSession, store: str, prepare: Callable[[DataFrame], DataFrame], version: int | None = None,
                  *, id_col: str = "doc_id", threshold: float = 0.5) -> Callable[[DataFrame], DataFrame]:
    """A scorer for ``score_stream``: the model is loaded here, once; it maps
    documents through ``prepare`` (the columns the pipeline reads) to (id, p,
    yhat, version).  Nothing is shuffled."""
    number, model = read_model(spark, store, version)

    def score(batch: DataFrame) -> DataFrame:
        p = vector_to_array("probability")[1]
        return (model.transform(prepare(batch)).select(id_col, p.alias("p"))
                .select(id_col, "p", (F.col("p") > threshold).cast("int").alias("yhat"),
                        F.lit(number).cast("long").alias("version")))

    return score
