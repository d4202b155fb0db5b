"""Session construction and table access.

The library never creates a session inside an operator: every operator takes
DataFrames.  These helpers exist for tests, the bench and ``__spark_entry__``.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def build_session(cores: int | str = "*", app: str = "quire", memory: str = "16g") -> SparkSession:
    """A local session tuned like a cluster job: AQE on, UI off, UTC clock."""
    cores = str(cores)
    parts = cores if cores.isdigit() else str(os.cpu_count() or 8)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", parts)
        .config("spark.default.parallelism", parts)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names in
    ``spark.checkpoint.dir``.  Only a local master may go without: it gets a
    temporary folder, which no cluster must use."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="quire-ckpt-")
    sc.setCheckpointDir(path)
    spark.conf.set("spark.checkpoint.dir", path)
    return sc.getCheckpointDir() or path


@contextmanager
def freed_shuffles(spark: SparkSession):
    """Actions on frames made in here leave no shuffle files: their results are
    written or collected, so nothing reads the files again.  Without it they stay
    until the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, was)


def discard(df: DataFrame) -> None:
    """Deletes the files of a frame that ``checkpoint()`` returned and nobody
    will read again: an iteration's state, once the next one is written."""
    plan = df._jdf.queryExecution().analyzed()
    file = plan.rdd().getCheckpointFile() if plan.getClass().getSimpleName() == "LogicalRDD" else None
    if file is not None and file.isDefined():
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(file.get())
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared checkpoint folder and read back.
    For small derived tables (stop words, lexicons, models): they are computed
    once, and their size in bytes is known to the planner, which broadcasts
    them below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles above."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    with freed_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
