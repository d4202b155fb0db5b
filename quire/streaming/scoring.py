"""Scoring newly arriving documents.

The stream reads documents with ``readStream`` and hands each micro-batch to
the same batch scorer used offline (``foreachBatch``): the scorer is
stateless per document, so no streaming state store is involved and a
restarted query resumes from its checkpoint.  Results land in a parquet
table under the shared checkpoint folder (idempotent per batch id).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def document_stream(spark: SparkSession, folder: str, *, file_glob: str = "documents*.parquet",
                    max_files: int = 1) -> DataFrame:
    """Documents arriving as parquet files in ``folder``."""
    return (spark.readStream.schema(DOC_SCHEMA).option("pathGlobFilter", file_glob)
            .option("maxFilesPerTrigger", max_files).parquet(folder))


def table_stream(spark: SparkSession, path: str, *, bytes_per_batch: int = 1 << 30) -> DataFrame:
    """The files of one Parquet table (a folder or a single file, with its own
    schema) as a stream; its last character is written as a pattern, which
    matches either."""
    path = path.rstrip("/")
    return (spark.readStream.schema(spark.read.parquet(path).schema)
            .option("maxBytesPerTrigger", str(bytes_per_batch)).parquet(f"{path[:-1]}[{path[-1]}]"))


def score_stream(stream: DataFrame, scorer: Callable[[DataFrame], DataFrame], out_path: str, checkpoint: str,
                 *, available_now: bool = True):
    """Run ``scorer`` on every micro-batch and append to ``out_path``.  A
    batch re-run after a failure overwrites its own partition
    (``batch_id``), so the sink stays exactly-once."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        scored = scorer(batch).withColumn("batch_id", F.lit(batch_id))
        (scored.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(out_path))

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
