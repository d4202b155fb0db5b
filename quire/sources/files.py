"""File sources and sinks (S8-S12): XML records, a directory corpus, a
materialised corpus with dense ids, and byte decoding with fallbacks."""

from __future__ import annotations

import gzip

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ranking import global_row_number
from ..functions.text import c

CORPUS_SCHEMA = "id long, doc_id long, text string"


def read_records(spark: SparkSession, path: str, row_tag: str, *, value_col: str | None = None) -> DataFrame:
    """One document per repeated XML element ``row_tag``, text
    lower-cased, in file order (``pos``)."""
    df = spark.read.format("xml").option("rowTag", row_tag).load(path)
    col = value_col or ("_VALUE" if "_VALUE" in df.columns else df.columns[0])
    return df.select(F.lower(F.col(col).cast("string")).alias("text"),
                     F.monotonically_increasing_id().alias("pos"))


def write_records(df: DataFrame, path: str, row_tag: str, root_tag: str = "records", *, col: str = "text") -> None:
    df.select(F.col(col).alias(row_tag)).write.mode("overwrite").format("xml").option("rowTag", "row") \
        .option("rootTag", root_tag).save(path)


def read_text_corpus(spark: SparkSession, root: str, *, glob: str = "*/*/*.txt") -> DataFrame:
    """Every text file under ``root/<split>/<label>/``, one row per
    file; split and label from the two folders above the file (a
    ``key=value`` folder name keeps its value)."""
    df = spark.read.option("wholetext", "true").option("recursiveFileLookup", "false").text(f"{root.rstrip('/')}/{glob}")
    path = F.col("_metadata.file_path")
    split = F.regexp_extract(path, r"/([^/]+)/[^/]+/[^/]+$", 1)
    label = F.regexp_extract(path, r"/([^/]+)/[^/]+$", 1)
    strip = lambda x: F.regexp_replace(x, r"^[^=]*=", "")
    return df.select(path.alias("path"), strip(split).alias("split"), strip(label).alias("label"),
                     F.col("value").alias("text"))


def write_corpus(df: DataFrame, path: str, *, order: list[str], id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Give each document a dense 0-based ``id`` in ``order``, write the
    corpus once as parquet, and read it back with an explicit schema (later
    runs read the written table instead of rebuilding it)."""
    ranked = global_row_number(df.select(id_col, text_col, *[o for o in order if o not in (id_col, text_col)]),
                               [F.col(o).asc() for o in order], name="id")
    ranked.select((F.col("id") - 1).alias("id"), F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")) \
        .write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(CORPUS_SCHEMA).parquet(path)


def corpus_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint directory for written tables."""
    base = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir")
    return f"{base.rstrip('/')}/tables/{name}"


# --------------------------------------------------------------- decoding

DECODE_SCHEMA = T.StructType([T.StructField("text", T.StringType()), T.StructField("status", T.StringType())])


@F.pandas_udf(DECODE_SCHEMA)
def _decode_bytes(content: pd.Series) -> pd.DataFrame:
    texts, status = [], []
    for b in content:
        if b is None:
            texts.append(None)
            status.append("failed")
            continue
        b = bytes(b)
        try:
            texts.append(b.decode("utf-8"))
            status.append("utf8")
            continue
        except UnicodeDecodeError:
            pass
        try:
            texts.append(gzip.decompress(b).decode("utf-8"))
            status.append("gzip")
        except (OSError, EOFError, UnicodeDecodeError):
            texts.append(None)
            status.append("failed")
    return pd.DataFrame({"text": texts, "status": status})


def decode_text(binary: DataFrame, *, content_col: str = "content") -> DataFrame:
    """UTF-8 text of a binary column; bytes that are not UTF-8 are
    gunzipped and decoded again; what still fails is kept with status
    ``failed`` and null text.  Valid UTF-8 is recognised JVM-side; only the
    other rows go through an Arrow batch UDF (gzip has no SQL built-in)."""
    s = F.col(content_col).cast("string")
    ok = F.expr(f"is_valid_utf8(cast({content_col} AS string))")
    fast = binary.filter(ok).withColumn("text", s).withColumn("status", F.lit("utf8"))
    slow = binary.filter(~ok | F.col(content_col).isNull()).withColumn("_d", _decode_bytes(c(content_col)))
    slow = slow.withColumn("text", F.col("_d.text")).withColumn("status", F.col("_d.status")).drop("_d")
    return fast.unionByName(slow)


def decode_counts(decoded: DataFrame) -> DataFrame:
    """Number of rows per decoding status."""
    return decoded.groupBy("status").agg(F.count(F.lit(1)).cast("long").alias("n"))
