"""Corpus preparation: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor
kept and returns a DataFrame; ``run`` writes each result as Parquet in the
shared folder and reads it back as the next stage's input.  All stages but the
last return the columns of ``documents``.  Extra columns of the input are
dropped; null ids, null texts and repeated rows are handled as each operator
says, and an empty table passes through as one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm.charcrf import find_personal_data
from quire.llm.common import row_key, written
from quire.llm.ebayes import score_quality
from quire.llm.packing import pack_documents
from quire.llm.queries import VOCABULARY
from quire.llm.simhash import near_duplicate_classes
from quire.llm.winnow import decontaminate
from quire.session import ensure_checkpoint_dir, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality posterior is at least one half stay."""
    scored = score_quality(docs, table(spark, sf_dir, "labels"), carry=("text", "lang", "source", "n_chars"))
    return scored.filter("keep").select("doc_id", *(F.col(f"carried_{c}").alias(c) for c in COLUMNS[1:]))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class stays: of the rows with the smallest
    id, the one with the smallest row key.  Rows without an id belong to no
    class that could name them and stay."""
    classes = near_duplicate_classes(docs, shingle=4, max_bits=4).filter("doc_id IS NOT NULL")
    keep = (classes.groupBy("component_id").agg(F.min(F.struct("doc_id", "rk")).alias("r"))
            .select("r.doc_id", "r.rk"))
    named = docs.filter("doc_id IS NOT NULL").select(*COLUMNS, row_key("doc_id", "text").alias("rk"))
    chosen = named.join(keep, ["doc_id", "rk"], "left_semi").dropDuplicates(["doc_id", "rk"]).select(COLUMNS)
    return chosen.union(docs.filter("doc_id IS NULL").select(COLUMNS))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold any 10-word window of a benchmark item go."""
    hit = (decontaminate(docs, table(spark, sf_dir, "benchmark"), window=10).filter("n_hit > 0")
           .select(F.col("doc_id").alias("d"), F.col("rk").alias("k")).distinct())
    hit = written(hit, "contaminated")
    own = docs.select(*COLUMNS, row_key("doc_id", "text").alias("rk"))
    return own.join(hit, own["doc_id"].eqNullSafe(hit["d"]) & (own["rk"] == hit["k"]), "left_anti").select(COLUMNS)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data becomes its kind's name; ``n_chars`` follows."""
    found = find_personal_data(docs, carry=("lang", "source"), redact=True)
    return found.select("doc_id", F.col("redacted").alias("text"), "lang", "source",
                        F.length("redacted").cast(docs.schema["n_chars"].dataType).alias("n_chars"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as pieces of sequences of at most 1024 tokens."""
    return pack_documents(docs, VOCABULARY, 2, capacity=1024)


STAGES = [
    ("quality_classifier", keep_quality),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("personal_data", redact_personal_data),
    ("best_fit_packing", pack),
]

#: fitted models, XXH64 and token ids are beyond SQL; tests/llm/test_pipeline.py
#: holds the stages against brute-force versions instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read again."""
    ensure_checkpoint_dir(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
