"""Audit of how quality filters interact, kept up to date while files arrive.

All files of a table are processed as available-now micro-batches of a file
stream.  Every batch updates two stored tables:

* *Text state*, keyed by the SHA-256 of the text: the smallest id seen so far
  and, for the rows that carry it, what they count towards.  A row is a copy if
  its text has a smaller id somewhere; when a batch brings a smaller id for a
  known text, the rows of the old id become copies.
* *Part counters*: signed changes of the number of rows per part, failure mask
  and label.  A new smaller id retracts the old rows' mask and counts them
  under the one with the copy bit.

Both are written by batch number and overwritten when a batch is repeated, so a
stream that ends early goes on from its checkpoint.  A batch takes
``bytes_per_core`` times the cores of the cluster; its texts are read once, for
a narrow table of masks and keys.  Copies are counted per id, then per text,
before rows of a text meet, so a text with a third of all rows sends a task no
more than one row for each part, label and task before it.

From the counters alone follow, for every order of the filters, the rows each
one removes, the redundant failures and the Shapley sums: a row that fails m
filters is removed by each of them in 1/m of the orders.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import scratch_path

SPACE = r"[\x20\x09-\x0D]+"
MASKS = "key binary, id long, part string, mask int"
MOVES = "key binary, part string, mask int, good int, toxic int, id long, held long, first long, copies long"
COUNTERS = "part string, mask int, good int, toxic int, first long, copies long"
SALT = 64  # rows without an id are dealt out by their text


def text_measures(rows: DataFrame) -> DataFrame:
    """Adds ``words``, ``n_words``, ``n_distinct``, ``n_upper`` and ``n_chars`` to
    rows with ``text``: words are case-sensitive runs without ASCII white space,
    ``n_upper`` counts A-Z and ``n_chars`` code points."""
    rows = rows.withColumn("words", F.array_remove(F.split("text", SPACE), ""))
    return rows.select(
        "*", F.size("words").alias("n_words"), F.size(F.array_distinct("words")).alias("n_distinct"),
        F.regexp_count("text", F.lit("[A-Z]")).alias("n_upper"), F.length("text").alias("n_chars"))


def failure_masks(batch: DataFrame, conditions: dict[str, str], id_col: str, text_col: str, part_col: str) -> DataFrame:
    """(key, id, part, mask): bit i of ``mask`` is set if the i-th condition,
    SQL over ``text`` and its measures, holds."""
    rows = batch.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    mask = F.lit(0)
    for i, condition in enumerate(conditions.values()):
        mask = mask + F.when(F.expr(condition), F.lit(1 << i)).otherwise(0)
    return text_measures(rows).select(F.unhex(F.sha2("text", 256)).alias("key"), "id", "part", mask.alias("mask"))


def label_table(labels: DataFrame, id_col: str) -> DataFrame:
    """(label_id, good, toxic), one row per id: whether any of its rows says so."""
    return (labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("label_id"))
            .agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
                 F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")))


def state_moves(masks: DataFrame, labels: DataFrame, state: DataFrame) -> DataFrame:
    """What a batch changes, as MOVES: for every text of the batch its new rows
    (``first``: not copies, ``copies``) and, where the smallest id falls, the
    retraction of the old one's (-n, +n).  ``held`` rows are the text's state."""
    counted = masks.groupBy("key", "mask", "part", "id").agg(F.count(F.lit(1)).alias("n"))
    counted = counted.withColumn("salt", F.when(F.col("id").isNull(), F.pmod(F.xxhash64("key"), F.lit(SALT))).otherwise(0))
    counted = counted.join(labels.withColumn("label_salt", F.lit(0).cast("long")),
                           (F.col("id") == F.col("label_id")) & (F.col("salt") == F.col("label_salt")), "left")
    none = F.lit(0).cast("long")
    fresh = counted.groupBy("key", "mask", "part", F.coalesce("good", F.lit(0)).alias("good"),
                            F.coalesce("toxic", F.lit(0)).alias("toxic")).agg(
        F.sum("n").alias("rows"), F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("least"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("nameless"))
    names = ["key", "mask", "part", "good", "toxic"]
    both = (fresh.select(*names, F.lit(True).alias("fresh"), "least.id", F.coalesce("least.n", none).alias("n"), "rows", "nameless")
            .union(state.select(*names, F.lit(False), "id", F.col("held"), none, none)))
    text = Window.partitionBy("key")
    both = both.select("*", F.min(F.when(~F.col("fresh"), F.col("id"))).over(text).alias("old"),
                       F.min("id").over(text).alias("new"), F.max("fresh").over(text).alias("touched"))
    fallen = ~F.col("fresh") & (F.col("id") == F.col("old")) & (F.col("new") < F.col("old"))
    held = F.when(F.col("fresh") & F.col("id").eqNullSafe(F.col("new")), F.col("n")).otherwise(none)
    moved = both.filter(F.col("touched") & (F.col("fresh") | fallen)).withColumn("held", held)
    first = F.when(F.col("fresh"), F.col("nameless") + F.col("held")).otherwise(-F.col("n"))
    return moved.select("key", "part", "mask", "good", "toxic", "id", "held", first.alias("first"),
                        (F.col("rows") - first).alias("copies"))


def counter_changes(moves: DataFrame) -> DataFrame:
    return moves.groupBy("part", "mask", "good", "toxic").agg(F.sum("first").alias("first"), F.sum("copies").alias("copies"))


def _read(spark: SparkSession, schema: str, *paths: str) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def stream_counters(spark: SparkSession, path: str, conditions: dict[str, str], labels: DataFrame, work: str,
                    batch_bytes: int, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """Runs the stream over all files of the Parquet table ``path`` not yet
    processed under ``work`` and returns the counters, as COUNTERS."""
    schema = spark.read.parquet(path).schema
    files = f"{path.rstrip('/')[:-1]}[{path.rstrip('/')[-1]}]"  # a pattern matches a folder and a single file alike
    source = spark.readStream.schema(schema).option("maxBytesPerTrigger", str(batch_bytes)).parquet(files)

    def process(batch: DataFrame, number: int) -> None:
        # the stream's own session plans without adaptive execution: it only maps the texts
        at = f"{work}/masks/batch-{number}"
        failure_masks(batch, conditions, id_col, text_col, part_col).write.mode("overwrite").parquet(at)
        state = _read(spark, MOVES, *[f"{work}/moves/batch-{i}" for i in range(number)]).filter("held > 0")
        moves = f"{work}/moves/batch-{number}"
        state_moves(_read(spark, MASKS, at), labels, state).write.mode("overwrite").parquet(moves)
        counter_changes(_read(spark, MOVES, moves)).write.mode("overwrite").parquet(f"{work}/counters/batch-{number}")

    (source.writeStream.foreachBatch(process).option("checkpointLocation", f"{work}/stream")
     .trigger(availableNow=True).start().awaitTermination())
    try:
        return counter_changes(spark.read.schema(COUNTERS).parquet(f"{work}/counters/batch-*"))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":  # a table without files makes no batch
            raise
        return spark.createDataFrame([], COUNTERS)


def order_report(counters: DataFrame, names: list[str]) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley) for every part and order of ``names``, the
    last of which is the copy filter.  There are at most 2^len(names) masks to a
    part."""
    bit = {name: 1 << i for i, name in enumerate(names)}
    steps = [("".join(order), k + 1, sum(bit[x] for x in order[:k]), bit[order[k]])
             for order in permutations(names) for k in range(len(names))]
    copy = bit[names[-1]]
    rows = counters.select("part", "good", "toxic", F.explode(F.array(
        F.struct("mask", F.col("first").alias("n")),
        F.struct((F.col("mask") + copy).alias("mask"), F.col("copies").alias("n")))).alias("c"))
    masks = rows.groupBy("part", F.col("c.mask").alias("mask")).agg(
        F.sum("c.n").alias("n"), F.sum(F.col("c.n") * F.col("good")).alias("good"), F.sum(F.col("c.n") * F.col("toxic")).alias("toxic"))
    parts = masks.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    table = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(k).alias("step"), F.lit(b).alias("before"), F.lit(x).alias("own"))
                      for o, k, b, x in steps])
    rows = parts.select("part", "masks", F.explode(table).alias("s")).select("part", "masks", "s.*")

    def total(condition: str, value: str = "m.n") -> Column:
        return F.expr(f"aggregate(filter(masks, m -> {condition}), 0L, (a, m) -> a + {value})")

    removed = "(m.mask & before) = 0 AND (m.mask & own) <> 0"
    return rows.select(
        "part", "filter_order", "step", total("(m.mask & (before | own)) = 0").alias("kept"), total(removed).alias("removed"),
        total("(m.mask & before) <> 0 AND (m.mask & own) <> 0").alias("redundant"), total("m.mask = own").alias("unique_fails"),
        total(removed, "m.good").alias("good_lost"), total(removed, "m.toxic").alias("toxic_lost"),
        total("(m.mask & own) <> 0", f"m.n * ({factorial(len(names))} div bit_count(m.mask))").alias("shapley"))


def audit_filters(spark: SparkSession, path: str, conditions: dict[str, str], labels: DataFrame, copy_filter: str,
                  work: str | None = None, bytes_per_core: int = 32 << 20, id_col: str = "doc_id",
                  text_col: str = "text", part_col: str = "lang", label_id: str = "doc_id") -> DataFrame:
    """``order_report`` of the filters ``conditions`` and ``copy_filter`` (fails
    rows whose text also has a smaller id) over the Parquet table ``path``.
    Give a folder as ``work`` to keep the state and process only new files next
    time; without it the state goes to a new scratch folder.

    A null text is empty and a null part the empty string.  A row without an id
    is no copy and makes none; rows with equal ids and texts are not copies of
    each other.  A row whose id has labels counts once, however many label rows
    there are; a null label says nothing.  Texts of any length are read whole.
    An empty table gives an empty report; other columns are not read."""
    labels = label_table(labels, label_id)
    work = work or scratch_path(labels, "filter-audit")
    kept = f"{work}/labels"
    labels.write.mode("overwrite").parquet(kept)
    cores = int(spark.sparkContext.defaultParallelism)
    counters = stream_counters(spark, path, conditions, _read(spark, "label_id long, good int, toxic int", kept), work,
                               bytes_per_core * cores, id_col, text_col, part_col)
    return order_report(counters, [*conditions, copy_filter])
