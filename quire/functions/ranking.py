"""Distributed global ranking.

``row_number() over (order by ...)`` without ``partition by`` moves every row
into one task.  ``global_row_number`` gives the same numbers with a range
shuffle: rows are range-partitioned and sorted on the order keys, each
partition numbers its rows locally (``monotonically_increasing_id`` is
sequential inside a partition) and adds the row count of all earlier
partitions.  The only small table is one row per partition.

The range-sorted rows are written once with ``checkpoint()`` (to the shared
``spark.checkpoint.dir``).  Range bounds come from sampling the input, and the
row order of a shuffled input is not deterministic, so two separate range
exchanges (one for the counts, one for the rows) could cut the data at
different places; after the checkpoint both read the same partitions, and a
lost executor re-reads files instead of re-sampling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F



def global_row_number(df: DataFrame, order: list[Column], name: str = "rank",
                      partitions: int | None = None) -> DataFrame:
    """Append a 1-based ``name`` (long) equal to ``row_number() over (order
    by *order)``.  ``order`` must be a total order (end with a unique key) so
    the numbering is deterministic under task retries."""
    # without an explicit count AQE may coalesce the range partitions to the
    # data size; coalesced partitions are contiguous ranges, so order holds
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    ranged = ranged.sortWithinPartitions(*order).checkpoint(eager=True)
    tagged = ranged.withColumn("_pid", F.spark_partition_id()).withColumn(
        "_mid", F.monotonically_increasing_id()
    )
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # at most ``n`` rows: bounded by the partition count, safe to broadcast
    offsets = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_off"),
    ).fillna(0, subset=["_off"])
    out = tagged.join(F.broadcast(offsets), "_pid").withColumn(
        name,
        (F.col("_off") + (F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)) + 1).cast("long"),
    )
    return out.drop("_pid", "_mid", "_off")


def rank_of(df: DataFrame, key_col: str, key_value, order: list[tuple[str, bool]], name: str = "rank") -> DataFrame:
    """Rank of one row in a total order without sorting the table:
    1 + number of rows that sort before it (a single global aggregate)."""
    target = df.filter(F.col(key_col) == F.lit(key_value))
    before = None
    eq = F.lit(True)
    for col, asc in order:
        a, b = F.col(f"o.{col}"), F.col(f"t.{col}")
        cmp = (a < b) if asc else (a > b)
        term = eq & cmp
        before = term if before is None else (before | term)
        eq = eq & (a == b)
    t = target.alias("t")
    o = df.alias("o")
    # the target side is one row: broadcast it, no shuffle of ``df``
    cnt = o.join(F.broadcast(t), before, "inner").agg(F.count(F.lit(1)).alias("_before"))
    return target.crossJoin(cnt).withColumn(name, (F.col("_before") + 1).cast("long")).drop("_before")


def smallest_per_group(df: DataFrame, group_col: str, id_col: str, k: int, salts: int = 64) -> DataFrame:
    """The k smallest ``id_col`` values of every group, with their rank.  Two
    bounded steps -- per (group, salt), then per group over at most
    ``salts * k`` survivors -- so a group holding a third of all rows is
    never sorted in one task."""
    s1 = df.withColumn("_salt", F.pmod(F.xxhash64(id_col), F.lit(salts)))
    s1 = s1.withColumn("_r1", F.row_number().over(Window.partitionBy(group_col, "_salt").orderBy(id_col)))
    s2 = s1.filter(F.col("_r1") <= k)
    s2 = s2.withColumn("rank", F.row_number().over(Window.partitionBy(group_col).orderBy(id_col)).cast("long"))
    return s2.filter(F.col("rank") <= k).drop("_salt", "_r1")
