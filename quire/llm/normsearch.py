"""Exact top-k inner products with norm buckets and local cosine thresholds.

Vectors are grouped by length into buckets a constant factor wide, and buckets
are cut into blocks.  A first pass scores the queries against a bounded set of
the longest vectors; the k-th score found is a lower bound of the final k-th
score.  A candidate v can only beat it when |q| |v| cos(q, v) does, so

* a block whose longest vector is too short for every query of a query block is
  never sent to it;
* inside a block, the bound over |q| times the block's longest vector is the
  local cosine threshold.  Below ``coordinate_from`` the query prunes by length
  (the block is sorted, so its candidates are a prefix); from there on by
  coordinates: a vector with that cosine must lie close to the query in each of
  the query's largest coordinates;
* what is left is verified by its exact integer product.

Queries are a stated set and meet the blocks block by block.  All bounds are
widened by a relative 1e-9, so rounding never drops a candidate.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import written

WIDER = 1 + 1e-9
EXACT = 2.0**53
SALT = 16


def scaled(vec, scale: float) -> np.ndarray | None:
    """floor(scale * x) of a vector, or None when it takes no part."""
    if vec is None or any(x is None for x in vec):
        return None
    v = np.floor(scale * np.asarray(vec, np.float64))
    return v if np.isfinite(v).all() else None


def integer_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """(vec_id, dim, norm, v, row) with the vector as float64 bytes; exact,
    since the floors are whole doubles.  ``row`` keeps equal rows apart."""
    def run(batches):
        for b in batches:
            ids, col = b.column(0), b.column(1)
            keep, raw, dims, norms = [], [], [], []
            for i, vec in enumerate(col.to_pylist()):
                v = scaled(vec, scale)
                if v is not None and ids[i].is_valid:
                    keep.append(i)
                    raw.append(v.tobytes())
                    dims.append(len(v))
                    top = np.abs(v).max(initial=0.0)
                    norms.append(float(top * math.sqrt(((v / top) ** 2).sum())) if top else 0.0)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(keep, pa.int64())).cast(pa.int64()), pa.array(dims, pa.int32()),
                 pa.array(norms, pa.float64()), pa.array(raw, pa.binary())], ["vec_id", "dim", "norm", "v"])

    return vectors.select(F.col(id_col).cast("long"), vec_col).mapInArrow(
        run, "vec_id long, dim int, norm double, v binary").withColumn("row", F.monotonically_increasing_id())


def matrix(raw: list[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), dim)


def products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact products of one query with rows, as Python ints only where doubles
    could round; clipped to the range of a long."""
    bound = np.abs(q).max(initial=0.0) * np.abs(v).max(initial=0.0) * max(1, len(q))
    if bound < EXACT:
        return (v @ q).astype(np.int64)
    qi = [int(x) for x in q]
    exact = [sum(a * int(b) for a, b in zip(qi, row)) for row in v]
    return np.array([min(max(s, -2**63), 2**63 - 1) for s in exact], np.int64)


def best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the k best by score, then id."""
    if len(scores) > k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        some = np.flatnonzero(scores >= cut)
    else:
        some = np.arange(len(scores))
    return some[np.lexsort((ids[some], -scores[some].astype(object) if (scores[some] == -2**63).any()
                            else -scores[some]))][:k]


class Block:
    """Vectors of one bucket sorted by falling length, ready for pruning."""

    def __init__(self, ids: np.ndarray, v: np.ndarray, norms: np.ndarray):
        order = np.argsort(-norms, kind="stable")
        self.ids, self.v, self.norms = ids[order], v[order], norms[order]
        self.unit = self.v / np.where(self.norms > 0, self.norms, 1)[:, None]

    def candidates(self, q: np.ndarray, q_norm: float, floor: float, coordinate_from: float, focus: int) -> np.ndarray:
        """Indexes that may reach a product of ``floor``."""
        longest = self.norms[0] if len(self.norms) else 0.0
        if floor <= 0 or not math.isfinite(floor):
            return np.arange(len(self.ids))
        if q_norm * longest * WIDER < floor:
            return np.empty(0, np.int64)
        prefix = int(np.searchsorted(-self.norms, -floor / (q_norm * WIDER), side="right"))
        cosine = floor / (q_norm * longest * WIDER)
        if cosine < coordinate_from:
            return np.arange(prefix)
        unit = q / q_norm
        keep = np.ones(prefix, bool)
        for f in np.argsort(-np.abs(unit))[:focus]:
            # coordinate f over the cap of vectors with that cosine or more
            mid = unit[f] * cosine
            slack = math.sqrt(max(0.0, 1 - cosine * cosine) * max(0.0, 1 - unit[f] ** 2)) + 1e-9
            low = -2.0 if unit[f] <= -cosine else mid - slack
            high = 2.0 if unit[f] >= cosine else mid + slack
            keep &= (self.unit[:prefix, f] >= low) & (self.unit[:prefix, f] <= high)
        return np.flatnonzero(keep)

    def search(self, q_ids, qs: np.ndarray, q_norms, floors, k: int, coordinate_from: float = 0.7, focus: int = 4,
               together: int = 64) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, scores) of the best k of each query, its own id left out.
        Queries that keep much of the block share one matrix product."""
        found: list = [None] * len(q_ids)
        wide: list[tuple[int, np.ndarray]] = []
        top = np.abs(self.v).max(initial=0.0) * max(1, self.v.shape[1])
        for i, (q_id, q, n, floor) in enumerate(zip(q_ids, qs, q_norms, floors)):
            c = self.candidates(q, n, floor, coordinate_from, focus)
            if 4 * len(c) > len(self.ids) and np.abs(q).max(initial=0.0) * top < EXACT:
                wide.append((i, c))
                continue
            c = c[self.ids[c] != q_id]
            score = products(q, self.v[c])
            b = best(self.ids[c], score, k)
            found[i] = (self.ids[c][b], score[b])
        for s in range(0, len(wide), together):
            part = wide[s:s + together]
            scores = (qs[[i for i, _ in part]] @ self.v.T).astype(np.int64)
            for (i, c), row in zip(part, scores):
                c = c[self.ids[c] != q_ids[i]]
                b = best(self.ids[c], row[c], k)
                found[i] = (self.ids[c][b], row[c][b])
        return found


def top_k_products(vectors: DataFrame, k: int = 20, every: int = 20, scale: float = 64.0, id_col: str = "vec_id",
                   vec_col: str = "embedding", ratio: float = 1.1, block: int = 8192, query_block: int = 512,
                   seeds: int = 2048) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each query by
    the inner product of the scaled floors, ties to the smaller id.

    Queries are the rows whose id is divisible by ``every``; candidates are all
    rows but those with the query's id.  Vectors that are null, hold null or a
    non-finite component (also after scaling), or have a null id take no part.
    Every row is a candidate, repeated ones too; rows equal in id and vector ask
    once, rows that repeat an id with another vector are queries of their own,
    and no row answers a query with its id.  Only vectors of one length
    are compared.  Fewer candidates than k give all of them; an empty table
    gives an empty table."""
    bucket = F.when(F.col("norm") > 0, F.floor(F.log("norm") / F.lit(math.log(ratio)))).otherwise(-10_000).cast("int")
    data = written(integer_vectors(vectors, id_col, vec_col, scale).withColumn("bucket", bucket), "vectors")
    queries = data.filter(F.pmod("vec_id", F.lit(every)) == 0).select("vec_id", "dim", "norm", "v").distinct()

    # seeds: the longest vectors of each dimension, at most ``seeds`` rows each;
    # first those of each of a few parts, so that no task sorts all vectors
    order = [F.col("norm").desc(), F.col("vec_id"), F.col("v"), F.col("row")]
    longest = data.select("dim", "norm", "vec_id", "v", "row", F.pmod(F.xxhash64("row"), F.lit(4 * SALT)).alias("share"))
    for keys in (["dim", "share"], ["dim"]):
        longest = (longest.withColumn("r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
                   .filter(F.col("r") <= seeds))
    seed = (longest.groupBy("dim")
            .agg(F.collect_list("vec_id").alias("ids"), F.collect_list("v").alias("vs"), F.collect_list("norm").alias("norms"))
            .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))))  # at most ``seeds`` vectors a copy
    # one row per dimension, or per dimension and bucket (the doubles' range has
    # about 15,000 buckets at ratio 1.1): bounded broadcasts, so that rows meet
    # their counts without being dealt by a few hot keys
    counts = written(queries.groupBy("dim").agg(F.count(F.lit(1)).alias("nq")), "counts")
    grouped = (queries.join(F.broadcast(counts), "dim")
               .withColumn("qb", F.expr(f"pmod(xxhash64(vec_id, v), CAST(ceil(nq / {query_block}) AS BIGINT))"))
               .groupBy("dim", "qb").agg(F.collect_list("vec_id").alias("q_ids"), F.collect_list("v").alias("q_vs"),
                                         F.collect_list("norm").alias("q_norms")))

    def floors(batches):
        for b in batches:
            for r in b.to_pylist():
                dim = r["dim"]
                blk = Block(np.array(r["ids"], np.int64), matrix(r["vs"], dim), np.array(r["norms"]))
                qs = matrix(r["q_vs"], dim)
                found = blk.search(r["q_ids"], qs, r["q_norms"], [-math.inf] * len(qs), k)
                out = [float(s[-1]) if len(s) == k and abs(s[-1]) < EXACT else -math.inf for _, s in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dim] * len(qs), pa.int32()), pa.array(r["q_ids"], pa.int64()),
                     pa.array(r["q_norms"], pa.float64()), pa.array(r["q_vs"], pa.binary()),
                     pa.array(out, pa.float64())], ["dim", "q_id", "q_norm", "q_v", "floor"])

    bounded = written(grouped.withColumn("salt", F.expr(f"CAST(pmod(qb, {SALT}) AS INT)")).join(seed, ["dim", "salt"]).mapInArrow(
        floors, "dim int, q_id long, q_norm double, q_v binary, floor double"), "floors")
    # the shortest bucket a query still needs; queries with like needs share a block
    need = F.when((F.col("floor") > 0) & (F.col("q_norm") > 0),
                  F.floor(F.log(F.col("floor") / F.col("q_norm")) / F.lit(math.log(ratio))) - 1).otherwise(-10_000).cast("int")
    bounded = bounded.withColumn("need", need)
    needs = written(bounded.groupBy("dim", "need").agg(F.count(F.lit(1)).alias("nq")), "needs")
    q_blocks = (bounded.join(F.broadcast(needs), ["dim", "need"])
                .withColumn("qb", F.expr(f"pmod(xxhash64(q_id, q_v), CAST(ceil(nq / {query_block}) AS BIGINT))"))
                .groupBy("dim", "need", "qb").agg(
                    F.collect_list("q_id").alias("q_ids"), F.collect_list("q_v").alias("q_vs"),
                    F.collect_list(F.xxhash64("q_v")).alias("q_keys"),
                    F.collect_list("q_norm").alias("q_norms"), F.collect_list("floor").alias("floors")))
    sizes = written(data.groupBy("dim", "bucket").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "parts", F.ceil(F.col("n") / F.lit(float(block))).cast("int")), "sizes")
    v_blocks = (data.join(F.broadcast(sizes), ["dim", "bucket"])
                .withColumn("part", F.expr("CAST(pmod(xxhash64(row), parts) AS INT)"))
                .groupBy("dim", "bucket", "part").agg(
                    F.collect_list("vec_id").alias("ids"), F.collect_list("v").alias("vs"),
                    F.collect_list("norm").alias("norms")))
    # which block pairs are left: bounded by blocks, not rows
    wanted = (q_blocks.select("dim", "need", "qb").join(sizes, "dim").filter("bucket >= need")
              .select("dim", "need", "qb", "bucket", F.explode(F.expr("sequence(0, parts - 1)")).alias("part")))
    units = wanted.join(q_blocks, ["dim", "need", "qb"]).join(v_blocks, ["dim", "bucket", "part"])

    def verify(batches):
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                blk = Block(np.array(r["ids"], np.int64), matrix(r["vs"], r["dim"]), np.array(r["norms"]))
                qs = matrix(r["q_vs"], r["dim"])
                found = blk.search(r["q_ids"], qs, r["q_norms"], r["floors"], k)
                sizes_ = [len(f[0]) for f in found]
                rep = np.repeat(np.arange(len(found)), sizes_)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(r["q_ids"], np.int64)[rep]),
                     pa.array(np.array(r["q_keys"], np.int64)[rep]),
                     pa.array(np.concatenate([f[0] for f in found])), pa.array(np.concatenate([f[1] for f in found]))],
                    ["query_id", "q_key", "vec_id", "score"])

    hits = units.mapInArrow(verify, "query_id long, q_key long, vec_id long, score long")
    order = Window.partitionBy("query_id", "q_key").orderBy(F.col("score").desc(), "vec_id")
    return (hits.select("query_id", "q_key", "vec_id", "score").withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
