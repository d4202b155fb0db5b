"""Exact k-nearest neighbours without a cross product, and the
oversamplers built on it (L13 SMOTE, L14 ADASYN).

Exact kNN with a random-projection tree:

1. A bounded sample (at most ``sample_size`` vectors) builds the tree on the
   driver: random unit direction, split at the median projection, until a
   node's share of the data is about ``leaf_size`` points.  The tree is the
   model (nodes x dim), broadcast to tasks.
2. Identical vectors are collapsed first (no hyperplane separates copies, so
   a vector repeated across a third of the rows would fill one leaf); each
   distinct vector keeps only its k+1 smallest ids, found in two bounded
   steps.  Distinct vectors are routed to their leaves.
3. Within each leaf (bounded size) distances are computed with numpy in
   a cogroup: the k best candidates and their k-th distance r.
4. Certification: a neighbour outside the leaf lies beyond at least one
   splitting hyperplane on the path, so it is at least the margin |u.q - t|
   away.  A query whose r exceeds a margin is sent to every leaf the ball of
   radius r reaches (tree descent), joined with those leaves' points by groups
   of neighbouring leaves and slices of queries, and the candidates are
   re-ranked.  The result equals brute force.

A task holds one group's points, one slice of queries and a matrix of ``STEP``
queries x points, however many queries reach a leaf.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import as_double


GROUP_LEAVES = 32  # neighbouring leaves that a second search reads together
SLICE = 4096       # queries in a task's group, about
STEP = 256         # queries compared at once
PIECE = 1 << 15    # pairs whose exact distance is computed at once


def _build_tree(sample: np.ndarray, leaf_sample: int, seed: int, max_depth: int = 40):
    rng = np.random.default_rng(seed)
    dirs, thr, left, right, leaf = [], [], [], [], []

    def node(idx, depth):
        me = len(dirs)
        dirs.append(None)
        thr.append(0.0)
        left.append(-1)
        right.append(-1)
        leaf.append(-1)
        pts = sample[idx]
        if len(idx) <= leaf_sample or depth >= max_depth:
            leaf[me] = me
            return me
        u = rng.normal(size=sample.shape[1])
        u /= np.linalg.norm(u) or 1.0
        proj = pts @ u
        t = float(np.median(proj))
        lo, hi = idx[proj <= t], idx[proj > t]
        if len(lo) == 0 or len(hi) == 0:
            leaf[me] = me
            return me
        dirs[me], thr[me] = u, t
        left[me] = node(lo, depth + 1)
        right[me] = node(hi, depth + 1)
        return me

    node(np.arange(len(sample)), 0)
    dim = sample.shape[1]
    D = np.array([d if d is not None else np.zeros(dim) for d in dirs])
    return D, np.array(thr), np.array(left), np.array(right), np.array(leaf)


def _route(X, tree):
    D, T, L, R, LF = tree
    node = np.zeros(len(X), dtype=np.int64)
    while True:
        inner = LF[node] < 0
        if not inner.any():
            return node
        i = np.flatnonzero(inner)
        go_left = np.einsum("nd,nd->n", X[i], D[node[i]]) <= T[node[i]]
        node[i] = np.where(go_left, L[node[i]], R[node[i]])


def _ball_leaves(X, r, tree):
    """Per query, which leaves (in tree order) its ball of radius ``r`` reaches:
    one step down the tree for all queries of a batch at once."""
    D, T, L, R, LF = tree
    number = np.cumsum(LF >= 0) - 1
    reach = {0: np.arange(len(X))}  # node -> queries whose ball touches it
    hit = np.zeros((len(X), int(number[-1]) + 1), dtype=bool)
    for n in range(len(T)):  # parents come before their children
        at = reach.pop(n)
        if LF[n] >= 0:
            hit[at, number[n]] = True
            continue
        p = np.einsum("nd,d->n", X[at], D[n]) - T[n]
        reach[L[n]] = at[(p <= 0) | (p - r[at] <= 0)]  # ball touches the left side (proj <= t)
        reach[R[n]] = at[(p > 0) | (-p < r[at])]  # ball touches the right side
    return hit


def _nearest(Q, qh, P, ph, k):
    """``(query index, point index, distance)`` of each query's ``k`` nearest
    points, ties by id, itself left out.  ``STEP`` queries at a time: a matrix
    product finds who may be among the k (with room for its rounding), exact
    differences decide.  Memory is bounded by ``STEP`` x points."""
    order, out = np.argsort(ph, kind="stable"), []
    P, ids = P[order], ph[order]
    pp = np.einsum("nd,nd->n", P, P)
    top = np.nanmax(np.where(np.isfinite(pp), pp, 0.0), initial=0.0)
    for lo in range(0, len(Q), STEP):
        q, h = Q[lo:lo + STEP], qh[lo:lo + STEP]
        qq = np.einsum("nd,nd->n", q, q)
        with np.errstate(invalid="ignore", over="ignore"):
            near = qq[:, None] + pp[None, :] - 2.0 * (q @ P.T)
        near[np.isnan(near)] = np.inf
        own = np.minimum(np.searchsorted(ids, h), len(ids) - 1)
        mine = np.flatnonzero(ids[own] == h)
        near[mine, own[mine]] = np.nan  # a vector is not its own neighbour
        kth = np.partition(near, min(k, near.shape[1]) - 1, axis=1)[:, min(k, near.shape[1]) - 1]
        room = 1e-9 * (np.where(np.isfinite(qq), qq, 0.0) + top) + 1e-300
        i, j = np.nonzero(near <= np.where(np.isnan(kth), np.inf, kth + room)[:, None])
        with np.errstate(invalid="ignore", over="ignore"):
            d = np.concatenate([np.sqrt(((q[i[s:s + PIECE]] - P[j[s:s + PIECE]]) ** 2).sum(-1))
                                for s in range(0, len(i), PIECE)] or [np.zeros(0)])
        best = np.lexsort((ids[j], d, i))
        i, j, d = i[best], j[best], d[best]
        keep = np.arange(len(i)) - np.searchsorted(i, i) < k
        out.append((i[keep] + lo, order[j[keep]], d[keep]))
    return [np.concatenate(x) for x in zip(*out)]


def _top_ids(pts: DataFrame, k: int, salts: int = 64) -> DataFrame:
    """Per distinct vector ``h``: the k+1 smallest point ids and the copy
    count, in two bounded steps (per (vector, salt), then per vector), so a
    vector repeated across a third of the rows never sits in one group."""
    w1 = Window.partitionBy("h", "_salt").orderBy("pid")
    s1 = pts.withColumn("_salt", F.pmod(F.xxhash64("pid"), F.lit(salts))).withColumn("_r", F.row_number().over(w1))
    cnt = s1.groupBy("h").agg(F.count(F.lit(1)).alias("copies"))
    s2 = s1.filter(F.col("_r") <= k + 1).withColumn("_r2", F.row_number().over(Window.partitionBy("h").orderBy("pid")))
    top = s2.filter(F.col("_r2") <= k + 1).groupBy("h").agg(F.array_sort(F.collect_list("pid")).alias("ids"))
    return top.join(cnt, "h")


def _knn_distinct(queries: DataFrame, points: DataFrame, k: int, tree, spark) -> DataFrame:
    """k nearest distinct vectors ``(qh, rank, nh, dist)``; a vector is not its
    own neighbour.  Inputs: ``(h, v)`` with unique h."""
    tb = spark.sparkContext.broadcast(tree)

    @F.pandas_udf("long")
    def route(v: pd.Series) -> pd.Series:
        X = np.vstack(v.to_numpy()) if len(v) else np.zeros((0, tree[0].shape[1]))
        return pd.Series(_route(X, tb.value))

    pts = points.select("h", "v").withColumn("leaf", route("v"))
    q = queries.select(F.col("h").alias("qh"), F.col("v").alias("qv")).withColumn("leaf", route("qv"))
    schema = "qh long, nh long, dist double"

    def local(key, qdf: pd.DataFrame, pdf: pd.DataFrame) -> pd.DataFrame:
        if qdf.empty or pdf.empty:
            return pd.DataFrame({"qh": [], "nh": [], "dist": []})
        qh, ph = qdf["qh"].to_numpy(np.int64), pdf["h"].to_numpy(np.int64)
        i, j, d = _nearest(np.vstack(qdf["qv"].to_numpy()), qh, np.vstack(pdf["v"].to_numpy()), ph, k)
        return pd.DataFrame({"qh": qh[i], "nh": ph[j], "dist": d})

    w = Window.partitionBy("qh").orderBy("dist", "nh")
    # leaf-local candidates: leaves are bounded by construction
    first = q.groupBy("leaf").cogroup(pts.groupBy("leaf")).applyInPandas(local, schema)
    first = first.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    radius = first.groupBy("qh").agg(F.max("dist").alias("r"), F.count(F.lit(1)).alias("n"))
    qr = q.join(radius, "qh", "left").withColumn(
        "r", F.when(F.col("n") >= k, F.col("r") * (1 + 1e-9) + 1e-12).otherwise(F.lit(float("inf"))))

    @F.pandas_udf("array<long>")
    def reach(v: pd.Series, r: pd.Series, own: pd.Series) -> pd.Series:
        if not len(v):
            return pd.Series([], dtype=object)
        hit = _ball_leaves(np.vstack(v.to_numpy()), r.to_numpy(float), tb.value)
        number = np.cumsum(tb.value[4] >= 0) - 1
        more = hit.sum(axis=1) > hit[np.arange(len(v)), number[own.to_numpy(np.int64)]]
        hit = np.logical_or.reduceat(hit, np.arange(0, hit.shape[1], GROUP_LEAVES), axis=1) & more[:, None]
        return pd.Series([np.flatnonzero(row) for row in hit], dtype=object)

    @F.pandas_udf("long")
    def group(leaf: pd.Series) -> pd.Series:
        return pd.Series((np.cumsum(tb.value[4] >= 0) - 1)[leaf.to_numpy(np.int64)] // GROUP_LEAVES)

    # certification: queries whose k-th distance crosses a splitting hyperplane
    # go once to every group of leaves that their ball reaches, in slices
    slices = max(1, -(-queries.count() // SLICE))
    extra = qr.withColumn("g", F.explode(reach("qv", "r", "leaf"))).select(
        "qh", "qv", "g", F.pmod(F.xxhash64("qh"), F.lit(slices)).alias("s"))
    dealt = pts.select("h", "v", group("leaf").alias("g"),
                       F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slices - 1).cast("long"))).alias("s"))
    second = extra.groupBy("g", "s").cogroup(dealt.groupBy("g", "s")).applyInPandas(local, schema)
    allc = first.select("qh", "nh", "dist").unionByName(second).dropDuplicates(["qh", "nh"])
    return allc.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def knn(queries: DataFrame, points: DataFrame, k: int, *, id_col: str = "vec_id", col: str = "embedding",
        leaf_size: int = 256, sample_size: int = 20000, seed: int = 42) -> DataFrame:
    """Exact k nearest ``points`` of every query row (queries are points
    too, matched by id; a point is never its own neighbour).  Euclidean
    distance, ties by id.  Returns ``(id, rank, nid, dist)``, rank 1..k."""
    spark = points.sparkSession
    pts = points.select(F.col(id_col).alias("pid"), as_double(col).alias("v")).withColumn("h", F.xxhash64("v"))
    distinct = pts.groupBy("h").agg(F.first("v").alias("v"))
    n_total = distinct.count()
    frac = min(1.0, sample_size / max(n_total, 1))
    sample = np.array([r.v for r in distinct.sample(fraction=frac, seed=seed).limit(sample_size).collect()])
    tree = _build_tree(sample if len(sample) else np.zeros((1, 1)), max(2, int(leaf_size * frac)), seed)
    qids = queries.select(F.col(id_col).alias("pid"))
    qpts = pts.join(qids, "pid", "left_semi")
    qdistinct = qpts.groupBy("h").agg(F.first("v").alias("v"))
    near = _knn_distinct(qdistinct, distinct, k, tree, spark)
    top = _top_ids(pts, k)
    # candidate ids per query vector: other copies (distance 0) and the
    # smallest ids of each neighbouring vector; at most (k+1)(k+1) entries
    nb = near.join(top.select(F.col("h").alias("nh"), "ids"), "nh").select(
        "qh", F.transform("ids", lambda i: F.struct(F.col("dist").alias("d"), i.alias("id"))).alias("c"))
    nb = nb.groupBy("qh").agg(F.flatten(F.collect_list("c")).alias("c"))
    own = top.select(F.col("h").alias("qh"), F.transform("ids", lambda i: F.struct(F.lit(0.0).alias("d"), i.alias("id"))).alias("o"))
    cand = own.join(nb, "qh", "left").select("qh", F.concat("o", F.coalesce("c", F.array().cast(
        "array<struct<d:double,id:bigint>>"))).alias("c"))
    per_q = qpts.select("pid", F.col("h").alias("qh")).join(cand, "qh")
    best = per_q.select("pid", F.slice(F.array_sort(F.filter("c", lambda s: s["id"] != F.col("pid"))), 1, k).alias("c"))
    out = best.select("pid", F.posexplode("c").alias("rank", "s"))
    return out.select(F.col("pid").alias(id_col), (F.col("rank") + 1).cast("long").alias("rank"),
                      F.col("s.id").alias("nid"), F.col("s.d").alias("dist"))


def _u(a, b) -> F.Column:
    """Reproducible uniform [0, 1) from two integers (same on every engine)."""
    return F.pmod(a * 7919 + b * 104729, F.lit(1_000_003)).cast("double") / 1_000_003.0


def _interpolate(base: DataFrame, neighbours: DataFrame, id_col: str, col: str) -> DataFrame:
    nv = neighbours.select(F.col(id_col).alias("nid"), as_double(col).alias("nv"))
    j = base.join(nv, "nid")
    u = _u(F.col(id_col), F.col("j"))
    vec = F.zip_with(as_double(col), F.col("nv"), lambda x, y: x + u * (y - x))
    return j.select(F.col(id_col).alias("base_id"), F.col("j").cast("long").alias("j"), vec.alias(col))


def smote(df: DataFrame, *, label_col: str = "y", minority=1, k: int = 5, id_col: str = "vec_id",
          col: str = "embedding", **knn_kw) -> DataFrame:
    """L13 (Chawla et al. 2002): G = majority - minority synthetic rows,
    dealt round-robin over minority rows by id and over each row's k
    minority neighbours by rank; x + u (x_nn - x) with a hash-derived u.
    Returns the synthetic rows ``(base_id, j, vector)``."""
    from ..functions.ranking import global_row_number

    mino = df.filter(F.col(label_col) == minority).select(id_col, col)
    counts = df.agg(F.sum((F.col(label_col) == minority).cast("long")).alias("n_min"),
                    F.sum((F.col(label_col) != minority).cast("long")).alias("n_maj"))
    nn = knn(mino, mino, k, id_col=id_col, col=col, **knn_kw)
    ranked = global_row_number(mino.select(id_col), [F.col(id_col).asc()], name="r")
    per = ranked.crossJoin(F.broadcast(counts)).withColumn("G", F.greatest(F.col("n_maj") - F.col("n_min"), F.lit(0)))
    per = per.withColumn("cnt", F.floor(F.col("G") / F.col("n_min")) + (F.col("r") - 1 < F.pmod(F.col("G"), F.col("n_min"))).cast("long"))
    jobs = per.filter(F.col("cnt") > 0).select(id_col, F.explode(F.sequence(F.lit(0), F.col("cnt") - 1)).alias("j"))
    nk = nn.groupBy(id_col).agg(F.count(F.lit(1)).alias("kk"))
    jobs = jobs.join(nk, id_col).withColumn("rank", F.pmod(F.col("j"), F.col("kk")) + 1)
    base = jobs.join(nn.select(id_col, "rank", "nid"), [id_col, "rank"]).join(mino, id_col)
    return _interpolate(base, mino, id_col, col)


def adasyn(df: DataFrame, *, label_col: str = "y", minority=1, k: int = 5, id_col: str = "vec_id",
           col: str = "embedding", **knn_kw) -> DataFrame:
    """L14 (He et al. 2008): r_i = share of majority rows among the k nearest
    of *all* rows; g_i = round(r_i / sum r * G); each minority row then gets
    g_i interpolations towards its minority neighbours (round-robin by rank).
    sum r = 0 gives no synthetic rows."""
    mino = df.filter(F.col(label_col) == minority).select(id_col, col)
    allp = df.select(id_col, col)
    lab = df.select(F.col(id_col).alias("nid"), (F.col(label_col) != minority).cast("double").alias("maj"))
    nn_all = knn(mino, allp, k, id_col=id_col, col=col, **knn_kw)
    ratio = nn_all.join(lab, "nid").groupBy(id_col).agg(F.avg("maj").alias("ri"))
    counts = df.agg(F.sum((F.col(label_col) == minority).cast("long")).alias("n_min"),
                    F.sum((F.col(label_col) != minority).cast("long")).alias("n_maj"))
    tot = ratio.agg(F.sum("ri").alias("sr"))
    g = ratio.crossJoin(F.broadcast(counts)).crossJoin(F.broadcast(tot)).withColumn(
        "cnt", F.when(F.col("sr") > 0, F.round(F.col("ri") / F.col("sr") * F.greatest(F.col("n_maj") - F.col("n_min"), F.lit(0)))).otherwise(0)
        .cast("long"))
    jobs = g.filter(F.col("cnt") > 0).select(id_col, F.explode(F.sequence(F.lit(0), F.col("cnt") - 1)).alias("j"))
    nn = knn(mino, mino, k, id_col=id_col, col=col, **knn_kw)
    nk = nn.groupBy(id_col).agg(F.count(F.lit(1)).alias("kk"))
    jobs = jobs.join(nk, id_col).withColumn("rank", F.pmod(F.col("j"), F.col("kk")) + 1)
    base = jobs.join(nn.select(id_col, "rank", "nid"), [id_col, "rank"]).join(mino, id_col)
    return _interpolate(base, mino, id_col, col)
