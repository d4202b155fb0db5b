"""Topic models and their reports.

Reports work on two long tables, whatever model produced them:
``topics (topic, term, weight)`` (K x V, the model) and ``doc_topics
(doc_id, topic, weight)`` (documents x K).  Models: MLlib LDA (online
variational and EM), truncated SVD via ``RowMatrix.computeSVD`` and
multiplicative-update NMF with distributed factors.
"""

from __future__ import annotations

from itertools import islice

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..functions.text import stable_round

GRAM_ROWS = 256  # dense rows held at once by a task
NMF_ROWS = 1024  # documents updated at once by a task
INCIDENCE_ROWS = 1024  # documents whose top words are counted at once
CV_ROWS = 4096  # windows whose top words are counted at once
CV_TOKENS = 1 << 18  # tokens of the documents looked at together, unless one has more


# --------------------------------------------------------------- reports


def term_shares(bow: DataFrame, groups: DataFrame, *, id_col: str = "doc_id", group_col: str = "topic") -> DataFrame:
    """A deterministic topic table: topic = a document group, weight = the
    term's share of the group's tokens."""
    # a document's words stream past its groups: nothing is sorted by document
    g = bow.join(groups.select(id_col, F.col(group_col).alias("topic")).hint("shuffle_hash"), id_col)
    tot = g.groupBy("topic", "term").agg(F.sum("tf").alias("_tf"))
    # one row per topic: totals by an aggregate, so no topic's vocabulary meets in one task
    sums = tot.groupBy("topic").agg(F.sum("_tf").alias("_all"))
    return tot.join(F.broadcast(sums), "topic").withColumn("weight", F.col("_tf") / F.col("_all")).drop("_tf", "_all")


def doc_topic_mix(bow: DataFrame, topics: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """Document-topic weights from a topic table: ``sum_t p_d(t) * phi_k(t)``
    normalised over topics (documents without overlap get no rows)."""
    lens = bow.groupBy(id_col).agg(F.sum("tf").alias("_len"))
    j = bow.join(lens, id_col).join(topics, "term")
    raw = j.groupBy(id_col, "topic").agg(F.sum(F.col("tf") / F.col("_len") * F.col("weight")).alias("_w"))
    return raw.withColumn("weight", F.col("_w") / F.sum("_w").over(Window.partitionBy(id_col))).drop("_w")


def top_words(topics: DataFrame, n: int = 20, *, by_abs: bool = False) -> DataFrame:
    """M6/M7: the n heaviest terms per topic (``rank`` from 1; ties by term)."""
    key = F.abs("weight") if by_abs else F.col("weight")
    w = Window.partitionBy("topic").orderBy(key.desc(), F.col("term").asc())
    return topics.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= n)


def topic_words_wide(top: DataFrame, topic_ids: list) -> DataFrame:
    """M6: one row per rank, one column ``Topic # 01``... per topic."""
    cols = {t: f"Topic # {i + 1:02d}" for i, t in enumerate(topic_ids)}
    p = top.groupBy("rank").pivot("topic", topic_ids).agg(F.first("term"))
    return p.select("rank", *[F.col(f"`{t}`").alias(cols[t]) for t in topic_ids])


def topic_keywords(top: DataFrame, sep: str = ", ") -> DataFrame:
    g = top.groupBy("topic").agg(F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("_k"))
    return g.select("topic", F.array_join(F.transform("_k", lambda s: s["term"]), sep).alias("keywords"))


def _listed(top: DataFrame, *cols: str):
    """The rows of the top-word table (topics x n of them, read once), its
    distinct words in order, and its topics numbered: ``(rows by topic number,
    words, table (t, topic))``.  Topics and words that are null take no part."""
    rows = [r for r in top.select("topic", "term", *cols).collect() if r[0] is not None and r[1] is not None]
    words = sorted({r[1] for r in rows})
    at, number, ids = {w: i for i, w in enumerate(words)}, {}, []
    by = []
    for r in rows:
        if r[0] not in number:
            number[r[0]] = len(ids)
            ids.append((len(ids), r[0]))
            by.append([])
        by[number[r[0]]].append((at[r[1]], *r[2:]))
    schema = StructType([StructField("t", IntegerType()), StructField("topic", top.schema["topic"].dataType)])
    return by, words, top.sparkSession.createDataFrame(ids, schema)


def _pair_rows(counts, by: list, *more: tuple[int, int, int]):
    """Counts of the words and word pairs that share a topic, as (i, j, c)."""
    import numpy as np
    import pyarrow as pa

    wanted = np.zeros(counts.shape, bool)
    for words in by:
        own = [w[0] for w in words]
        wanted[np.ix_(own, own)] = True
    i, j = np.nonzero(wanted & (counts != 0))
    cols = [np.r_[x, [m[k] for m in more]].astype(np.int64) for k, x in enumerate((i, j, counts[i, j]))]
    return pa.RecordBatch.from_arrays([pa.array(x) for x in cols], ["i", "j", "c"])


def _scored(found: DataFrame, ids: DataFrame, finish) -> DataFrame:
    """(topic, coherence): the counts summed over the tasks, at most topics x n^2
    of them, scored in one task by ``finish(counts {(i, j): c})``."""
    import pyarrow as pa

    def run(batches):
        counts = {}
        for b in batches:
            counts.update(zip(zip(b.column(0).to_pylist(), b.column(1).to_pylist()), b.column(2).to_pylist()))
        got = finish(counts)
        yield pa.RecordBatch.from_arrays([pa.array([*got], pa.int32()), pa.array([*got.values()], pa.float64())], ["t", "coherence"])

    none = found.sparkSession.createDataFrame([(-2, -2, 0)], "i long, j long, c long")  # scores without any document, too
    sums = found.unionByName(none).groupBy("i", "j").agg(F.sum("c").alias("c")).repartition(1)
    return sums.mapInArrow(run, "t int, coherence double").join(F.broadcast(ids), "t").select("topic", "coherence")


def coherence_umass(top: DataFrame, bow: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """M9 (Mimno et al. 2011): per topic, the mean over ranked pairs i > j of
    ``ln((D(w_i, w_j) + 1) / D(w_j))`` with D = document counts.  Only the
    incidences of top words are kept, one row of them per document; a task
    multiplies the documents' incidence matrix with itself, so a pair is counted
    once however many topics share it, and only counts leave the task."""
    import numpy as np

    by, words, ids = _listed(top, "rank")
    number = top.sparkSession.createDataFrame([(w, i) for i, w in enumerate(words)], "term string, no int")

    def count(batches):
        once, both = np.zeros(len(words), np.int64), np.zeros((len(words), len(words)))
        for b in batches:
            for at in range(0, b.num_rows, INCIDENCE_ROWS):
                part = b.slice(at, INCIDENCE_ROWS)
                row = np.repeat(np.arange(part.num_rows), part.column(1).value_lengths().to_numpy())
                m = np.bincount(row * len(words) + part.column(1).flatten().to_numpy(), minlength=part.num_rows * len(words))
                m = m.reshape(part.num_rows, len(words)).astype(float)
                once += m.sum(0).astype(np.int64)
                m = m[part.column(0).is_valid().to_numpy(zero_copy_only=False)]  # rows without id are of no common document
                both += m.T @ m
        both = np.rint(both).astype(np.int64)
        yield _pair_rows(both, by, *((-1, i, int(n)) for i, n in enumerate(once) if n))

    def finish(counts):
        out = {}
        for t, own in enumerate(by):
            v = [np.log((counts.get((i, j), 0) + 1.0) / counts[-1, j]) for i, ri in own for j, rj in own if ri > rj and (-1, j) in counts]
            if v:
                out[t] = float(np.mean(v))
        return out

    inc = bow.select(id_col, "term").filter(F.col("term").isin(words)).join(F.broadcast(number), "term")
    inc = inc.groupBy(id_col).agg(F.collect_list("no").alias("at"))
    return _scored(inc.select(id_col, "at").mapInArrow(count, "i long, j long, c long"), ids, finish)


def _window_counts(words: list[str], by: list, window: int):
    """The Arrow function of ``coherence_cv`` over ``(id, tokens, n)``, rows of
    one id together and ``n`` of them.  The windows of some documents lie below
    each other; a word's hits switch it on at the first window that holds them
    and off after the last, so a running sum over the windows says which words
    they hold, and its product with itself counts windows of words and pairs."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def add(batch, first, both):
        """Adds the windows of documents whose rows begin at ``first``."""
        lens = pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy().astype(np.int64)
        starts = np.maximum(lens - window, 0) + 1  # window starts of a row
        doc = np.searchsorted(first, np.arange(len(lens)), "right") - 1
        base = np.r_[0, np.cumsum(np.maximum.reduceat(starts, first))]  # rows of one id share their windows
        term = pc.fill_null(pc.index_in(batch.column(1).flatten(), value_set=pa.array(words, pa.string())), -1).to_numpy()
        hit = np.flatnonzero(term >= 0)
        row = np.searchsorted(np.cumsum(lens), hit, "right")
        p, at = hit - (np.cumsum(lens) - lens)[row], base[doc[row]]
        on = at + np.maximum(p - window + 1, 0)
        off = at + np.minimum(p, starts[row] - 1) + 1
        event = np.r_[on, off]
        order = np.argsort(event, kind="stable")
        event, word, sign = event[order], np.r_[term[hit], term[hit]][order], np.repeat([1.0, -1.0], len(hit))[order]
        held = np.zeros(len(words))
        for lo in range(0, int(base[-1]), CV_ROWS):
            n = min(CV_ROWS, int(base[-1]) - lo)
            a, b = np.searchsorted(event, [lo, lo + n])
            m = np.bincount((event[a:b] - lo) * len(words) + word[a:b], sign[a:b], n * len(words)).astype(float).reshape(n, len(words))
            m[0] += held
            np.cumsum(m, axis=0, out=m)
            held = m[-1]
            m = (m > 0.5).astype(np.float32)
            both += np.rint(m.T @ m).astype(np.int64)
        return int(starts.sum())

    def run(batches):
        both, total, kept = np.zeros((len(words), len(words)), np.int64), 0, None
        for batch in batches:
            if kept is not None:
                batch = pa.Table.from_batches([kept, batch]).combine_chunks().to_batches()[0]
            kept, n, first, i = None, batch.column(2).to_numpy(), [], 0
            while i < len(n):
                first.append(i)
                i += int(n[i])
            if i > len(n):  # the last id goes on in the next batch
                kept = batch.slice(first[-1])
                first = first[:-1]
            ends = np.array([*first, len(n) - (0 if kept is None else kept.num_rows)])
            size = np.cumsum(pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy().astype(np.int64))
            a = 0
            while a < len(first):
                so_far = size[ends[a] - 1] if ends[a] else 0
                b = min(len(first), max(a + 1, int(np.searchsorted(size[ends[a + 1:] - 1], so_far + CV_TOKENS, "right")) + a))
                total += add(batch.slice(ends[a], ends[b] - ends[a]), ends[a:b] - ends[a], both)
                a = b
        yield _pair_rows(both, by, (-1, -1, total))

    return run


def coherence_cv(top: DataFrame, tokens: DataFrame, *, window: int = 110, id_col: str = "doc_id",
                 tokens_col: str = "tokens", eps: float = 1e-12) -> DataFrame:
    """M10 (Roeder et al. 2015): boolean sliding windows of ``window``
    tokens (step 1; a shorter document is one window).  A top word at
    position p of a document with L tokens lies in window starts
    ``max(0, p-window+1) .. min(p, max(0, L-window))``.  C(w, w') is the number
    of windows that hold both, counted inside the documents' tasks for all words
    of all topics at once (``_window_counts``): the work is linear in the tokens
    and does not grow with the topics that share a pair.  NPMI =
    ln((P(w,w')+eps) / (P(w)P(w'))) /
    -ln(P(w,w')+eps); each word's vector is its NPMI with all top words of the
    topic; score = mean cosine of the word vectors with their sum."""
    import numpy as np

    by, words, ids = _listed(top)

    def finish(counts):
        N, out = counts.get((-1, -1), 0), {}
        for t, own in enumerate(by):
            v = np.zeros((len(own), len(own)))
            for x, (i,) in enumerate(own):
                for y, (j,) in enumerate(own):
                    pi, pj, pij = (counts.get(k, 0) / N if N else 0.0 for k in ((i, i), (j, j), (i, j)))
                    if pi * pj > 0 and np.log(pij + eps) != 0:
                        v[x, y] = np.log((pij + eps) / (pi * pj)) / -np.log(pij + eps)
            total = v.sum(0)
            size = np.sqrt((v * v).sum(1)) * np.sqrt(total @ total)
            out[t] = float(np.mean(np.divide(v @ total, size, out=np.zeros(len(own)), where=size != 0)))
        return out

    docs = tokens.select(id_col, tokens_col, F.count(F.lit(1)).over(Window.partitionBy(id_col)).alias("_n"))
    return _scored(docs.mapInArrow(_window_counts(words, by, window), "i long, j long, c long"), ids, finish)


def best_k(scores: DataFrame) -> DataFrame:
    """Per measure the k with the highest score (ties: smaller k); then
    the k whose winning measure value is larger."""
    per = scores.groupBy("measure").agg(F.max_by(F.struct("k", "score"), F.struct(F.col("score"), -F.col("k"))).alias("b"))
    per = per.select("measure", F.col("b.k").alias("k"), F.col("b.score").alias("score"))
    return per.agg(F.max_by(F.struct("measure", "k", "score"), F.struct(F.col("score"), -F.col("k"))).alias("w")).select("w.*")


def topic_distribution(topics: DataFrame) -> DataFrame:
    """Weights min-max scaled within each topic, then made to sum to 1
    (for signed loadings)."""
    ends = topics.groupBy("topic").agg(F.min("weight").alias("_lo"), F.max("weight").alias("_hi"))  # one row per topic
    mm = topics.join(F.broadcast(ends), "topic").withColumn(
        "_m", F.coalesce(F.try_divide(F.col("weight") - F.col("_lo"), F.col("_hi") - F.col("_lo")), F.lit(0.0)))
    sums = mm.groupBy("topic").agg(F.sum("_m").alias("_all"))
    return mm.join(F.broadcast(sums), "topic").withColumn(
        "weight", F.coalesce(F.try_divide("_m", "_all"), F.lit(0.0))).drop("_lo", "_hi", "_m", "_all")


def topic_distances(topics: DataFrame) -> DataFrame:
    """Hellinger distance of every topic pair (each once), largest first.
    With distributions summing to 1, ``H^2 = 1 - sum sqrt(p q)`` over the
    shared terms only, so the join is an equi-join on term; pairs without a
    shared term get H = 1."""
    t = topics.select("topic", "term", F.sqrt("weight").alias("s"))
    bc = t.alias("x").join(t.alias("y"), "term").filter(F.col("x.topic") < F.col("y.topic")).groupBy(
        F.col("x.topic").alias("a"), F.col("y.topic").alias("b")).agg(F.sum(F.col("x.s") * F.col("y.s")).alias("bc"))
    ids = topics.select("topic").distinct()
    # K topic ids (the model size): broadcast
    pairs = ids.alias("x").join(F.broadcast(ids.alias("y")), F.col("x.topic") < F.col("y.topic")).select(
        F.col("x.topic").alias("a"), F.col("y.topic").alias("b"))
    out = pairs.join(bc, ["a", "b"], "left")
    return out.select("a", "b", F.sqrt(F.greatest(1.0 - F.coalesce("bc", F.lit(0.0)), F.lit(0.0))).alias("hellinger"))


def dominant_topic(doc_topics: DataFrame, keywords: DataFrame | None = None, *, id_col: str = "doc_id",
                   by_abs: bool = False) -> DataFrame:
    """Each document's heaviest topic (ties: smaller topic), its
    contribution rounded to 4 decimals and the topic's keywords."""
    key = F.abs("weight") if by_abs else F.col("weight")
    best = doc_topics.groupBy(id_col).agg(F.min_by(F.struct("topic", "weight"), F.struct(-key, F.col("topic"))).alias("b"))
    out = best.select(id_col, F.col("b.topic").alias("topic"), stable_round(F.col("b.weight"), 4).alias("contribution"))
    return out.join(keywords, "topic", "left") if keywords is not None else out


def representative_docs(dominant: DataFrame, n: int = 1, *, id_col: str = "doc_id") -> DataFrame:
    """Per topic the n documents with the greatest contribution among
    those it dominates (ties: smaller id)."""
    w = Window.partitionBy("topic").orderBy(F.desc("contribution"), F.asc(id_col))
    return dominant.withColumn("rank", F.row_number().over(w).cast("long")).filter(F.col("rank") <= n)


def topic_shares(dominant: DataFrame, keywords: DataFrame | None = None) -> DataFrame:
    """Documents per dominant topic and their percentage of the corpus
    (4 decimals), joined to keywords on the topic number."""
    cnt = dominant.groupBy("topic").agg(F.count(F.lit(1)).cast("long").alias("n_docs"))
    tot = cnt.agg(F.sum("n_docs").alias("_t"))
    out = cnt.crossJoin(F.broadcast(tot)).select("topic", "n_docs", stable_round(F.col("n_docs") * 100.0 / F.col("_t"), 4).alias("pct"))
    return out.join(keywords, "topic", "left") if keywords is not None else out


# ----------------------------------------------------------------- models


def fit_lda(vectors: DataFrame, k: int, *, optimizer: str = "online", max_iter: int = 20, seed: int = 222,
            features: str = "features"):
    """M1 (``online``, batch updates: subsampling 1.0) / M2 (``em``)."""
    from pyspark.ml.clustering import LDA

    lda = LDA(k=k, maxIter=max_iter, seed=seed, optimizer=optimizer, featuresCol=features)
    if optimizer == "online":
        lda.setSubsamplingRate(1.0)
    return lda.fit(vectors)


def lda_topics(model, vocab: list[str] | DataFrame, n: int | None = None) -> DataFrame:
    """The model's topic-term matrix as ``(topic, term, weight)`` (each topic
    a distribution).  ``vocab`` maps term indices to terms."""
    spark = model.describeTopics(1).sparkSession
    size = model.vocabSize()
    desc = model.describeTopics(n or size)
    rows = desc.select("topic", F.arrays_zip("termIndices", "termWeights").alias("z")).select(
        "topic", F.explode("z").alias("z")).select("topic", F.col("z.termIndices").alias("term_id"),
                                                   F.col("z.termWeights").alias("weight"))
    if isinstance(vocab, list):
        vdf = spark.createDataFrame(list(enumerate(vocab)), "term_id int, term string")
    else:
        vdf = vocab
    return rows.join(vdf, "term_id").select("topic", "term", "weight")


def lda_doc_topics(model, vectors: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    t = model.transform(vectors).select(id_col, vector_to_array("topicDistribution").alias("_d"))
    return t.select(id_col, F.posexplode("_d").alias("topic", "weight"))


def perplexity(model, vectors: DataFrame) -> float:
    """M8: log-perplexity bound of the documents under the model."""
    return float(model.logPerplexity(vectors))


def sweep(fit_fn, score_fn, ks) -> list[tuple[int, str, float]]:
    """One distributed fit per k (driver loop over the k values only),
    scored by ``score_fn(model) -> {measure: value}``."""
    out = []
    for k in ks:
        model = fit_fn(k)
        for measure, value in score_fn(model).items():
            out.append((int(k), measure, float(value)))
    return out


def lsi(vectors: DataFrame, k: int, *, features: str = "features", id_col: str = "doc_id"):
    """M4: truncated SVD of the document-term matrix X (documents x V).

    One pass sums the per-partition Gram matrices X_p'X_p, each from
    ``GRAM_ROWS`` dense rows at a time (``treeReduce``:
    partial sums combine on executors, the result is V x V -- the model
    size, independent of the number of documents); its top-k eigenvectors
    are the right singular vectors, singular values are the square roots of
    the eigenvalues, and document coordinates U = X V / s are computed
    map-side with V broadcast.  Signs are fixed so each concept's
    largest-magnitude loading is positive.  Returns ``(concepts (topic,
    term_id, weight), singular values, doc coordinates (doc_id, topic,
    weight))``."""
    import numpy as np

    spark = vectors.sparkSession
    rows = vectors.select(id_col, features).rdd

    def part_gram(it):
        gram = None
        while block := [r[1].toArray() for r in islice(it, GRAM_ROWS)]:
            a = np.vstack(block)
            gram = a.T @ a if gram is None else gram + a.T @ a
        return [] if gram is None else [gram]

    gram = rows.mapPartitions(part_gram).treeReduce(lambda x, y: x + y)
    vals, vecs = np.linalg.eigh(gram)
    order = np.argsort(vals)[::-1][:k]
    s = np.sqrt(np.clip(vals[order], 0.0, None))
    V = vecs[:, order]
    signs = np.sign(V[np.abs(V).argmax(axis=0), range(V.shape[1])])
    signs[signs == 0] = 1
    V = V * signs
    concepts = spark.createDataFrame(
        [(int(j), int(t), float(V[t, j])) for j in range(V.shape[1]) for t in range(V.shape[0]) if V[t, j] != 0.0],
        "topic int, term_id int, weight double")
    vb = spark.sparkContext.broadcast((V / np.where(s > 0, s, 1.0)).tolist())

    def coords(it):
        proj = np.asarray(vb.value)
        for r in it:
            u = r[1].toArray() @ proj
            for j in range(len(u)):
                yield (int(r[0]), j, float(u[j]))

    docs = spark.createDataFrame(rows.mapPartitions(coords), f"{id_col} long, topic int, weight double")
    return concepts, s, docs


def _nmf_pass(id_col: str, Hs: list, k: int, V: int, eps: float, out_w: bool):
    """The Arrow function of one pass of ``nmf`` over documents ``(id, ids, values,
    start)``: every document's factors from their start and the ``H`` of all
    iterations so far.  Yields the factors, or W'X and W'W summed over the task."""
    import numpy as np
    import pyarrow as pa

    steps = [(H, H @ H.T) for H in Hs]

    def run(batches):
        wtx, wtw = np.zeros((k, V)), np.zeros((k, k))
        for batch in batches:
            for at in range(0, batch.num_rows, NMF_ROWS):
                part = batch.slice(at, NMF_ROWS)
                n = part.num_rows
                row = np.repeat(np.arange(n), part.column(1).value_lengths().to_numpy())
                term = part.column(1).flatten().to_numpy()
                value = part.column(2).flatten().to_numpy()
                w = part.column(3).flatten().to_numpy().reshape(n, k)
                for H, HHt in steps:
                    xh = np.stack([np.bincount(row, value * h[term], n) for h in H], axis=1)
                    w = w * (xh / (w @ HHt + eps))
                if out_w:
                    ends = np.arange(n + 1, dtype=np.int32) * k
                    yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(ends, w.ravel())], [id_col, "w"])
                else:
                    wtw += w.T @ w
                    for j in range(k):
                        wtx[j] += np.bincount(term, value * w[row, j], V)
        if not out_w:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(k * (V + k), dtype=np.int32)),
                                              pa.array(np.concatenate([wtx.ravel(), wtw.ravel()]))], ["at", "v"])

    return run


def nmf(x: DataFrame, k: int, *, max_iter: int = 50, tol: float = 1e-4, seed: int = 222, id_col: str = "doc_id",
        eps: float = 1e-9):
    """M5 (Lee & Seung 2001, Frobenius): ``x`` is the long non-negative matrix
    ``(doc_id, term_id, value)``.  It is written once, as one row per document
    with its terms, values and hash-seeded start.  Multiplicative updates touch
    a document's factors only through its own row and H, so a pass rebuilds them
    from the start and the H of the iterations so far (k x V each); nothing of
    the size of X or W is moved or written again.  An iteration is one pass that
    returns W'X (k x V) and W'W, summed in every task first; H is kept on the
    driver (bounded by the model size).  Returns ``(W (doc_id, w array), H numpy
    k x V, objective history)``."""
    import numpy as np

    cells = F.struct(F.col("term_id").cast("int").alias("t"), F.coalesce(F.col("value").cast("double"), F.lit(0.0)).alias("v"))
    u = lambda j: (F.pmod(F.xxhash64(F.col(id_col), F.lit(seed), F.lit(j)), F.lit(1_000_003)).cast("double") / 1_000_003.0 + 0.01)
    docs = x.groupBy(id_col).agg(F.collect_list(cells).alias("_c")).select(
        id_col, F.array(*[u(j) for j in range(k)]).alias("start"), F.col("_c.t").alias("_t"), F.col("_c.v").alias("_v"),
    ).checkpoint()
    size = docs.agg(F.max(F.array_max("_t")), F.sum(F.aggregate("_v", F.lit(0.0), lambda a, v: a + v * v))).first()
    V, xx = int(size[0]) + 1, float(size[1])
    # a row without id belongs to no document: it keeps no entries
    known = lambda c: F.when(F.col(id_col).isNotNull(), F.col(c)).otherwise(F.array().cast(docs.schema[c].dataType))
    docs = docs.select(id_col, known("_t").alias("ids"), known("_v").alias("values"), "start")

    def sums(Hs):
        got = docs.mapInArrow(_nmf_pass(id_col, Hs, k, V, eps, False), "at int, v double").groupBy("at").agg(F.sum("v").alias("v"))
        flat = np.zeros(k * (V + k))
        for r in got.collect():
            flat[r["at"]] = r["v"]
        return flat[:k * V].reshape(k, V), flat[k * V:].reshape(k, k)

    rng = np.random.default_rng(seed)
    H = rng.random((k, V)) + 0.01
    history, Hs = [], []
    WtX, WtW = sums(Hs)
    for it in range(max_iter):
        H = H * WtX / (WtW @ H + eps)
        Hs.append(H)
        WtX, WtW = sums(Hs)  # of the new W: for the objective, and for the next H
        # objective ||X - WH||^2 = ||X||^2 - 2 tr(W'XH') + tr(W'W HH')
        obj = xx - 2 * float(np.sum(WtX * H)) + float(np.sum(WtW * (H @ H.T)))
        history.append(obj)
        if len(history) > 1 and abs(history[-2] - obj) <= tol * max(abs(history[-2]), 1e-12):
            break
    id_type = docs.schema[id_col].dataType.simpleString()
    W = docs.mapInArrow(_nmf_pass(id_col, Hs, k, V, eps, True), f"`{id_col}` {id_type}, w array<double>")
    return W, H, history
