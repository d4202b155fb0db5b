"""SimHash near-duplicates through a segment-popcount embedding.

Every document gets a 64-bit fingerprint.  Two fingerprints that differ in at
most ``max_bits`` bits must be linked, whatever else the corpus holds:

* *Embedding.*  A fingerprint is mapped to the bit counts of its 2-bit
  segments.  Flipping one bit moves one count by one, so the Manhattan
  distance of two count vectors never exceeds the number of differing bits.
* *Grid range-join.*  The segments are dealt into ``groups`` halves.  Of two
  fingerprints within ``max_bits``, at least one half lies within
  ``max_bits // groups`` in Manhattan distance, so the two count vectors share
  a lattice point that is at most half that distance (rounded up) from each.
  Every distinct fingerprint is therefore sent to the lattice cells around its
  own, and only fingerprints that meet in a cell are compared: first the
  Manhattan bound over all segments, then the exact bit distance.
* *Crowded cells.*  Copies are collapsed before (one row per distinct
  fingerprint).  A cell with more than ``block`` fingerprints is cut into
  blocks, and every pair of blocks is one bounded unit of work; any other cell
  is one unit.  A unit emits a spanning forest of its links, never all its
  pairs, which is what the connected components need.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import row_key, spread_scan, written
from .components import connected_components

SEED = 42
CHUNK = 255  # rows that an 8-bit counter can take
#: byte value -> eight 8-bit lanes holding its bits
LANES = np.array([sum(((v >> j) & 1) << (8 * j) for j in range(8)) for v in range(256)], dtype=np.uint64)


def shingle_hashes(text: str | None, k: int) -> np.ndarray:
    """XXH64 of each ``k``-word shingle of the A-Z-lowered text, in order."""
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= k:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    starts = list(accumulate((len(w) + 1 for w in words), initial=0))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(joined[a:z - 1], SEED) for a, z in zip(starts, starts[k:])),
                       np.uint64, len(words) - k + 1)


def majority_bits(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprint of each run of ``counts[i]`` (> 0) consecutive hashes."""
    cuts = [np.arange(s, s + n, CHUNK) for s, n in zip(np.cumsum(counts) - counts, counts)]
    per_doc = np.array([len(c) for c in cuts])
    lanes = np.add.reduceat(LANES[hashes.view(np.uint8).reshape(-1, 8)], np.concatenate(cuts), axis=0)
    ones = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 64).astype(np.int64),
                           np.cumsum(per_doc) - per_doc, axis=0)
    bits = ones * 2 > counts[:, None]
    return np.packbits(bits, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprint_texts(texts: list, k: int, flush: int = 400_000) -> np.ndarray:
    """Fingerprints of many texts; a text without words has fingerprint 0."""
    out = np.zeros(len(texts), np.uint64)
    part: list[np.ndarray] = []
    where: list[int] = []
    held = 0
    for i, t in enumerate(texts):
        h = shingle_hashes(t, k)
        if len(h):
            part.append(h)
            where.append(i)
            held += len(h)
        if where and (held >= flush or i == len(texts) - 1):
            out[where] = majority_bits(np.concatenate(part), np.array([len(p) for p in part]))
            part, where, held = [], [], 0
    if where:
        out[where] = majority_bits(np.concatenate(part), np.array([len(p) for p in part]))
    return out


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(doc_id, rk long, fp long): one row per input row, with the row key of
    ``common.row_key``.  A map over Arrow batches."""
    named = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    slim = spread_scan(named.select("doc_id", "text", row_key("doc_id", "text").alias("rk")))
    id_type = slim.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            fp = fingerprint_texts(b.column(1).to_pylist(), shingle)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(fp.view(np.int64))], ["doc_id", "rk", "fp"])

    return slim.mapInArrow(run, f"doc_id {id_type}, rk long, fp long")


# -- the embedding and its grid -------------------------------------------------

ODD = 0x5555555555555555


def segment_counts(fp: np.ndarray) -> np.ndarray:
    """Bit counts of the 32 two-bit segments, each in its own two bits."""
    x = fp.astype(np.uint64)
    return x - ((x >> np.uint64(1)) & np.uint64(ODD))


def manhattan(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Manhattan distance of packed count vectors (fields 0..2)."""
    odd = np.uint64(ODD)
    alo, ahi, blo, bhi = a & odd, (a >> np.uint64(1)) & odd, b & odd, (b >> np.uint64(1)) & odd
    # 0 is 00, 1 is 01, 2 is 10: they differ by two when one is 10 and the other 00
    differ = (alo ^ blo) | (ahi ^ bhi)
    twice = (ahi ^ bhi) & ~(alo | blo)
    return np.bitwise_count(differ).astype(np.int64) + np.bitwise_count(twice)


def lattice_cells(fp: np.ndarray, groups: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(cell, row index) of every lattice point within ``radius`` of a
    fingerprint's counts, in each of ``groups`` groups of segments."""
    width = 64 // groups
    counts = segment_counts(fp)
    cells, rows = [], []
    for g in range(groups):
        own = (counts >> np.uint64(g * width)) & np.uint64((1 << width) - 1)
        key, row = own, np.arange(len(fp))
        reached_key, reached_row = [key], [row]
        for _ in range(radius):
            nk, nr = [], []
            for s in range(0, width, 2):
                field = (key >> np.uint64(s)) & np.uint64(3)
                up, down = field < 2, field > 0
                nk += [key[up] + np.uint64(1 << s), key[down] - np.uint64(1 << s)]
                nr += [row[up], row[down]]
            key, row = np.concatenate(nk), np.concatenate(nr)
            if radius > 1:
                both = np.unique(np.stack([row.astype(np.uint64), key], 1), axis=0)
                row, key = both[:, 0].astype(np.int64), both[:, 1]
            reached_key.append(key)
            reached_row.append(row)
        key, row = np.concatenate(reached_key), np.concatenate(reached_row)
        if radius > 1:
            both = np.unique(np.stack([row.astype(np.uint64), key], 1), axis=0)
            row, key = both[:, 0].astype(np.int64), both[:, 1]
        if groups > 1:  # one group fills all 64 bits by itself
            key = key | np.uint64(g << width)
        cells.append(key)
        rows.append(row)
    return np.concatenate(cells), np.concatenate(rows)


def links_within(members: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among distinct fingerprints: the bound
    first, then the exact distance, against members not reached yet."""
    left, right = [], []
    rest, rest_counts = members, segment_counts(members)
    while len(rest) > 1:
        queue = [rest[0]]
        rest, rest_counts = rest[1:], rest_counts[1:]
        while queue and len(rest):
            q = queue.pop()
            near = manhattan(rest_counts, segment_counts(np.array([q]))) <= max_bits
            near[near] = np.bitwise_count(rest[near] ^ q) <= max_bits
            hit = rest[near]
            if len(hit):
                left.append(np.full(len(hit), q))
                right.append(hit)
                queue.extend(hit)
                rest, rest_counts = rest[~near], rest_counts[~near]
    if not left:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate(left), np.concatenate(right)


def links_of_groups(flat: np.ndarray, sizes: np.ndarray, max_bits: int, small: int = 12):
    """Links of many groups that lie one after the other in ``flat``.  Groups
    of one small size are compared together; larger ones give a forest each."""
    left, right = [], []
    starts = np.cumsum(sizes) - sizes
    for m in np.unique(sizes[(sizes > 1) & (sizes <= small)]):
        block = flat[starts[sizes == m][:, None] + np.arange(m)]
        counts = segment_counts(block)
        i, j = np.triu_indices(m, 1)
        a, b = block[:, i].ravel(), block[:, j].ravel()
        near = manhattan(counts[:, i].ravel(), counts[:, j].ravel()) <= max_bits
        a, b = a[near], b[near]
        near = np.bitwise_count(a ^ b) <= max_bits
        left.append(a[near])
        right.append(b[near])
    for s, m in zip(starts[sizes > small], sizes[sizes > small]):
        a, b = links_within(flat[s:s + m], max_bits)
        left.append(a)
        right.append(b)
    if not left:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate(left), np.concatenate(right)


def fingerprint_links(distinct_fps: DataFrame, max_bits: int = 4, groups: int = 2, block: int = 1024) -> DataFrame:
    """(a, b) links between distinct fingerprints (column ``fp``) at most
    ``max_bits`` apart: enough of them to give the exact components."""
    radius = -(-(max_bits // groups) // 2)

    def to_cells(batches):
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for s in range(0, len(fp), 20_000):
                cell, row = lattice_cells(fp[s:s + 20_000], groups, radius)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell.view(np.int64)), pa.array(fp[s:s + 20_000][row].view(np.int64))], ["cell", "fp"])

    cells = distinct_fps.select("fp").mapInArrow(to_cells, "cell long, fp long")
    crowded = written(cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block), "crowded")
    plain = (cells.join(crowded, "cell", "left_anti")
             .groupBy("cell").agg(F.collect_list("fp").alias("fps")).filter("size(fps) > 1").select("fps"))
    partner = F.explode(F.expr("filter(sequence(0, nb - 1), x -> x <> own)"))
    paired = (cells.join(crowded, "cell")
              .withColumn("nb", F.ceil(F.col("n") / F.lit(float(block))).cast("int"))
              .withColumn("own", F.expr("CAST(pmod(xxhash64(fp), nb) AS INT)"))
              .withColumn("other", partner)
              .select("cell", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
              .groupBy("cell", "i", "j").agg(F.collect_list("fp").alias("fps")).select("fps"))
    units = plain.union(paired)

    def to_links(batches):
        for b in batches:
            col = b.column(0)
            sizes = np.diff(col.offsets.to_numpy())
            a, z = links_of_groups(col.flatten().to_numpy(zero_copy_only=False).view(np.uint64), sizes, max_bits)
            if len(a):
                both = np.unique(np.stack([np.minimum(a, z), np.maximum(a, z)], 1), axis=0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.ascontiguousarray(both[:, 0]).view(np.int64)),
                     pa.array(np.ascontiguousarray(both[:, 1]).view(np.int64))], ["a", "b"])

    return units.mapInArrow(to_links, "a long, b long").distinct()


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           shingle: int = 4, max_bits: int = 4, groups: int = 2, block: int = 1024) -> DataFrame:
    """(doc_id, rk, fp long, fingerprint string, component_id), one row per row.

    Null and wordless texts have fingerprint 0 and are linked like any other.
    A text of fewer than ``shingle`` words is one shingle.  Rows with a null
    id belong to their class but never name it (a class of null ids only has
    a null component).  Repeated rows stay.  ``component_id`` is the smallest
    id reachable over links of at most ``max_bits`` bits; an empty table gives
    an empty table."""
    own = written(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    named = own.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    cc = connected_components(fingerprint_links(named.select("fp"), max_bits, groups, block))
    linked = named.join(cc.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp"))
    names = linked.groupBy("component").agg(F.min("least_id").alias("component_id"))
    classes = linked.join(names, "component").select("fp", "component_id")
    return (own.join(classes, "fp")
            .select("doc_id", "rk", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))
