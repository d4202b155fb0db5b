"""Vector codes from part codebooks, searched in integer Walsh-Hadamard space.

Vectors become integers (``floor(scale * x)``) and are cut into equal parts; a
code names, for every part, the nearest entry of that position's codebook.
Parts and entries are padded with zeros to a power of two n and transformed
with the Walsh-Hadamard matrix, whose rows are orthogonal with entries +1 and
-1: the squared difference of two transforms is exactly n times that of the
parts.  Differences are added coefficient by coefficient in sequency order
(number of sign changes), where the first ones hold most of a smooth part's
energy, and an entry is given up as soon as its partial sum exceeds the whole
sum of the entry that led after the first coefficient.  What survives is
compared whole, so the result is the exact nearest entry, the lowest among
equals, without any floating point.

Each round is one map over the vectors with the codebooks in the closure
(``parts * entries * width`` integers, whatever the number of vectors); a task
returns one sum per entry component, and the driver sees one row for each.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spread_scan, written

LIMIT = 1 << 40      # integers are held to this range
LONGEST = 2 ** 63 - 1
FEW = 100_000        # labels whose totals are broadcast
SALT = 16


def sequency(parts: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the rows of ``parts``, zero-padded to a power
    of two, coefficients by rising number of sign changes."""
    width = parts.shape[1]
    n = 1 << max(0, (width - 1).bit_length())
    out = np.zeros((len(parts), n), parts.dtype)
    out[:, :width] = parts
    signs = np.ones((1, 1), np.int64)
    step = 1
    while step < n:
        pairs = out.reshape(len(parts), n // (2 * step), 2, step)
        out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(len(parts), n)
        signs = np.block([[signs, signs], [signs, -signs]])
        step *= 2
    changes = (signs[:, 1:] != signs[:, :-1]).sum(1)
    return out[:, np.argsort(changes, kind="stable")]


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each point, the lowest among equals, and
    the squared distance; both arrays hold integers (int64 or Python's)."""
    if not len(points):
        return np.zeros(0, np.int64), np.zeros(0, points.dtype)
    p, e = sequency(points), sequency(entries)
    partial = (p[:, :1] - e[None, :, 0]) ** 2
    best = ((p - e[partial.argmin(1)]) ** 2).sum(1)
    row, entry = np.nonzero(partial <= best[:, None])
    partial = partial[row, entry]
    for j in range(1, p.shape[1]):
        partial = partial + (p[row, j] - e[entry, j]) ** 2
        alive = np.flatnonzero(partial <= best[row])
        row, entry, partial = row[alive], entry[alive], partial[alive]
    starts = np.searchsorted(row, np.arange(len(p)))
    least = np.minimum.reduceat(partial, starts)
    ties = np.flatnonzero(partial == least[row])
    chosen = ties[np.unique(row[ties], return_index=True)[1]]
    return entry[chosen], least // p.shape[1]


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as a matrix, shorter lists padded with zeros."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _exact(values: np.ndarray, books: np.ndarray) -> np.dtype:
    """int64 where all partial sums fit it, else Python integers."""
    width = books.shape[2]
    top = max([1, *(int(np.abs(x).max()) for x in (values, books.astype(object)) if x.size)])
    return np.dtype(np.int64) if (2 * top) ** 2 * (2 * width) ** 2 < 2 ** 62 else np.dtype(object)


def _assigned(column: pa.Array, books: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(part, its integers, nearest entries, squared distances)."""
    parts, _, width = books.shape
    values = _matrix(column, parts * width)
    kind = _exact(values, books)
    for part in range(parts):
        own = values[:, part * width:(part + 1) * width]
        yield part, own, *nearest(own.astype(kind), books[part].astype(kind))


def entry_sums(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """(part, entry, position, n, total) of the parts nearest to each entry."""
    def add(batches):
        sums = np.zeros(books.shape, object)
        counts = np.zeros(books.shape[:2], np.int64)
        for batch in batches:
            for part, own, entry, _ in _assigned(batch.column("ints"), books):
                added = np.zeros(books.shape[1:], np.int64)
                np.add.at(added, entry, own)
                sums[part] += added
                counts[part] += np.bincount(entry, minlength=len(books[part]))
        part, entry = np.nonzero(counts)
        width = books.shape[2]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(part, width).astype(np.int32)), pa.array(np.repeat(entry, width).astype(np.int32)),
            pa.array(np.tile(np.arange(width, dtype=np.int32), len(part))), pa.array(np.repeat(counts[part, entry], width)),
            pa.array([Decimal(x) for x in sums[part, entry].ravel().tolist()], pa.decimal128(38, 0))],
            ["part", "entry", "position", "n", "total"])

    return (vectors.select("ints").mapInArrow(add, "part int, entry int, position int, n long, total decimal(38,0)")
            .groupBy("part", "entry", "position").agg(F.sum("n").alias("n"), F.sum("total").alias("total")))


def coded(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """(vec_id, label, codes array<int>, error) of every vector."""
    label = vectors.schema["label"].dataType.simpleString()

    def code(batches):
        for batch in batches:
            found = list(_assigned(batch.column("ints"), books))
            codes = np.stack([entry for _, _, entry, _ in found], 1).astype(np.int32)
            errors = sum(np.asarray(d, object) for *_, d in found)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id"), batch.column("label"),
                pa.ListArray.from_arrays(np.arange(len(codes) + 1, dtype=np.int32) * codes.shape[1], pa.array(codes.ravel())),
                pa.array([min(x, LONGEST) for x in errors.tolist()], pa.int64())], ["vec_id", "label", "codes", "error"])

    return vectors.mapInArrow(code, f"vec_id long, label {label}, codes array<int>, error long")


def integer_vectors(vectors: DataFrame, scale: float, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, ints array<long>) of the vectors without null, NaN or
    infinite components."""
    fine = "vec IS NOT NULL AND forall(vec, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    ints = f"transform(vec, x -> greatest(-{LIMIT}L, least({LIMIT}L, floor({scale}D * CAST(x AS DOUBLE)))))"
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vec_col).alias("vec"))
            .filter(fine).select("vec_id", "label", F.expr(ints).alias("ints")))


def label_errors(rows: DataFrame) -> DataFrame:
    """``rows`` with ``label_error``, the error summed over equal labels.  Few
    labels are broadcast; else a label's rows are dealt out, its total copied."""
    totals = rows.groupBy(F.col("label").alias("of")).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total"))
    totals = totals.select("of", F.least("total", F.lit(Decimal(LONGEST))).cast("long").alias("label_error"))
    totals = written(totals, "label-errors")
    if totals.count() <= FEW:
        return rows.join(F.broadcast(totals), F.col("label").eqNullSafe(F.col("of"))).drop("of")
    totals = totals.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("vec_id", "codes"), F.lit(SALT)))
    return (salted.join(totals, F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("at")))
            .drop("of", "at", "salt"))


def compress_vectors(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, scale: float = 256.0,
                     id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, codes array<int>, error, label_error) of every vector, and
    the codebooks as integers [part, entry, position].

    Codebooks begin as the parts of the ``entries`` vectors with the smallest
    ids (fewer, if there are fewer) and move ``rounds`` times to the floors of
    their parts' means; an entry without parts stays.

    Vectors that are null or hold a null, NaN or infinite component take no
    part.  Rows that repeat an id are vectors of their own, in the order of their
    integers; rows without an id come last.  A shorter vector is filled up with
    zeros to the longest one's length, and that to a multiple of ``parts``; an
    empty vector is all zeros.  Integers are held to +-2^40, and sums of errors
    to 64 bits.  Null labels count as one label.  An empty table gives an empty
    result and empty codebooks; other columns are ignored."""
    own = written(integer_vectors(spread_scan(vectors), scale, id_col, vec_col, label_col), "integer-vectors")
    longest = own.agg(F.max(F.size("ints"))).first()[0]
    width = max(1, -(-(longest or 0) // parts))
    # at most ``entries`` rows; a top-k of each task, then of those
    first = own.orderBy(F.col("vec_id").asc_nulls_last(), "ints").limit(entries).select("ints").collect()
    books = np.zeros((parts, len(first), width), object)
    for k, row in enumerate(first):
        for i, x in enumerate(row.ints):
            books[i // width, k, i % width] = x
    if not first:
        return own.select("vec_id", "label", F.array().cast("array<int>").alias("codes"),
                          F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error")), books
    for _ in range(rounds):
        for r in entry_sums(own, books).collect():
            books[r.part, r.entry, r.position] = int(r.total) // r.n
    return label_errors(written(coded(own, books), "vector-codes")), books
