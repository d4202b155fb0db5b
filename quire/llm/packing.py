"""Best-fit packing of tokenized documents into fixed-length sequences.

Documents no longer than a sequence stay whole; longer ones are cut into full
sequences, with what is left over as a shorter first piece.  The pieces short
of a sequence are packed hierarchically:

* *Locally.*  Each task packs its own pieces, longest first, each into the
  fullest bin that still takes it.  Bins with at most ``slack`` tokens free are
  final and leave.
* *Tree merge.*  Underfull bins become items of the next round: they are dealt
  to fewer tasks of at most ``fan_in`` bins, to other ones in each round, and
  packed again, bin into bin.  Rounds go on until one bounded task holds the
  rest, or a round saves less than one bin for each of its tasks: two or more
  lists of ``fan_in`` bins that best fit cannot shorten.

A bin never has more members than tokens, so its members travel inside it.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spread_scan, written
from .tokens import encoder

MEMBER = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
                    ("length", pa.int64()), ("ids_crc32", pa.int64())])
BIN = "done boolean, fill int, members array<struct<doc_id:long,piece:int,start:long,length:long,ids_crc32:long>>"
BIN_ARROW = pa.schema([("done", pa.bool_()), ("fill", pa.int32()), ("members", pa.list_(MEMBER))])


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins (lists of item indexes) for items given largest first.  Bins are
    stacked by free room; a bit mask of the non-empty stacks finds the least
    room that is enough."""
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0
    bins: list[list[int]] = []
    for i, n in enumerate(sizes):
        fits = mask >> n << n
        if fits:
            room = (fits & -fits).bit_length() - 1
            b = stacks[room].pop()
            if not stacks[room]:
                mask &= ~(1 << room)
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        left = room - n
        if left:
            stacks[left].append(b)
            mask |= 1 << left
    return bins


def bin_rows(rows: list[tuple], done: list[bool]) -> pa.RecordBatch:
    """rows: (fill, member tuples)."""
    members = [m for _, ms in rows for m in ms]
    cols = list(zip(*members)) if members else [[]] * 5
    flat = pa.StructArray.from_arrays(
        [pa.array(c, f.type) for c, f in zip(cols, MEMBER)], fields=list(MEMBER))
    offsets = np.concatenate([[0], np.cumsum([len(ms) for _, ms in rows])]).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(done, pa.bool_()), pa.array([f for f, _ in rows], pa.int32()),
         pa.ListArray.from_arrays(pa.array(offsets), flat)], schema=BIN_ARROW)


def pack_bins(bins: list[tuple], capacity: int, slack: int, final: bool):
    """Pack (fill, members) bins into one another; yields Arrow batches."""
    bins.sort(key=lambda b: (-b[0], [(-1 if m[0] is None else m[0], m[1]) for m in b[1][:1]]))
    packed = best_fit([b[0] for b in bins], capacity)
    rows = [(sum(bins[i][0] for i in p), [m for i in p for m in bins[i][1]]) for p in packed]
    for s in range(0, len(rows), 4096):
        part = rows[s:s + 4096]
        yield bin_rows(part, [final or capacity - fill <= slack for fill, _ in part])


def cut(length: int, capacity: int) -> list[int]:
    """Piece lengths of a document: all full but a shorter first piece."""
    if length <= capacity:
        return [length]
    short = length % capacity
    return ([short] if short else []) + [capacity] * (length // capacity)


def pieces_packed_locally(docs: DataFrame, vocabulary: str, end_id: int, capacity: int, slack: int,
                          fan_in: int) -> DataFrame:
    def run(batches):
        enc = encoder(vocabulary)
        end = np.array([end_id], "<u4")
        open_bins: list[tuple] = []
        for b in batches:
            names, texts = b.column(0).to_pylist(), b.column(1)
            for s in range(0, len(names), 1024):
                full = []
                for name, raw in zip(names[s:s + 1024], enc.encode(texts[s:s + 1024].to_pylist())):
                    ids = np.concatenate([np.frombuffer(raw, enc.dtype).astype("<u4"), end])
                    view, at = memoryview(ids.tobytes()), 0
                    for k, n in enumerate(cut(len(ids), capacity)):
                        bin_ = (n, [(name, k, at, n, zlib.crc32(view[4 * at:4 * (at + n)]))])
                        (full if capacity - n <= slack else open_bins).append(bin_)
                        at += n
                if full:
                    yield bin_rows(full, [True] * len(full))
                if len(open_bins) >= fan_in:
                    yield from pack_bins(open_bins, capacity, slack, False)
                    open_bins = []
        yield from pack_bins(open_bins, capacity, slack, False)

    return docs.mapInArrow(run, BIN)


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int, capacity: int = 1024, slack: int = 4,
                   fan_in: int = 50_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row
    per piece.

    A null or empty text is the end id alone.  Rows that repeat an id or a text
    are packed each on their own, null ids too; an empty table gives an empty
    table.  Offsets of a sequence are gapless from 0."""
    slim = spread_scan(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")))
    level = written(pieces_packed_locally(slim, vocabulary, end_id, capacity, slack, fan_in), "bins")
    final, waiting = [level.filter("done")], level.filter("NOT done")
    n, deal = waiting.count(), 0
    while n:
        tasks = -(-n // fan_in)

        def run(batches, last=tasks == 1):
            bins = []
            for b in batches:
                fills, lists = b.column(0).to_pylist(), b.column(1)
                flat = list(zip(*(lists.flatten().field(k).to_pylist() for k in range(5))))
                at = lists.offsets.to_pylist()
                bins += [(f, flat[x - at[0]:z - at[0]]) for f, x, z in zip(fills, at, at[1:])]
            yield from pack_bins(bins, capacity, slack, last)

        dealt = waiting.select("fill", "members", F.xxhash64(F.col("members")[0], F.lit(deal)).alias("k"))
        level = written(dealt.repartition(tasks, "k").select("fill", "members").mapInArrow(run, BIN), "bins")
        final.append(level.filter("done"))
        waiting = level.filter("NOT done")
        left, before = waiting.count(), n
        n, deal = left, deal + 1
        if n and before - level.count() < tasks:
            final.append(waiting)
            break
    packed = final[0]
    for part in final[1:]:
        packed = packed.union(part)

    def spell(batches):
        for b in batches:
            lists = b.column(1)
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten()
            length = flat.field(3).to_numpy(zero_copy_only=False)
            upto = np.cumsum(length) - length
            first = np.repeat(upto[np.cumsum(sizes) - sizes], sizes)
            seq = np.repeat(b.column(0).to_numpy(zero_copy_only=False), sizes)
            yield pa.RecordBatch.from_arrays(
                [*(flat.field(k) for k in range(5)), pa.array(seq, pa.int64()), pa.array(upto - first, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return packed.select(F.monotonically_increasing_id().alias("sequence_id"), "members").mapInArrow(
        spell, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
