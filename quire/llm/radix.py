"""Removal of repeated passages by a depth-limited radix sort of suffixes.

Two suffixes count as equal once their first ``depth`` bytes agree, so sorting
them that far is enough: groups still together after the last digit are exactly
the repeated windows.  Digits are taken most significant first, and a group
leaves as soon as a single document owns it.

* *First digit.*  A suffix's first digit is the smallest hash of the 16-byte
  grams in its window.  Equal windows have equal digits, and neighbouring
  suffixes mostly share theirs, so a run of suffixes travels as one record (about
  two per ``depth - 14`` bytes).  One pass deals the digits alone, without any
  text, into buckets and keeps those that occur in two documents.
* *Other digits.*  Only the runs whose digit survived are dealt out again, with
  their bytes.  A bucket first merges runs of equal bytes, then orders the
  windows of the different ones eight bytes a pass, dropping groups owned by one
  document after each pass, until the window's end.
* *Frequent digits.*  Digits that a sample of documents shows in a large share
  of documents (a bounded list) are not dealt as runs: their windows are dealt
  one by one, by a hash of all their bytes, after equal windows of one batch
  are merged.  This only changes where windows meet, never what is found.

A byte is removed when a window covers it that also starts in a document with a
smaller id; windows are judged on the input.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spread_scan

GRAM = 16
LONGEST = 64          # windows in one run
PIECE = 1 << 20       # bytes hashed at once
FLUSH = 1_000_000     # runs held by a mapper before it deals them out
C1, C2, C3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)


def words_at(buf: np.ndarray) -> np.ndarray:
    """The little-endian 64-bit word that starts at each byte (n - 7 of them)."""
    n = len(buf) - 7
    out = np.empty(max(n, 0), np.uint64)
    for o in range(min(8, max(n, 0))):
        m = (len(buf) - o) // 8
        out[o::8] = buf[o:o + 8 * m].view("<u8")[:len(out[o::8])]
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * C3
    return x ^ (x >> np.uint64(29))


def first_digits(buf: np.ndarray, depth: int) -> np.ndarray:
    """Smallest gram hash of each ``depth``-byte window of ``buf``."""
    w = words_at(buf)
    h = mixed(w[:-8] * C1 ^ np.roll(w, -8)[:-8] * C2) if len(w) > 8 else np.empty(0, np.uint64)
    span, width = depth - GRAM + 1, 1
    while 2 * width <= span:
        h = np.minimum(h[:-width], h[width:])
        width *= 2
    return np.minimum(h[:len(h) - (span - width)], h[span - width:]) if span > width else h


class Runs:
    """Runs of suffixes with one first digit: digit, piece, position in the
    buffer, number of windows."""

    def __init__(self, raws: list[bytes], depth: int):
        pieces = []  # (document, offset, bytes): long texts in overlapping parts
        for i, raw in enumerate(raws):
            for at in range(0, max(0, len(raw) - depth + 1), PIECE):
                pieces.append((i, at, raw[at:at + PIECE + depth - 1]))
        digit, doc, pos, count, self.where = [], [], [], [], []
        at = 0
        while at < len(pieces):
            end, held = at, 0
            while end < len(pieces) and (held == 0 or held + len(pieces[end][2]) <= 2 * PIECE):
                held += len(pieces[end][2])
                end += 1
            part = pieces[at:end]
            buf = np.frombuffer(b"".join(p[2] for p in part), np.uint8)
            m = first_digits(buf, depth)
            sizes = np.array([len(p[2]) for p in part])
            starts = np.cumsum(sizes) - sizes
            usable = np.zeros(len(buf) + 1, np.int8)
            usable[starts] += 1
            usable[starts + sizes - depth + 1] -= 1
            ok = np.cumsum(usable[:len(m)]) > 0
            new = np.ones(len(m), bool)
            new[1:] = m[1:] != m[:-1]
            new[starts] = True
            idx = np.arange(len(m))
            begun = np.maximum.accumulate(np.where(new, idx, 0))
            new |= (idx - begun) % LONGEST == 0
            stop = new | ~ok
            first = np.flatnonzero(new & ok)
            breaks = np.append(np.flatnonzero(stop), len(m))
            after = breaks[np.searchsorted(breaks, first, side="right")]
            which = np.searchsorted(starts, first, side="right") - 1
            digit.append(m[first])
            doc.append(np.array([p[0] for p in part])[which])
            pos.append(first - starts[which] + np.array([p[1] for p in part])[which])
            count.append(after - first)
            at = end
        none = np.empty(0, np.int64)
        self.digit = np.concatenate(digit) if digit else np.empty(0, np.uint64)
        self.doc, self.pos, self.count = (np.concatenate(x) if x else none for x in (doc, pos, count))


def utf8(texts: list) -> list[bytes]:
    return [(t or "").encode("utf-8") for t in texts]


def batches_of(batch, rows: int = 512, size: int = 1 << 22):
    """Slices of an Arrow batch of some rows and bytes."""
    at = 0
    lengths = [len(x) if x else 0 for x in (batch.column(1)[i].as_buffer() for i in range(batch.num_rows))]
    while at < batch.num_rows:
        end, held = at, 0
        while end < batch.num_rows and end - at < rows and (held == 0 or held + lengths[end] <= size):
            held += lengths[end]
            end += 1
        yield batch.slice(at, end - at)
        at = end


def frequent_digits(docs: DataFrame, depth: int, n_docs: int, one_in: int, share: float, least: int,
                    most: int = 4096) -> np.ndarray:
    """At most ``most`` digits that a hash sample of the documents shows in
    ``share`` of them (and at least ``least``)."""
    def run(batches):
        for b in batches:
            for part in batches_of(b):
                r = Runs(utf8(part.column(1).to_pylist()), depth)
                both = np.unique(np.stack([r.doc.astype(np.uint64), r.digit], 1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(both[:, 1]).view(np.int64))], ["digit"])

    sample = docs.filter(F.pmod(F.xxhash64("doc_id", "rk"), F.lit(one_in)) == 0)
    floor = max(least, share * n_docs / one_in)
    rows = (sample.select("doc_id", "text").mapInArrow(run, "digit long").groupBy("digit").agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") >= floor).orderBy(F.col("n").desc(), "digit").limit(most).collect())
    return np.array(sorted(r.digit % 2**64 for r in rows), np.uint64)


def packed(arrays: list[np.ndarray]) -> list[bytes]:
    return [np.ascontiguousarray(a).tobytes() for a in arrays]


def shared_digits(docs: DataFrame, depth: int, buckets: int, frequent: np.ndarray) -> DataFrame:
    """(doc_id, rk, digit): the digits of a document that another document also
    has, one row each, frequent ones left out."""
    def deal(batches):
        ids, keys, doc, digit = [], [], [], []
        held = 0

        def flush():
            d, h = np.concatenate(doc), np.concatenate(digit)
            b = (h % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(b, kind="stable")
            cuts = np.append(np.flatnonzero(np.diff(b[order], prepend=-1)), len(order))
            id_arr, key_arr = np.array(ids, np.int64), np.array(keys, np.uint32)
            for a, z in zip(cuts, cuts[1:]):
                o = order[a:z]
                used, local = np.unique(d[o], return_inverse=True)
                short = (h[o] // np.uint64(buckets)).astype(np.uint32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b[o[0]]], pa.int32()),
                     *(pa.array([x], pa.binary()) for x in packed(
                         [id_arr[used], key_arr[used], local.astype(np.uint32), short]))],
                    ["bucket", "ids", "keys", "doc", "digit"])

        for b in batches:
            for part in batches_of(b):
                raws = utf8(part.column(1).to_pylist())
                r = Runs(raws, depth)
                keep = ~np.isin(r.digit, frequent)
                doc.append(r.doc[keep] + len(ids))
                digit.append(r.digit[keep])
                ids += part.column(0).to_pylist()
                keys += part.column(2).to_pylist()
                held += int(keep.sum())
                if held >= FLUSH:
                    yield from flush()
                    ids, keys, doc, digit, held = [], [], [], [], 0
        if held:
            yield from flush()

    def meet(table: pa.Table) -> pa.Table:
        ids, keys, doc, digit = [], [], [], []
        base = 0
        for r in table.to_pylist():
            ids.append(np.frombuffer(r["ids"], np.int64))
            keys.append(np.frombuffer(r["keys"], np.uint32))
            doc.append(np.frombuffer(r["doc"], np.uint32).astype(np.int64) + base)
            digit.append(np.frombuffer(r["digit"], np.uint32))
            base += len(ids[-1])
        ids, keys, doc, digit = (np.concatenate(x) for x in (ids, keys, doc, digit))
        order = np.argsort(digit, kind="stable")
        doc, digit = doc[order], digit[order]
        cuts = np.flatnonzero(np.diff(digit, prepend=digit[0] ^ 1))
        owner = ids[doc]
        several = np.minimum.reduceat(owner, cuts) != np.maximum.reduceat(owner, cuts)
        keep = np.repeat(several, np.diff(np.append(cuts, len(digit))))
        doc, digit = doc[keep], digit[keep]
        # the kept bits of a digit and its bucket make one number
        kept = digit.astype(np.int64) * buckets + int(table["bucket"][0].as_py())
        return pa.table({"doc_id": pa.array(ids[doc]), "rk": pa.array(keys[doc].astype(np.int64)), "digit": pa.array(kept)})

    dealt = docs.select("doc_id", "text", "rk").mapInArrow(
        deal, "bucket int, ids binary, keys binary, doc binary, digit binary")
    return dealt.groupBy("bucket").applyInArrow(meet, "doc_id long, rk long, digit long")


def squeezed(raw: bytes) -> bytes:
    return zstandard.compress(raw, 3)


def unsqueezed(raw: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(raw), kind)


def gathered(buf: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Bytes [at, at + size) of each entry, one after the other."""
    base = np.repeat(at - (np.cumsum(size) - size), size)
    return buf[base + np.arange(len(base))]


def equal_windows(buf: np.ndarray, at: np.ndarray, group: np.ndarray, owner: np.ndarray, depth: int) -> np.ndarray:
    """Smallest owner of each window's equals, by radix passes of eight bytes,
    most significant first; windows whose group has one owner leave early (and
    get their own)."""
    least = owner.copy()
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    words = words_at(padded)
    active = np.arange(len(at))
    for j in range(0, depth, 8):
        digit = words[at[active] + j]
        if depth - j < 8:
            digit = digit & np.uint64((1 << (8 * (depth - j))) - 1)
        order = np.lexsort((digit, group[active]))
        active, digit = active[order], digit[order]
        g = group[active]
        new = np.ones(len(active), bool)
        new[1:] = (g[1:] != g[:-1]) | (digit[1:] != digit[:-1])
        cuts = np.flatnonzero(new)
        if not len(cuts):
            return least
        low, high = np.minimum.reduceat(owner[active], cuts), np.maximum.reduceat(owner[active], cuts)
        size = np.diff(np.append(cuts, len(active)))
        stays = np.repeat(low != high, size)
        group = group.copy()
        group[active] = np.repeat(np.arange(len(cuts)), size)
        if j + 8 >= depth:
            least[active] = np.repeat(low, size)
        active = active[stays]
    return least


def spans_of(flags: np.ndarray) -> list[tuple[int, int]]:
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist()))


def repeated_starts(docs: DataFrame, digits: DataFrame, depth: int, buckets: int, out_buckets: int,
                    frequent: np.ndarray) -> DataFrame:
    """(doc_id, rk, first, last): ranges of window starts that also start in a
    document with a smaller id."""
    per_doc = digits.groupBy("doc_id", "rk").agg(
        F.collect_list("digit").alias("shared"))
    # a left join on the same columns as the last one, so that one exchange of
    # the texts serves both; documents without shared digits leave in the task
    near = docs.join(per_doc, ["doc_id", "rk"], "left").select("doc_id", "text", "rk", "shared")

    def flush(ids, keys, runs):
        """runs: (doc, digit, pos, count, sizes, bytes) of several slices."""
        doc, digit, pos, count = (np.concatenate([r[k] for r in runs]) for k in range(4))
        size = count + depth - 1
        buf = np.concatenate([r[4] for r in runs])
        offset = np.cumsum(size) - size
        b = (digit % np.uint64(out_buckets)).astype(np.int64)
        order = np.argsort(b, kind="stable")
        cuts = np.append(np.flatnonzero(np.diff(b[order], prepend=-1)), len(order))
        for a, z in zip(cuts, cuts[1:]):
            o = order[a:z]
            used, local = np.unique(doc[o], return_inverse=True)
            raw = gathered(buf, offset[o], size[o]).tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([b[o[0]]], pa.int32()), *(pa.array([squeezed(x)], pa.binary()) for x in packed(
                    [ids[used], keys[used], local.astype(np.uint32), (digit[o] // np.uint64(out_buckets)).astype(np.uint32),
                     pos[o].astype(np.int64), count[o].astype(np.uint8)])),
                 pa.array([squeezed(raw)], pa.binary())],
                ["bucket", "ids", "keys", "doc", "digit", "pos", "count", "bytes"])

    def decided(ids, keys, doc, pos):
        """Windows settled inside a batch, as ranges, marked by bucket -1 - k."""
        order = np.lexsort((pos, doc))
        doc, pos = doc[order], pos[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1] + 1)
        cuts = np.flatnonzero(new)
        last = np.append(cuts[1:], len(doc)) - 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1 - int(ids[doc[0]] % out_buckets)], pa.int32()), *(pa.array([squeezed(x)], pa.binary()) for x in packed(
                [ids[doc[cuts]], keys[doc[cuts]], np.empty(0), np.empty(0), pos[cuts].astype(np.int64),
                 pos[last].astype(np.int64)])), pa.array([b""], pa.binary())],
            ["bucket", "ids", "keys", "doc", "digit", "pos", "count", "bytes"])

    def single_windows(raws_buf, starts, r, pick, ids, base):
        """Windows of frequent runs: equal ones of the slice are merged to their
        smallest owner; returns (kept windows, settled windows)."""
        n = r.count[pick]
        doc = np.repeat(r.doc[pick], n)
        pos = np.repeat(r.pos[pick], n) + np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
        at = starts[doc] + pos
        window = np.ascontiguousarray(raws_buf[at[:, None] + np.arange(depth)])
        owner = ids[base + doc]
        key = window.view(f"V{depth}").ravel()
        _, first, same = np.unique(key, return_index=True, return_inverse=True)
        least = np.full(len(first), np.iinfo(np.int64).max)
        np.minimum.at(least, same, owner)
        settled = owner > least[same]
        order = np.lexsort((np.arange(len(doc)), settled))
        _, one = np.unique(same[order], return_index=True)
        keep = order[one]  # one window of the smallest owner; its twins in that text follow
        twins = np.setdiff1d(np.flatnonzero(~settled), keep)
        keep = np.sort(np.concatenate([keep, twins]))
        full = np.zeros(len(keep), np.uint64)
        words = words_at(np.concatenate([window[keep].ravel(), np.zeros(8, np.uint8)]))
        lead = np.arange(len(keep)) * depth
        for j in range(0, depth, 8):
            d = words[lead + j]
            full = mixed(full * C2 ^ (d if depth - j >= 8 else d & np.uint64((1 << (8 * (depth - j))) - 1)) * C1)
        return (doc[keep], full, pos[keep], window[keep]), (doc[settled], pos[settled])

    def deal(batches):
        ids: list = []
        keys: list = []
        runs: list = []
        held = 0
        for b in batches:
            if not len(frequent):
                b = b.filter(pc.is_valid(b.column(3)))
            for part in batches_of(b):
                raws = utf8(part.column(1).to_pylist())
                r = Runs(raws, depth)
                wanted = [np.array(x or [], np.int64).astype(np.uint64) for x in part.column(3).to_pylist()]
                # the 32 bits kept of a digit, per document
                short = ((r.digit // np.uint64(buckets)).astype(np.uint32).astype(np.uint64) * np.uint64(buckets)
                         + r.digit % np.uint64(buckets))
                common = np.isin(r.digit, frequent)
                keep = np.zeros(len(short), bool)
                edges = np.searchsorted(r.doc, np.arange(len(raws) + 1))
                for i, w in enumerate(wanted):
                    if len(w):
                        keep[edges[i]:edges[i + 1]] = np.isin(short[edges[i]:edges[i + 1]], w)
                keep &= ~common
                base = len(ids)
                ids += part.column(0).to_pylist()
                keys += part.column(2).to_pylist()
                buf = np.frombuffer(b"".join(raws), np.uint8)
                sizes = np.array([len(x) for x in raws])
                starts = np.cumsum(sizes) - sizes
                if keep.any():
                    at = starts[r.doc[keep]] + r.pos[keep]
                    runs.append((r.doc[keep] + base, r.digit[keep], r.pos[keep], r.count[keep],
                                 gathered(buf, at, r.count[keep] + depth - 1)))
                    held += int(keep.sum())
                if common.any():
                    id_arr, key_arr = np.array(ids, np.int64), np.array(keys, np.uint32)
                    picks = np.flatnonzero(common)
                    for s in range(0, len(picks), 4096):
                        (d, h, p, w), (sd, sp) = single_windows(buf, starts, r, picks[s:s + 4096], id_arr, base)
                        runs.append((d + base, h, p, np.ones(len(d), np.int64), w.ravel()))
                        held += 4 * len(d)
                        if len(sd):
                            yield from decided(id_arr, key_arr, sd + base, sp)
                if held >= FLUSH // 4:
                    yield from flush(np.array(ids, np.int64), np.array(keys, np.uint32), runs)
                    ids, keys, runs, held = [], [], [], 0
        if runs:
            yield from flush(np.array(ids, np.int64), np.array(keys, np.uint32), runs)

    def rows(doc_id, rk, first, last):
        return pa.table({"doc_id": pa.array(doc_id, pa.int64()), "rk": pa.array(rk, pa.int64()),
                         "first": pa.array(first, pa.int64()), "last": pa.array(last, pa.int64())})

    def settle(table: pa.Table) -> pa.Table:
        if table["bucket"][0].as_py() < 0:
            parts = [[unsqueezed(r[c], t) for c, t in (("ids", np.int64), ("keys", np.uint32), ("pos", np.int64),
                                                          ("count", np.int64))] for r in table.to_pylist()]
            ids, keys, first, last = (np.concatenate([p[k] for p in parts]) for k in range(4))
            return rows(ids, keys.astype(np.int64), first, last)
        # runs of equal bytes are one content, owned by its smallest document
        content: dict[tuple[int, bytes], int] = {}
        least: list[int] = []
        owner, key, pos, count, of = [], [], [], [], []
        for r in table.to_pylist():
            ids, rks = unsqueezed(r["ids"], np.int64), unsqueezed(r["keys"], np.uint32)
            doc = unsqueezed(r["doc"], np.uint32)
            n = unsqueezed(r["count"], np.uint8).astype(np.int64)
            raw = zstandard.decompress(r["bytes"])
            ends = np.cumsum(n + depth - 1)
            names = ids[doc].tolist()
            which = []
            for d, a, z, i in zip(unsqueezed(r["digit"], np.uint32).tolist(), (ends - n - depth + 1).tolist(),
                                  ends.tolist(), names):
                c = content.setdefault((d, raw[a:z]), len(least))
                if c == len(least):
                    least.append(i)
                elif i < least[c]:
                    least[c] = i
                which.append(c)
            owner.append(ids[doc])
            key.append(rks[doc])
            pos.append(unsqueezed(r["pos"], np.int64))
            count.append(n)
            of.append(np.array(which, np.int64))
        owner, key, pos, count, of = (np.concatenate(x) for x in (owner, key, pos, count, of))
        low = np.array(least, np.int64)
        later = owner > low[of]
        out = [(owner[later], key[later], pos[later], pos[later] + count[later] - 1)]
        # different contents under one digit: order their windows
        digit = np.array([d for d, _ in content], np.int64)
        order = np.argsort(digit, kind="stable")
        cuts = np.append(np.flatnonzero(np.diff(digit[order], prepend=-1)), len(order))
        texts = [t for _, t in content]
        mine: dict[int, list[tuple[int, int]]] = {}
        at = 0
        while at < len(cuts) - 1:
            end, held, group = at, 0, []
            while end < len(cuts) - 1 and held < 1_000_000:
                g = order[cuts[end]:cuts[end + 1]]
                if len(g) > 1 and low[g].min() != low[g].max():
                    group.append(g)
                    held += sum(len(texts[c]) - depth + 1 for c in g)
                end += 1
            if group:
                members = np.concatenate(group)
                raw = np.frombuffer(b"".join(texts[c] for c in members), np.uint8)
                size = np.array([len(texts[c]) for c in members])
                n = size - depth + 1
                which = np.repeat(np.arange(len(members)), n)
                begin = np.cumsum(n) - n
                where = (np.cumsum(size) - size)[which] + np.arange(len(which)) - begin[which]
                label = np.repeat(np.repeat(np.arange(len(group)), [len(g) for g in group]), n)
                flags = equal_windows(raw, where, label, low[members][which], depth) < low[members][which]
                for k in np.unique(which[flags]):
                    mine[int(members[k])] = spans_of(flags[begin[k]:begin[k] + n[k]])
            at = end
        if mine:
            hit = np.isin(of, np.fromiter(mine, np.int64)) & ~later
            extra = [(o, k, p + a, p + z) for o, k, p, c in zip(
                owner[hit].tolist(), key[hit].tolist(), pos[hit].tolist(), of[hit].tolist()) for a, z in mine[c]]
            if extra:
                out.append(tuple(np.array(x) for x in zip(*extra)))
        doc_id, rk, first, last = (np.concatenate([x[k] for x in out]) for k in range(4))
        return rows(doc_id, rk.astype(np.int64), first, last)

    dealt = near.mapInArrow(deal, "bucket int, ids binary, keys binary, doc binary, digit binary, pos binary, "
                                  "count binary, bytes binary")
    return dealt.groupBy("bucket").applyInArrow(settle, "doc_id long, rk long, first long, last long")


def without_ranges(raw: bytes, ranges: list[tuple[int, int]], depth: int) -> tuple[bytes, list[tuple[int, int]]]:
    """(kept bytes, removed spans [start, end)) after removing every byte
    covered by a window that starts in one of the ranges."""
    spans: list[tuple[int, int]] = []
    for first, last in sorted(ranges):
        a, z = first, last + depth
        if spans and a <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(z, spans[-1][1]))
        else:
            spans.append((a, z))
    kept, at = [], 0
    for a, z in spans:
        kept.append(raw[at:a])
        at = z
    kept.append(raw[at:])
    return b"".join(kept), spans


def remove_repeats(docs: DataFrame, depth: int = 50, id_col: str = "doc_id", text_col: str = "text",
                   bucket_bytes: int = 16 << 20, sample_one_in: int = 64, frequent_share: float = 0.02,
                   frequent_least: int = 50) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans array<struct<start, end>>, kept
    binary), one row per row of ``docs``.

    A null text is empty; texts shorter than ``depth`` bytes are kept whole.  A
    null id is neither smaller nor larger than any other: such rows stay whole
    and remove nothing.  Rows that repeat an id are one document and do not
    remove each other, but each is judged on its own text.  An empty table
    gives an empty table.  ``depth`` is at least 17 bytes."""
    if depth < GRAM + 1:
        raise ValueError(f"depth must be at least {GRAM + 1}")
    # no alias on a plain id: the optimizer drops it on one side of the two joins
    # below only, and their equal exchanges would no longer be seen as one
    plain = id_col == "doc_id" and docs.schema[id_col].dataType.simpleString() == "bigint"
    own = docs.select(F.col(id_col) if plain else F.col(id_col).cast("long").alias("doc_id"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    own = own.withColumn("rk", F.crc32(F.col("text").cast("binary")))
    size = own.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("b")).first()
    out_buckets = max(1, -(-(size.b or 0) // bucket_bytes))
    buckets = max(1, -(-out_buckets // 4))
    named = own.filter("doc_id IS NOT NULL").select("doc_id", "text", "rk")
    spread = spread_scan(named)
    frequent = frequent_digits(spread, depth, size.n, sample_one_in, frequent_share, frequent_least)
    digits = shared_digits(spread, depth, buckets, frequent)
    starts = repeated_starts(named, digits, depth, buckets, out_buckets, frequent)
    ranges = starts.groupBy("doc_id", "rk").agg(F.collect_set(F.struct("first", "last")).alias("ranges"))
    nameless = own.filter("doc_id IS NULL").select(
        "doc_id", "text", F.lit(None).cast(ranges.schema["ranges"].dataType).alias("ranges"))
    joined = named.join(ranges, ["doc_id", "rk"], "left").select("doc_id", "text", "ranges").union(nameless)

    def cut(batches):
        for b in batches:
            for s in range(0, b.num_rows, 256):
                part = b.slice(s, 256)
                sizes, removed, spans, kept = [], [], [], []
                for t, r in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    raw = t.encode("utf-8")
                    left, gone = without_ranges(raw, [(x["first"], x["last"]) for x in r or []], depth)
                    sizes.append(len(raw))
                    removed.append(len(raw) - len(left))
                    spans.append([{"start": a, "end": z} for a, z in gone])
                    kept.append(left)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                     pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "n_removed", "spans", "kept"])

    return joined.mapInArrow(cut, "doc_id long, n_bytes long, n_removed long, "
                                  "spans array<struct<start:long,end:long>>, kept binary")
