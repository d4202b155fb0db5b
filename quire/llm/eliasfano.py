"""Token-id files with Elias-Fano document boundaries.

Documents are sorted by id over range partitions; every partition becomes a
shard of segments.  A segment is one record: the concatenated ids of up to
``max_docs`` documents (16 bits an id where the vocabulary allows), the
document ends as an Elias-Fano sequence, and the document ids as another.  An
Elias-Fano sequence of n values below u keeps floor(log2(u / n)) low bits of
each value as they are and the high parts in unary, about 2 + log2(u / n) bits a
value; the position of every 64th one bit is kept so that ``select`` finds a
single value without decoding the rest.

Records are written by Spark's Parquet writer (atomic per task, any store) and
read back as records; a reader decodes one segment at a time.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch_path
from .tokens import encoder

SAMPLE = 64


class EliasFano:
    """A non-decreasing sequence of n values in [0, top]."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, samples: bytes):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        v = np.asarray(values, np.uint64)
        n = len(v)
        if n == 0:
            return cls(0, 0, b"", b"", b"")
        width = max(0, (int(v[-1]) // n).bit_length() - 1)
        bits = (v[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
        ones = (v >> np.uint64(width)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(ones[-1]) + 1, np.uint8)
        unary[ones] = 1
        return cls(n, width, low, np.packbits(unary, bitorder="little").tobytes(),
                   ones[::SAMPLE].astype("<u4").tobytes())

    def _low(self, i: int) -> int:
        a = i * self.low_bits
        chunk = int.from_bytes(self.low[a >> 3:(a + self.low_bits + 7) >> 3], "little")
        return (chunk >> (a & 7)) & ((1 << self.low_bits) - 1)

    def select(self, i: int) -> int:
        """The i-th value: from the sampled one bit before it, count forward."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at = int.from_bytes(self.samples[4 * (i // SAMPLE):4 * (i // SAMPLE) + 4], "little")
        need = i % SAMPLE
        byte, first = at >> 3, at & 7
        word = self.high[byte] >> first << first
        while need >= word.bit_count():
            need -= word.bit_count()
            byte += 1
            word = self.high[byte]
        for _ in range(need):
            word &= word - 1
        pos = 8 * byte + (word & -word).bit_length() - 1
        return ((pos - i) << self.low_bits) | self._low(i)

    def values(self) -> np.ndarray:
        if self.n == 0:
            return np.empty(0, np.uint64)
        ones = np.flatnonzero(np.unpackbits(np.frombuffer(self.high, np.uint8), bitorder="little"))[:self.n]
        high = (ones - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if not self.low_bits:
            return high
        bits = np.unpackbits(np.frombuffer(self.low, np.uint8), count=self.n * self.low_bits,
                             bitorder="little").reshape(self.n, self.low_bits)
        low = (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return high | low


EF = "struct<n:long,low_bits:int,low:binary,high:binary,samples:binary>"
RECORD = (f"shard int, segment int, n_docs long, n_ids long, id_bytes int, ids binary, ends {EF}, "
          f"n_null long, base_id long, doc_ids {EF}")
EF_ARROW = pa.struct([("n", pa.int64()), ("low_bits", pa.int32()), ("low", pa.binary()),
                      ("high", pa.binary()), ("samples", pa.binary())])
RECORD_ARROW = pa.schema([
    ("shard", pa.int32()), ("segment", pa.int32()), ("n_docs", pa.int64()), ("n_ids", pa.int64()),
    ("id_bytes", pa.int32()), ("ids", pa.binary()), ("ends", EF_ARROW), ("n_null", pa.int64()),
    ("base_id", pa.int64()), ("doc_ids", EF_ARROW)])


def write_token_files(docs: DataFrame, path: str, vocabulary: str, end_id: int, id_col: str = "doc_id",
                      text_col: str = "text", max_docs: int = 65_536, max_ids: int = 2_000_000) -> None:
    """Write the ids of all texts, each followed by ``end_id``, in ascending id
    order (rows of one id in text order, null ids first; a null text is
    empty).  A single longer document makes a segment of its own."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = slim.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    def run(batches):
        enc = encoder(vocabulary)
        end = np.array([end_id], enc.dtype).tobytes()
        shard, segment = TaskContext.get().partitionId(), 0
        names: list = []
        raws: list[bytes] = []
        held = 0

        def record():
            sizes = np.array([len(r) // enc.dtype.itemsize for r in raws], np.int64)
            known = np.array([x for x in names if x is not None], np.int64)
            base = int(known[0]) if len(known) else 0
            ends, ids = EliasFano.of(np.cumsum(sizes)), EliasFano.of(known.view(np.uint64) - np.uint64(base % 2**64))
            row = {"shard": shard, "segment": segment, "n_docs": len(raws), "n_ids": int(sizes.sum()),
                   "id_bytes": enc.dtype.itemsize, "ids": b"".join(raws), "ends": vars(ends),
                   "n_null": len(names) - len(known), "base_id": base, "doc_ids": vars(ids)}
            return pa.RecordBatch.from_pylist([row], RECORD_ARROW)

        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1)
            for s in range(0, len(ids), 1024):
                for name, raw in zip(ids[s:s + 1024], enc.encode(texts[s:s + 1024].to_pylist())):
                    raw += end
                    size = len(raw) // enc.dtype.itemsize
                    if raws and (len(raws) >= max_docs or held + size > max_ids):
                        yield record()
                        names, raws, held, segment = [], [], 0, segment + 1
                    names.append(name)
                    raws.append(raw)
                    held += size
        if raws:
            yield record()

    ordered.mapInArrow(run, RECORD).write.parquet(path)


def read_token_files(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, shard, segment) per document, from
    the files alone; ``start`` counts the ids of all documents before it."""
    records = spark.read.schema(RECORD).parquet(path)

    def run(batches):
        for b in batches:
            for i in range(b.num_rows):
                r = b.slice(i, 1).to_pylist()[0]
                ids = np.frombuffer(r["ids"], f"<u{r['id_bytes']}").astype("<u4")
                ends = EliasFano(**r["ends"]).values().astype(np.int64)
                starts = np.concatenate([[0], ends[:-1]])
                raw = memoryview(ids.tobytes())
                names = (EliasFano(**r["doc_ids"]).values() + np.uint64(r["base_id"] % 2**64)).view(np.int64)
                crc = [zlib.crc32(raw[4 * a:4 * z]) for a, z in zip(starts.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["shard"]] * len(ends), pa.int32()), pa.array([r["segment"]] * len(ends), pa.int32()),
                     pa.array([None] * r["n_null"] + names.tolist(), pa.int64()),
                     pa.array(starts), pa.array(ends - starts), pa.array(crc, pa.int64())],
                    ["shard", "segment", "doc_id", "local_start", "n_tokens", "ids_crc32"])

    per_doc = records.select(*[f.name for f in records.schema]).mapInArrow(
        run, "shard int, segment int, doc_id long, local_start long, n_tokens long, ids_crc32 long")
    sizes = records.select("shard", "segment", "n_ids")
    before = lambda *keys: Window.orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    # one row per shard (as many as partitions) in one window, then within shards
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(before("shard")), F.lit(0)).alias("shard_base"))
    inner = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    bases = (sizes.withColumn("inner", F.coalesce(F.sum("n_ids").over(inner), F.lit(0)))
             .join(shards, "shard").select("shard", "segment", (F.col("shard_base") + F.col("inner")).alias("base")))
    return per_doc.join(bases, ["shard", "segment"]).select(
        "doc_id", (F.col("base") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32", "shard", "segment")


def token_files(docs: DataFrame, vocabulary: str, end_id: int, path: str | None = None, **kw) -> DataFrame:
    """Write ``docs`` to ``path`` (default: the shared checkpoint folder) and
    read the files back.  One row per row of ``docs``; no documents give files
    without records and an empty table."""
    path = path or scratch_path(docs, "token-files")
    write_token_files(docs, path, vocabulary, end_id, **kw)
    return read_token_files(docs.sparkSession, path)
