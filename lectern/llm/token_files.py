"""Token-id files with Elias-Fano document boundaries.

A corpus is written in ascending doc_id order as shard images. An image holds
the concatenated ids of its documents at the narrowest of 2 or 4 bytes an id,
and two Elias-Fano sequences: document ends, and doc_ids less the first. Both
take about 2 + log2(universe / n) bits a document; select samples give any
boundary without a table of 64-bit offsets. Images are rows of a Parquet table,
so that Spark's committer makes the write safe against lost executors.

Defined results: a null text is empty (one end id); a null doc_id sorts first;
repeated rows are kept, ties in doc_id ordered by text; an empty table gives no
shard; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm.common import scratch_path, text_slices
from lectern.llm.tokens import END_ID, default_path, encoder

MAGIC = b"LECTOK01"
HEADER = struct.Struct("<8sQQQqBxxxxxxx")
SAMPLE = 64
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
#: One bits of each byte, and the place of each one's n-th (8: there is none).
_ONES = _BITS.sum(axis=1).astype(np.int64)
_NTH = np.array([[*np.flatnonzero(b), *[8] * (8 - int(b.sum()))] for b in _BITS], np.int64)


def ef_encode(values: np.ndarray, universe: int) -> bytes:
    """Encode ascending unsigned values, none above ``universe``."""
    n = len(values)
    values = values.astype(np.uint64)
    low_bits = max(0, (universe // n).bit_length() - 1) if n else 0
    low = values & np.uint64((1 << low_bits) - 1)
    lows = np.packbits(((low[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8).ravel(), bitorder="little")
    at = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
    bits = np.zeros((universe >> low_bits) + n + 1, np.uint8)
    bits[at] = 1
    highs = np.packbits(bits, bitorder="little")
    samples = at[::SAMPLE].astype("<u8" if len(bits) >> 32 else "<u4")
    head = struct.pack("<QBBQQ", n, low_bits, samples.itemsize, len(lows), len(highs))
    return head + lows.tobytes() + highs.tobytes() + samples.tobytes()


class EliasFano:
    """Reads a sequence: one value by select, or all of them."""

    def __init__(self, raw: memoryview | bytes, at: int = 0):
        self.n, self.low_bits, width, n_low, n_high = struct.unpack_from("<QBBQQ", raw, at)
        at += struct.calcsize("<QBBQQ")
        self.lows = np.frombuffer(raw, np.uint8, n_low, at)
        self.highs = np.frombuffer(raw, np.uint8, n_high, at + n_low)
        count = -(-self.n // SAMPLE)
        self.samples = np.frombuffer(raw, f"<u{width}", count, at + n_low + n_high)
        self.end = at + n_low + n_high + count * width

    def _low(self, i: int) -> int:
        first = i * self.low_bits
        span = self.lows[first >> 3 : (first + self.low_bits + 7) >> 3].tobytes()
        return (int.from_bytes(span, "little") >> (first & 7)) & ((1 << self.low_bits) - 1)

    def __getitem__(self, i: int) -> int:
        """Select the i-th one bit from the nearest sample on."""
        pos, left = int(self.samples[i // SAMPLE]), i % SAMPLE
        while left:
            pos += 1
            left -= (int(self.highs[pos >> 3]) >> (pos & 7)) & 1
        return ((pos - i) << self.low_bits) | self._low(i)

    def select(self, at: np.ndarray) -> np.ndarray:
        """The values at many places: from each one's sample on, byte by byte, to the byte that holds its one bit."""
        at = np.asarray(at, np.int64)
        place = self.samples[at // SAMPLE].astype(np.int64)
        left = at % SAMPLE  # one bits to pass, from the sample's on
        byte = place >> 3
        value = self.highs[byte] & (0xFF << (place & 7)).astype(np.uint8) if len(at) else np.zeros(0, np.uint8)
        going = np.arange(len(at))
        while len(going):
            ones = _ONES[value[going]]
            on = left[going] >= ones
            left[going[on]] -= ones[on]
            going = going[on]
            byte[going] += 1
            value[going] = self.highs[byte[going]]
        out = ((byte << 3) + _NTH[value, left] - at).astype(np.uint64) << np.uint64(self.low_bits)
        for b in range(self.low_bits):
            bit = at * self.low_bits + b
            out |= ((self.lows[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1).astype(np.uint64) << np.uint64(b)
        return out

    def all(self) -> np.ndarray:
        at = np.flatnonzero(np.unpackbits(self.highs, bitorder="little"))[: self.n]
        out = (at - np.arange(self.n)).astype(np.uint64) << np.uint64(self.low_bits)
        if self.low_bits and self.n:
            bits = np.unpackbits(self.lows, bitorder="little")[: self.n * self.low_bits].reshape(self.n, self.low_bits)
            out |= (bits.astype(np.uint64) << np.arange(self.low_bits, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        return out


def shard_image(doc_ids: list[int | None], ids: list[bytes]) -> bytes:
    """The bytes of one shard; ``ids`` are unsigned 32-bit, little-endian, nulls stand first."""
    flat = np.frombuffer(b"".join(ids), "<u4")
    width = 2 if not len(flat) or int(flat.max()) < 1 << 16 else 4
    ends = np.cumsum([len(x) // 4 for x in ids], dtype=np.int64)
    nulls = sum(d is None for d in doc_ids)
    known = np.array(doc_ids[nulls:], np.int64)
    base = int(known[0]) if len(known) else 0
    gaps = known.astype(np.uint64) - np.uint64(base & (1 << 64) - 1)
    return b"".join(
        (
            HEADER.pack(MAGIC, len(ids), len(flat), nulls, base, width),
            ef_encode(ends, int(ends[-1]) if len(ends) else 0),
            ef_encode(gaps, int(gaps[-1]) if len(gaps) else 0),
            flat.astype(f"<u{width}").tobytes(),
        )
    )


class Shard:
    """A shard image, opened."""

    def __init__(self, raw: bytes | memoryview):
        magic, self.n_docs, self.n_tokens, self.nulls, self.base, self.width = HEADER.unpack_from(raw, 0)
        if magic != MAGIC:
            raise ValueError("not a token shard")
        self.ends = EliasFano(raw, HEADER.size)
        self.gaps = EliasFano(raw, self.ends.end)
        self.ids = np.frombuffer(raw, f"<u{self.width}", self.n_tokens, self.gaps.end)

    def doc_ids(self) -> list[int | None]:
        base = np.uint64(self.base & (1 << 64) - 1)
        return [None] * self.nulls + (self.gaps.all() + base).astype(np.int64).tolist()

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.ends[i - 1] if i else 0 : self.ends[i]]


SHARD_SCHEMA = "part int, seq int, n_docs long, n_tokens long, image binary"


def write_token_files(docs: DataFrame, path: str, tokenizer: str | None = None, shard_tokens: int = 2_000_000, end_id: int = END_ID) -> None:
    """Write ``docs`` (doc_id, text) as shards of about ``shard_tokens`` ids, in doc_id order."""
    tokenizer = tokenizer or default_path()

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, doc_ids, ids = TaskContext.get().partitionId(), 0, 0, [], []
        end = np.array([end_id], "<u4").tobytes()

        def flush():
            rows = {"part": [part], "seq": [seq], "n_docs": [len(ids)], "n_tokens": [held], "image": [shard_image(doc_ids, ids)]}
            return pa.RecordBatch.from_pydict(rows, pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("image", pa.binary())]))

        for batch in batches:
            for rows in text_slices(batch, limit=2 << 20):
                new, bounds = encoder(tokenizer).encode_column(rows.column(1))
                for d, a, b in zip(rows.column(0).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    doc_ids.append(d)
                    ids.append(new[a:b].tobytes() + end)
                    held += b - a + 1
                    if held >= shard_tokens:
                        yield flush()
                        seq, held, doc_ids, ids = seq + 1, 0, [], []
        if ids:
            yield flush()

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    ordered = ordered.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie", "text").select("doc_id", "text")
    ordered.mapInArrow(shards, SHARD_SCHEMA).write.option("compression", "zstd").parquet(path)


def read_token_files(spark: SparkSession, path: str, broadcast_shards: int = 1_000_000) -> DataFrame:
    """One row a document: doc_id, start, n_tokens, ids_crc32, as read from the shards.

    A shard's first position is the sum over earlier parts and earlier shards of
    its part. Those small figures are broadcast up to ``broadcast_shards`` rows;
    beyond, they are joined.
    """
    shards = spark.read.schema(SHARD_SCHEMA).parquet(path)
    sizes = shards.select("part", "seq", "n_tokens")
    totals = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n"), F.count("*").alias("k")).orderBy("part").collect()  # one row a partition
    bases, base = [], 0
    for r in totals:
        bases.append((r["part"], base))
        base += r["n"]
    own = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.join(F.broadcast(spark.createDataFrame(bases, "part int, base long")), "part")
    first = first.select("part", "seq", (F.col("base") + F.coalesce(F.sum("n_tokens").over(own), F.lit(0))).alias("first"))
    if sum(r["k"] for r in totals) <= broadcast_shards:
        first = F.broadcast(first)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, image in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                shard = Shard(image.as_buffer())
                ends = shard.ends.select(np.arange(shard.n_docs)).astype(np.int64)
                starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
                flat = memoryview(shard.ids.astype("<u4").view(np.uint8))
                crcs = [zlib.crc32(flat[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.doc_ids(), pa.int64()), pa.array(starts + first), pa.array(ends - starts), pa.array(crcs, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return shards.join(first, ["part", "seq"]).select("first", "image").mapInArrow(decode, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all documents as token files, read them back, and return each document's place and checksum."""
    path = scratch_path(spark, "token-files")
    write_token_files(spark.read.parquet(f"{sf_dir}/documents.parquet"), path)
    return read_token_files(spark, path)
