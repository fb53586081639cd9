"""Helpers shared by the training-data operators: shared scratch tables,
row keys, Arrow slicing and vectorised word hashing."""

from __future__ import annotations

import tempfile
import uuid
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are maximal runs of anything but these six ASCII separators.
SEPARATORS = b" \t\n\x0b\x0c\r"
SPLIT_WORDS = "[\\x20\\x09-\\x0D]+"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder that ``spark.checkpoint.dir`` names.

    Only a local session without that setting gets a folder of its own.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext._conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/lectern/{label}-{uuid.uuid4().hex}"


#: Spark's own setting: a finished execution's shuffle files go at once.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write ``df`` to a shared table and read it back.

    A step's shuffle files need not lie beside the next step's.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    _paths[out] = path
    return out


def drop_tables(*tables: DataFrame) -> None:
    """Delete tables of ``materialize`` that nothing reads any more."""
    for table in tables:
        path = _paths.pop(table, None)
        if path:
            remove_path(table.sparkSession, path)


def remove_path(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text: str | Column = "text") -> Column:
    """Tells apart the rows of a doc_id that occurs with several texts."""
    return F.xxhash64(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")))


def words_of(text: Column) -> Column:
    """The words of a text as an array (null: none), JVM-side."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPLIT_WORDS), lambda w: w != "")


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = 1 << 20):
    """Cut a batch into runs of rows of about ``limit`` bytes of text each."""
    col = batch.column(batch.schema.get_field_index(column))
    n = len(col)
    if not n:
        return
    size = np.asarray(pc.fill_null(pc.binary_length(col), 0)).astype(np.int64)
    at = np.cumsum(size + 64)
    start = 0
    while start < n:
        base = at[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(at, base + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, and the offsets of its rows (null: empty)."""
    col = pc.fill_null(col, "").cast(pa.large_binary())
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64)[col.offset : col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, off - off[0]


_rng = np.random.default_rng(20240229)
_BYTES = _rng.integers(0, 1 << 64, 256, dtype=np.uint64)
#: Odd multipliers for hashing sequences of words.
SALTS = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 5
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over unsigned 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The base's powers, and those of its inverse modulo 2**64."""
    if len(_powers[0]) < n:
        size = 1 << max(n - 1, 1).bit_length()
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[k] = np.multiply.accumulate(p)
    return _powers[0], _powers[1]


def word_hashes(raw: np.ndarray, offsets: np.ndarray, lower: bool = False, separators: bytes = SEPARATORS):
    """Hash each word of each row of a text buffer.

    Returns (hashes, byte starts, byte ends, row bounds): row ``i`` has the
    words ``bounds[i]:bounds[i + 1]``. ``lower`` folds A-Z before hashing.
    """
    values, is_sep = _BYTES.copy(), np.zeros(256, bool)
    is_sep[list(separators)] = True
    if lower:
        values[65:91] = values[97:123]
    n = len(raw)
    if not n:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, np.zeros(len(offsets), np.int64)
    inside = ~is_sep[raw]
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    edges = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < n)]
    before[edges], after[edges - 1] = False, False
    starts, ends = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    pw, inverse = powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(values[raw] * pw[:n], out=total[1:])
    h = (total[ends] - total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * SALTS[63]
    return mix(h), starts, ends, np.searchsorted(starts, offsets)
