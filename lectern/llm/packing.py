"""Best-fit packing of token pieces into sequences, planned on a length histogram.

Only the counts of each length reach the driver (at most ``capacity`` rows, at
any size of the corpus). There, linear grouping rounds the large lengths up
within groups of about equal cardinality, few-size configurations are chosen
for the rounded lengths, actual lengths replace the rounded ones, and best fit
places the small lengths in the gaps. Best fit alone is planned too, and taken if
it needs fewer sequences. The plan is a list of bin templates with
multiplicities; Spark ranks the pieces of each length and joins rank ranges to
template slots. Ranks are counted in hashed buckets, so one frequent length
never meets in one task.

Defined results: a null text is one end id; empty tables give no rows; repeated
rows are packed each; ties are ordered by doc_id, piece and checksum; other
columns are ignored, a null doc_id is packed like any other.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm.common import materialize, text_slices
from lectern.llm.tokens import END_ID, default_path, encoder


def token_pieces(docs: DataFrame, capacity: int = 1024, tokenizer: str | None = None, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Cut each document's ids into pieces of ``capacity``; the first takes the remainder."""
    tokenizer = tokenizer or default_path()
    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    if with_ids:
        fields.append(("ids", pa.binary()))
        schema += ", ids binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for rows in text_slices(batch, limit=2 << 20):
                out = []
                ids, bounds = encoder(tokenizer).encode_column(rows.column(1))
                for d, low, high in zip(rows.column(0).to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                    raw = memoryview(ids[low:high].tobytes() + end)
                    n = len(raw) // 4
                    cuts = [0, *range(n % capacity or min(n, capacity), n + 1, capacity)]
                    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):  # noqa: B905
                        piece = raw[4 * a : 4 * b]
                        out.append((d, k, a, b - a, zlib.crc32(piece)) + ((bytes(piece),) if with_ids else ()))
                yield pa.RecordBatch.from_arrays([pa.array(c, f[1]) for c, f in zip(zip(*out, strict=True), fields, strict=True)], schema=pa.schema(fields))

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, schema)


def linear_groups(counts: dict[int, int], groups: int) -> list[tuple[int, list[int]]]:
    """Groups of lengths, largest first, of about equal cardinality: (rounded length, members)."""
    quota, out, held = max(1, -(-sum(counts.values()) // groups)), [], 0
    for length in sorted(counts, reverse=True):
        if not out or held + counts[length] > quota and held:
            out.append((length, []))
            held = 0
        out[-1][1].append(length)
        held += counts[length]
    return out


def configurations(counts: dict[int, int], capacity: int, most: int = 4) -> list[tuple[tuple[int, ...], int]]:
    """Use up rounded lengths by configurations of at most ``most`` sizes, each any number of times, fullest first for the largest left."""
    left, out = dict(counts), []
    while left:
        size = max(left)
        left[size] -= 1
        runs = [(s, s * m) for s in sorted(left, reverse=True) for m in range(1, min(left[s], (capacity - size) // s) + 1)]
        left[size] += 1
        reach = [1]
        limit = (1 << (capacity - size + 1)) - 1
        for _ in range(most - 1):
            sums = 0
            for _, width in runs:
                sums |= reach[-1] << width
            reach.append(sums & limit)
        total, k = max((r.bit_length() - 1, -k) for k, r in enumerate(reach) if r)
        config, k = [size], -k
        while k:
            s, width = next((s, width) for s, width in runs if width <= total and reach[k - 1] >> (total - width) & 1)
            config += [s] * (width // s)
            total, k = total - width, k - 1
        times = min(left[s] // n for s, n in Counter(config).items())
        while not times:  # a length was taken more often than it is there: fit what is there
            config.pop()
            times = min(left[s] // n for s, n in Counter(config).items())
        out.append((tuple(config), times))
        for s, n in Counter(config).items():
            left[s] -= n * times
            if not left[s]:
                del left[s]
    return out


def plan_bins(counts: dict[int, int], capacity: int, small: int | None = None, groups: int = 400) -> dict[tuple[int, ...], int]:
    """Bin templates (actual lengths in place order) and how often each is used."""
    small = capacity // 8 if small is None else small
    large = {s: n for s, n in counts.items() if s > small}
    grouped = linear_groups(large, groups)
    stock = {size: [[s, large[s]] for s in members] for size, members in grouped}
    bins: dict[tuple[int, ...], int] = defaultdict(int)
    for config, times in configurations({size: sum(large[s] for s in m) for size, m in grouped}, capacity):
        slots = []
        for size in config:  # actual lengths take the places of the rounded one
            runs, need = [], times
            while need:
                head = stock[size][0]
                n = min(need, head[1])
                runs.append([head[0], n])
                need, head[1] = need - n, head[1] - n
                if not head[1]:
                    stock[size].pop(0)
            slots.append(runs)
        while slots[0]:
            n = min(r[0][1] for r in slots)
            bins[tuple(r[0][0] for r in slots)] += n
            for r in slots:
                r[0][1] -= n
                if not r[0][1]:
                    r.pop(0)
    gaps: dict[int, dict[tuple[int, ...], int]] = defaultdict(dict)
    for lengths, n in bins.items():
        gaps[capacity - sum(lengths)][lengths] = n
    for s in sorted((s for s in counts if s <= small), reverse=True):
        n = counts[s]
        while n:
            gap = min((g for g in gaps if g >= s), default=None)
            if gap is None:
                per = min(n, capacity // s)
                gaps[capacity - per * s][(s,) * per] = gaps[capacity - per * s].get((s,) * per, 0) + n // per
                n -= n // per * per
                continue
            lengths, there = gaps[gap].popitem()
            if not gaps[gap]:
                del gaps[gap]
            used = min(n, there)
            if there > used:
                gaps[gap][lengths] = there - used
            fuller = (*lengths, s)
            gaps[gap - s][fuller] = gaps[gap - s].get(fuller, 0) + used
            n -= used
    plan = {lengths: n for g in gaps.values() for lengths, n in g.items()}
    plain = plan_bins(counts, capacity, capacity) if small < capacity else plan
    return min(plan, plain, key=lambda p: sum(p.values()))


def slot_ranges(templates: dict[tuple[int, ...], int]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, rank after the last, first sequence, offset) of each slot of each template."""
    used, rows, sequence = Counter(), [], 0
    for lengths, n in sorted(templates.items()):
        offset = 0
        for s in lengths:
            rows.append((s, used[s], used[s] + n, sequence, offset))
            used[s] += n
            offset += s
        sequence += n
    return rows


def pack(pieces: DataFrame, capacity: int = 1024, small: int | None = None, groups: int = 400, order: tuple[str, ...] = ("doc_id", "piece", "ids_crc32")) -> DataFrame:
    """Add sequence_id and offset to ``pieces`` (a column ``length`` of 1 to ``capacity``).

    The histogram has ``capacity`` rows at most, the slot ranges a bounded
    number for each pair of lengths; both are independent of the row count, and
    the latter are broadcast.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    slots = spark.createDataFrame(slot_ranges(plan_bins(counts, capacity, small, groups)), "slot_length long, low long, high long, first long, offset long")
    buckets = max(64, sum(counts.values()) // 50_000)
    pieces = pieces.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = pieces.groupBy("length", "_bucket").count().select("length", "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("length", "_bucket").orderBy(*order)
    ranked = pieces.withColumn("_rank", F.row_number().over(within) - 1).join(base, ["length", "_bucket"]).withColumn("_rank", F.col("_base") + F.col("_rank"))
    placed = ranked.join(F.broadcast(slots), (F.col("length") == F.col("slot_length")) & (F.col("_rank") >= F.col("low")) & (F.col("_rank") < F.col("high")))
    return placed.withColumn("sequence_id", F.col("first") + F.col("_rank") - F.col("low")).drop("_bucket", "_base", "_rank", "slot_length", "low", "high", "first")


def pack_documents(docs: DataFrame, capacity: int = 1024, tokenizer: str | None = None) -> DataFrame:
    """Cut and pack the documents (doc_id, text); one row a piece."""
    pieces = materialize(token_pieces(docs, capacity, tokenizer), "pieces")
    return pack(pieces, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of at most 1024 ids."""
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
