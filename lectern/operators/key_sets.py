"""Sets of citekeys as bitmaps over their numbers.

Keys are numbered in order, without a gap; a set is a bitmap for each 32,768
numbers, built and merged by aggregates. What a dossier has not considered is the
complement of what it mentions: runs of numbers, as many as it mentions keys and
one more, not a row for each key of the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.operators.graph import kept

#: Numbers a bitmap covers: what ``bitmap_construct_agg`` fills.
BITS = 32_768


def numbered(keys: DataFrame) -> DataFrame:
    """citekey and n, its place from 0 on, of each different key."""
    ranged = keys.where("citekey is not null").select("citekey").distinct().repartitionByRange("citekey").sortWithinPartitions("citekey")
    rows = kept(ranged.withColumn("at", F.monotonically_increasing_id()), "numbers")
    part = F.shiftright("at", 33)
    sizes = rows.groupBy(part.alias("part")).agg(F.count("*").alias("size")).orderBy("part").collect()  # a row a partition
    firsts, first = [], 0
    for r in sizes:
        firsts.append((r["part"], first))
        first += r["size"]
    starts = F.broadcast(rows.sparkSession.createDataFrame(firsts, "part long, first long"))
    return rows.withColumn("part", part).join(starts, "part").select("citekey", (F.col("first") + F.col("at").bitwiseAND((1 << 33) - 1)).alias("n"))


def bitmaps(rows: DataFrame, *by: str) -> DataFrame:
    """The groups' bitmaps: ``by``, bucket, bits. ``rows``: ``by`` and n."""
    return rows.groupBy(*by, F.floor(F.col("n") / BITS).alias("bucket")).agg(F.call_function("bitmap_construct_agg", F.col("n") % BITS).alias("bits"))


def merged(sets: DataFrame, *by: str) -> DataFrame:
    """The unions of bitmaps."""
    return sets.groupBy(*by, "bucket").agg(F.call_function("bitmap_or_agg", F.col("bits")).alias("bits"))


def sizes(sets: DataFrame, *by: str) -> DataFrame:
    return sets.groupBy(*by).agg(F.sum(F.call_function("bitmap_count", F.col("bits"))).alias("n"))


def _runs(bits: bytes) -> tuple[np.ndarray, np.ndarray]:
    """First and last places of the runs of ones."""
    on = np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")
    edge = np.diff(np.concatenate([[0], on, [0]]).astype(np.int8))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


def complements(groups: DataFrame, sets: DataFrame, by: str, total: int) -> DataFrame:
    """``by``, first, last: the runs of numbers below ``total`` that each group's set lacks. A group without a set lacks all."""
    schema = f"{by} {groups.schema[by].dataType.simpleString()}, first long, last long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (bucket, bits) in enumerate(zip(batch.column("bucket").to_pylist(), batch.column("bits").to_pylist(), strict=True)):
                a, b = _runs(bits)
                yield pa.RecordBatch.from_arrays([batch.column(by).take(pa.array(np.full(len(a), i))), pa.array(a + bucket * BITS), pa.array(b + bucket * BITS)], names=[by, "first", "last"])

    has = sets.select(by, "bucket", "bits").mapInArrow(run, schema)
    edges = groups.select(by, F.lit(total).cast("long").alias("first"), F.lit(total).cast("long").alias("last"))  # the end of every group's numbers
    order = Window.partitionBy(by).orderBy("first")
    gaps = has.unionByName(edges).withColumn("from", F.coalesce(F.lag("last").over(order) + 1, F.lit(0).cast("long")))
    return gaps.where(F.col("from") < F.col("first")).select(by, F.col("from").alias("first"), (F.col("first") - 1).alias("last"))


def unconsidered(known: DataFrame, dossiers: DataFrame, mentioned: DataFrame) -> DataFrame:
    """dossier, from_key, to_key, n: the known keys that each dossier mentions nowhere, as runs in key order.

    ``dossiers``: dossier; ``mentioned``: dossier, citekey. Mentions of unknown keys count for nothing.
    """
    numbers = kept(numbered(known), "numbered")
    total = numbers.count()
    own = bitmaps(mentioned.select("dossier", "citekey").join(numbers, "citekey").select("dossier", "n"), "dossier")
    runs = complements(dossiers.select("dossier").distinct(), own, "dossier", total)
    low, high = numbers.select(F.col("n").alias("first"), F.col("citekey").alias("from_key")), numbers.select(F.col("n").alias("last"), F.col("citekey").alias("to_key"))
    return runs.join(low, "first").join(high, "last").select("dossier", "from_key", "to_key", (F.col("last") - F.col("first") + 1).alias("n"))


def members(runs: DataFrame, known: DataFrame) -> DataFrame:
    """dossier and citekey of runs, spelt out for those who want every key."""
    numbers = kept(numbered(known), "numbered")
    low, high = (numbers.select(F.col("citekey").alias(c), F.col("n").alias(n)) for c, n in (("from_key", "first"), ("to_key", "last")))
    every = runs.join(low, "from_key").join(high, "to_key").select("dossier", F.explode(F.sequence("first", "last")).alias("n"))
    return every.join(numbers, "n").select("dossier", "citekey")
