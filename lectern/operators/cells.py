"""Vectors dealt to cells, and searches that visit some or all of them.

Cells are the neighbourhoods of centres, fitted on a bounded sample; every vector
is dealt to one. Large cells are split, so a task holds a bounded number of
vectors, and queries stream past them: neither side goes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def matrix(col: pa.Array, unit: bool = False) -> np.ndarray:
    """The vectors of a list column; ``unit`` scales them to length one."""
    flat = np.asarray(col.flatten(), np.float64)
    x = flat.reshape(len(col), -1) if len(col) else np.zeros((0, 1))
    return x / np.maximum(np.linalg.norm(x, axis=1), 1e-300)[:, None] if unit else x


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x**2).sum(1)[:, None] + (y**2).sum(1) - 2 * x @ y.T, 0)


def k_means(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Centres of a sample, from evenly spaced rows on; an empty one keeps its place."""
    centres = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy() if len(x) else np.zeros((1, x.shape[1]))
    for _ in range(rounds if len(x) else 0):
        near = squared(x, centres).argmin(1)
        sums, n = np.zeros_like(centres), np.bincount(near, minlength=len(centres))
        np.add.at(sums, near, x)
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def sampled(vectors: DataFrame, rows: int, unit: bool) -> np.ndarray:
    """At most ``rows`` vectors, chosen by a hash of their number."""
    chosen = vectors.where("embedding is not null").orderBy(F.xxhash64("vec_id"), "vec_id").limit(rows).select("embedding").toArrow()
    return matrix(chosen.column("embedding").combine_chunks(), unit) if chosen.num_rows else np.zeros((0, 1))


def fit_cells(vectors: DataFrame, n: int, unit: bool = False, sample: int = 16_384) -> np.ndarray:
    """Centres for ``n`` vectors: about the square root of their number, 4,096 at most."""
    x = sampled(vectors, sample, unit)
    return k_means(x, int(min(4096, max(1, round(n**0.5)))))


def dealt(vectors: DataFrame, centres: np.ndarray, visits: int, unit: bool = False) -> DataFrame:
    """``vectors`` (vec_id, embedding, ...) with ``cell``: a row for each of the ``visits`` nearest centres, nulls left out."""
    held = vectors.sparkSession.sparkContext.broadcast(centres)
    visits = min(visits, len(centres))
    schema = T.StructType([*vectors.schema.fields, T.StructField("cell", T.IntegerType())])
    at = vectors.columns.index("embedding")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(batch.column(at).is_valid())
            for i in range(0, batch.num_rows, 4096):
                part = batch.slice(i, 4096)
                d = squared(matrix(part.column(at), unit), held.value)
                near = np.argpartition(d, visits - 1, axis=1)[:, :visits] if visits < d.shape[1] else np.broadcast_to(np.arange(d.shape[1]), d.shape)
                rows = np.repeat(np.arange(part.num_rows), visits)
                yield pa.RecordBatch.from_arrays([*part.take(pa.array(rows)).columns, pa.array(near.ravel().astype(np.int32))], names=schema.names)

    return vectors.mapInArrow(run, schema)


def met(stored: DataFrame, asking: DataFrame, answer, schema: str, cell_rows: int = 20_000) -> DataFrame:
    """``answer(stored batch, asking batch)`` for each cell, as a DataFrame of ``schema``.

    Both sides have the same columns, and a cell each. Cells of over ``cell_rows``
    stored rows are split, and asked in every part; queries come in batches.
    """
    ways = stored.groupBy("cell").agg(F.ceil(F.count("*") / cell_rows).alias("ways"))  # a row a cell: 4,096 at most
    ways = F.broadcast(ways)
    left = stored.join(ways, "cell").withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("ways"))).drop("ways")
    right = asking.join(ways, "cell").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("ways") - 1))).drop("ways")
    both = left.withColumn("asks", F.lit(False)).unionByName(right.withColumn("asks", F.lit(True)), allowMissingColumns=True)
    both = both.repartition("cell", "part").sortWithinPartitions("cell", "part", "asks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, here = None, [], None
        for batch in batches:
            cell, part, asks = (np.asarray(batch.column(c).to_numpy(zero_copy_only=False)) for c in ("cell", "part", "asks"))
            new = np.flatnonzero(np.concatenate([[True], (cell[1:] != cell[:-1]) | (part[1:] != part[:-1]) | (asks[1:] != asks[:-1])]))
            for a, b in zip(new.tolist(), [*new[1:].tolist(), batch.num_rows], strict=True):
                rows = batch.slice(a, b - a)
                if (cell[a], part[a]) != key:
                    key, held, here = (cell[a], part[a]), [], None
                if not asks[a]:
                    held.append(rows)
                    continue
                if here is None:
                    here = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                for i in range(0, rows.num_rows, 1024):
                    yield answer(here, rows.slice(i, 1024))

    return both.mapInArrow(run, schema)


def nearest_rows(k: int, unit: bool = False, own: bool = False):
    """An answer for ``met``: query_id, vec_id and distance (rounded) of the k nearest rows of each query; ``own``: itself too."""

    def answer(stored: pa.RecordBatch, asking: pa.RecordBatch) -> pa.RecordBatch:
        ids, x = stored.column("vec_id").to_numpy(), matrix(stored.column("embedding"), unit)
        asked, q = asking.column("vec_id").to_numpy(), matrix(asking.column("embedding"), unit)
        d = squared(q, x)
        if not own:
            d[asked[:, None] == ids] = np.inf
        take = np.argpartition(d, k, axis=1)[:, : k + 1] if k + 1 < d.shape[1] else np.broadcast_to(np.arange(d.shape[1]), d.shape)
        rows, cols = np.repeat(np.arange(len(asked)), take.shape[1]), take.ravel()
        fits = np.isfinite(d[rows, cols])
        rows, cols = rows[fits], cols[fits]
        exact = np.round(np.sqrt(((q[rows] - x[cols]) ** 2).sum(1)), 9)
        return pa.RecordBatch.from_arrays([pa.array(asked[rows]), pa.array(ids[cols]), pa.array(exact)], names=["query_id", "vec_id", "distance"])

    return answer


NEAREST = "query_id long, vec_id long, distance double"


def best(found: DataFrame, k: int) -> DataFrame:
    """The k nearest of each query, ties by number, with their rank."""
    order = Window.partitionBy("query_id").orderBy("distance", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
