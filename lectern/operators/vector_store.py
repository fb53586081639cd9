"""A store of chunk vectors by model: kept up to date by text hash, searched through an inverted file with product quantisation.

Each model has a table of its own, so vectors of two models never meet. A row
holds a chunk, its text's hash, its vector, the cell it lies in and a code: the
vector's difference from its cell's centre, cut into subspaces, each named by the
nearest of up to 256 centres. Centres are fitted on a bounded sample when the
store is first filled, and anew when it has grown eightfold. A search deals
queries to cells, ranks rows there by codes alone, and ranks the best again by
their vectors; queries stay on the executors.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.functions.text import word_chunks
from lectern.operators.cells import best, dealt, k_means, matrix, met, squared
from lectern.sources.counters import Counters
from lectern.sources.sliced import SlicedTable

ROWS = "citekey string, i int, chunk string, text_hash string, vec_id long, embedding array<float>, cell int, code binary"
GROWTH = 8


def model_slug(model: str) -> str:
    """A name for the model's table: fixed form, 63 characters at most."""
    return f"corpus-{re.sub(r'[^A-Za-z0-9._-]+', '-', model).strip('-.')}"[:63].rstrip("-.")


class Quantiser:
    """Cell centres and the centres of each subspace."""

    def __init__(self, centres: np.ndarray, books: np.ndarray):
        self.centres, self.books = centres, books  # (cells, dim), (parts, names, dim / parts)

    @classmethod
    def fit(cls, x: np.ndarray, cells: int, parts: int) -> Quantiser:
        centres = k_means(x, cells)
        rest = x - centres[squared(x, centres).argmin(1)]
        width = -(-x.shape[1] // parts)
        rest = np.pad(rest, ((0, 0), (0, width * parts - x.shape[1])))
        return cls(centres, np.stack([k_means(rest[:, k * width : (k + 1) * width], min(256, max(1, len(x)))) for k in range(parts)]))

    def rest(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        parts, _, width = self.books.shape
        return np.pad(x - self.centres[cell], ((0, 0), (0, parts * width - x.shape[1]))).reshape(len(x), parts, width)

    def codes(self, x: np.ndarray, cell: np.ndarray) -> np.ndarray:
        rest = self.rest(x, cell)
        return np.stack([squared(rest[:, k], b).argmin(1) for k, b in enumerate(self.books)], axis=1).astype(np.uint8)

    def estimates(self, q: np.ndarray, cell: int, codes: np.ndarray) -> np.ndarray:
        """Squared distances of queries to the coded rows of one cell, from a table of each subspace."""
        rest = self.rest(q, np.full(len(q), cell))
        out = np.zeros((len(q), len(codes)))
        for k, b in enumerate(self.books):
            out += squared(rest[:, k], b)[:, codes[:, k]]
        return out


@lru_cache(maxsize=8)
def _quantiser(centres: bytes, books: bytes, shape: tuple) -> Quantiser:
    return Quantiser(np.frombuffer(centres, np.float64).reshape(shape[0]), np.frombuffer(books, np.float64).reshape(shape[1]))


class VectorStore(SlicedTable):
    def __init__(self, spark: SparkSession, path: str, model: str, slices: int = 64, sample: int = 16_384, parts: int = 16):
        self.model, self.sample, self.parts = model, sample, parts
        super().__init__(spark, f"{path.rstrip('/')}/{model_slug(model)}", ROWS, "citekey", slices)

    def quantiser(self) -> Quantiser | None:
        now = self.versions.current()
        if not now or "fitted" not in now:
            return None
        row = self.spark.read.parquet(now["fitted"]["folder"]).first()
        return _quantiser(bytes(row["centres"]), bytes(row["books"]), (tuple(row["s1"]), tuple(row["s2"])))

    def refresh(self, texts: DataFrame, encode: Callable[[Column], Column], size: int = 200, overlap: int = 40) -> dict:
        """Make the store hold the chunks of ``texts`` (citekey, text): encoded, kept and gone texts, and chunks encoded.

        Only new and changed texts are cut and encoded. A text without a word has no chunks.
        """
        hashed = texts.where("citekey is not null").select("citekey", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_hash"))
        stored = self.rows().groupBy("citekey").agg(F.min("text_hash").alias("low"), F.max("text_hash").alias("high"))
        both = hashed.join(stored, "citekey", "full")
        wordless = ~F.coalesce(F.regexp_like("text", F.lit(r"\S")), F.lit(False))
        same = (F.col("low") == F.col("high")) & (F.col("low") == F.col("text_hash"))
        state = F.when(F.col("text_hash").isNull(), "gone").when(same, "kept").when(F.col("low").isNull() & wordless, "empty").when(F.col("low").isNull(), "new").otherwise("changed")
        states = both.select("citekey", state.alias("state")).persist()
        counts = {r["state"]: r["n"] for r in states.groupBy("state").agg(F.count("*").alias("n")).collect()}
        out = {k: counts.get(k, 0) for k in ("new", "changed", "kept", "gone", "empty")} | {"chunks": 0}
        moved = states.where("state in ('new', 'changed', 'gone')").select("citekey")
        if out["new"] + out["changed"] + out["gone"]:
            fresh = hashed.join(states.where("state in ('new', 'changed')").select("citekey"), "citekey", "left_semi")
            cut = fresh.select("citekey", "text_hash", F.explode(word_chunks("text", size, overlap)).alias("c")).select("citekey", "c.i", "c.chunk", "text_hash")
            counted = Counters()
            vectors = cut.withColumn("embedding", encode(F.col("chunk")).cast("array<float>"))
            vectors = counted.of(vectors.withColumn("vec_id", F.xxhash64("citekey", "i")), n=F.count("*"))
            folder = self.versions.folder("encoded")
            vectors.write.parquet(folder)
            vectors, out["chunks"] = self.spark.read.parquet(folder), counted["n"]
            also = self._fitted(vectors, out["chunks"])
            coded = self._coded(vectors, also["fitted"]["folder"]) if also else self._coded(vectors, self.versions.current()["fitted"]["folder"])
            refit = also is not None and self.versions.current() is not None

            def rule(rows: DataFrame) -> DataFrame:
                left = rows.join(moved, "citekey", "left_anti")
                return (self._coded(left.drop("cell", "code"), also["fitted"]["folder"]) if refit else left).select(self.columns).unionByName(coded.select(self.columns))

            self.change(None if refit else moved, rule, also=also)
        states.unpersist()
        return out

    def _fitted(self, new: DataFrame, count: int) -> dict | None:
        """A new quantiser for the manifest, if there is none or the store has outgrown it."""
        now = self.versions.current()
        rows = (self.rows().count() if now else 0) + count
        if now and rows < GROWTH * max(1, now["fitted"]["rows"]):
            return None
        every = new.select("vec_id", "embedding")
        every = self.rows().select("vec_id", "embedding").unionByName(every) if now else every
        chosen = every.where("embedding is not null").orderBy(F.xxhash64("vec_id"), "vec_id").limit(self.sample).select("embedding").toArrow()
        x = matrix(chosen.column("embedding").combine_chunks()) if chosen.num_rows else np.zeros((0, 1))
        q = Quantiser.fit(x, int(min(4096, max(1, round(rows**0.5 / 2)))), min(self.parts, x.shape[1]))
        folder = self.versions.folder("fitted")
        one = [(bytearray(q.centres.tobytes()), bytearray(q.books.tobytes()), list(q.centres.shape), list(q.books.shape))]
        self.spark.createDataFrame(one, "centres binary, books binary, s1 array<int>, s2 array<int>").coalesce(1).write.parquet(folder)
        return {"fitted": {"folder": folder, "rows": rows}, "model": self.model}

    def _coded(self, vectors: DataFrame, folder: str) -> DataFrame:
        row = self.spark.read.parquet(folder).first()
        held = self.spark.sparkContext.broadcast((bytes(row["centres"]), bytes(row["books"]), (tuple(row["s1"]), tuple(row["s2"]))))
        names = [c for c in self.columns if c not in ("cell", "code")]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            q = _quantiser(*held.value)
            for batch in batches:
                x = matrix(batch.column("embedding"))
                cell = squared(x, q.centres).argmin(1) if len(x) else np.zeros(0, np.int64)
                codes = [c.tobytes() for c in q.codes(x, cell)] if len(x) else []
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(cell.astype(np.int32)), pa.array(codes, pa.binary())], names=[*names, "cell", "code"])

        return vectors.where("embedding is not null").select(names).mapInArrow(run, ROWS)

    def search(self, queries: DataFrame, k: int = 5, visits: int = 16, again: int = 16) -> DataFrame:
        """query_id, citekey, i, chunk, distance (squared), rank of the k nearest chunks. ``queries``: query_id, embedding.

        ``visits`` cells are searched by code; ``again`` times k candidates are ranked by their vectors.
        """
        now = self.versions.current()
        if not now:
            return self.spark.createDataFrame([], "query_id long, citekey string, i int, chunk string, distance double, rank int")
        row = self.spark.read.parquet(now["fitted"]["folder"]).first()
        held = self.spark.sparkContext.broadcast((bytes(row["centres"]), bytes(row["books"]), (tuple(row["s1"]), tuple(row["s2"]))))
        most = k * again

        def answer(stored: pa.RecordBatch, asking: pa.RecordBatch) -> pa.RecordBatch:
            q = _quantiser(*held.value)
            codes = np.frombuffer(b"".join(stored.column("code").to_pylist()), np.uint8).reshape(stored.num_rows, -1)
            d = q.estimates(matrix(asking.column("embedding")), int(stored.column("cell")[0].as_py()), codes)
            take = np.argpartition(d, most - 1, axis=1)[:, :most] if most < d.shape[1] else np.broadcast_to(np.arange(d.shape[1]), d.shape)
            rows, cols = np.repeat(np.arange(len(d)), take.shape[1]), take.ravel()
            return pa.RecordBatch.from_arrays([asking.column("vec_id").take(pa.array(rows)), stored.column("vec_id").take(pa.array(cols)), pa.array(d[rows, cols])], names=["query_id", "vec_id", "distance"])

        centres = _quantiser(*held.value).centres
        rows = self.rows()
        asked = queries.where("embedding is not null").select(F.col("query_id").cast("long").alias("query_id"), F.col("embedding").cast("array<float>").alias("embedding"))
        asking = dealt(asked.withColumnRenamed("query_id", "vec_id"), centres, visits)
        near = best(met(rows.select("vec_id", "cell", "code"), asking, answer, "query_id long, vec_id long, distance double"), most).select("query_id", "vec_id")
        exact = near.join(rows.select("vec_id", "citekey", "i", "chunk", F.col("embedding").alias("v")), "vec_id").join(asked, "query_id")
        gap = F.aggregate(F.zip_with("v", "embedding", lambda a, b: (a.cast("double") - b.cast("double")) * (a.cast("double") - b.cast("double"))), F.lit(0.0), lambda s, x: s + x)
        exact = exact.select("query_id", "citekey", "i", "chunk", F.round(gap, 6).alias("distance"))
        order = Window.partitionBy("query_id").orderBy("distance", "citekey", "i")
        return exact.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


class VectorCache(SlicedTable):
    """One whole-text vector a citekey, kept by (citekey, text hash, model): what topics are made from."""

    def __init__(self, spark: SparkSession, path: str, slices: int = 64):
        super().__init__(spark, path, "citekey string, text_hash string, model string, embedding array<float>", "citekey", slices)

    def vectors(self, texts: DataFrame, model: str, encode: Callable[[Column], Column]) -> tuple[DataFrame, int]:
        """citekey and embedding of every text that isn't empty, and how many were encoded. Another model's vectors are replaced."""
        now = texts.where(F.col("text").isNotNull() & (F.col("text") != "")).select("citekey", "text", F.sha2("text", 256).alias("text_hash"), F.lit(model).alias("model"))
        stale = now.join(self.rows().select("citekey", "text_hash", "model"), ["citekey", "text_hash", "model"], "left_anti").select("citekey", "text_hash", "model", "text").persist()
        count = stale.count()
        if count:
            made = stale.select("citekey", "text_hash", "model", encode(F.col("text")).cast("array<float>").alias("embedding"))
            self.change(stale.select("citekey"), lambda rows: rows.join(stale.select("citekey"), "citekey", "left_anti").unionByName(made))
        stale.unpersist()
        return self.rows().where(F.col("model") == model).join(now.select("citekey", "text_hash"), ["citekey", "text_hash"], "left_semi").select("citekey", "embedding"), count
