"""Vector search by blocks of queries, and incremental embedding."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import word_chunks
from lectern.operators.cells import NEAREST, best, matrix, met, squared


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, metric: str = "l2", cell_rows: int = 20_000) -> DataFrame:
    """query_id, vec_id, distance, rank of the k nearest vectors of each query (exact).

    ``vectors`` and ``queries``: vec_id, embedding; nulls are left out. Vectors are
    dealt to parts of ``cell_rows``, and queries stream past each part, which
    keeps its k best of each; those are merged, so no pair is shuffled. ``metric``:
    l2 (squared) or cosine.
    """

    def answer(stored: pa.RecordBatch, asking: pa.RecordBatch) -> pa.RecordBatch:
        x, q = matrix(stored.column("embedding")), matrix(asking.column("embedding"))
        if metric == "cosine":
            d = 1 - (q @ x.T) / np.maximum(np.linalg.norm(q, axis=1)[:, None] * np.linalg.norm(x, axis=1), 1e-300)
        else:
            d = squared(q, x)
        d = np.round(d, 6)
        # all that are no farther than the k-th nearest, so that ties go by number
        far = np.partition(d, k - 1, axis=1)[:, k - 1] if k <= d.shape[1] else np.full(len(d), np.inf)
        rows, cols = np.nonzero(d <= far[:, None])
        return pa.RecordBatch.from_arrays([asking.column("vec_id").take(pa.array(rows)), stored.column("vec_id").take(pa.array(cols)), pa.array(d[rows, cols])], names=["query_id", "vec_id", "distance"])

    one = [v.where("embedding is not null").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.lit(0).alias("cell")) for v in (vectors, queries)]
    return best(met(*one, answer, NEAREST, cell_rows), k)


def embedding_state(texts: DataFrame, stored: DataFrame) -> DataFrame:
    """citekey, state: keep, replace or new. ``texts``: citekey, text_hash; ``stored``: citekey, stored_hash."""
    rows = texts.join(stored, "citekey", "left")
    return rows.select("citekey", F.when(F.col("stored_hash").isNull(), "new").when(F.col("stored_hash") == F.col("text_hash"), "keep").otherwise("replace").alias("state"))


def refresh_chunks(texts: DataFrame, stored: DataFrame, encode, size: int = 200, overlap: int = 40) -> DataFrame:
    """The chunk store after a refresh: chunks of unchanged texts as stored, those of new and changed ones made again.

    ``texts``: citekey, text; ``stored``: citekey, i, chunk, text_hash, vector;
    ``encode`` turns chunks into vectors and runs on those made again only.
    Chunks of texts that are gone are dropped.
    """
    hashed = texts.select("citekey", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_hash"))
    states = embedding_state(hashed, stored.groupBy("citekey").agg(F.min("text_hash").alias("low"), F.max("text_hash").alias("high")).select("citekey", F.when(F.col("low") == F.col("high"), F.col("low")).otherwise("mixed").alias("stored_hash")))
    kept = stored.join(states.where("state = 'keep'"), "citekey", "left_semi")
    again = hashed.join(states.where("state <> 'keep'"), "citekey", "left_semi")
    made = again.select("citekey", "text_hash", F.explode(word_chunks("text", size, overlap)).alias("c")).select("citekey", "c.i", "c.chunk", "text_hash")
    return kept.select("citekey", "i", "chunk", "text_hash", "vector").unionByName(made.withColumn("vector", encode(F.col("chunk")).cast("array<double>")))


def hashed_vector(chunk: Column | str, dimensions: int = 16) -> Column:
    """Feature hashing, of length one: each word adds or takes one (by a bit of its CRC-32) at the place the rest of it names.

    An encoder without a model, in Arrow batches; another one fits wherever this does.
    """

    @F.pandas_udf("array<float>")
    def encode(texts: pd.Series) -> pd.Series:
        words = [re.findall("[a-z0-9]+", (t or "").lower()) for t in texts]
        rows = np.repeat(np.arange(len(words)), [len(w) for w in words])
        h = np.fromiter((zlib.crc32(x.encode()) for w in words for x in w), np.int64, len(rows))
        out = np.zeros((len(words), dimensions))
        np.add.at(out, (rows, (h >> 1) % dimensions), 1 - 2 * (h & 1))
        norm = np.linalg.norm(out, axis=1)
        return pd.Series(list((out / np.where(norm > 0, norm, 1)[:, None]).astype(np.float32)))

    return encode(chunk)


def topics(vectors: DataFrame, centres: DataFrame, rounds: int = 5) -> DataFrame:
    """vec_id and topic: k-means from given centres (topic, embedding), ties to the smaller topic.

    Centres are as many as there are topics, and are all that is sent out.
    """
    spark = vectors.sparkSession
    rows = centres.orderBy("topic").collect()
    names, at = [r["topic"] for r in rows], np.array([r["embedding"] for r in rows], np.float64)
    kind = centres.schema["topic"].dataType.simpleString()

    def nearest_of(at: np.ndarray):
        held = spark.sparkContext.broadcast(at)

        def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                x = np.array(pdf["embedding"].tolist(), np.float64)
                d = np.round((x**2).sum(1)[:, None] + (held.value**2).sum(1) - 2 * x @ held.value.T, 9) if len(x) else np.zeros((0, len(names)))
                yield pdf[["vec_id"]].assign(topic=[names[k] for k in d.argmin(axis=1)], embedding=pdf["embedding"])

        return vectors.select("vec_id", "embedding").mapInPandas(assign, f"vec_id long, topic {kind}, embedding array<float>")

    for _ in range(rounds - 1):
        sums = nearest_of(at).select("topic", F.posexplode("embedding").alias("k", "v")).groupBy("topic", "k").agg(F.avg(F.col("v").cast("double")).alias("v"))
        new = at.copy()
        for r in sums.collect():  # a number for each topic and dimension
            new[names.index(r["topic"]), r["k"]] = r["v"]
        if np.allclose(new, at, atol=1e-12):
            break
        at = new
    return nearest_of(at).select("vec_id", "topic")
