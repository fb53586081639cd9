"""The vector store: refreshes by text hash and model, recall of coded search, the whole-text cache."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.operators import vectors
from lectern.operators.vector_store import Quantiser, VectorCache, VectorStore, model_slug


def texts(spark, rows):
    return spark.createDataFrame(list(rows.items()), "citekey string, text string")


def encode(chunk):
    return vectors.hashed_vector(chunk, 8)


def test_slugs():
    assert model_slug("lab/mini v2.") == "corpus-lab-mini-v2"
    assert len(model_slug("x" * 100)) == 63 and not model_slug("ab/" * 19 + "-----------").endswith("-")


def test_only_what_changed_is_encoded(spark, tmp_path):
    store = VectorStore(spark, str(tmp_path), "m/one", slices=4, parts=4)
    rows = {f"k{i}": " ".join(f"w{i}x{j}" for j in range(10 + 40 * i)) for i in range(12)} | {"bare": " \n", "null": None}
    got = store.refresh(texts(spark, rows), encode)
    assert (got["new"], got["empty"], got["kept"], got["chunks"]) == (12, 2, 0, store.rows().count())
    version = store.versions.current()["version"]
    assert store.refresh(texts(spark, rows), encode) == {"new": 0, "changed": 0, "kept": 12, "gone": 0, "empty": 2, "chunks": 0}
    assert store.versions.current()["version"] == version
    del rows["k3"]
    rows |= {"k4": "another text", "bare": "now words"}
    got = store.refresh(texts(spark, rows), encode)
    assert (got["new"], got["changed"], got["gone"], got["kept"], got["chunks"]) == (1, 1, 1, 10, 2)
    want = vectors.refresh_chunks(texts(spark, rows).where("text rlike '\\\\S'"), spark.createDataFrame([], "citekey string, i int, chunk string, text_hash string, vector array<double>"), encode)
    key = lambda df: sorted((r["citekey"], r["i"], r["chunk"]) for r in df.collect())
    assert key(store.rows()) == key(want)
    assert [r["citekey"] for r in store.of(["k4", "k3"]).collect()] == ["k4"]
    other = VectorStore(spark, str(tmp_path), "m/two", slices=4, parts=4)
    assert other.read() is None and other.refresh(texts(spark, rows), encode)["new"] == 12
    near = store.search(store.rows().select(F.col("vec_id").alias("query_id"), "embedding"), 1).collect()
    assert len(near) == store.rows().count() and all(r["distance"] == 0 for r in near)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_recall_against_exact_search(spark, tmp_path, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet").select("vec_id", "embedding")
    store = VectorStore(spark, str(tmp_path), "m", slices=4)
    held = rows.select(F.col("vec_id").cast("string").alias("citekey"), F.col("vec_id").cast("string").alias("text"), "embedding")
    spoken = {r["citekey"]: r["embedding"] for r in held.collect()}
    known = F.create_map(*[x for k, v in spoken.items() for x in (F.lit(k), F.array(*map(F.lit, v)))]) if len(spoken) < 600 else None
    if known is None:  # too many for a literal map: vectors by a join of their own
        lookup = F.udf(lambda c: spoken[c], "array<float>")
        store.refresh(held.select("citekey", "text"), lambda c: lookup(c))
    else:
        store.refresh(held.select("citekey", "text"), lambda c: F.element_at(known, c))
    asked = rows.where("vec_id % 5 = 0")
    want = {(r["query_id"], r["vec_id"]) for r in vectors.nearest(rows, asked, 5).collect()}
    got = {(r["query_id"], int(r["citekey"])) for r in store.search(asked.withColumnRenamed("vec_id", "query_id"), 5).collect()}
    assert len(want & got) / len(want) >= 0.95


def test_more_cells_and_codes_than_rows():
    x = np.random.default_rng(1).normal(size=(3, 5))
    q = Quantiser.fit(x, 9, 4)
    cell = np.array([0, 1, 2])
    assert np.allclose([q.estimates(x[[k]], c, q.codes(x, cell))[0, k] for k, c in enumerate(cell)], 0)


def test_whole_text_cache(spark, tmp_path):
    cache, rows = VectorCache(spark, str(tmp_path / "c"), slices=2), {"a": "one reef", "b": "two reefs", "c": None, "d": ""}
    got, n = cache.vectors(texts(spark, rows), "m1", encode)
    assert n == 2 and sorted(r["citekey"] for r in got.collect()) == ["a", "b"]
    assert cache.vectors(texts(spark, rows), "m1", encode)[1] == 0
    assert cache.vectors(texts(spark, rows | {"a": "other"}), "m1", encode)[1] == 1
    got, n = cache.vectors(texts(spark, rows), "m2", encode)
    assert n == 2 and cache.rows().where("model = 'm1'").isEmpty()


def test_nearest_in_parts_with_ties_and_nulls(spark):
    rows = spark.createDataFrame([(i, [float(i % 4), 0.0]) for i in range(40)] + [(99, None)], "vec_id long, embedding array<float>")
    got = {(r["query_id"], r["rank"]): r["vec_id"] for r in vectors.nearest(rows, rows.where("vec_id in (1, 99)"), 3, cell_rows=7).collect()}
    assert got == {(1, 1): 1, (1, 2): 5, (1, 3): 9}
