"""Each stage of the pipeline against a plain version, and on empty and odd tables."""

import random
import re

import corpus_pipeline
from pyspark.sql import functions as F

from lectern.llm import registry

SMALL = "/root/testdata/sf0.001"
WORD = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def test_quality_stage_keeps_what_the_query_scores_well(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = sorted(r["doc_id"] for r in corpus_pipeline.quality(spark, docs, SMALL).select("doc_id").collect())
    assert kept == sorted(r["doc_id"] for r in registry.QUERIES["op8_quality"](spark, SMALL).where("predicted = 1").collect())


def test_benchmark_stage_against_all_windows(spark, tmp_path):
    r = random.Random(6)
    items = [" ".join(f"b{i}w{j}" for j in range(r.choice([5, 13, 40]))) for i in range(12)] + [None, "..."]
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    texts = []
    for k in range(60):
        words = [f"d{k}x{j}" for j in range(r.choice([20, 200, 700]))]
        at = r.randrange(len(words))
        own = (items[k % 12] or "").split()
        a = r.randrange(len(own))
        words[at:at] = own[a : a + r.randrange(1, len(own) + 1)] if k % 2 else own
        texts.append(", ".join(words).upper() if k % 3 else " ".join(words))
    texts += [None, "", items[0], "!"]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], SCHEMA)
    windows = set()
    for t in items:
        w = re.findall(WORD, (t or "").lower())
        windows |= {tuple(w[i : i + 13]) for i in range(max(1, len(w) - 12))} if w else set()
    want = []
    for i, t in enumerate(texts):
        w = re.findall(WORD, (t or "").lower())
        hit = {i + j for n in {len(x) for x in windows} for i in range(len(w) - n + 1) if tuple(w[i : i + n]) in windows for j in range(n)}
        if not (hit and 20 * len(hit) >= len(w)):
            want.append(i)
    got = corpus_pipeline.benchmarks(spark, docs, str(tmp_path))
    assert got.columns == docs.columns and sorted(r["doc_id"] for r in got.collect()) == want and 20 < len(want) < 60


def test_packing_stage_places_every_id(spark):
    docs = spark.createDataFrame([(i, "word " * (700 * i), "en", "s", 1) for i in range(5)] + [(None, None, None, None, None)], SCHEMA)
    rows = corpus_pipeline.packing(spark, docs, "").collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
    assert set(by_doc) == {0, 1, 2, 3, 4, None} and by_doc[None] == [(0, 1)]
    for own in by_doc.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:]))  # noqa: B905


def test_stages_on_an_empty_table(spark):
    empty = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, SMALL)
        assert out.count() == 0, name
        assert name == "packing" or out.columns == empty.columns, name


def test_columns_survive_whatever_their_names(spark):
    """Names that the operators use inside, and a stage's own."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(120)
    names = ["_d", "_k", "_key", "key", "_score", "clean_text", "n_words", "n_hit", "_text", "_spans", "row", "d", "k", "none", "a.b"]
    odd = docs.select("*", *(F.concat(F.lit(f"{n}:"), "source").alias(n) for n in names)).cache()
    plain = {name: sorted((r["doc_id"], r["text"]) for r in stage(spark, docs, SMALL).collect()) for name, stage in corpus_pipeline.STAGES[:-1]}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, SMALL)
        assert out.columns == odd.columns and out.schema["n_chars"].dataType == odd.schema["n_chars"].dataType
        rows = out.collect()
        assert sorted((r["doc_id"], r["text"]) for r in rows) == plain[name]
        assert all(r[n] == f"{n}:{r['source']}" for r in rows for n in names)
    assert corpus_pipeline.packing(spark, odd, SMALL).columns == corpus_pipeline.packing(spark, docs, SMALL).columns


def test_whole_run_is_its_stages_one_by_one(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    got = corpus_pipeline.run(spark, SMALL).select(columns).collect()
    assert sorted(got) == sorted(docs.select(columns).collect()) and got
