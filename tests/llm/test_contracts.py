"""Checks on whole tables and odd columns: held-out accuracy, ids of the library, chosen cutoffs, clashing names."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from lectern.llm import decontaminate, line_dedup, quality, quality_rules, registry, substring, tokens, url_filter

SMALL, MEDIUM = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_cutoffs_are_chosen(spark):
    """600 good texts, 10 with a share of 0.07: 0.08 can be shown harmless, 0.06 can't; too few labels decide together or not at all."""
    rows = [(i, "en", 7 if i < 10 else 0) for i in range(600)]
    rows += [(1000 + i, None, 0) for i in range(300)] + [(2000 + i, "xx", 0) for i in range(5)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, n_symbols long")
    zero = {c: F.lit(0).cast("long") for c in ("n_dup_lines", "n_repeat_words", "n_capitals")}
    whole = {c: F.lit(100).cast("long") for c in ("word_chars", "n_lines", "n_words")}
    labels = docs.select("doc_id", F.lit(1).alias("quality"))
    got = {r["lang"]: (r["cutoff"], r["pooled"]) for r in quality_rules.choose_cutoffs(docs.withColumns(zero | whole), labels).collect()}
    assert got == {"en": (0.08, False), None: (0.03, False), "xx": (None, True)}
    two = docs.where("lang is not null").withColumn("lang", F.concat("lang", F.when(F.col("doc_id") < 2000, F.col("doc_id") % 3).otherwise(0)))
    pooled = {r["lang"]: r["cutoff"] for r in quality_rules.choose_cutoffs(two.withColumns(zero | whole), labels).collect()}
    assert pooled == {"en0": 0.08, "en1": 0.08, "en2": 0.08, "xx0": 0.08}


def test_cutoffs_take_effect(spark):
    words = [" ".join(f"word{i}x{j}" for j in range(40)) for i in range(400)]
    noisy = [" ".join(f"no{i}se{j} ###" for j in range(40)) for i in range(20)]
    docs = spark.createDataFrame([(i, t, None if i % 2 else "en") for i, t in enumerate(words + noisy)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(400)], "doc_id long, quality int")
    got = {r["doc_id"]: (r["kept"], r["base_failed"]) for r in quality_rules.apply_rules(docs, labels).collect()}
    assert all(got[i] == (True, False) for i in range(400)) and not any(got[400 + i][0] for i in range(20))
    assert not got[400][1]


def test_classifier_on_held_out_documents(spark):
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet").select("doc_id", "quality")
    rows = registry.QUERIES["op8_quality"](spark, MEDIUM).where("held_out").join(labels, "doc_id").collect()
    good, bad = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert len(good) > 20 and len(bad) > 5
    assert np.mean([(g > b) + (g == b) / 2 for g in good for b in bad]) >= 0.95
    assert np.mean([g >= 0.3 for g in good]) >= 0.95


def test_ids_equal_the_library_on_whole_documents(spark):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokens.default_path())
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy("doc_id").collect()
    pieces, start, want = {}, 0, []
    for r in docs:
        ids = np.array([*whole.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((r["doc_id"], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
        cuts = [0, *range(len(ids) % 1024 or min(len(ids), 1024), len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):  # noqa: B905
            pieces[r["doc_id"], k] = (a, b - a, zlib.crc32(ids[a:b].tobytes()))
    got = registry.QUERIES["op10_token_files"](spark, SMALL).collect()
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    packed = registry.QUERIES["op1_pack"](spark, SMALL).collect()
    assert {(r["doc_id"], r["piece"]): (r["start"], r["length"], r["ids_crc32"]) for r in packed} == pieces and len(packed) == len(pieces)
    places = {}
    for r in packed:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in places.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(own, own[1:])) and own[-1][0] + own[-1][1] <= 1024  # noqa: B905
    assert len(places) <= 1.02 * -(-sum(r["length"] for r in packed) // 1024) + 1


def test_clashing_columns(spark):
    r = random.Random(5)
    text = " ".join(f"w{r.randrange(90)}" for _ in range(40))
    names = ["lines", "row", "key", "spans", "piece", "at", "d", "t", "words", "_key"]
    docs = spark.createDataFrame([(i, text, *["own"] * len(names)) for i in range(3)], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names))
    for out in (line_dedup.dedup_lines(docs.drop("_key")), substring.drop_repeats(docs, with_text=True)):
        got = out.collect()
        assert len(got) == 3 and all(x[n] == "own" for x in got for n in names if n != "_key" or "_kept" in out.columns)
        assert sorted(x["_n_removed"] for x in got)[0] == 0 and max(x["_n_removed"] for x in got) > 0
    pages = spark.createDataFrame([(1, "http://a.com/x", "own", "own", "own", "own")], "page_id long, url string, host string, path string, rule string, verdict string")
    rules = spark.createDataFrame([("com", "/x", "block")], "host string, path string, verdict string")
    got = url_filter.filter_urls(pages, rules).first()
    assert (got["host"], got["path"], got["rule"], got["verdict"]) == ("a.com", "/x", "com/x", "block")
    scored = quality.score_quality(docs.withColumn("_score", F.lit("own")), quality.fit_quality(docs, spark.createDataFrame([], "doc_id long, quality int")))
    assert scored.columns.count("_score") == 1 and {x["_score"] for x in scored.collect()} == {0.5}
    items = spark.createDataFrame([(1, text)], "item_id long, text string")
    judged = decontaminate.judge(decontaminate.mark(docs.withColumns({"_spans": F.lit("own"), "n_words": F.lit(-1), "_items": F.lit(0)}), items))
    assert {(x["n_words"], x["n_hit"], x["contaminated"], x["spans"]) for x in judged.collect()} == {(40, 40, True, "own")}


def test_select_gives_any_boundary():
    from lectern.llm.token_files import EliasFano, ef_encode

    rng = np.random.default_rng(3)
    for n, top in ((0, 1), (1, 0), (1, 1 << 50), (63, 64), (65, 100), (1000, 1 << 40), (5000, 5000), (5000, 0)):
        v = np.sort(rng.integers(0, top + 1, n, dtype=np.uint64))
        ef = EliasFano(ef_encode(v, int(v[-1]) if n else 0))
        at = rng.permutation(n)
        assert ef.select(at).tolist() == v[at].tolist()
