"""Sinks of single keys, errors raised by the plan, and counters."""

import os

import pytest
from pyspark.sql import functions as F

from lectern.operators import citations, ledger, retrieval, topics
from lectern.sources import passages, sinks
from lectern.sources.counters import Counters


def rows_of(spark, path):
    return {r["citekey"]: r["text"] for r in sinks.read_texts(spark, path, "citekey").collect()}


def files_of(path, key):
    return {f: os.stat(f"{path}/citekey={key}/{f}").st_mtime_ns for f in os.listdir(f"{path}/citekey={key}") if f.startswith("part")}


def test_one_sidecar_is_rewritten_or_cleared(spark, tmp_path):
    path = str(tmp_path / "s")
    assert rows_of(spark, path) == {}
    schema = "citekey string, ord int, text string, label string, page int"
    rows = spark.createDataFrame([("a", 1, 'two "é"\n', "text", None), ("a", 0, "one", "title", 1), ("b-1", 0, "x", "text", 2)], schema)
    sinks.write_sidecars(rows, path, rows.select("citekey").unionByName(spark.createDataFrame([("none",)], "citekey string")))
    got = rows_of(spark, path)
    assert got["a"] == '[{"text":"one","label":"title","page":1},{"text":"two \\"é\\"\\n","label":"text"}]' and got["none"] == "[]"
    back = passages.sidecar(sinks.read_texts(spark, path, "citekey").withColumnRenamed("text", "json"))
    assert {(r["citekey"], r["ord"], r["text"], r["page"]) for r in back.collect()} == {("a", 0, "one", 1), ("a", 1, 'two "é"\n', None), ("b-1", 0, "x", 2)}
    before = files_of(path, "a")
    sinks.write_sidecars(spark.createDataFrame([("b-1", 0, "new", "text", 2)], schema), path)
    assert files_of(path, "a") == before and rows_of(spark, path)["b-1"] == '[{"text":"new","label":"text","page":2}]'
    sinks.clear(spark, path, "citekey", ["b-1", "never"])
    assert rows_of(spark, path).keys() == {"a", "none"} and files_of(path, "a") == before


def test_keys_that_cannot_name_a_file(spark, tmp_path):
    with pytest.raises(Exception, match="no file can be named so"):
        sinks.write_texts(spark.createDataFrame([("../up", "x")], "citekey string, text string"), str(tmp_path / "s"), "citekey")
    assert spark.createDataFrame([("a/b.md",), ("b.tex",), ("c",)], "d string").select(sinks.numbered_copy_name(F.col("d"))).collect() == [("a/b.numbered",), ("b.numbered",), ("c.numbered",)]


ITEMS = [("a", "reefs", "kelp and reefs. " * 50), ("b", None, None)]


def test_missing_keys_fail_the_plan(spark):
    items = spark.createDataFrame(ITEMS, "citekey string, title string, text string")
    assert [r["citekey"] for r in ledger.named(items, ["a", "a"]).collect()] == ["a"]
    lazy = ledger.named(items, ["a", "zz", "yy"])
    with pytest.raises(Exception, match="not in the ledger: yy, zz"):
        lazy.collect()
    many = spark.range(70).select(F.format_string("k%02d", "id").alias("citekey"))
    with pytest.raises(Exception, match="k00, k01.*k49 and 20 more"):
        ledger.all_there(items, many, items).collect()


def test_unknown_key_before_empty_query(spark):
    items = spark.createDataFrame(ITEMS, "citekey string, title string, text string")
    ask = lambda *rows: retrieval.evidence(items, spark.createDataFrame(rows, "query_id int, citekey string, query string"), 40, 2)
    got = {r["query_id"]: r["windows"] for r in ask((1, "a", "kelp"), (2, "a", "the of"), (3, "b", "kelp")).collect()}
    assert len(got[1]) == 2 and all("kelp" in w for w in got[1]) and got[2] == got[3] == []
    with pytest.raises(Exception, match="not in the ledger: nokey"):
        ask((1, "nokey", "the")).collect()


def test_gate_over_drafts_without_citations(spark):
    drafts = spark.createDataFrame([(1, "says @a and @zz"), (2, "nothing"), (3, "@a")], "draft_id int, text string")
    known = spark.createDataFrame([("a",)], "citekey string")
    got = {r["draft_id"]: (r["total"], r["unknown"], r["ok"]) for r in citations.gate_summary(citations.cited(drafts), known, drafts).collect()}
    assert got == {1: (2, 1, False), 2: (0, 0, True), 3: (1, 0, True)}
    assert tuple(citations.verdict(citations.cited(drafts), known, drafts).first()) == (3, 3, 1, 1, False)
    assert tuple(citations.verdict(citations.cited(drafts).limit(0), known, drafts.limit(0)).first()) == (0, 0, 0, 0, True)


def test_counters_come_with_the_write(spark, tmp_path):
    counted = Counters()
    counted.of(spark.range(10), n=F.count("*"), odd=F.count_if(F.col("id") % 2 == 1)).write.parquet(str(tmp_path / "a"))
    assert counted.all() == {"n": 10, "odd": 5}
    empty = Counters()
    empty.of(spark.range(10).where("id > 20"), n=F.count("*")).write.parquet(str(tmp_path / "b"))
    assert empty["n"] == 0


def test_topic_names(spark):
    rows = [(0, 1, "reef", 4), (0, 1, "sand", 4), (0, 2, "reef", 2), (1, 3, "sand", 5), (1, 3, "kelp", 5), (1, 4, None, 0), (2, 5, None, 0)]
    got = {r["topic"]: (r["count"], r["name"]) for r in topics.topic_names(spark.createDataFrame(rows, "topic int, doc int, term string, tf long"), 2).collect()}
    assert got == {0: (2, "0_reef_sand"), 1: (2, "1_kelp_sand"), 2: (1, "2")}
