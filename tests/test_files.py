"""Snapshots, logs, listings and the streamed ledger."""

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lectern.sources import files
from lectern.sources.versions import Versions


def test_only_moved_files_are_read_again(spark, tmp_path):
    for name, text in (("a.txt", "kelp"), ("b.txt", "reef")):
        (tmp_path / name).write_text(text)
    where = str(tmp_path / "*.txt")
    first = files.hashes(spark, where, spark.createDataFrame([], "path string, size long, modified timestamp, sha256 string"))
    known = [(r["path"], r["size"], r["modified"], "kept" if r["path"].endswith("a.txt") else r["sha256"]) for r in first.collect()]
    assert len(known) == 2
    (tmp_path / "b.txt").write_text("a longer reef")
    again = files.hashes(spark, where, spark.createDataFrame(known, first.schema)).collect()
    got = {r["path"][-5:]: (r["size"], r["sha256"]) for r in again}
    assert got["a.txt"] == (4, "kept") and got["b.txt"][0] == 13 and got["b.txt"][1] != known[1][3]


def test_snapshots_and_added_columns(spark, tmp_path):
    path, schema = str(tmp_path / "t"), StructType([StructField("citekey", StringType()), StructField("n", LongType()), StructField("note", StringType())])
    assert files.read_snapshot(spark, path, schema) is None
    files.write_snapshot(spark.createDataFrame([("a", 1)], "citekey string, n int"), path)
    one = files.read_snapshot(spark, path, schema)
    assert one.schema == schema and one.first()["note"] is None
    files.write_snapshot(one.unionByName(spark.createDataFrame([("b", 2, "x")], schema)), path)
    assert files.read_snapshot(spark, path, schema).count() == 2
    assert Versions(spark, path).numbers() == [1, 2]


def test_a_crash_while_a_snapshot_is_written(spark, tmp_path, monkeypatch):
    path, schema = str(tmp_path / "t"), StructType([StructField("citekey", StringType())])
    files.write_snapshot(spark.createDataFrame([("a",)], schema), path)
    monkeypatch.setattr(Versions, "commit", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        files.write_snapshot(spark.createDataFrame([("b",)], schema), path)
    assert [r["citekey"] for r in files.read_snapshot(spark, path, schema).collect()] == ["a"]


def test_log_rows_stay_on_one_line(spark, tmp_path):
    path = str(tmp_path / "log")
    for k in range(2):
        files.append_log(spark.createDataFrame([(f"q |\n {k} ", k)], "query string, chars int"), path)
    assert sorted(r["query"] for r in spark.read.parquet(path).collect()) == ["q \\| 0", "q \\| 1"]
