"""Key sets as bitmaps, and alarms of stalled workers from a replayed stream."""

import random
from datetime import datetime, timedelta

import pytest

from lectern.operators import key_sets
from lectern.streaming import watchdog


def test_unconsidered_keys(spark, monkeypatch):
    r = random.Random(4)
    known = [f"k{i:06d}" for i in range(70_000)]
    mentioned = [("a", k) for k in r.sample(known, 300)] + [("b", k) for k in known[32_760:32_780]] + [("a", "nowhere"), ("c", known[0]), ("c", known[-1]), ("c", known[0])]
    keys = spark.createDataFrame([(k,) for k in known] * 2, "citekey string").repartition(5)
    said = spark.createDataFrame(mentioned, "dossier string, citekey string")
    dossiers = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "dossier string")
    numbers = {r["citekey"]: r["n"] for r in key_sets.numbered(keys).collect()}
    assert numbers == {k: i for i, k in enumerate(known)}
    runs = key_sets.unconsidered(keys, dossiers, said)
    rows = runs.collect()
    assert len(rows) < 320  # not a row for each key
    for d in "abcd":
        own = {k for x, k in mentioned if x == d}
        want = [i for i, k in enumerate(known) if k not in own]
        got = sorted(i for r in rows if r["dossier"] == d for i in range(numbers[r["from_key"]], numbers[r["to_key"]] + 1))
        assert got == want and sum(r["n"] for r in rows if r["dossier"] == d) == len(want)
    assert key_sets.members(runs.where("dossier = 'b'"), keys).count() == 70_000 - 20


def test_bitmaps_are_merged(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 40_000), ("a", 1), ("b", 1), ("b", 2)], "g string, n long")
    sets = key_sets.bitmaps(rows, "g")
    assert {r["g"]: r["n"] for r in key_sets.sizes(sets, "g").collect()} == {"a": 2, "b": 2}
    assert key_sets.sizes(key_sets.merged(sets)).first()["n"] == 3
    assert key_sets.bitmaps(rows.limit(0), "g").isEmpty()


def test_alarms_without_a_later_event(spark, tmp_path):
    """w1 goes silent, w2 comes back between half and all of the limit, w3 keeps on and moves the watermark."""
    if "rocksdb" not in spark.conf.get("spark.sql.streaming.stateStore.providerClass", "").lower():
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    start, source = datetime(2024, 1, 1), tmp_path / "in"
    batches = [[("w1", 0), ("w2", 0), ("w3", 0)], [("w3", 40), ("w1", 5)], [("w3", 70)], [("w3", 75)], [("w3", 80), ("w2", 90)], [("w3", 120)], [("w3", 400), ("w2", 390)]]
    for k, rows in enumerate(batches):
        spark.createDataFrame([(w, start + timedelta(seconds=s)) for w, s in rows], "worker string, ts timestamp").coalesce(1).write.parquet(str(source / f"b{k}"))

    def replay(name):
        events = spark.readStream.schema("worker string, ts timestamp").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(source))
        stream = watchdog.alarms(events, "worker", 100, "0 seconds").writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        stream.awaitTermination(180)
        return sorted((r["worker"], int((r["last"] - start).total_seconds()), r["level"]) for r in spark.table(name).collect())

    first = replay("alarms1")
    assert ("w1", 5, "slow") in first and ("w1", 5, "stalled") in first
    assert ("w2", 0, "slow") in first and ("w2", 0, "stalled") not in first
    assert replay("alarms2") == first


def test_busy_spells(spark, tmp_path):
    start = datetime(2024, 1, 1)
    rows = [("a", start + timedelta(seconds=s)) for s in (0, 10, 15, 200, 900)] + [("b", start)]
    spark.createDataFrame(rows, "worker string, ts timestamp").coalesce(1).write.parquet(str(tmp_path / "in"))
    events = spark.readStream.schema("worker string, ts timestamp").parquet(str(tmp_path / "in"))
    stream = watchdog.busy_spells(events, "worker", 60, "1 second").writeStream.format("memory").queryName("spells").outputMode("append").trigger(availableNow=True).start()
    stream.awaitTermination(120)
    got = sorted((r["worker"], int((r["start"] - start).total_seconds()), r["n"]) for r in spark.table("spells").collect())
    assert got == [("a", 0, 3), ("a", 200, 1), ("b", 0, 1)]
    with pytest.raises(Exception):  # noqa: B017
        watchdog.busy_spells(events, "nobody", 60)
