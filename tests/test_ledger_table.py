"""The ledger as a versioned table: one rule, crashes between any two steps, replayed batches, whole runs."""

import itertools

import pytest
from pyspark.sql import functions as F

from lectern.operators import ledger_table
from lectern.operators.ledger_table import LedgerTable, sync
from lectern.sources.versions import CommitConflict, Versions
from lectern.streaming.upsert import keep_ledger

ENTRY = "citekey string, pdf_hash string"


def rows_of(table):
    return {r["citekey"]: (r["pdf_hash"], r["status"], r["parsed_path"], r["failure_kind"]) for r in table.rows().collect()}


def entries(spark, *rows):
    return spark.createDataFrame(rows, ENTRY)


def plain(old, entry, present, force):
    """One entry, case by case."""
    key, pdf = entry
    if key not in old:
        return (pdf, "discovered" if pdf else "no_pdf", None, None)
    was, status, path, kind = old[key]
    if force and pdf:
        status = "discovered"
    elif pdf != was:
        status = "discovered" if pdf else "no_pdf"
    elif pdf and status == "parsed" and key not in present:
        status = "discovered"
    elif pdf and status == "parse_failed" and kind != "deterministic":
        status = "discovered"
    return (pdf, status, path, kind)


@pytest.mark.parametrize("force", [False, True])
def test_every_case_of_the_rule(spark, tmp_path, force):
    table, old = LedgerTable(spark, str(tmp_path / "l"), slices=3), {}
    for n, (pdf, status, kind) in enumerate(itertools.product(("h", None), ("parsed", "parse_failed", "no_pdf"), (None, "transient", "deterministic"))):
        old[f"k{n}"] = (pdf, status, "p" if status == "parsed" else None, kind)
    start = spark.createDataFrame([(k, v[0], v[1], v[2], None, v[3]) for k, v in old.items()], ledger_table.ROWS)
    table.change(start.select("citekey"), lambda _: start)
    new = [(k, pdf) for k, (was, *_) in old.items() for pdf in [was if int(k[1:]) % 3 else "other"]] + [("fresh", "x"), ("bare", None), (None, "x"), ("fresh", "a")]
    present = [k for k in old if int(k[1:]) % 2]
    table.upsert(entries(spark, *new), spark.createDataFrame([(k,) for k in present], "citekey string"), force)
    want = old | {k: plain(old, (k, pdf), present, force) for k, pdf in new[:-2]}
    assert rows_of(table) == want


def test_only_touched_slices_are_written(spark, tmp_path):
    table = LedgerTable(spark, str(tmp_path / "l"), slices=16)
    table.upsert(entries(spark, *((f"k{i}", "h") for i in range(200))))
    before = table.versions.current()["slices"]
    table.upsert(entries(spark, ("k3", "new")))
    after = table.versions.current()["slices"]
    assert len(before) == 16 and sum(before[s] != after[s] for s in before) == 1
    assert len(rows_of(table)) == 200 and rows_of(table)["k3"][0] == "new"


@pytest.mark.parametrize("step", ["before", "after"])
def test_a_kill_at_any_step_loses_nothing(spark, tmp_path, monkeypatch, step):
    """A stream's batch dies before or after its commit; the restarted stream replays it."""
    source, path = tmp_path / "in", str(tmp_path / "l")
    table = LedgerTable(spark, path, slices=4)
    commit, dead = Versions.commit, []

    def run():
        stream = keep_ledger(spark.readStream.schema(ENTRY).json(str(source)), table, str(tmp_path / "state"))
        stream.awaitTermination(120)

    def dies(self, *a):
        if not dead:
            dead.append(1)
            if step == "after":
                commit(self, *a)
            raise RuntimeError("killed")
        return commit(self, *a)

    entries(spark, ("a", "1"), ("b", None), ("a", "1")).coalesce(1).write.json(str(source))
    run()
    table.record(spark.createDataFrame([("a", "p", None, None)], "citekey string, path string, error string, kind string"))
    entries(spark, ("c", "3"), ("a", "1")).coalesce(1).write.mode("append").json(str(source))
    monkeypatch.setattr(Versions, "commit", dies)
    with pytest.raises(Exception):  # noqa: B017
        run()
    assert rows_of(table).keys() == ({"a", "b"} if step == "before" else {"a", "b", "c"})
    version = table.versions.current()["version"]
    run()
    monkeypatch.undo()
    assert rows_of(table) == {"a": ("1", "parsed", "p", None), "b": (None, "no_pdf", None, None), "c": ("3", "discovered", None, None)}
    assert table.versions.current()["version"] == version + (step == "before")


def test_a_faster_writer(spark, tmp_path, monkeypatch):
    table, other = LedgerTable(spark, str(tmp_path / "l"), slices=1), LedgerTable(spark, str(tmp_path / "l"), slices=1)
    commit, once = Versions.commit, []

    def slow(self, *a):
        if not once:
            once.append(1)
            other.upsert(entries(spark, ("b", "2")))
        return commit(self, *a)

    monkeypatch.setattr(Versions, "commit", slow)
    table.upsert(entries(spark, ("a", "1")))
    assert rows_of(table).keys() == {"a", "b"}
    monkeypatch.setattr(Versions, "commit", lambda *_: (_ for _ in ()).throw(CommitConflict("taken")))
    with pytest.raises(CommitConflict):
        table.upsert(entries(spark, ("c", "1")))


def test_runs(spark, tmp_path):
    table = LedgerTable(spark, str(tmp_path / "l"), slices=4)
    seen = []

    def parse(queue):
        keys = sorted(r["citekey"] for r in queue.collect())
        seen.append(keys)
        out = [(k, f"out/{k}", "CUDA out of memory" if k == "oom" else "bad" if k == "bad" else None, None, None, 3) for k in keys]
        return spark.createDataFrame(out, "citekey string, path string, error string, category string, worker string, pages int")

    bib = entries(spark, ("good", "1"), ("bad", "2"), ("oom", "3"), ("none", None))
    got = sync(table, bib, parse, str(tmp_path / "o1"))
    assert {k: got[k] for k in ("parsed", "failed", "unchanged", "no_pdf", "stale", "transient", "deterministic", "pages")} == {"parsed": 1, "failed": 2, "unchanged": 0, "no_pdf": 1, "stale": 0, "transient": 1, "deterministic": 1, "pages": 3}
    assert got["pages_per_s"] > 0
    got = sync(table, bib.where(F.col("citekey") != "none"), parse, str(tmp_path / "o2"), remove_stale=True)
    assert (got["parsed"], got["failed"], got["unchanged"], got["stale"], got["pruned"], got["pages_per_s"]) == (0, 1, 2, 1, 1, None)
    assert seen == [["bad", "good", "oom"], ["oom"]] and rows_of(table).keys() == {"good", "bad", "oom"}
    with pytest.raises(ValueError, match="empty"):
        table.prune(bib.limit(0).select("citekey"))
    assert len(rows_of(table)) == 3 and LedgerTable(spark, str(tmp_path / "never")).read() is None
