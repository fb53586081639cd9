"""The ledger as a sliced table (``sources/sliced.py``): one upsert rule for batches and streams, and whole runs."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators import ledger
from lectern.sources.counters import Counters
from lectern.sources.sliced import SlicedTable

ROWS = "citekey string, pdf_hash string, status string, parsed_path string, error string, failure_kind string"


def upserted(items: DataFrame, entries: DataFrame, present: DataFrame | None = None, force: bool = False) -> DataFrame:
    """``items`` (``ROWS``) after ``entries`` (citekey, pdf_hash), by the rule of ``ledger.decide``; others stay as they are.

    ``present`` names the citekeys whose outputs exist (None: all do). An entry
    that comes twice counts with its greatest hash; one without a citekey is left out.
    """
    new = entries.where("citekey is not null").groupBy("citekey").agg(F.max("pdf_hash").alias("pdf_hash"))
    old = items.select("citekey", F.col("pdf_hash").alias("old_hash"), F.col("status").alias("old_status"), "failure_kind")
    old = old.withColumn("output_present", F.lit(True)) if present is None else old.join(present.select("citekey", F.lit(True).alias("there")).distinct(), "citekey", "left").withColumn("output_present", F.coalesce("there", F.lit(False))).drop("there")
    decided = ledger.decide(new, old, force).select("citekey", F.col("status").alias("new_status")).join(new.withColumnRenamed("pdf_hash", "new_hash"), "citekey")
    rows = items.join(decided, "citekey", "full")
    came = F.col("new_status").isNotNull()
    return rows.select("citekey", F.when(came, F.col("new_hash")).otherwise(F.col("pdf_hash")).alias("pdf_hash"), F.coalesce("new_status", "status").alias("status"), "parsed_path", "error", "failure_kind")


def recorded(items: DataFrame, outcomes: DataFrame) -> DataFrame:
    """``items`` after ``outcomes`` (citekey, path, error, kind), by the rule of ``ledger.record_outcomes``."""
    return ledger.record_outcomes(items, outcomes).join(items.select("citekey", "pdf_hash"), "citekey").select("citekey", "pdf_hash", "status", "parsed_path", "error", "failure_kind")


class LedgerTable(SlicedTable):
    """The ledger as a table of ``ROWS``."""

    def __init__(self, spark: SparkSession, path: str, slices: int = 64):
        super().__init__(spark, path, ROWS, "citekey", slices)

    def upsert(self, entries: DataFrame, present: DataFrame | None = None, force: bool = False, batch: tuple[str, int] | None = None) -> int:
        return self.change(entries.select("citekey"), lambda rows: upserted(rows, entries, present, force), batch)

    def record(self, outcomes: DataFrame) -> int:
        return self.change(outcomes.select("citekey"), lambda rows: recorded(rows, outcomes))

    def prune(self, bib: DataFrame) -> int:
        """Drop rows that the bibliography no longer has; refused for an empty one."""
        return self.change(None, lambda rows: ledger.prune(rows, bib))

    def queue(self) -> DataFrame:
        """The entries that wait to be parsed."""
        return self.rows().where("status = 'discovered' and pdf_hash is not null")


def sync(table: LedgerTable, entries: DataFrame, parse: Callable[[DataFrame], DataFrame], out: str, present: DataFrame | None = None, force: bool = False, remove_stale: bool = False) -> dict:
    """One run: upsert, parse what is queued, record the outcomes, report.

    ``parse`` turns queued rows into outcomes (citekey, path, error, category,
    worker, pages); they are written to ``out`` once, and counted as they are.
    Returns parsed, failed, unchanged, no_pdf, stale, pruned, transient,
    deterministic, pages, seconds and pages_per_s (None without a page).
    """
    table.upsert(entries, present, force)
    counted, began = Counters(), time.monotonic()
    outcomes = parse(table.queue())
    failed = F.col("error").isNotNull()
    counted.of(outcomes, parsed=F.count_if(~failed), failed=F.count_if(failed), pages=F.sum(F.when(~failed, F.col("pages")))).write.parquet(out)
    seconds, ran = time.monotonic() - began, table.spark.read.schema(outcomes.schema).parquet(out)
    table.record(ledger.failure_kind(ran).select("citekey", "path", "error", "kind"))
    keys = entries.where("citekey is not null").select("citekey").distinct()
    state = table.rows().join(keys.withColumn("listed", F.lit(True)), "citekey", "left").join(ran.select("citekey", F.lit(True).alias("ran")), "citekey", "left")
    lost = F.col("status") == "parse_failed"
    transient = lost & ~F.coalesce(F.col("failure_kind") == "deterministic", F.lit(False))
    report = state.agg(
        F.count_if(F.col("listed") & F.col("ran").isNull() & (F.col("status") != "no_pdf")).alias("unchanged"),
        F.count_if(F.col("listed") & (F.col("status") == "no_pdf")).alias("no_pdf"),
        F.count_if(F.col("listed").isNull()).alias("stale"),
        F.count_if(transient).alias("transient"),
        F.count_if(lost & ~transient).alias("deterministic"),
    ).first().asDict()
    if remove_stale:
        table.prune(keys)
    got = counted.all()
    return got | report | {"pruned": report["stale"] if remove_stale else 0, "seconds": seconds, "pages_per_s": got["pages"] / seconds if got["pages"] and seconds > 0 else None}
