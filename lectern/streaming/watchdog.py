"""Stalls between completions, in a batch or as a stream."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def gaps(events: DataFrame, worker: str, limit_s: int = 1800) -> DataFrame:
    """Gaps of over half of ``limit_s`` before an event of the same worker, and whether it stalled."""
    order = Window.partitionBy(worker).orderBy("ts", "event_id")
    gap = F.unix_micros(F.to_timestamp("ts")) - F.lag(F.unix_micros(F.to_timestamp("ts"))).over(order)
    rows = events.select(worker, "event_id", gap.alias("gap")).where(F.col("gap") > limit_s * 500_000)
    return rows.select(worker, "event_id", F.floor(F.col("gap") / 1_000_000).cast("long").alias("gap_s"), (F.col("gap") > limit_s * 1_000_000).alias("stalled"))


def busy_spells(events: DataFrame, worker: str, limit_s: int = 1800, late: str = "1 hour") -> DataFrame:
    """Session windows of a stream of completions; a spell ends after ``limit_s`` without one."""
    spells = events.withWatermark("ts", late).groupBy(F.session_window("ts", f"{limit_s} seconds"), worker)
    return spells.agg(F.count("*").alias("n")).select(worker, "session_window.start", "session_window.end", "n")


class _Stall(StatefulProcessor):
    """Keeps each worker's last completion, and two timers that its next one replaces."""

    def __init__(self, limit_ms: int, by_event_time: bool):
        self.limit, self.by_event_time = limit_ms, by_event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "ms long, start long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        latest = max(int(pdf["ms"].max()) for pdf in rows)
        before, started = self.last.get() if self.last.exists() else (None, None)
        if before is None or latest > before:
            start = latest if self.by_event_time else timerValues.getCurrentProcessingTimeInMs()
            self.last.update((latest, start))
            for wait in (self.limit // 2, self.limit):
                if started is not None:
                    self.handle.deleteTimer(started + wait)
                self.handle.registerTimer(start + wait)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        latest, start = self.last.get()
        level = "stalled" if expiredTimerInfo.getExpiryTimeInMs() - start >= self.limit else "slow"
        yield pd.DataFrame({"worker": [key[0]], "last": [latest], "level": [level]})

    def close(self) -> None:
        pass


def alarms(events: DataFrame, worker: str, limit_s: int = 1800, late: str | None = None) -> DataFrame:
    """worker, last and level of workers of a stream that complete nothing: slow after half of ``limit_s``, stalled after all of it.

    Alarms need no later event of the worker: timers give them. They run by the
    clock; with ``late``, a watermark's delay, by event time, which other workers'
    events move on, so a replayed stream gives the alarms of the first time. The
    state store must be RocksDB.
    """
    rows = events.select(F.col(worker).cast("string").alias("worker"), F.col("ts").cast("timestamp").alias("ts")).where("ts is not null").withColumn("ms", F.unix_millis("ts"))
    if late:
        rows = rows.withWatermark("ts", late)
    found = rows.groupBy("worker").transformWithStateInPandas(_Stall(limit_s * 1000, late is not None), "worker string, last long, level string", "Append", "eventTime" if late else "processingTime")
    return found.select(F.col("worker").alias(worker), F.timestamp_millis("last").alias("last"), "level")
