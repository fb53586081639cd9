"""Counters taken while a table is written, in the same pass."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation


class Counters:
    """Counts rows that flow into a write: ``counted = Counters(); counted.of(df, n=F.count("*")).write...; counted["n"]``."""

    def __init__(self):
        self._seen, self._names = Observation(), []

    def of(self, rows: DataFrame, **metrics: Column) -> DataFrame:
        self._names = list(metrics)
        return rows.observe(self._seen, *(c.alias(n) for n, c in metrics.items()))

    def all(self) -> dict:
        """The metrics; zeros where an input that turned out empty was cut from the plan, counters and all."""
        try:
            return {n: v or 0 for n, v in self._seen.get.items()}
        except Py4JJavaError:
            return dict.fromkeys(self._names, 0)

    def __getitem__(self, name: str):
        return self.all()[name]
