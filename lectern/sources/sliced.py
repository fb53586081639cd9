"""Versioned tables in slices of their key: a change reads and writes only the slices that its keys fall in."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.sources.versions import CommitConflict, Versions


class SlicedTable:
    """Rows of ``schema``, sliced by hash of the string column ``key``.

    A new version's manifest takes over the folders of untouched slices. A
    stream's batch number is committed with its rows, so a batch that is replayed
    after a crash changes nothing.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, key: str = "citekey", slices: int = 64, tries: int = 5):
        self.spark, self.schema, self.key, self.tries, self._slices = spark, schema, key, tries, slices
        self.versions = Versions(spark, path)
        self.columns = spark.createDataFrame([], schema).columns

    @property
    def slices(self) -> int:
        """As many as the table was made with, whoever made it."""
        now = self.versions.current()
        return now["count"] if now else self._slices

    def _rows(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return reduce(DataFrame.unionByName, [self.spark.read.schema(self.schema).parquet(f) for f in folders])

    def read(self) -> DataFrame | None:
        """All rows; None if nothing was ever committed, which isn't an empty table."""
        now = self.versions.current()
        return self._rows(sorted(now["slices"].values())) if now else None

    def rows(self) -> DataFrame:
        held = self.read()
        return self._rows([]) if held is None else held

    def of(self, keys: list[str]) -> DataFrame:
        """The rows of some keys, from their slices only; a key without rows is simply absent."""
        now = self.versions.current()
        if not now or not keys:
            return self._rows([])
        asked = self.spark.createDataFrame([(k,) for k in keys], "k string").select(F.pmod(F.xxhash64("k"), F.lit(now["count"])).alias("s")).distinct().collect()
        return self._rows(sorted(now["slices"][str(r["s"])] for r in asked if str(r["s"]) in now["slices"])).where(F.col(self.key).isin(keys))

    def change(self, keys: DataFrame | None, rule: Callable[[DataFrame], DataFrame], batch: tuple[str, int] | None = None, also: dict | None = None) -> int:
        """Commit ``rule(rows)`` for the slices of ``keys`` (the key column; None: all slices) and return the version.

        ``batch`` names a stream and the number of its batch; one that was
        committed before is left alone. ``also`` goes into the manifest. If
        another writer was faster, the rule is applied to what it left.
        """
        for _ in range(self.tries):
            now = self.versions.current() or {"slices": {}, "batches": {}, "count": self._slices, "version": 0}
            if batch and now["batches"].get(batch[0], -1) >= batch[1]:
                return now["version"]
            slice_ = F.pmod(F.xxhash64(self.key), F.lit(now["count"])).cast("int")
            own = list(map(str, range(now["count"])))
            if keys is not None:
                own = sorted(str(r[0]) for r in keys.where(F.col(self.key).isNotNull()).select(slice_).distinct().collect())  # at most all slices
            old = self._rows(sorted(now["slices"][s] for s in own if s in now["slices"]))
            folder = self.versions.folder("rows")
            rule(old).select(self.columns).withColumn("slice", slice_).repartition("slice").write.partitionBy("slice").parquet(folder)
            kept = {s: f for s, f in now["slices"].items() if s not in own}
            new = {"count": now["count"], "slices": kept | self._written(folder), "batches": now["batches"] | ({batch[0]: batch[1]} if batch else {})}
            try:
                return self.versions.commit({k: v for k, v in now.items() if k != "version"} | new | (also or {}), now["version"])
            except CommitConflict:
                continue
        raise CommitConflict(f"the table changed {self.tries} times meanwhile")

    def _written(self, folder: str) -> dict[str, str]:
        at = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        names = (s.getPath().getName() for s in at.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(at) if s.isDirectory())
        return {n.removeprefix("slice="): f"{folder}/{n}" for n in names if n.startswith("slice=")}
