"""Files and tables on shared storage: listings, hashes of what changed, snapshots, append-only logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lectern.sources.versions import Versions


def stat(spark: SparkSession, path: str) -> DataFrame:
    """path, size and modified of the files at ``path``; no content is read."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def hashes(spark: SparkSession, path: str, known: DataFrame) -> DataFrame:
    """path, size, modified and sha256 of the files at ``path``.

    A file whose size and time are as in ``known`` (the same columns) keeps its
    hash; only others are read.
    """
    now = stat(spark, path)
    same = now.join(known, ["path", "size", "modified"])
    moved = now.join(known, ["path", "size", "modified"], "left_anti").select("path")
    read = spark.read.format("binaryFile").load(path).join(moved, "path", "left_semi")
    read = read.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("sha256"))
    return same.unionByName(read)


def aligned(rows: DataFrame, schema: StructType) -> DataFrame:
    """``rows`` with the columns of ``schema``: missing ones are null, others stay behind."""
    return rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) if f.name in rows.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema))


def write_snapshot(rows: DataFrame, path: str) -> None:
    """Make ``rows`` the table at ``path``, as a new version: ``rows`` may read from it, and a crash leaves what was there."""
    table = Versions(rows.sparkSession, path)
    folder, now = table.folder("snapshot"), table.current()
    rows.write.parquet(folder)
    table.commit({"folder": folder}, now["version"] if now else 0)


def read_snapshot(spark: SparkSession, path: str, schema: StructType) -> DataFrame | None:
    """The table at ``path`` with the columns of ``schema``; None if there never was one, which isn't an empty one."""
    now = Versions(spark, path).current()
    return aligned(spark.read.parquet(now["folder"]), schema) if now else None


def append_log(rows: DataFrame, path: str) -> None:
    """Add rows to a log; text is kept on one line, and pipes are escaped, as in a Markdown table."""
    text = [f.name for f in rows.schema if f.dataType.simpleString() == "string"]
    clean = {c: F.regexp_replace(F.trim(F.regexp_replace(c, r"\s+", " ")), r"\|", r"\\|") for c in text}
    rows.withColumns(clean).write.mode("append").parquet(path)
