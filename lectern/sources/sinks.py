"""Files of single keys on shared storage: sidecars and numbered copies that are rewritten or cleared one by one.

Each key has a folder of its own. A write replaces the folders of its keys and
touches no other, through Spark's dynamic partition overwrite; clearing a key
removes its folder, so it reads as absent, which isn't the same as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.text import citekey_problem


def _named(rows: DataFrame, key: str) -> DataFrame:
    problem = citekey_problem(key)
    return rows.withColumn(key, F.when(problem.isNull(), F.col(key)).otherwise(F.raise_error(F.concat(F.lit("no file can be named so ("), problem, F.lit("): "), F.coalesce(F.col(key), F.lit("null"))))))


def write_texts(rows: DataFrame, path: str, key: str) -> None:
    """Write one text for each key (``key``, text), in place of what the key had."""
    _named(rows.select(key, F.coalesce("text", F.lit("")).alias("text")), key).repartition(key).write.option("partitionOverwriteMode", "dynamic").option("lineSep", "\x1e").mode("overwrite").partitionBy(key).text(path)


def read_texts(spark: SparkSession, path: str, key: str) -> DataFrame:
    """``key`` and text of the keys that have one; no rows if nothing was ever written."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], f"{key} string, text string")
    return spark.read.schema(f"text string, {key} string").option("lineSep", "\x1e").text(path).select(key, "text")


def clear(spark: SparkSession, path: str, key: str, names: list[str]) -> None:
    """Remove the texts of some keys; one that isn't there is fine."""
    files = None
    for name in names:
        escaped = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(name)
        at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{key}={escaped}")
        files = files or at.getFileSystem(spark._jsc.hadoopConfiguration())
        files.delete(at, True)


def sidecar_json(passages: DataFrame) -> DataFrame:
    """citekey and text: the JSON list of each citekey's passages (citekey, ord, text, label, page), in order; pages that are null are left out."""
    one = F.to_json(F.struct("text", "label", "page"))
    rows = passages.groupBy("citekey").agg(F.array_sort(F.collect_list(F.struct("ord", one.alias("json")))).alias("all"))
    return rows.select("citekey", F.concat(F.lit("["), F.array_join(F.transform("all", lambda x: x["json"]), ","), F.lit("]")).alias("text"))


def write_sidecars(passages: DataFrame, path: str, parsed: DataFrame | None = None) -> None:
    """Write the sidecars of ``passages``; keys of ``parsed`` (citekey) without a passage get an empty list, so that they count as parsed."""
    rows = sidecar_json(passages)
    if parsed is not None:
        rows = parsed.select("citekey").distinct().join(rows, "citekey", "left").select("citekey", F.coalesce("text", F.lit("[]")).alias("text"))
    write_texts(rows, path, "citekey")


def numbered_copy_name(draft: str | Column) -> Column:
    """The name of a draft's numbered copy: the draft itself is never written."""
    return F.concat(F.regexp_replace(draft, r"\.(md|tex)$", ""), F.lit(".numbered"))
