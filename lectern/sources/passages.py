"""Passages of a source: sidecar records, parsed pages, and which of them to use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.functions.text import pages

#: Kinds of records that are quoted.
LABELS = ["text", "list_item", "section_header", "title"]


def quotable(label: Column) -> Column:
    return F.element_at(F.split(F.lower(label), r"\."), -1).isin(LABELS)


def sidecar(files: DataFrame) -> DataFrame:
    """citekey, ord, text, label, page of the records of JSON lists (citekey, json).

    Broken JSON, and JSON that is no list, gives no record; a record without
    text, or that is no object, is passed over; a page that is no whole number
    of 1 or more is null.
    """
    listed = F.when(F.regexp_like("json", F.lit(r"^\s*\[")), F.from_json("json", "array<string>"))
    rows = files.select("citekey", F.posexplode(listed).alias("ord", "r")).where(F.regexp_like("r", F.lit(r"^\s*\{")))
    page = F.get_json_object("r", "$.page")
    page = F.when(F.regexp_like(page, F.lit("^[1-9][0-9]*$")), page.cast("int"))
    rows = rows.select("citekey", "ord", F.get_json_object("r", "$.text").alias("text"), F.get_json_object("r", "$.label").alias("label"), page.alias("page"))
    return rows.where(F.regexp_like("text", F.lit(r"\S")))


def parsed_pages(items: DataFrame) -> DataFrame:
    """citekey, ord, text, page of the pages of texts that have more than one."""
    rows = items.select("citekey", pages("text").alias("p")).where(F.size("p") > 1)
    return rows.select("citekey", F.posexplode("p").alias("ord", "p")).select("citekey", "ord", "p.text", "p.page")


def ladder(rungs: list[tuple[str, DataFrame]], known: DataFrame) -> DataFrame:
    """citekey, source, ord, text, page: each item's passages from the first rung that has any; none: source null."""
    rows = None
    for k, (name, own) in enumerate(rungs):
        own = own.select(F.lit(k).alias("rung"), F.lit(name).alias("source"), "citekey", "ord", "text", "page")
        rows = own if rows is None else rows.unionByName(own)
    first = rows.groupBy("citekey").agg(F.min("rung").alias("rung"))
    best = rows.join(first, ["citekey", "rung"]).drop("rung")
    return known.select("citekey").join(best, "citekey", "left")


def page_sample(items: DataFrame, count: int, size: str = "n_chars", key: str = "citekey") -> DataFrame:
    """``count`` items at even distances in the order of size (ties by key).

    Ranks come from counts of each size, so no task holds all items.
    """
    sizes = items.groupBy(size).agg(F.count("*").alias("c"))
    before = F.coalesce(F.sum("c").over(Window.orderBy(size).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    own = F.row_number().over(Window.partitionBy(size).orderBy(key)) - 1
    ranked = items.withColumn("own", own).join(sizes.select(size, before.alias("before")), size)
    total = items.count()
    wanted = sorted({round(i * (total - 1) / max(count - 1, 1)) for i in range(count)}) if total else []
    return ranked.withColumn("rank", F.col("before") + F.col("own")).where(F.col("rank").isin(wanted)).select(*items.columns, "rank")
