"""Which text of an item counts, what another layer's parse is good for, and which draft a dossier belongs to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.text import pages, strip_images

#: What a draft may be, the first that exists counts.
DRAFT_SUFFIXES = [".md", ".tex"]


def best_text(items: DataFrame) -> DataFrame:
    """citekey, source and text: the layout parse without image marks, else the parsed text, else a fresh extraction, else null.

    ``items``: citekey, layout, parsed, fresh (null: there is none; empty texts count).
    """
    rungs = [("layout", strip_images("layout")), ("parsed", F.col("parsed")), ("fresh", F.col("fresh"))]
    source, text = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, value in reversed(rungs):
        source, text = (F.when(F.col(name).isNotNull(), x).otherwise(y) for x, y in ((F.lit(name), source), (value, text)))
    return items.select("citekey", source.alias("source"), text.alias("text"))


def page_source(items: DataFrame) -> DataFrame:
    """citekey, source, page, text: pages of the file if it can be read, else those of the parsed text; one without either has no rows. ``items``: citekey, file_text, parsed."""
    source = F.when(F.col("file_text").isNotNull(), "file").when(F.col("parsed").isNotNull(), "parsed")
    rows = items.select("citekey", source.alias("source"), F.explode(pages(F.coalesce("file_text", "parsed"))).alias("p"))
    return rows.where("source is not null").select("citekey", "source", "p.page", "p.text")


def reusable(items: DataFrame, images: bool = False) -> DataFrame:
    """``items`` (citekey, pdf_time, text_time, sidecar_time, ...) with reuse: whether the other layer's parse can be taken over.

    Both its files must be there and no older than the document; never if
    ``images`` are wanted, as that parse has none.
    """
    older = F.least("text_time", "sidecar_time")  # skips nulls, so both are asked for
    there = F.col("text_time").isNotNull() & F.col("sidecar_time").isNotNull() & F.col("pdf_time").isNotNull()
    return items.withColumn("reuse", F.lit(not images) & there & F.coalesce(older >= F.col("pdf_time"), F.lit(False)))


def taken_over(text: str | Column) -> Column:
    """Another layer's text in this one's form: page breaks as blank lines, no more than one blank line in a row."""
    return F.regexp_replace(F.regexp_replace(text, "\f", "\n\n"), r"\n{3,}", "\n\n")


def fits_cache(now: DataFrame, stored: DataFrame) -> DataFrame:
    """``now`` (citekey, size, modified, present) with hit: stored (citekey, size, modified) says the same and the outputs are present."""
    old = stored.select("citekey", F.col("size").alias("s"), F.col("modified").alias("m"), F.lit(True).alias("known"))
    rows = now.join(old, "citekey", "left")
    same = F.col("known") & F.col("size").eqNullSafe(F.col("s")) & F.col("modified").eqNullSafe(F.col("m")) & F.col("present")
    return rows.select(*now.columns, F.coalesce(same, F.lit(False)).alias("hit"))


def relative_name(path: str | Column, root: str) -> Column:
    """A file's path below ``root``, without its suffix; one outside of it, or with a step up, fails the plan."""
    path = F.col(path) if isinstance(path, str) else path
    bare = F.regexp_replace(path, r"^[a-z][a-z0-9+.-]*:/*(?=/)", "")
    top = root.rstrip("/").split("://")[-1].removeprefix("file:") + "/"
    inside = bare.startswith(top) & ~bare.rlike(r"(^|/)\.\.(/|$)")
    outside = F.raise_error(F.concat(F.coalesce(path, F.lit("null")), F.lit(f" is not under {root}")))
    return F.when(inside, F.regexp_replace(F.substring(bare, len(top) + 1, 1 << 30), r"\.[^./]*$", "")).otherwise(outside)


def drafts(spark: SparkSession, root: str) -> DataFrame:
    """name, path and text of the drafts below ``root``; of a name with several suffixes the first of ``DRAFT_SUFFIXES`` counts."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.{md,tex}").option("wholetext", True).text(root)
    rows = files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    rank = F.when(F.col("path").endswith(DRAFT_SUFFIXES[0]), 0).otherwise(1)
    rows = rows.withColumn("name", relative_name("path", root))
    best = rows.groupBy("name").agg(F.min_by(F.struct("path", "text"), rank).alias("d"))
    return best.select("name", "d.path", "d.text")


def dossier_files(spark: SparkSession, root: str, names: list[str]) -> DataFrame:
    """dossier (its path below ``root``), name and text of the files called one of ``names`` below ``root``."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.md").option("wholetext", True).text(root)
    rows = files.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"), F.col("value").alias("text")).where(F.col("name").isin(names))
    return rows.select(F.regexp_replace(relative_name("path", root), "/?[^/]*$", "").alias("dossier"), "name", "text")


def with_drafts(dossiers: DataFrame, found: DataFrame) -> DataFrame:
    """``dossiers`` (dossier, ...) with the path of their draft: the one of the same name (null: it is gone)."""
    return dossiers.join(found.select(F.col("name").alias("dossier"), F.col("path").alias("draft")), "dossier", "left")
