"""The ledger: what an entry's state becomes, what is stale, duplicates, digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import normal_doi, normal_title


def decide(bib: DataFrame, items: DataFrame, force: bool = False) -> DataFrame:
    """citekey, needs_parse, status of every entry of ``bib``.

    ``bib``: citekey, pdf_hash (null: no file); ``items``: citekey, old_hash,
    old_status, failure_kind, output_present. The first rule that fits decides:
    new, forced, changed, output missing, failed for a passing reason, as it
    was. A discovered entry that was never parsed is queued again.
    """
    has = F.col("pdf_hash").isNotNull()
    fresh = F.when(has, "discovered").otherwise("no_pdf")
    retry = (F.col("old_status") == "parse_failed") & ~F.coalesce(F.col("failure_kind") == "deterministic", F.lit(False))
    rows = bib.join(items.withColumn("there", F.lit(True)), "citekey", "left")
    changed = F.col("there").isNull() | ~F.col("pdf_hash").eqNullSafe(F.col("old_hash")) | (F.lit(force) & has)
    again = has & (((F.col("old_status") == "parsed") & ~F.col("output_present")) | retry | (F.col("old_status") == "discovered"))
    return rows.select("citekey", F.when(changed, has).otherwise(again).alias("needs_parse"), F.when(changed, fresh).when(again, "discovered").otherwise(F.col("old_status")).alias("status"))


def stale(items: DataFrame, bib: DataFrame) -> DataFrame:
    """Items that the bibliography no longer has."""
    return items.join(bib.select("citekey"), "citekey", "left_anti")


def prune(items: DataFrame, bib: DataFrame) -> DataFrame:
    """``items`` without stale ones; refused for an empty bibliography and a ledger that isn't."""
    if bib.isEmpty() and not items.isEmpty():
        raise ValueError("the bibliography is empty: nothing is pruned")
    return items.join(bib.select("citekey"), "citekey", "left_semi")


def failure_counts(items: DataFrame) -> DataFrame:
    """Failed items by kind; no kind counts as transient."""
    kind = F.when(F.col("failure_kind") == "deterministic", "deterministic").otherwise("transient")
    return items.where("status = 'parse_failed'").groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


def duplicate_groups(items: DataFrame) -> DataFrame:
    """Groups of two citekeys or more with one DOI, or one title: reason, citekeys.

    A set of citekeys that both give is reported once, for its DOI. Empty keys
    group nothing. ``items``: citekey, title, doi.
    """
    doi = items.select(F.lit("doi").alias("reason"), normal_doi("doi").alias("value"), "citekey")
    title = items.select(F.lit("title").alias("reason"), normal_title("title").alias("value"), "citekey")
    groups = doi.unionByName(title).where("value <> ''").groupBy("reason", "value").agg(F.array_join(F.array_sort(F.collect_set("citekey")), ",").alias("citekeys"))
    return groups.where(F.col("citekeys").contains(",")).groupBy("citekeys").agg(F.min("reason").alias("reason"))


def digest(keys: DataFrame, buckets: int = 4096) -> DataFrame:
    """One row: n and a 12-character digest of the set of citekeys, whatever their order.

    Keys are digested in hashed buckets, then the buckets' digests, so that no
    task holds all keys.
    """
    parts = keys.select("citekey").distinct().groupBy(F.substring(F.sha2("citekey", 256), 1, 3).alias("bucket")).agg(F.count("*").alias("n"), F.sha2(F.array_join(F.array_sort(F.collect_list("citekey")), "\n"), 256).alias("digest"))
    whole = F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "digest"))), lambda x: x["digest"]), "\n"), 256)
    return parts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.substring(whole, 1, 12).alias("digest"))


#: Phrases of a timeout, and of a device without memory, in an error text.
TIMEOUTS = ["document timeout", "document processing timeout"]
OUT_OF_MEMORY = ["CUDA out of memory", "CUDA error: out of memory"]


def _any_of(text: Column, phrases: list[str]) -> Column:
    out = F.lit(False)
    for p in phrases:
        out = out | text.contains(p)
    return F.coalesce(out, F.lit(False))


def failure_kind(outcomes: DataFrame) -> DataFrame:
    """``outcomes`` (category, error, worker) with kind and timed_out.

    transient: no memory on a device, or a worker that died or stalled; the rest,
    timeouts too, would fail again. The error's words count for a timeout only
    without a category.
    """
    passing = F.col("worker").isin("died", "stalled") | _any_of(F.col("error"), OUT_OF_MEMORY)
    late = F.when(F.col("category").isNotNull(), F.col("category") == "timeout").otherwise(_any_of(F.lower("error"), TIMEOUTS))
    kind = F.when(F.coalesce(passing, F.lit(False)), "transient").otherwise("deterministic")
    return outcomes.withColumns({"kind": kind, "timed_out": late})


def record_outcomes(items: DataFrame, outcomes: DataFrame) -> DataFrame:
    """``items`` (citekey, status, parsed_path, error, failure_kind) after a run.

    ``outcomes``: citekey, path, error, kind. A parsed item gets its path and
    loses its error; a failed one gets error and kind; others stay as they are.
    """
    out = outcomes.select("citekey", F.col("path").alias("new_path"), F.col("error").alias("new_error"), F.coalesce("kind", F.lit("deterministic")).alias("new_kind"), F.lit(True).alias("ran"))
    rows = items.join(out, "citekey", "left")
    failed, done = F.col("new_error").isNotNull(), F.col("ran").isNotNull()
    return rows.select(
        "citekey",
        F.when(done & failed, "parse_failed").when(done, "parsed").otherwise(F.col("status")).alias("status"),
        F.when(done & ~failed, F.col("new_path")).otherwise(F.col("parsed_path")).alias("parsed_path"),
        F.when(done, F.col("new_error")).otherwise(F.col("error")).alias("error"),
        F.when(done & failed, F.col("new_kind")).when(done, None).otherwise(F.col("failure_kind")).alias("failure_kind"),
    )


def run_summary(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row: parsed, failed, unchanged, no_pdf of a run, from the states before and after it."""
    rows = before.select("citekey", F.col("needs_parse")).join(after.select("citekey", "status"), "citekey")
    return rows.agg(
        F.count_if(F.col("needs_parse") & (F.col("status") == "parsed")).alias("parsed"),
        F.count_if(F.col("needs_parse") & (F.col("status") == "parse_failed")).alias("failed"),
        F.count_if(~F.col("needs_parse") & (F.col("status") != "no_pdf")).alias("unchanged"),
        F.count_if(F.col("status") == "no_pdf").alias("no_pdf"),
    )


def by_status(items: DataFrame, status: str | None = None) -> DataFrame:
    """Items of a status (None: all)."""
    return items if status is None else items.where(F.col("status") == status)


def all_there(rows: DataFrame, asked: DataFrame, known: DataFrame, what: str = "not in the ledger") -> DataFrame:
    """``rows``, if ``known`` has every citekey of ``asked``; else the plan fails when it runs, and names up to 50 that it lacks.

    The check is a branch of the plan that gives no rows; nothing is collected beforehand.
    """
    lost = asked.select("citekey").where("citekey is not null").distinct().join(known.select("citekey"), "citekey", "left_anti")
    bad = lost.withColumn("h", F.xxhash64("citekey") % 1024).groupBy("h").agg(F.count("*").alias("n"), F.slice(F.array_sort(F.collect_set("citekey")), 1, 50).alias("some"))
    bad = bad.agg(F.sum("n").alias("n"), F.slice(F.array_sort(F.flatten(F.collect_list("some"))), 1, 50).alias("some")).where("n > 0")
    said = F.concat(F.lit(f"{what}: "), F.array_join("some", ", "), F.when(F.col("n") > 50, F.concat(F.lit(" and "), (F.col("n") - 50).cast("string"), F.lit(" more"))).otherwise(""))
    fails = bad.select(F.raise_error(said).alias("e")).where("e is null")
    return rows.unionByName(fails.select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema)))


def named(items: DataFrame, keys: list[str]) -> DataFrame:
    """The items of ``keys``; missing keys are an error that names them, raised by the plan."""
    found = items.where(F.col("citekey").isin(keys))
    return all_there(found, items.sparkSession.createDataFrame([(k,) for k in keys], "citekey string"), found)
