"""Drift of dossiers against the corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def missing(cited: DataFrame, known: DataFrame) -> DataFrame:
    """Cited keys that the corpus no longer has."""
    return cited.join(known.select("citekey"), "citekey", "left_anti")


def _hits(matches: DataFrame) -> DataFrame:
    return matches.groupBy("dossier", "citekey").agg(F.array_join(F.array_sort(F.collect_set("query_id")), ",").alias("queries"))


def candidates(matches: DataFrame, cited: DataFrame, rejected: DataFrame) -> DataFrame:
    """Keys that a dossier's queries reach, neither cited nor rejected there. ``matches``: dossier, query_id, citekey."""
    seen = cited.select("dossier", "citekey").unionByName(rejected.select("dossier", "citekey"))
    return _hits(matches).join(seen, ["dossier", "citekey"], "left_anti")


def reconsider(matches: DataFrame, cited: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rejected keys that the queries still reach, with the reason."""
    return _hits(matches).join(rejected.select("dossier", "citekey", "reason"), ["dossier", "citekey"]).join(cited.select("dossier", "citekey"), ["dossier", "citekey"], "left_anti")


def unconsidered(known: DataFrame, cited: DataFrame, rejected: DataFrame) -> DataFrame:
    """How many known keys each dossier mentions nowhere.

    Counted as all keys less those mentioned, so that no dossier meets every key.
    """
    n = known.select("citekey").distinct().count()
    mentioned = cited.select("dossier", "citekey").unionByName(rejected.select("dossier", "citekey")).distinct()
    here = mentioned.join(known.select("citekey").distinct().withColumn("there", F.lit(1)), "citekey", "left")
    return here.groupBy("dossier").agg((n - F.count("there")).alias("unconsidered"))


#: A citekey in backticks, with a separator at least.
KEY_TOKEN = r"`([A-Za-z][A-Za-z0-9]*(?:[_:-]+[A-Za-z0-9]+)+)`"
CORPUS_LINE = r"(?m)^-\s*corpus:\s*(\d+)\s+citekeys?,\s*digest\s*`?([0-9a-f]+)`?"


def key_tokens(text: str | Column) -> Column:
    return F.regexp_extract_all(text, F.lit(KEY_TOKEN), F.lit(1))


def table_rows(files: DataFrame, cells: int) -> DataFrame:
    """dossier, line and cells of the table rows of exactly so many cells; pipes behind a backslash don't split."""
    rows = files.select("dossier", F.posexplode(F.split("text", "\n", -1)).alias("line", "t")).withColumn("t", F.trim("t")).where(F.col("t").startswith("|"))
    split = F.transform(F.split(F.regexp_replace("t", r"^\|+|\|+$", ""), r"(?<!\\)\|", -1), lambda c: F.trim(c))
    return rows.select("dossier", "line", split.alias("cells")).where(F.size("cells") == cells)


def rejections(files: DataFrame) -> DataFrame:
    """dossier, citekey and reason of what was turned down; a later row replaces an earlier one."""
    rows = table_rows(files, 3).select("dossier", "line", F.explode(key_tokens(F.col("cells")[0])).alias("citekey"), F.col("cells")[2].alias("reason"))
    return rows.groupBy("dossier", "citekey").agg(F.max_by("reason", "line").alias("reason"))


def section_keys(files: DataFrame) -> DataFrame:
    """dossier, line, section, ord and citekey of the section table, without its header."""
    rows = table_rows(files, 3).where(~F.regexp_like(F.col("cells")[0], F.lit("^[-: ]+$")) & (F.lower(F.col("cells")[0]) != "section"))
    return rows.select("dossier", "line", F.col("cells")[0].alias("section"), F.posexplode(key_tokens(F.col("cells")[1])).alias("ord", "citekey"))


def sections_of_keys(keys: DataFrame) -> DataFrame:
    """dossier, citekey and its sections, in order."""
    out = keys.groupBy("dossier", "citekey").agg(F.array_sort(F.collect_set(F.struct("line", "section"))).alias("s"))
    return out.select("dossier", "citekey", F.array_join(F.transform("s", lambda x: x["section"]), "; ").alias("sections"))


def evidence_blocks(files: DataFrame) -> DataFrame:
    """dossier, citekey and block: each block from its heading on, by the heading's first key, or its text. The last of a key counts."""
    rows = files.select("dossier", F.posexplode(F.split("text", "\n", -1)).alias("line", "t"))
    order = Window.partitionBy("dossier").orderBy("line")
    rows = rows.withColumn("block", F.sum(F.col("t").startswith("## ").cast("int")).over(order)).where("block > 0")
    found = rows.groupBy("dossier", "block").agg(F.array_sort(F.collect_list(F.struct("line", "t"))).alias("own"))
    head = F.trim(F.substring(F.col("own")[0]["t"], 4, 1 << 30))
    key = F.coalesce(F.get(key_tokens(head), F.lit(0)), F.regexp_replace(head, "^[` ]+|[` ]+$", ""))
    body = F.concat(F.regexp_replace(F.array_join(F.transform("own", lambda x: x["t"]), "\n"), r"\s+$", ""), F.lit("\n"))
    named = found.select("dossier", "block", key.alias("citekey"), body.alias("body"))
    return named.groupBy("dossier", "citekey").agg(F.max_by("body", "block").alias("block"))


def recorded_corpus(files: DataFrame) -> DataFrame:
    """dossier, n and digest of the first corpus line; dossiers without one are left out."""
    n, digest = (F.regexp_extract("text", CORPUS_LINE, k) for k in (1, 2))
    return files.select("dossier", n.alias("n"), digest.alias("digest")).where("n <> ''").select("dossier", F.col("n").cast("long").alias("n"), "digest")


#: What the files of a dossier hold; a file of another name holds prose.
FILE_KINDS = {"evidence.md": "blocks", "rejected.md": "rows", "sections.md": "rows", "retrieval.md": "rows"}


def line_tallies(files: DataFrame, *by: str) -> DataFrame:
    """``by`` with blocks, rows (headers of tables too) and prose: how many lines of a file are of each kind, comments left out.

    Lines are told apart one by one, so a long file is only a long list of lines.
    """
    bare = F.regexp_replace(F.coalesce("text", F.lit("")), r"(?s)<!--.*?-->", "")
    lines = files.select(*by, F.explode(F.split(bare, "\n", -1)).alias("t")).withColumn("first", F.substring(F.ltrim("t"), 1, 1))
    ruler = F.regexp_like("t", F.lit(r"^[|\-: \t]*$"))
    kinds = {
        "blocks": F.col("t").startswith("## "),
        "rows": (F.col("first") == "|") & ~ruler,
        "prose": F.regexp_like("t", F.lit(r"\S")) & (F.col("first") != "#"),
    }
    return lines.groupBy(*by).agg(*(F.count_if(test).alias(name) for name, test in kinds.items()))


def entry_counts(files: DataFrame) -> DataFrame:
    """dossier with blocks, rows (without one header; -1 where there is no table) and prose lines of a file."""
    return line_tallies(files, "dossier").withColumn("rows", F.col("rows") - 1)


def file_counts(files: DataFrame) -> DataFrame:
    """dossier, name, kind and entries of each file (dossier, name, text), counted as its name says."""
    kind = F.lit("prose")
    for name, what in FILE_KINDS.items():
        kind = F.when(F.col("name") == name, what).otherwise(kind)
    rows = line_tallies(files, "dossier", "name").withColumn("kind", kind)
    entries = F.when(F.col("kind") == "blocks", F.col("blocks")).when(F.col("kind") == "rows", F.col("rows") - 1).otherwise(F.col("prose"))
    return rows.select("dossier", "name", "kind", entries.alias("entries"))


def normal_section(name: str | Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(name), r"\s+", " "))


def match_sections(wanted: DataFrame, keys: DataFrame) -> DataFrame:
    """dossier, wanted and section: the one named so, else the only one of which either name holds the other; else null.

    Only the sections of the same dossier are tried, so this is an equi-join.
    """
    known = keys.groupBy("dossier", "section").agg(F.min("line").alias("line")).withColumn("own", normal_section("section"))
    rows = wanted.withColumn("asked", normal_section("wanted")).join(known, "dossier", "left")
    rows = rows.withColumns({"same": F.col("own") == F.col("asked"), "near": F.col("own").contains(F.col("asked")) | F.col("asked").contains(F.col("own"))})
    out = rows.groupBy("dossier", "wanted").agg(F.min_by("section", F.when(F.col("same"), F.col("line"))).alias("exact"), F.count_if("same").alias("n"), F.count_if("near").alias("m"), F.max(F.when(F.col("near"), F.col("section"))).alias("only"))
    return out.select("dossier", "wanted", F.when(F.col("n") > 0, F.col("exact")).when(F.col("m") == 1, F.col("only")).alias("section"))


def brief(asked: DataFrame, blocks: DataFrame) -> DataFrame:
    """dossier, citekey and block of what a brief asks for; a missing block is null."""
    return asked.select("dossier", "citekey").distinct().join(blocks, ["dossier", "citekey"], "left")


def drift_flags(recorded: DataFrame, digest: str | Column) -> DataFrame:
    """dossier, n, digest and drifted: whether the corpus has another digest now."""
    return recorded.withColumn("drifted", F.col("digest") != digest)


def mentioned(files: list[DataFrame]) -> DataFrame:
    """The different citekeys in backticks of all files (text)."""
    out = None
    for rows in files:
        own = rows.select(F.explode(key_tokens("text")).alias("citekey"))
        out = own if out is None else out.unionByName(own)
    return out.distinct()
