"""Bibliography files: entries, those that were dropped, names, attachments.

A file is a row (path, text), or, if it may be large, read in splits
(``scan_files``). Files are cut at entry starts, and each entry is parsed in its task by a small reader of braces and quotes. An entry whose braces
don't close before the next one starts is dropped, and counted.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.functions.text import author_names, citekey_problem
from lectern.operators.graph import kept

#: Blocks that are no entries, and why an entry has no file.
NOT_ENTRIES = ["comment", "string", "preamble"]
RESOLVED, NO_FIELD, MALFORMED, GONE, OTHER = "resolved", "no_file_field", "malformed_file_field", "pdf_path_gone", "non_pdf_attachment"
#: Fields that a reference list may need.
KEPT_FIELDS = "author editor journal journaltitle booktitle series volume number pages publisher institution school address location edition howpublished organization eprint eprinttype archiveprefix primaryclass".split()

_START = re.compile(r"@(\w+)\s*([{(])\s*([^,{}()\"]*?)\s*(?=[,})])")
_NAME = re.compile(r"[\s,]*([A-Za-z][\w:-]*)\s*=\s*")


def raw_entries(files: DataFrame) -> DataFrame:
    """path, n and raw: the text of each block that starts like an entry, in file order."""
    parts = F.split("text", r"(?m)^(?=@\w+\s*[{(])")
    rows = files.select("path", F.posexplode(parts).alias("n", "raw")).where(F.regexp_like("raw", F.lit(r"^@\w+\s*[{(]")))
    return rows.where(~F.lower(F.regexp_extract("raw", r"^@(\w+)", 1)).isin(NOT_ENTRIES))


def _value(text: str, at: int) -> tuple[str, int] | None:
    """A field's value from ``at`` on, and where it ends; None if it doesn't end."""
    if at < len(text) and text[at] in '{"':
        depth, quoted, begin = 0, text[at] == '"', at + 1
        for k in range(at, len(text)):
            c = text[k]
            if c == '"' and quoted and depth == 0 and k > at:
                return text[begin:k], k + 1
            depth += (c == "{") - (c == "}")
            if not quoted and depth == 0:
                return text[begin:k], k + 1
        return None
    end = re.compile(r"[^,})\s]*").match(text, at).end()
    return text[at:end], end


def read_entry(raw: str) -> tuple[str, str, dict[str, str]] | None:
    """(type, citekey, fields) of an entry; None if it can't be read to its end."""
    head = _START.match(raw)
    if not head:
        return None
    close, at, fields = "}" if head[2] == "{" else ")", head.end(), {}
    while name := _NAME.match(raw, at):
        found = _value(raw, name.end())
        if found is None:
            return None
        fields[name[1].lower()] = " ".join(found[0].split())
        at = found[1]
    rest = raw[at:].lstrip(" \t\r\n,")
    return (head[1].lower(), head[3], fields) if rest.startswith(close) else None


def parsed(raw: DataFrame) -> DataFrame:
    """path, n, item_type, citekey and fields of raw entries (path, n, raw); citekey null: it can't be read."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [read_entry(x) or (None, None, None) for x in pdf["raw"]]
            yield pdf[["path", "n"]].assign(item_type=[x[0] for x in found], citekey=[x[1] for x in found], fields=[x[2] for x in found])

    return raw.select("path", "n", "raw").mapInPandas(run, f"path string, n {raw.schema['n'].dataType.simpleString()}, item_type string, citekey string, fields map<string,string>")


def entries(files: DataFrame) -> DataFrame:
    """The entries of files that are rows (path, text)."""
    return parsed(raw_entries(files))


_ENTRY_START = re.compile(r"@\w+\s*[{(]")


def scan_files(spark: SparkSession, path: str, split_bytes: int | None = None) -> DataFrame:
    """path, n (grows along the file) and raw of the blocks that start like an entry, of files of any size.

    A file is read in splits, as lines; a task keeps the blocks that lie in its
    split whole, and hands on two pieces of text: what stands before its first
    entry, and its last entry, which may go on. These pieces alone meet, a few
    for each split, and an entry that spans several splits is put together.
    """
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    if split_bytes:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"), F.col("value").alias("t"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, seq, open_ = None, [], 0, False

        def piece(whole: bool) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"path": [at[0]], "split": [at[1]], "seq": [seq], "starts": [open_], "whole": [whole], "raw": ["\n".join(held) + "\n"]}, _PIECES)

        for batch in batches:
            for p, split, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (p, split) != at:
                    if at and held:
                        yield piece(False)
                    at, held, seq, open_ = (p, split), [], 0, False
                if _ENTRY_START.match(t):
                    if held:
                        yield piece(open_)
                    held, seq, open_ = [], seq + 1, True
                held.append(t)
        if at and held:
            yield piece(False)

    out = lines.mapInArrow(cut, "path string, split long, seq long, starts boolean, whole boolean, raw string")
    pieces = kept(out, "entries")
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    loose = pieces.where("not whole")
    order = Window.partitionBy("path").orderBy("split", "seq")
    loose = loose.withColumn("entry", F.sum(F.col("starts").cast("int")).over(order)).where("entry > 0")
    joined = loose.groupBy("path", "entry").agg(F.array_sort(F.collect_list(F.struct("split", "seq", "raw"))).alias("all"))
    first = F.get("all", F.lit(0))
    joined = joined.select("path", first["split"].alias("split"), first["seq"].alias("seq"), F.array_join(F.transform("all", lambda x: x["raw"]), "").alias("raw"))
    rows = pieces.where("whole").select("path", "split", "seq", "raw").unionByName(joined)
    # a split of n bytes holds fewer than n entries, so this orders them along the file
    rows = rows.select("path", (F.col("split") + F.col("seq")).alias("n"), "raw")
    return rows.where(~F.lower(F.regexp_extract("raw", r"^@(\w+)", 1)).isin(NOT_ENTRIES))


_PIECES = pa.schema([("path", pa.string()), ("split", pa.int64()), ("seq", pa.int64()), ("starts", pa.bool_()), ("whole", pa.bool_()), ("raw", pa.string())])


def entry_source(raw: str) -> tuple[str, str] | None:
    """An entry's citekey, and its text to the brace that closes it (all of it, if none does)."""
    head = re.match(r"@\w+\s*([{(])\s*([^,\s{}()]+)\s*,", raw)
    if not head:
        return None
    depth = 0
    for k in range(head.start(1), len(raw)):
        c = raw[k]
        if head[1] == "(" and c == ")" and depth == 1:
            return head[2], raw[: k + 1]
        depth += (c in "{(" if k == head.start(1) else c == "{") - (c == "}")
        if depth == 0:
            return head[2], raw[: k + 1]
    return head[2], raw.rstrip()


def lookup(raw: DataFrame, keys: DataFrame) -> DataFrame:
    """citekey and source of the entries of ``keys`` (citekey), the first one of several; a key that no file has has an empty source.

    ``raw``: path, n, raw. Blocks that hold none of the keys at their head aren't read further.
    """
    head = F.regexp_extract("raw", r"^@\w+\s*[{(]\s*([^,\s{}()]+)\s*,", 1)
    found = raw.withColumn("citekey", head).join(keys.select("citekey").distinct(), "citekey", "left_semi")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf[["path", "n", "citekey"]].assign(source=[entry_source(x)[1] for x in pdf["raw"]])

    rows = found.mapInPandas(run, f"path string, n {raw.schema['n'].dataType.simpleString()}, citekey string, source string")
    rows = rows.groupBy("citekey").agg(F.min_by("source", F.struct("path", "n")).alias("source"))
    return keys.select("citekey").distinct().join(rows, "citekey", "left").select("citekey", F.coalesce("source", F.lit("")).alias("source"))


def dropped(parsed: DataFrame) -> DataFrame:
    """path, found and dropped: how many entries each file has, and how many of them can't be read."""
    return parsed.groupBy("path").agg(F.count("*").alias("found"), F.count_if(F.col("citekey").isNull()).alias("dropped"))


def field(name: str, fields: str | Column = "fields") -> Column:
    return F.get(F.map_values(F.map_filter(fields, lambda k, v: k == name)), F.lit(0))


def attachments(value: Column) -> Column:
    """(mime, path) of each ``name:path:mime`` of a file field; a path may hold colons."""
    parts = F.filter(F.transform(F.split(value, ";"), lambda a: F.split(a, ":")), lambda p: F.size(p) >= 3)
    return F.transform(parts, lambda p: F.struct(F.element_at(p, -1).alias("mime"), F.array_join(F.slice(p, F.lit(2), F.size(p) - 2), ":").alias("path")))


def library(parsed: DataFrame, listing: DataFrame) -> DataFrame:
    """The entries with a usable citekey: names, year, doi, url, fields, and the PDF that ``listing`` (path) has.

    Of several PDFs the first that is there counts; a missing one says more than
    an attachment of another kind.
    """
    rows = parsed.where(F.col("citekey").isNotNull() & citekey_problem("citekey").isNull())
    rows = rows.withColumn("files", attachments(F.coalesce(field("file"), F.lit(""))))
    rows = rows.withColumn("pdfs", F.filter("files", lambda a: F.lower(a["mime"]).contains("pdf")))
    tried = rows.select("path", "n", F.posexplode(F.transform("pdfs", lambda a: a["path"])).alias("at", "pdf"))
    there = tried.join(listing.select(F.col("path").alias("pdf")).distinct(), "pdf", "left_semi")
    there = there.groupBy("path", "n").agg(F.min_by("pdf", "at").alias("pdf_path"))
    rows = rows.join(there, ["path", "n"], "left")
    why = F.when(F.col("pdf_path").isNotNull(), RESOLVED).when(field("file").isNull(), NO_FIELD).when(F.size("pdfs") > 0, GONE)
    why = why.when(F.size("files") > 0, OTHER).otherwise(MALFORMED)
    title = F.translate(F.coalesce(field("title"), F.lit("Untitled")), "{}", "")
    year = F.coalesce(field("year"), F.lit("n.d."))
    names = author_names(F.coalesce(field("author"), F.lit("")))
    return rows.select("citekey", "item_type", title.alias("title"), names.alias("authors"), year.alias("year"), field("doi").alias("doi"), field("url").alias("url"), "fields", "pdf_path", why.alias("pdf_resolution"))


def kept_fields(fields: str | Column = "fields") -> Column:
    """The fields for reference lists as JSON with sorted keys; null without one."""
    kept = F.map_filter(fields, lambda k, v: F.lower(k).isin(KEPT_FIELDS) & (F.trim(v) != ""))
    ordered = F.map_from_entries(F.array_sort(F.map_entries(kept)))
    return F.when(F.size(kept) > 0, F.to_json(ordered))


def without_authors(refs: DataFrame) -> DataFrame:
    return refs.where(F.size("authors") == 0).select("citekey")


def missing_reasons(refs: DataFrame) -> DataFrame:
    """How many entries have no file, by reason."""
    return refs.where(F.col("pdf_resolution") != RESOLVED).groupBy("pdf_resolution").agg(F.count("*").alias("n"))
