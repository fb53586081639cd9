"""WARC records and Merkle fixity audits of their replicas.

An archive is a set of segments; a record is a span of bytes in one. ``audit``
hashes each record, then each ordered range of offsets (``fan_out`` times as
wide a level), up to a segment's root and to roots over ranges of segments.
Starting from the top it joins the two replicas' digests level by level, keeps
the ranges that differ, and looks only at their children. Digests are gathered
at most ``fan_out`` at a time, records by 64 KiB of offsets.

Defined results: null fields are written empty; a record that one replica lacks
is ``missing`` or ``extra``; equal replicas give no rows; a record that a
replica holds several times at one offset counts by its smallest and largest
digest; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lectern.llm.common import materialize

RANGE_BITS, FAN_BITS = 16, 4


def record_bytes(uri: Column, body: Column) -> Column:
    """A WARC resource record as text: header lines, a blank line, the body and two line ends."""
    body = F.coalesce(body, F.lit(""))
    head = ["WARC/1.1\r\nWARC-Type: resource\r\nWARC-Target-URI: ", F.coalesce(uri, F.lit("")), "\r\nContent-Type: text/html\r\nContent-Length: ", F.octet_length(body).cast("string"), "\r\n\r\n", body, "\r\n\r\n"]
    return F.concat(*(F.lit(x) if isinstance(x, str) else x for x in head))


def archive(pages: DataFrame, segment_records: int = 256) -> DataFrame:
    """Lay records out: key, segment, offset, length, record. ``pages``: page_id, url, html.

    A segment holds the page_ids of one range of ``segment_records``; lengths,
    not bytes, are ordered to find the offsets.
    """
    loose = -1 - F.pmod(F.xxhash64("url", "html"), F.lit(4096))  # pages without an id spread over segments of their own
    segment = F.coalesce(F.floor(F.col("page_id") / segment_records), loose).cast("long")
    rows = pages.select(F.col("page_id").alias("key"), segment.alias("segment"), record_bytes(F.col("url"), F.col("html")).alias("record"))
    return rows.withColumn("length", F.octet_length("record").cast("long"))


def index(records: DataFrame) -> DataFrame:
    """key, segment, offset, length and digest of laid-out records."""
    small = records.select("key", "segment", "length", F.sha2("record", 256).alias("digest"))
    before = Window.partitionBy("segment").orderBy(F.col("key").asc_nulls_first(), "digest").rowsBetween(Window.unboundedPreceding, -1)
    return small.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))


def write_warc(records: DataFrame, path: str) -> None:
    """Write one text file of concatenated records a segment range, in offset order."""
    records.repartitionByRange("segment").sortWithinPartitions("segment", F.col("key").asc_nulls_first()).select("record").write.option("lineSep", "\r\n").text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of WARC files: file, offset, length, uri, body, digest. One file is read by one task."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib

        for pdf in batches:
            for file, raw in zip(pdf["path"], pdf["content"], strict=True):
                at, rows = 0, []
                while (at := raw.find(b"WARC/1.", at)) >= 0:
                    end = raw.index(b"\r\n\r\n", at) + 4
                    head = dict(x.split(b": ", 1) for x in raw[at:end].split(b"\r\n")[1:] if b": " in x)
                    size = int(head[b"Content-Length"])
                    stop = end + size + 4
                    rows.append((file, at, stop - at, head.get(b"WARC-Target-URI", b"").decode(), raw[end : end + size].decode("utf-8", "replace"), hashlib.sha256(raw[at:stop]).hexdigest()))
                    at = stop
                yield pd.DataFrame(rows, columns=["file", "offset", "length", "uri", "body", "digest"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(parse, "file string, offset long, length long, uri string, body string, digest string")


def _leaves(records: DataFrame) -> DataFrame:
    return records.groupBy("segment", "offset").agg(F.sha2(F.concat(F.min("digest"), F.max("digest"), F.max("length").cast("string")), 256).alias("digest"))


def _parents(level: DataFrame, segment: Column, place: Column) -> DataFrame:
    """Digest of each range over its ordered children, as a table: plans of many levels would outgrow the driver."""
    children = F.array_sort(F.collect_list(F.struct("segment", "place", "digest")))
    return materialize(level.groupBy(segment.alias("segment"), place.alias("place")).agg(F.sha2(F.to_json(children), 256).alias("digest")), "ranges")


def tree(records: DataFrame, offset_bits: int, segment_bits: int) -> list[tuple[str, DataFrame]]:
    """Levels from records up: offset ranges, segments, ranges of segments, one root a sign of the segment.

    ``records``: segment, offset, length, digest, with numbers of at most so many bits.
    """
    level = materialize(_leaves(records).withColumnRenamed("offset", "place"), "leaves")
    levels, shift = [("record", level)], RANGE_BITS
    level = _parents(level, F.col("segment"), F.shiftright("place", RANGE_BITS))
    levels.append(("range", level))
    while shift < offset_bits:
        level = _parents(level, F.col("segment"), F.shiftright("place", FAN_BITS))
        levels.append(("range", level))
        shift += FAN_BITS
    for _ in range(0, segment_bits, FAN_BITS):
        level = _parents(level, F.shiftright("segment", FAN_BITS), F.lit(0).cast("long"))
        levels.append(("segments", level))
    return levels


def audit(left: DataFrame, right: DataFrame) -> DataFrame:
    """Records where two replicas differ: segment, offset, status (corrupt, missing or extra in ``right``).

    Both have segment, offset, length and digest.
    """
    tops = left.select("segment", "offset").unionByName(right.select("segment", "offset")).agg(F.max("offset"), F.max(F.abs("segment"))).first()
    bits = [max(1, int(b or 0).bit_length()) for b in tops]
    trees = list(zip(tree(left, *bits), tree(right, *bits), strict=True))
    suspects = None
    for depth, ((kind, a), (_, b)) in reversed(list(enumerate(trees))):
        if suspects is not None:
            below = trees[depth + 1][0][0]
            if below == "segments":
                up = [F.shiftright("segment", FAN_BITS).alias("segment"), F.lit(0).cast("long").alias("place")]
            else:
                up = [F.col("segment"), F.shiftright("place", RANGE_BITS if kind == "record" else FAN_BITS).alias("place")]
            parents = suspects.select(F.col("segment").alias("up_segment"), F.col("place").alias("up_place"))

            def within(x: DataFrame, up=up, parents=parents) -> DataFrame:
                return x.join(parents, (up[0] == F.col("up_segment")) & (up[1] == F.col("up_place")), "left_semi")

            a, b = within(a), within(b)
        both = a.withColumnRenamed("digest", "a").join(b.withColumnRenamed("digest", "b"), ["segment", "place"], "full")
        suspects = materialize(both.where(~F.col("a").eqNullSafe(F.col("b"))), "suspects")
    status = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").otherwise("corrupt")
    return suspects.select("segment", F.col("place").alias("offset"), status.alias("status"))


def replica(records: DataFrame, spoil_every: int = 53, lose_every: int = 101) -> DataFrame:
    """A second copy whose storage spoiled one byte of some records and lost others.

    Which: those whose key times 7919 is divisible by ``spoil_every``, or leaves
    1 divided by ``lose_every``. Keeps each record's place.
    """
    spoilt = F.pmod(F.col("key") * 7919, F.lit(spoil_every)) == 0
    record = F.when(spoilt, F.concat(F.expr("substring(record, 1, length(record) - 5)"), F.lit("~"), F.expr("right(record, 4)"))).otherwise(F.col("record"))
    return records.withColumn("record", record).withColumn("lost", F.pmod(F.col("key") * 7919, F.lit(lose_every)) == 1)


def op5_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive all pages, spoil a replica, audit it against the archive, and return where they differ."""
    records = archive(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    left = materialize(index(records), "archive")
    placed = left.select("key", "segment", "offset", F.col("digest").alias("was"))
    copy = replica(records.withColumn("was", F.sha2("record", 256))).where(~F.coalesce("lost", F.lit(False)))
    copy = copy.select("key", "segment", "length", "was", F.sha2("record", 256).alias("digest"))
    right = materialize(copy.join(placed, copy["key"].eqNullSafe(placed["key"]) & (copy["segment"] == placed["segment"]) & (copy["was"] == placed["was"])).select(copy["segment"], "offset", "length", "digest"), "replica")
    found = audit(left, right)
    return found.join(left, ["segment", "offset"], "left").select(F.col("key").alias("page_id"), "segment", "offset", "length", "status")


OP5_SQL = r"""
WITH r AS (SELECT page_id, CAST(floor(page_id / 256.0) AS BIGINT) AS segment,
                  CAST(octet_length(encode('WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
                       || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: ' || CAST(octet_length(encode(coalesce(html, ''))) AS VARCHAR))) AS BIGINT) + 8 + octet_length(encode(coalesce(html, ''))) AS length,
                  right(coalesce(html, ''), 1) AS last_char
           FROM pages),
o AS (SELECT *, coalesce(sum(length) OVER (PARTITION BY segment ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first FROM r)
SELECT page_id, segment, CAST(first AS BIGINT) AS "offset", length, CASE WHEN (page_id * 7919) % 101 = 1 THEN 'missing' ELSE 'corrupt' END AS status
FROM o WHERE (page_id * 7919) % 101 = 1 OR (page_id * 7919) % 53 = 0
"""
