"""URL filter: a blocked Bloom filter before an exact hash join.

Rules are (host, path prefix, verdict). A rule fits its host and all subdomains
if the url's path starts with the rule's; the longest rule wins. Each distinct
url gives one canonical key for each host suffix and each path length that some
rule has; a blocked Bloom filter of the rules' keys drops nearly all of them,
and an exact join on the key's text removes the false positives.

The filter is broadcast only up to ``most_bytes``; with more rules all keys go
to the join. Path lengths are collected: there are no more than the longest
rule's path has characters.

Defined results: a null url, or one without ``://``, has an empty host and path
and fits no rule; repeated urls are judged once and joined back to their rows;
of equally long rules the one with the longer host, then the smaller text,
wins; without rules all urls are allowed; other columns pass through, but for
those named host, path, rule or verdict, which are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_BIT_SHIFTS = (0, 6, 12, 18, 24, 30)


def url_parts(url: str = "url") -> tuple:
    """Columns of the host (A-Z lower-cased) and the path."""
    rest = F.when(F.instr(url, "://") > 0, F.expr(f"substring({url}, instr({url}, '://') + 3)")).otherwise("")
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(F.regexp_replace(rest, r"^[^/?#]*", ""), r"^[^?#]*", 0)
    return host, path


class BlockedBloom:
    """One 64-bit word a block; a key sets six bits of its block."""

    def __init__(self, words: np.ndarray):
        self.words = words

    @staticmethod
    def bits(h: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h), np.uint64)
        for s in _BIT_SHIFTS:
            out |= np.uint64(1) << ((h >> np.uint64(s)) & np.uint64(63))
        return out

    @staticmethod
    def block(h: np.ndarray, blocks: int) -> np.ndarray:
        return ((h >> np.uint64(36)).astype(np.uint64) % np.uint64(blocks)).astype(np.int64)

    def may_hold(self, h: np.ndarray) -> np.ndarray:
        h = h.astype(np.int64).view(np.uint64)
        need = self.bits(h)
        return (self.words[self.block(h, len(self.words))] & need) == need


def build_bloom(keys: DataFrame, column: str, count: int, bits_per_key: int = 16, part_blocks: int = 1 << 17) -> BlockedBloom:
    """OR the keys' bits in Spark; the driver takes one run of ``part_blocks`` packed blocks after the other, and holds the filter alone."""
    blocks = max(1, count * bits_per_key // 64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            block = BlockedBloom.block(h, blocks)
            cols = [block // part_blocks, block % part_blocks, BlockedBloom.bits(h).view(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["part", "at", "bits"])

    def packed(part: pa.Table) -> pa.Table:
        words = np.zeros(part_blocks, np.uint64)
        np.bitwise_or.at(words, part["at"].to_numpy(), part["bits"].to_numpy().view(np.uint64))
        return pa.table({"part": part["part"][:1], "words": [words.tobytes()]})

    filled = keys.select(column).where(F.col(column).isNotNull()).mapInArrow(place, "part long, at long, bits long").groupBy("part").applyInArrow(packed, "part long, words binary")
    words = np.zeros(blocks, np.uint64)
    for row in filled.toLocalIterator():
        own = words[row["part"] * part_blocks : (row["part"] + 1) * part_blocks]
        own[:] = np.frombuffer(row["words"], np.uint64, len(own))
    return BlockedBloom(words)


def filter_urls(pages: DataFrame, rules: DataFrame, most_bytes: int = 64 << 20, bits_per_key: int = 16) -> DataFrame:
    """``pages`` (a column url) with host, path, rule and verdict. ``rules``: host, path, verdict."""
    spark = pages.sparkSession
    pages = pages.drop("host", "path", "rule", "verdict")
    rules = rules.select(F.concat("host", "path").alias("rule"), F.length("host").alias("host_chars"), "verdict", F.length("path").alias("path_chars"))
    rules = rules.groupBy("rule", "host_chars", "path_chars").agg(F.max("verdict").alias("verdict")).withColumn("key_hash", F.xxhash64("rule"))
    lengths = sorted(r[0] for r in rules.select("path_chars").distinct().collect() if r[0] is not None)
    count = rules.count()
    host, path = url_parts()
    labels = F.split("host", "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.transform(F.filter(F.array(*map(F.lit, lengths)) if lengths else F.array().cast("array<int>"), lambda n: n <= F.length("path")), lambda n: F.expr("path").substr(F.lit(1), n))
    urls = pages.select("url").where(F.col("url").isNotNull()).distinct().withColumns({"host": host, "path": path}).where("host <> ''")
    keys = urls.withColumn("keys", F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.struct(F.concat(s, p).alias("rule"), F.length(s).alias("host_chars"))))))
    if count * bits_per_key <= 8 * most_bytes:
        bloom = spark.sparkContext.broadcast(build_bloom(rules, "key_hash", count, bits_per_key))

        @F.pandas_udf("array<int>")
        def may_hold(hashes: pd.Series) -> pd.Series:
            size = hashes.map(len).to_numpy()
            flat = np.concatenate([np.asarray(x, np.int64) for x in hashes]) if size.sum() else np.zeros(0, np.int64)
            hit = bloom.value.may_hold(flat)
            return pd.Series([np.flatnonzero(x).astype(np.int32) for x in np.split(hit, np.cumsum(size)[:-1])] if len(size) else [], dtype=object)

        possible = keys.select("url", "keys", F.explode(may_hold(F.transform("keys", lambda k: F.xxhash64(k["rule"])))).alias("at"))
        keys = possible.select("url", F.get("keys", F.col("at")).alias("key"))
    else:
        keys = keys.select("url", F.explode("keys").alias("key"))
    found = keys.select("url", "key.*").join(rules, ["rule", "host_chars"])
    best = F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), "host_chars", F.col("rule")))
    found = found.groupBy("url").agg(best.alias("best")).select("url", "best.rule", "best.verdict")
    out = pages.join(found, "url", "left")
    whole = {"host": F.coalesce(host, F.lit("")), "path": F.coalesce(path, F.lit("")), "verdict": F.coalesce("verdict", F.lit("allow"))}
    return out.withColumns(whole)


#: The contract's rules.
OP6_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge the url of every page."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    rules = spark.createDataFrame(OP6_RULES, "host string, path string, verdict string")
    return filter_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


OP6_SQL = r"""
WITH r(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
s AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*') AS path FROM u),
m AS (SELECT page_id, arg_max(h || p, length(h || p)) AS rule, arg_max(v, length(h || p)) AS verdict
      FROM s JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT s.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM s LEFT JOIN m USING (page_id)
"""
