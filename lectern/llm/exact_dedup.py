"""Exact deduplication against a persistent digest index, in DataFrame functions only.

The index is a table on shared storage with one row for each different text: its
SHA-256 digest and the row that stays, bucketed and sorted by digest. New data is
reduced to one row a digest (so a group of copies is counted where it is read),
joined to the index by a sort-merge anti-join that moves no row of the index, and
what is new is appended. A row that the index holds already stays; of the copies
in one batch the one with the largest doc_id does. A batch that was added in part
before a crash can be added again: only what lacks is appended.

Defined results: a null text equals an empty one; a null doc_id is smaller than
all others; of rows repeated with the same doc_id and text exactly one stays; an
empty table gives no rows; columns other than doc_id and text are ignored,
whatever their names.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import materialize, read_table, scratch_path

#: Distinct digests a bucket is meant to hold.
BUCKET_ROWS = 4_000_000
#: A digest is hot beyond this share of all rows, so there are fewer than its inverse of them.
HOT_SHARE = 1000


def sign(docs: DataFrame) -> DataFrame:
    """digest, doc_id, batch, row of every row, as a table: the text is read once, and row tells repeated rows apart."""
    digest = F.unhex(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
    signed = docs.select(digest.alias("digest"), F.col("doc_id").cast("long").alias("doc_id"))
    return materialize(signed.withColumns({"batch": F.lit(uuid.uuid4().hex), "row": F.monotonically_increasing_id()}), "signed")


class DigestIndex:
    """The index in folder ``path``. The number of buckets is fixed when it is made, and read from it later."""

    def __init__(self, spark: SparkSession, path: str, buckets: int | None = None):
        self.spark = spark
        try:
            buckets = spark.read.schema("buckets int").parquet(f"{path}/layout").first()["buckets"]
        except AnalysisException:
            buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
            spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.parquet(f"{path}/layout")
        self.name = f"digest_index_{hashlib.md5(path.encode()).hexdigest()}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} (digest BINARY, doc_id BIGINT, batch STRING, row BIGINT) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}/entries'"
        )

    def entries(self) -> DataFrame:
        return self.spark.table(self.name)

    def fresh(self, signed: DataFrame) -> DataFrame:
        """The digests of ``signed`` that the index lacks, each with the row that stays."""
        first = signed.groupBy("digest").agg(F.max(F.struct("doc_id", "batch", "row")).alias("keep"))
        new = first.join(self.entries().select("digest").hint("merge"), "digest", "left_anti")
        return new.select("digest", "keep.doc_id", "keep.batch", "keep.row")

    def add(self, signed: DataFrame) -> None:
        self.fresh(signed).write.insertInto(self.name)


def verdicts(signed: DataFrame, index: DigestIndex) -> DataFrame:
    """doc_id, keep_id, group_size (rows of ``signed`` with the text), kept and text_sha256 of every row.

    Rows of hot digests get their class by broadcast, all others by a join in
    which no key has more than a small share of the rows.
    """
    copies = signed.groupBy("digest").agg(F.count("*").alias("group_size"))
    classes = index.entries().select("digest", F.struct("doc_id", "batch", "row").alias("keep")).hint("merge").join(copies, "digest")
    classes = materialize(classes, "classes")
    bound = max(1, signed.count() // HOT_SHARE)
    hot = classes.where(F.col("group_size") > bound).select("digest", F.struct("keep", "group_size").alias("class"))
    rest = classes.where(F.col("group_size") <= bound)
    met = signed.join(F.broadcast(hot), "digest", "left")
    rows = met.where("class is not null").select("digest", "doc_id", "batch", "row", "class.keep", "class.group_size")
    rows = rows.unionByName(met.where("class is null").drop("class").join(rest.hint("merge"), "digest"))
    kept = F.struct("doc_id", "batch", "row").eqNullSafe(F.col("keep"))
    return rows.select("doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size", kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index all documents in two batches, the larger doc_ids first, and return each one's class.

    The row with the largest doc_id stays, as what the index holds already does.
    """
    signed = sign(read_table(spark, sf_dir, "documents"))
    rows, middle = signed.agg(F.count("*"), F.percentile_approx("doc_id", 0.5)).first()
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // BUCKET_ROWS))
    index = DigestIndex(spark, scratch_path(spark, "digest-index"), buckets)
    late = F.coalesce(F.col("doc_id") > F.lit(middle), F.lit(False))
    index.add(signed.where(late))
    index.add(signed.where(~late))
    return verdicts(signed, index)


OP12_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
