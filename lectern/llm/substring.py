"""Substring deduplication on a compacted de Bruijn graph of token windows.

Each window of ``window`` words is an edge between the word sequences it starts
and ends with. The graph keeps edges that may occur in two documents: windows
whose minimiser (the smallest hash of its inner word runs) occurs in two. One
aggregation over the minimisers of all texts gives, beside their documents, the
minimisers that stand before and after each: one that has two different ones on
a side is a branching node. Between branching nodes a path is compacted to one
piece, named by a digest of its words, so equal passages give equal pieces
wherever they stand. A join of the pieces with each one's first document settles
every later copy of a piece at once. Only one copy of each piece is opened into
edges, which a second join resolves against the first document that holds each
edge. Piece offsets and source coordinates then give the words to remove in each
text.

Pieces are equal if 128-bit digests of their words are, edges if two independent
64-bit hashes are; nothing rests on one 64-bit hash. Repeated and branching
minimisers are sent out as Bloom filters up to ``most_bytes`` each; beyond that
all edges are kept, or paths are cut only where kept edges end, which costs a
larger shuffle and changes no result.

Defined results: null texts have no words; rows with a null doc_id are returned
whole and are nobody's source; rows that repeat a doc_id are judged one by one,
and only against smaller doc_ids; an empty table gives no rows; other columns
pass through, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.common import SALTS, drop_tables, materialize, mix, text_buffer, text_key, text_slices, word_hashes
from lectern.llm.url_filter import build_bloom

def _windows(h: np.ndarray, bounds: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Places at which a window of one row starts, and their rows."""
    per = np.maximum(np.diff(bounds) - window + 1, 0)
    row = np.repeat(np.arange(len(per)), per)
    place = np.arange(len(row)) - (np.cumsum(per) - per)[row] + bounds[:-1][row]
    return place, row


def _rolling(h: np.ndarray, size: int, salt: int = 20) -> np.ndarray:
    """A hash of each run of ``size`` words; ``salt`` tells independent ones apart."""
    n = len(h) - size + 1
    if n <= 0:
        return h[:0]
    out = np.zeros(n, np.uint64)
    for j in range(size):
        out += h[j : j + n] * SALTS[(salt + j) % len(SALTS)]
    return mix(out)


def minimisers(h: np.ndarray, place: np.ndarray, window: int) -> np.ndarray:
    """The minimiser of the window at each place."""
    inner = window // 2 + 1
    g = _rolling(h, inner)
    if not len(place):
        return g[:0]
    n = len(g) - (window - inner)
    least = g[:n].copy()
    for j in range(1, window - inner + 1):
        np.minimum(least, g[j : j + n], out=least)
    return least[place]


def repeated_minimisers(docs: DataFrame, window: int) -> DataFrame:
    """Minimisers (m) of two doc_ids or more, and whether each is a branching node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in text_slices(batch):
                h, _, _, bounds = word_hashes(*text_buffer(rows.column(1)))
                place, row = _windows(h, bounds, window)
                m = minimisers(h, place, window)
                new = np.ones(len(m), bool)
                new[1:] = (m[1:] != m[:-1]) | (row[1:] != row[:-1])
                m, row = m[new].view(np.int64), row[new]
                before, after = np.zeros((2, len(m)), np.int32)
                same = row[1:] == row[:-1]
                low = m.astype(np.int32)
                before[1:], after[:-1] = np.where(same, low[:-1], 0), np.where(same, low[1:], 0)
                cols = [pa.array(m), rows.column(0).take(pa.array(row)), pa.array(before), pa.array(after)]
                yield pa.RecordBatch.from_arrays(cols, names=["m", "doc_id", "before", "after"])

    found = docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(run, "m long, doc_id long, before int, after int")
    ends = [f(c).alias(f"{c}_{k}") for c in ("doc_id", "before", "after") for k, f in (("x", F.min), ("y", F.max))]
    found = found.groupBy("m").agg(*ends).where("doc_id_x < doc_id_y")
    return found.select("m", ((F.col("before_x") != F.col("before_y")) | (F.col("after_x") != F.col("after_y"))).alias("branching"))


def pieces(docs: DataFrame, window: int, repeated, branching) -> DataFrame:
    """piece (digest), doc_id, key, start and the edges (two hashes each) of every piece of every path."""
    shared = docs.sparkSession.sparkContext.broadcast((repeated, branching))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated, branching = shared.value
        for batch in batches:
            for rows in text_slices(batch):
                raw, offsets = text_buffer(rows.column(2))
                h, starts, ends, bounds = word_hashes(raw, offsets)
                place, row = _windows(h, bounds, window)
                m = minimisers(h, place, window)
                if repeated is not None:
                    kept = repeated.may_hold(m.view(np.int64))
                    place, row, m = place[kept], row[kept], m[kept]
                if not len(place):
                    continue
                edge, check = (_rolling(h, window, salt)[place] for salt in (20, 40))
                head = np.ones(len(edge), bool)
                head[1:] = (place[1:] != place[:-1] + 1) | (row[1:] != row[:-1])
                if branching is not None:
                    node = branching.may_hold(m.view(np.int64))
                    head[1:] |= (m[1:] != m[:-1]) & (node[1:] | node[:-1])
                first = np.flatnonzero(head)
                last = np.append(first[1:], len(edge)) - 1
                text = raw.tobytes()
                a, b = starts[place[first]].tolist(), ends[place[last] + window - 1].tolist()
                names = [hashlib.blake2b(b" ".join(text[x:y].split()), digest_size=16).digest() for x, y in zip(a, b, strict=True)]
                cuts = pa.array(np.append(first, len(edge)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(cuts, pa.array(x.view(np.int64))) for x in (edge, check)]
                owner = pa.array(row[first])
                at = pa.array((place[first] - bounds[:-1][row[first]]).astype(np.int32))
                cols = [pa.array(names, pa.binary()), rows.column(0).take(owner), rows.column(1).take(owner), at, *lists]
                yield pa.RecordBatch.from_arrays(cols, names=["piece", "doc_id", "key", "start", "edges", "checks"])

    schema = "piece binary, doc_id long, key long, start int, edges array<long>, checks array<long>"
    return docs.where("doc_id is not null").select("doc_id", "key", "text").mapInArrow(run, schema)


def repeated_spans(docs: DataFrame, window: int = 13, most_bytes: int = 64 << 20, bits_per_key: int = 12) -> DataFrame:
    """doc_id, key and the spans (start, stop: words) that repeat windows of smaller doc_ids."""
    again = materialize(repeated_minimisers(docs, window), "minimisers")

    def filter_of(rows: DataFrame):
        count = rows.count()
        return build_bloom(rows, "m", count, bits_per_key) if count * bits_per_key <= 8 * most_bytes else None

    found = materialize(pieces(docs, window, filter_of(again), filter_of(again.where("branching"))), "pieces")
    drop_tables(again)
    named = found.groupBy("piece").agg(F.min(F.struct("doc_id", "edges", "checks")).alias("first"))
    named = named.select("piece", "first.*").withColumn("id", F.monotonically_increasing_id())
    named = materialize(named.withColumnRenamed("doc_id", "first_doc"), "named")
    edges = named.select("id", "first_doc", F.posexplode(F.arrays_zip("edges", "checks")).alias("at", "e"))
    edges = edges.select("id", "first_doc", "at", "e.edges", "e.checks")
    sources = edges.groupBy("edges", "checks").agg(F.min("first_doc").alias("source"), F.max("first_doc").alias("other"))
    sources = materialize(sources.where("source < other").select("edges", "checks", "source"), "sources")
    inner = edges.join(sources, ["edges", "checks"]).where("source < first_doc")
    inner = materialize(inner.groupBy("id").agg(F.sort_array(F.collect_list("at")).alias("inner")), "inner")
    first = named.select("piece", "first_doc", "id", F.size("edges").alias("n")).join(inner, "id", "left")
    placed = found.select("piece", "doc_id", "key", "start").join(first, "piece")
    whole = F.array(F.struct(F.col("start"), (F.col("start") + F.col("n") + window - 1).alias("stop")))
    parts = F.transform("inner", lambda i: F.struct((F.col("start") + i).alias("start"), (F.col("start") + i + window).alias("stop")))
    spans = placed.select("doc_id", "key", F.when(F.col("doc_id") > F.col("first_doc"), whole).otherwise(parts).alias("s")).where("s is not null")
    spans = materialize(spans.groupBy("doc_id", "key").agg(F.flatten(F.collect_list("s")).alias("spans")), "spans")
    drop_tables(found, named, sources, inner)
    return spans


def drop_repeats(docs: DataFrame, window: int = 13, with_text: bool = False) -> DataFrame:
    """``docs`` (doc_id, text, ...) with _n_words, _n_removed and the kept words' digest, or with the kept words; columns of these names are replaced."""
    kept_name = "_kept" if with_text else "_kept_sha256"
    docs = docs.drop("_n_words", "_n_removed", kept_name)
    passed = [c for c in docs.columns if with_text or c != "text"]
    row = F.struct(*(F.col(f"`{c}`") for c in passed)).alias("row")
    keyed = docs.select(row, "doc_id", text_key().alias("key"), "text")
    spans = repeated_spans(keyed.select("doc_id", "key", "text"), window)
    spans = spans.select(F.col("doc_id").alias("d"), F.col("key").alias("t"), "spans").hint("shuffle_hash")
    joined = keyed.join(spans, (keyed["doc_id"] == F.col("d")) & (keyed["key"] == F.col("t")), "left").select("row", "text", "spans")
    extra = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in text_slices(batch):
                n_words, n_removed, kept = [], [], []
                for text, cuts in zip(rows.column("text").to_pylist(), rows.column("spans").to_pylist(), strict=True):
                    words = (text or "").encode().split()
                    left, at = [], 0
                    for c in sorted(cuts or (), key=lambda c: c["start"]):
                        left += words[at : c["start"]]
                        at = max(at, c["stop"])
                    left += words[at:]
                    n_words.append(len(words))
                    n_removed.append(len(words) - len(left))
                    joined_words = b" ".join(left)
                    kept.append(joined_words.decode() if with_text else hashlib.sha256(joined_words).hexdigest())
                cols = [rows.column("row"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names=["row", *(f.name for f in extra)])

    out = joined.mapInArrow(run, T.StructType([joined.schema["row"], *extra]))
    return out.select("row.*", F.col("n_words").alias("_n_words"), F.col("n_removed").alias("_n_removed"), F.col("kept").alias(kept_name))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Remove from every document the windows of smaller doc_ids."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(F.col("doc_id").cast("long"), "text")
    return drop_repeats(docs).select("doc_id", F.col("_n_words").alias("n_words"), F.col("_n_removed").alias("n_removed"), F.col("_kept_sha256").alias("kept_sha256"))


OP4_SQL = r"""
WITH t AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i : i + 12], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM t WHERE len(w) >= 13)),
bad AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY k) AS first FROM win) WHERE first < doc_id),
cov AS (SELECT doc_id, list(DISTINCT p) AS ps FROM (SELECT doc_id, unnest(range(i, i + 13)) AS p FROM bad) GROUP BY doc_id)
SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(ps), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(array_to_string(CASE WHEN ps IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(ps, i)) END, ' '), '')) AS kept_sha256
FROM t LEFT JOIN cov USING (doc_id)
"""
