"""Merkle manifest of a dataset: a root for each group of rows, one over all, and a proof for each row.

Every row is a leaf, placed in its group (``lang``) by its doc_id. Places come
from bitmaps, without sorting the leaves: tasks turn the doc_ids they read into
compressed containers of 4,096 ids each, containers of a group and range are
merged, and a directory of their running counts is kept beside them. A leaf's
place is the count before its container plus its rank inside, by popcounts.
Leaves then go to slot arrays keyed by (group, block of 4,096 places); a block is
filled by slot, reduced level by level, and its root is a leaf of the next
round's blocks. The roots of groups are reduced in the same way. Proofs run the
other way, each block handing its nodes' siblings down.

Defined results: null doc_ids stand first, as do null groups; rows that share a
doc_id within a group stand in order of their leaves; repeated rows are leaves of
their own; a null text or other field is hashed as null; an empty table gives no
rows; columns other than the five are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import materialize, read_table
from lectern.llm.scan import running

#: Ids a container covers, places a block covers, as powers of two.
BITS = 12
SIZE = 1 << BITS
#: A key is dealt to several tasks beyond this many rows or this share of all.
HOT_ROWS, HOT_SHARE = 1 << 17, 10_000


def field(value: str | Column) -> Column:
    """A null is ``-``; anything else its count of UTF-8 bytes, a colon and itself."""
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(n_chars: str | Column = "n_chars") -> Column:
    return F.sha2(F.concat(field("doc_id"), field("source"), field("lang"), field(n_chars), field("text")), 256)


class Container:
    """A set of 12-bit numbers with their counts: a sorted array or a bitmap with a popcount directory, and the counts beyond one.

    Layout: distinct and repeated numbers (uint16 each); the array, or 64 words and their 64 running popcounts; the repeated numbers and their further counts.
    """

    def __init__(self, image: bytes):
        n, more = struct.unpack_from("<HH", image)
        at = 4
        self.low = self.words = None
        if n <= SIZE // 16:
            self.low = np.frombuffer(image, "<u2", n, at)
            at += 2 * n
        else:
            self.words, self.before = np.frombuffer(image, "<u8", 64, at), np.frombuffer(image, "<u2", 64, at + 512)
            at += 640
        self.again = np.frombuffer(image, "<u2", more, at)
        self.extra = np.frombuffer(image, "<i8", more, at + 2 * more)
        self.extra_before = np.concatenate([[0], np.cumsum(self.extra)])

    @staticmethod
    def image(low: np.ndarray, counts: np.ndarray) -> bytes:
        """``low``: different numbers, ascending."""
        more = counts > 1
        out = struct.pack("<HH", len(low), int(more.sum()))
        if len(low) <= SIZE // 16:
            out += low.astype("<u2").tobytes()
        else:
            bits = np.zeros(SIZE, np.uint8)
            bits[low] = 1
            words = np.packbits(bits, bitorder="little").view("<u8")
            ones = np.cumsum(np.bitwise_count(words), dtype=np.int64)
            out += words.tobytes() + (ones - np.bitwise_count(words)).astype("<u2").tobytes()
        return out + low[more].astype("<u2").tobytes() + (counts[more] - 1).astype("<i8").tobytes()

    def numbers(self) -> tuple[np.ndarray, np.ndarray]:
        low = self.low if self.low is not None else np.flatnonzero(np.unpackbits(self.words.view(np.uint8), bitorder="little"))
        low, counts = low.astype(np.int64), np.ones(len(low), np.int64)
        counts[np.searchsorted(low, self.again)] += self.extra
        return low, counts

    def rank(self, low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many are smaller, and whether the number occurs more than once."""
        if self.low is not None:
            below = np.searchsorted(self.low, low).astype(np.int64)
        else:
            word = self.words[low >> 6] & ((np.uint64(1) << (low & 63).astype(np.uint64)) - np.uint64(1))
            below = self.before[low >> 6].astype(np.int64) + np.bitwise_count(word)
        k = np.searchsorted(self.again, low)
        several = k < len(self.again)
        several[several] = self.again[k[several]] == low[several]
        return below + self.extra_before[k], several


def containers(leaves: DataFrame) -> DataFrame:
    """lang, chunk, n (rows), image: one merged container for each group and range of ids. A null doc_id is the number 0 of a null chunk."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) >= 1 << 20:
                yield pack(held)
                held = []
        if sum(x.num_rows for x in held):
            yield pack(held)

    def pack(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).group_by(["lang", "doc_id"]).aggregate([([], "count_all")]).combine_chunks()
        lang = table.column("lang").combine_chunks().dictionary_encode(null_encoding="encode")
        ids = table.column("doc_id").combine_chunks()
        null = ids.is_null().to_numpy(zero_copy_only=False)
        ids = ids.fill_null(0).to_numpy()
        code = lang.indices.to_numpy(zero_copy_only=False)
        order = np.lexsort((ids, ~null, code))
        code, null, ids, count = code[order], null[order], ids[order], table.column("count_all").to_numpy()[order]
        chunk = ids >> BITS
        new = np.flatnonzero(np.concatenate([[True], (code[1:] != code[:-1]) | (null[1:] != null[:-1]) | (chunk[1:] != chunk[:-1])]))
        ends = [*new[1:].tolist(), len(ids)]
        images = [Container.image(ids[a:b] & (SIZE - 1), count[a:b]) for a, b in zip(new.tolist(), ends, strict=True)]
        return pa.RecordBatch.from_arrays([lang.dictionary.take(pa.array(code[new])), pa.array(chunk[new], mask=null[new]), pa.array(np.add.reduceat(count, new)), pa.array(images, pa.binary())], names=["lang", "chunk", "n", "image"])

    def merge(table: pa.Table) -> pa.Table:
        total = np.zeros(SIZE, np.int64)
        for image in table.column("image").to_pylist():
            low, counts = Container(image).numbers()
            total[low] += counts
        low = np.flatnonzero(total)
        return pa.table({"lang": table.column("lang")[:1], "chunk": table.column("chunk")[:1], "n": [int(total.sum())], "image": [Container.image(low, total[low])]})

    schema = "lang string, chunk long, n long, image binary"
    parts = leaves.select("lang", "doc_id").mapInArrow(build, schema)
    return parts.groupBy("lang", "chunk").applyInArrow(merge, schema)


def placed(leaves: DataFrame, most_broadcast: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """Leaves with key (the group's place among the groups), n (the group's leaves) and pos (the leaf's place), and the groups (lang, key, n)."""
    held = materialize(running(materialize(containers(leaves), "containers"), "lang", [F.col("chunk").asc_nulls_first()], total="n"), "directory")
    groups = held.groupBy("lang").agg(F.sum("n").alias("size")).withColumn("all", F.lit(0))
    groups = materialize(running(materialize(groups, "groups"), "all", [F.col("lang").asc_nulls_first()]).select(F.col("lang").alias("group"), F.col("index").alias("key"), "size"), "groups")
    named = F.broadcast(groups) if groups.count() <= most_broadcast else groups
    total = groups.agg(F.sum("size")).first()[0] or 0

    hot = held.where(F.col("n") > max(HOT_ROWS, total // HOT_SHARE)).select(F.col("lang").alias("l"), F.col("chunk").alias("c"), F.ceil(F.col("n") / HOT_ROWS).alias("ways"))

    def dealt(rows: DataFrame, share: Column) -> DataFrame:
        met = rows.join(F.broadcast(hot), F.col("lang").eqNullSafe(F.col("l")) & F.col("chunk").eqNullSafe(F.col("c")), "left").drop("l", "c")
        return met.withColumn("salt", share).drop("ways")

    one = F.coalesce("ways", F.lit(1))
    looked_up = dealt(held, F.explode(F.sequence(F.lit(0).cast("long"), one - 1))).join(named, F.col("lang").eqNullSafe(F.col("group")))
    looked_up = looked_up.select("lang", "chunk", "salt", "key", F.col("size").alias("n"), "before", "image")
    asking = dealt(leaves.withColumn("chunk", F.shiftright("doc_id", BITS)), F.pmod(F.xxhash64("row"), one))
    both = looked_up.unionByName(asking.select("lang", "chunk", "salt", "doc_id", "leaf", "tampered", "row"), allowMissingColumns=True)
    both = both.repartition("lang", "chunk", "salt").sortWithinPartitions("lang", "chunk", "salt", F.col("image").isNull())

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A container comes before the rows that ask it."""
        now = None
        for batch in batches:
            heads = np.flatnonzero(~batch.column("image").is_null().to_numpy(zero_copy_only=False)).tolist()
            for a, b in zip([-1, *heads], [*heads, batch.num_rows], strict=True):
                if a >= 0:
                    head = {c: batch.column(c)[a].as_py() for c in ("key", "n", "before", "image")}
                    now = (head["key"], head["n"], head["before"], Container(head["image"]))
                asks = batch.slice(a + 1, b - a - 1)
                if not asks.num_rows:
                    continue
                key, n, before, container = now
                rank, several = container.rank(asks.column("doc_id").fill_null(0).to_numpy() & (SIZE - 1))
                full = lambda x, m=asks.num_rows: pa.array(np.full(m, x, np.int64))
                yield pa.RecordBatch.from_arrays([full(key), full(n), pa.array(before + rank), pa.array(several), *(asks.column(c) for c in ("doc_id", "leaf", "tampered", "row"))], names=["key", "n", "pos", "several", "doc_id", "leaf", "tampered", "row"])

    found = materialize(both.mapInArrow(look_up, "key long, n long, pos long, several boolean, doc_id long, leaf binary, tampered binary, row long"), "places")
    ties = materialize(found.where("several").withColumn("same", F.concat_ws(":", "key", "doc_id")), "ties")
    ranked = running(ties, "same", [F.col("leaf"), F.col("row")]).withColumn("pos", F.col("pos") + F.col("index"))
    out = ["key", "n", "pos", "doc_id", "leaf", "tampered"]
    return found.where("not several").select(out).unionByName(ranked.select(out)), groups


def _hash(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _levels(nodes: list[str], n: int) -> list[list[str]]:
    """A block's levels from ``nodes`` up, as many as a tree of ``n`` nodes has, or a block at most."""
    out = [nodes]
    for _ in range(min(BITS, (n - 1).bit_length())):
        last = out[-1]
        out.append([_hash(*last[i : i + 2]) for i in range(0, len(last), 2)])
    return out


_BLOCK = "key long, block long, n long, digests binary, doc_ids array<long>, tampered array<binary>, root binary"


def blocks(nodes: DataFrame) -> DataFrame:
    """Slot arrays (``_BLOCK``) of ``nodes`` (key, n, pos, leaf, doc_id, tampered), reduced to one root each."""

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                items = row["items"]
                slots: list[tuple | None] = [None] * len(items)
                for x in items:
                    slots[x["slot"]] = (x["leaf"], x["doc_id"], x["tampered"])
                if None in slots:
                    raise ValueError("two leaves share a slot")
                root = _levels([x[0].hex() for x in slots], row["n"])[-1][0]
                one = {"key": row["key"], "block": row["block"], "n": row["n"], "digests": b"".join(x[0] for x in slots), "doc_ids": [x[1] for x in slots], "tampered": [x[2] for x in slots], "root": bytes.fromhex(root)}
                yield pa.RecordBatch.from_pylist([one], _SCHEMA)

    item = F.struct(F.col("pos").bitwiseAND(SIZE - 1).cast("int").alias("slot"), "leaf", "doc_id", "tampered")
    by_block = nodes.groupBy("key", F.shiftright("pos", BITS).alias("block")).agg(F.max("n").alias("n"), F.collect_list(item).alias("items"))
    return materialize(by_block.mapInArrow(fill, _BLOCK), "blocks")


_SCHEMA = pa.schema([("key", pa.int64()), ("block", pa.int64()), ("n", pa.int64()), ("digests", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("tampered", pa.list_(pa.binary())), ("root", pa.binary())])


def _siblings(row: dict) -> tuple[list[str], list[str]]:
    """A block's nodes, and each one's way to the top: ``>`` or ``<`` and the sibling on that side, or ``-``, for each level."""
    nodes = [row["digests"][i : i + 32].hex() for i in range(0, len(row["digests"]), 32)]
    levels = _levels(nodes, row["n"])
    ways = [row["way"]]
    for level in reversed(levels[:-1]):
        ways = [("-" if i ^ 1 >= len(level) else "<>"[~i & 1] + level[i ^ 1]) + ways[i >> 1] for i in range(len(level))]
    return nodes, ways


def steps(way: str) -> Iterator[tuple[str, str]]:
    at = 0
    while at < len(way):
        end = at + (1 if way[at] == "-" else 65)
        yield way[at], way[at + 1 : end]
        at = end


def fold(node: str, way: list[tuple[str, str]]) -> str:
    """The root that a node and the siblings on its way give."""
    for side, other in way:
        node = _hash(node, other) if side == ">" else _hash(other, node) if side == "<" else _hash(node)
    return node


def _hand_down(level: DataFrame, groups: bool) -> DataFrame:
    """key, block, way, subroot of each node of the blocks of ``level``, which are blocks of the next level down."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                nodes, ways = _siblings(row)
                places = np.arange(len(nodes)) + (row["block"] << BITS)
                zero = np.zeros(len(nodes), np.int64)
                own = [bytes.fromhex(x) for x in nodes] if groups else [row["subroot"]] * len(nodes)
                key, block = (places, zero) if groups else (zero + row["key"], places)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(block), pa.array(ways), pa.array(own, pa.binary())], names=["key", "block", "way", "subroot"])

    return level.mapInArrow(run, "key long, block long, way string, subroot binary")


def manifest(docs: DataFrame, tampered: Column) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of each row.

    ``tampered`` is the hex leaf to verify in place of the row's own (null: its own).
    """
    leaves = docs.select("lang", F.col("doc_id").cast("long").alias("doc_id"), F.unhex(leaf()).alias("leaf"), F.unhex(tampered).alias("tampered"))
    leaves = materialize(leaves.withColumn("row", F.monotonically_increasing_id()), "leaves")
    nodes, groups = placed(leaves)
    none = [F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("binary").alias("tampered")]

    def reduced(nodes: DataFrame) -> list[DataFrame]:
        """Rounds of blocks, until each key has one."""
        rounds = [blocks(nodes)]
        while not rounds[-1].where(F.col("n") > SIZE).isEmpty():
            rounds.append(blocks(rounds[-1].select("key", F.ceil(F.col("n") / SIZE).alias("n"), F.col("block").alias("pos"), F.col("root").alias("leaf"), *none)))
        return rounds

    low = reduced(nodes)
    high = reduced(low[-1].select(F.lit(0).cast("long").alias("key"), F.lit(groups.count()).cast("long").alias("n"), F.col("key").alias("pos"), F.col("root").alias("leaf"), *none))
    top = high[-1].select("root").first()
    root = top["root"].hex() if top else ""

    way = high[-1].select("key", "block", F.lit("").alias("way"), F.lit(None).cast("binary").alias("subroot"))
    levels = [(x, False) for x in low] + [(x, k == 0) for k, x in enumerate(high)]
    for level, is_groups in reversed(levels[1:]):
        way = materialize(_hand_down(level.join(way, ["key", "block"]), is_groups), "ways")

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own, ways = _siblings(row)
                proofs, folded = [], []
                for node, new, w in zip(own, row["tampered"], ways, strict=True):
                    way = list(steps(w))
                    proofs.append(_hash(*(x for _, x in way)))
                    folded.append(fold(new.hex() if new else node, way))
                m = len(own)
                yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), *map(pa.array, (own, [row["subroot"].hex()] * m, [root] * m, proofs, folded, [x == root for x in folded]))], names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    schema = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return low[0].join(way, ["key", "block"]).mapInArrow(prove, schema)


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs for all documents, of which those whose doc_id's CRC-32 is divisible by 7 are tampered with: n_chars is one more."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    return manifest(read_table(spark, sf_dir, "documents"), F.when(hit & F.col("n_chars").isNotNull(), leaf(F.col("n_chars") + 1)))


OP11_SQL = r"""
WITH RECURSIVE crc AS (SELECT list(c ORDER BY i) AS t FROM (
       SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS c FROM range(256) r(i))),
raw AS (SELECT doc_id, lang,
               coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || CAST(doc_id AS VARCHAR), '-') || coalesce(octet_length(encode(source)) || ':' || source, '-') || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS head,
               coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || CAST(n_chars AS VARCHAR), '-') AS size, coalesce(octet_length(encode(CAST(n_chars + 1 AS VARCHAR))) || ':' || CAST(n_chars + 1 AS VARCHAR), '-') AS more,
               coalesce(octet_length(encode(text)) || ':' || text, '-') AS body,
               xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda z: CAST(ascii(z) AS BIGINT))), lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1])), 4294967295) % 7 = 0 AS hit
        FROM documents, crc),
d AS (SELECT doc_id, lang, sha256(head || size || body) AS leaf, sha256(head || CASE WHEN hit THEN more ELSE size END || body) AS shown FROM raw),
p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
low AS (SELECT lang, 0 AS k, list(leaf ORDER BY pos) AS hs FROM p GROUP BY lang
        UNION ALL SELECT lang, k + 1, list_transform(range(0, len(hs), 2), lambda i: sha256(hs[i + 1] || coalesce(hs[i + 2], ''))) FROM low WHERE len(hs) > 1),
sub AS (SELECT lang, hs[1] AS subroot, k AS height, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS place FROM low WHERE len(hs) = 1),
high AS (SELECT 0 AS k, list(subroot ORDER BY place) AS hs FROM sub
         UNION ALL SELECT k + 1, list_transform(range(0, len(hs), 2), lambda i: sha256(hs[i + 1] || coalesce(hs[i + 2], ''))) FROM high WHERE len(hs) > 1),
way AS (SELECT p.lang, p.pos, low.k AS k, (p.pos >> low.k) % 2 AS odd, hs[xor(p.pos >> low.k, 1) + 1] AS sib FROM p JOIN low ON low.lang IS NOT DISTINCT FROM p.lang AND len(hs) > 1
        UNION ALL SELECT p.lang, p.pos, sub.height + high.k, (place >> high.k) % 2, hs[xor(place >> high.k, 1) + 1] FROM p JOIN sub ON sub.lang IS NOT DISTINCT FROM p.lang, high WHERE len(hs) > 1),
ways AS (SELECT lang, pos, string_agg(sib, '' ORDER BY k) AS proof, list({'h': sib, 'odd': odd} ORDER BY k) AS steps FROM way GROUP BY lang, pos),
f AS (SELECT p.doc_id, leaf, subroot, (SELECT hs[1] FROM high WHERE len(hs) = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
             list_reduce(list_prepend({'h': shown, 'odd': 0::BIGINT}, coalesce(steps, [])), lambda x, y: {'h': sha256(CASE WHEN y.h IS NULL THEN x.h WHEN y.odd = 1 THEN y.h || x.h ELSE x.h || y.h END), 'odd': 0::BIGINT}).h AS folded_root
      FROM p JOIN sub ON sub.lang IS NOT DISTINCT FROM p.lang LEFT JOIN ways ON ways.lang IS NOT DISTINCT FROM p.lang AND ways.pos = p.pos)
SELECT *, folded_root = root AS verified FROM f
"""
