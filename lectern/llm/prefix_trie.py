"""Prefix trie over conversations: which openings they share, and what a cache of them saves.

Conversations are rebuilt (``rebuilt``), and each turn gets a 128-bit digest of all
turns up to it (``running``). Distinct digests are the nodes; their counts are
summed before the shuffle, so an opening that most conversations share costs no
more than another. Sums over subtrees come in two steps:

* Nodes with ``shard_rows`` turns or fewer below them lie in subtrees of bounded
  size, which are dealt to shards. A shard has a minimal perfect hash over its
  digests: counts are scattered into flat arrays by slot, each node's parent
  digest becomes a parent slot, and sums flow along parent slots from the deepest
  level up. A slot counts only if the digest stored there is the one looked up.
* The few nodes above them take the shards' sums, and sum over their own
  descendants by doubling distances, so a long chain takes few rounds.

A digest is taken for a node only if all conversations agree on the turn, the
depth and the digest before it; otherwise the query fails.

Defined results: turns without a conv_id belong to no conversation and are left
out; a null role or text is empty; turns with the same number are ordered by
their digest; repeated rows are turns of their own; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import materialize, mix, read_table, words_of
from lectern.llm.scan import running

#: Turns of a conversation that are joined under one key.
BLOCK = 4096
#: The root's digest: of no turns.
ROOT = (0, 0)


class PerfectSlots:
    """A minimal perfect hash of different 128-bit keys.

    Each level is a bit array in which keys that hash to a place of their own set
    its bit; the others go on to the next. A key's slot is the rank of its bit,
    from a directory of popcounts. Keys that were not among those given get any
    slot or none (-1).
    """

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.levels, base, left = [], 0, np.arange(len(a))
        while len(left):
            if len(self.levels) == 200:
                raise ValueError("keys occur twice")
            size = 64 * (len(left) * 5 // 256 + 1)
            at = self._hash(a[left], b[left], len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            bits = np.packbits(alone, bitorder="little").view("<u8")
            ones = np.cumsum(np.bitwise_count(bits).astype(np.int64))
            self.levels.append((size, bits, base + np.concatenate([[0], ones[:-1]])))
            base += int(ones[-1])
            left = left[~alone[at]]

    @staticmethod
    def _hash(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
        salt = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        return (mix((a ^ salt) + mix(b + salt)) % np.uint64(size)).astype(np.int64)

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        slot, left = np.full(len(a), -1), np.arange(len(a))
        for level, (size, bits, directory) in enumerate(self.levels):
            at = self._hash(a[left], b[left], level, size)
            word, bit = bits[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            rank = directory[at >> 6] + np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            slot[left[hit]] = rank[hit]
            left = left[~hit]
        return slot


def sum_subtrees(key: np.ndarray, parent: np.ndarray, depth: np.ndarray, n_convs: np.ndarray, words: np.ndarray, conv_id: np.ndarray) -> dict[str, np.ndarray]:
    """Sums over the subtrees of whole tries; ``key`` and ``parent`` have two columns. Returned in the order given, parent_slot -1 at the tops."""
    table = PerfectSlots(key[:, 0], key[:, 1])
    own = table(key[:, 0], key[:, 1])
    n = len(own)
    if n and (own.min() < 0 or len(np.unique(own)) < n):
        raise ValueError("slots collide")
    stored = np.empty_like(key)
    stored[own] = key
    up = table(parent[:, 0], parent[:, 1])
    up[(up >= 0) & (stored[up] != parent).any(axis=1)] = -1
    slot_up, at_depth, children, saved, first = (np.zeros(n, np.int64) for _ in range(5))
    slot_up[own], at_depth[own], saved[own], first[own] = up, depth, (n_convs - 1) * words, conv_id
    np.add.at(children, up[up >= 0], 1)
    leaves = (children == 0).astype(np.int64)
    order = np.argsort(at_depth, kind="stable")[::-1]
    for level in np.split(order, np.flatnonzero(np.diff(at_depth[order])) + 1):
        level = level[slot_up[level] >= 0]
        np.add.at(leaves, slot_up[level], leaves[level])
        np.add.at(saved, slot_up[level], saved[level])
    return {"parent_slot": up, "parent_conv_id": first[up], "n_children": children[own], "n_leaves": leaves[own], "saved_tokens": saved[own]}


def rebuilt(conversations: DataFrame, family: int = 20, shared: int = 4) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, at, digest, words) and conversations (conv_id, length), rebuilt.

    A conversation gets the first h turns of the first one of its ``family``,
    then its own after its first h; h is the CRC-32 of its number modulo ``shared``.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    turns = conversations.where("conv_id is not null").select("conv_id", "turn", digest.alias("digest"), F.size(words_of(F.col("text"))).cast("long").alias("words"))
    turns = materialize(turns.withColumn("row", F.monotonically_increasing_id()), "turns")
    placed = running(turns, "conv_id", [F.col("turn").asc_nulls_first(), F.col("digest"), F.col("row")])
    placed = placed.select("conv_id", F.col("index").alias("at"), "digest", "words")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % shared
    head = F.sort_array(F.collect_list(F.when(F.col("at") < shared - 1, F.struct("at", "digest", "words"))))
    convs = materialize(placed.groupBy("conv_id").agg(F.count("*").alias("n"), head.alias("head")), "conversations")
    of = convs.select("conv_id", "n", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    of = of.join(convs.select(F.col("conv_id").alias("base"), "head"), "base", "left")
    got = F.coalesce(F.slice("head", F.lit(1), F.col("h").cast("int")), F.array())
    of = materialize(of.select("conv_id", got.alias("head"), F.greatest(F.col("n") - F.col("h"), F.lit(0)).alias("own")), "heads")
    heads = of.select("conv_id", F.explode("head").alias("t")).select("conv_id", "t.at", "t.digest", "t.words")
    rows = materialize(heads.unionByName(placed.where(F.col("at") >= h)), "rebuilt")
    return rows, of.select("conv_id", (F.size("head") + F.col("own")).alias("length"))


def _blocks(length: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), F.floor((length - 1) / BLOCK)))


def ends_digests(ends: DataFrame, chunk: int = 4096) -> DataFrame:
    """a, b, ends_sha256 of ``ends`` (a, b, conv_id): the ascending conv_ids of each node, joined by commas.

    Tasks join runs of ids first; only these strings meet, and they are hashed as they stream by.
    """

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, ids = None, []

        def flush():
            return pa.RecordBatch.from_pydict({"a": [key[0]], "b": [key[1]], "first": [ids[0]], "ids": [",".join(map(str, ids))]})

        for batch in batches:
            for a, b, c in zip(*(batch.column(x).to_pylist() for x in ("a", "b", "conv_id")), strict=True):
                if ids and ((a, b) != key or len(ids) == chunk):
                    yield flush()
                    ids = []
                key = (a, b)
                ids.append(c)
        if ids:
            yield flush()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, out = None, None, []
        for batch in batches:
            for a, b, ids in zip(*(batch.column(x).to_pylist() for x in ("a", "b", "ids")), strict=True):
                if (a, b) != key:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = (a, b), hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if len(out) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=["a", "b", "ends_sha256"])
                out = []
        if key is not None:
            out.append((*key, state.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out, strict=True)], names=["a", "b", "ends_sha256"])

    ranged = ends.repartitionByRange("a", "b", "conv_id").sortWithinPartitions("a", "b", "conv_id")
    joined = ranged.mapInArrow(runs, "a long, b long, first long, ids string").repartition("a", "b").sortWithinPartitions("a", "b", "first")
    return joined.mapInArrow(hashed, "a long, b long, ends_sha256 string")


def trie_nodes(rows: DataFrame, lengths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The nodes below the root, and the rows (conv_id, depth, a, b, length) of each conversation's path."""
    chained = running(rows, "conv_id", [F.col("at")], chain="digest").withColumn("depth", F.col("index") + 1)
    blocks = lengths.where("length > 0").select("conv_id", "length", _blocks(F.col("length")).alias("block"))
    chained = chained.withColumn("block", F.floor(F.col("index") / BLOCK)).join(blocks, ["conv_id", "block"])
    chained = materialize(chained.select("conv_id", "depth", "length", "a", "b", "pa", "pb", "digest", "words"), "paths")
    seen = F.struct("depth", "pa", "pb", "digest")
    nodes = chained.groupBy("a", "b").agg(
        F.count("*").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.max("words").alias("words"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("rows"),
        F.min(seen).alias("low"),
        F.max(seen).alias("high"),
    )
    sound = (F.col("low") == F.col("high")) & ((F.col("a") != ROOT[0]) | (F.col("b") != ROOT[1]))
    depth = F.when(sound, F.col("low.depth")).otherwise(F.raise_error(F.lit("two prefixes have one digest")))
    nodes = nodes.select("a", "b", "n_convs", "conv_id", "words", "rows", depth.alias("depth"), "low.pa", "low.pb")
    return materialize(nodes, "nodes"), chained


_SUMS = "conv_id long, depth long, a long, b long, pa long, pb long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def _shards(shard_rows: int):
    """Sums of the subtrees of one task, a bounded number of nodes at a time. Rows of a subtree stand together."""

    def solve(table: pa.Table) -> pa.RecordBatch:
        col = {c: table.column(c).to_numpy() for c in ("a", "b", "pa", "pb", "depth", "n_convs", "words", "conv_id")}
        key, parent = (np.stack([col[x].view(np.uint64), col[y].view(np.uint64)], axis=1) for x, y in (("a", "b"), ("pa", "pb")))
        s = sum_subtrees(key, parent, col["depth"], col["n_convs"], col["words"], col["conv_id"])
        parents = pa.array(s["parent_conv_id"], mask=s["parent_slot"] < 0)
        whole = [col["conv_id"], col["depth"], col["a"], col["b"], col["pa"], col["pb"], parents, col["n_convs"], s["n_children"], s["n_leaves"], s["saved_tokens"]]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in whole], names=[x.split()[0] for x in _SUMS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(x.num_rows for x in held) < shard_rows:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            ca, cb = (table.column(c).to_numpy() for c in ("ca", "cb"))
            cuts = np.flatnonzero((ca[1:] != ca[:-1]) | (cb[1:] != cb[:-1])) + 1
            if len(cuts):  # all but the last subtree are whole
                yield solve(table.slice(0, int(cuts[-1])))
                held = table.slice(int(cuts[-1])).to_batches()
        if held and sum(x.num_rows for x in held):
            yield solve(pa.Table.from_batches(held).combine_chunks())

    return run


def _double(top: DataFrame) -> DataFrame:
    """a, b with n_leaves and saved_tokens summed over all descendants. ``top``: a, b, pa, pb (null at the root) and the nodes' own sums."""
    now = materialize(top.select("a", "b", F.when(F.col("depth") > 0, F.struct("pa", "pb")).alias("far"), "n_leaves", "saved_tokens"), "doubling")
    while not now.where("far is not null").isEmpty():
        told = now.where("far is not null").groupBy("far").agg(F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
        told = told.select(F.col("far.pa").alias("a"), F.col("far.pb").alias("b"), "l", "s")
        further = now.select(F.struct(F.col("a").alias("pa"), F.col("b").alias("pb")).alias("far"), F.col("far").alias("beyond"))
        step = now.join(told, ["a", "b"], "left").join(further, "far", "left")
        now = materialize(step.select("a", "b", F.col("beyond").alias("far"), (F.col("n_leaves") + F.coalesce("l", F.lit(0))).alias("n_leaves"), (F.col("saved_tokens") + F.coalesce("s", F.lit(0))).alias("saved_tokens")), "doubling")
    return now.drop("far")


def prefix_trie(conversations: DataFrame, shard_rows: int | None = None, most_broadcast: int = 100_000) -> DataFrame:
    """A row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``shard_rows`` bounds the turns below a subtree that one task sums up; by
    default it is a 500th of all, but 256 at least and 131,072 at most.
    """
    rows, lengths = rebuilt(conversations)
    nodes, paths = trie_nodes(rows, lengths)
    shard_rows = shard_rows or min(1 << 17, max(256, paths.count() // 500))
    root = lengths.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).where("n_convs > 0")
    root = root.select(*(F.lit(x).cast("long").alias(c) for c, x in zip(("a", "b"), ROOT, strict=True)), "n_convs", "conv_id", *(F.lit(0).cast("long").alias(c) for c in ("words", "depth", "pa", "pb")))
    top = materialize(nodes.where(F.col("rows") > shard_rows).drop("rows").unionByName(root), "top")
    few = top.count() <= most_broadcast
    named = F.broadcast(top) if few else top.hint("merge")

    # each conversation's highest node that isn't above the shards names its shard's subtree
    above = named.select("a", "b", F.lit(True).alias("above"))
    cut = paths.join(above, ["a", "b"], "left").where("above is null").groupBy("conv_id").agg(F.min(F.struct("depth", "a", "b")).alias("cut"), F.max("length").alias("length"))
    cut = cut.select("conv_id", F.col("cut.a").alias("ca"), F.col("cut.b").alias("cb"), _blocks(F.col("length")).alias("block"))
    below = nodes.where(F.col("rows") <= shard_rows).drop("rows").withColumn("block", F.floor((F.col("depth") - 1) / BLOCK)).join(cut, ["conv_id", "block"])
    below = below.drop("block").repartition("ca", "cb").sortWithinPartitions("ca", "cb")
    sums = materialize(below.mapInArrow(_shards(shard_rows), _SUMS), "sums")

    tops = sums.where("parent_conv_id is null")
    up = tops.select("pa", "pb", "n_leaves", "saved_tokens", F.lit(1).alias("n")).unionByName(top.where("depth > 0").select("pa", "pb", F.lit(0).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), F.lit(1).alias("n")))
    up = up.groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.sum("n").alias("n_children"), F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
    top = top.join(up, ["a", "b"], "left")
    own = top.select("a", "b", "pa", "pb", "depth", F.when(F.col("n_children").isNull(), 1).otherwise(F.col("l")).alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("words") + F.coalesce("s", F.lit(0))).alias("saved_tokens"))
    top = top.select("conv_id", "depth", "a", "b", "pa", "pb", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children")).join(_double(own), ["a", "b"])
    top = top.withColumn("parent_conv_id", F.lit(None).cast("long"))

    owner = named.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("owner"))
    loose = tops.unionByName(top).join(owner, ["pa", "pb"], "left").withColumn("parent_conv_id", F.when(F.col("depth") > 0, F.col("owner"))).drop("owner")
    whole = sums.where("parent_conv_id is not null").unionByName(loose)
    ends = paths.where("depth = length").select("a", "b", "conv_id")
    ends = ends.unionByName(lengths.where("length = 0").select(*(F.lit(x).cast("long").alias(c) for c, x in zip(("a", "b"), ROOT, strict=True)), "conv_id"))
    whole = whole.join(ends_digests(ends), ["a", "b"], "left")
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return whole.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", none).alias("ends_sha256"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie over all conversations."""
    return prefix_trie(read_table(spark, sf_dir, "conversations"))


OP13_SQL = r"""
WITH crc AS (SELECT list(c ORDER BY i) AS t FROM (
       SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS c FROM range(256) r(i))),
k AS (SELECT conv_id AS c, conv_id - conv_id % 20 AS base,
             xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda z: CAST(ascii(z) AS BIGINT))), lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1])), 4294967295) % 4 AS h
      FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL), crc),
o AS (SELECT conv_id, s, w, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, s) AS p FROM (
        SELECT conv_id, turn, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS w,
               sha256(concat(octet_length(encode(coalesce(role, ''))), ':', coalesce(role, ''), coalesce(text, ''))) AS s
        FROM conversations WHERE conv_id IS NOT NULL)),
b AS (SELECT c, p, s, w FROM k JOIN o ON conv_id = base AND p <= h UNION ALL SELECT c, p, s, w FROM k JOIN o ON conv_id = c AND p > h),
path AS (SELECT c, 0 AS d, 0 AS w, '' AS node FROM k
         UNION ALL SELECT c, row_number() OVER turns, w, sha256(string_agg(s, '') OVER turns) FROM b WINDOW turns AS (PARTITION BY c ORDER BY p)),
node AS (SELECT node, d, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(w) AS saved FROM path GROUP BY node, d),
up AS (SELECT n.node, p.node AS above FROM node n JOIN path p ON p.c = n.conv_id AND p.d = n.d - 1),
kids AS (SELECT above AS node, count(*) AS n FROM up GROUP BY above),
below AS (SELECT p.node, sum(u.saved) AS saved, count(*) FILTER (WHERE kids.n IS NULL) AS leaves
          FROM node u JOIN path p ON p.c = u.conv_id AND p.d <= u.d LEFT JOIN kids ON kids.node = u.node GROUP BY p.node),
ends AS (SELECT node, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids FROM (SELECT c, arg_max(node, d) AS node FROM path GROUP BY c) GROUP BY node)
SELECT n.conv_id, CAST(n.d AS BIGINT) AS depth, a.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n, 0) AS n_children, leaves AS n_leaves,
       CAST(below.saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM node n JOIN below ON below.node = n.node LEFT JOIN kids ON kids.node = n.node LEFT JOIN ends ON ends.node = n.node
     LEFT JOIN up ON up.node = n.node LEFT JOIN node a ON a.node = up.above
"""
