"""MinHash near-duplicates from bottom-k sketches of one hash function.

A text's set is its distinct shingles of ``shingle`` words, hashed to 64 bits;
the sketch is its ``k`` smallest values. Texts with one set are one class, and
only classes are compared.

Inverted lists of retained values give candidates: if two sets are as similar
as asked, their sketches overlap in ``least`` values or more (or, when no
partner's set can exceed ``k``, in the exact share of the set), so they share
``common`` of each sketch's rarest ``k - least + common``. Rarest first, a text
whose rarest values nobody else retains is out at once.

* Lists of ``small`` members at most give their pairs, which are counted; a pair
  needs ``common`` lists, less those that may be longer ones.
* Members of longer lists are held against three members of the list.
* Candidates pass if the union of their sketches says so, and form families.
* Where a longer list spans several families, every member outside its main
  family is held against all others, sketch against sketch, in cells of bounded
  size that need each sketch once for a block, not once for a pair.
* Each family is verified on the full sets, again in cells of bounded size: only
  links that the whole sets confirm count.

For sets within ``k`` this is exact; beyond, a pair at the limit is missed with
a probability below 1e-8 (a binomial tail; fewer than ``least`` of ``k`` draws).

Defined results: null texts and texts without words have an empty set and link
with nothing; a text shorter than a shingle is a set of itself; repeated rows
are one class; null doc_ids belong to classes, but never name a component unless
all are null; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.common import SALTS, drop_tables, materialize, mix, text_buffer, text_key, text_slices, word_hashes
from lectern.llm.graph import components


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, shingle: int = 2) -> list[np.ndarray]:
    """The sorted hashed shingle set of each row of a text buffer."""
    h, _, _, bounds = word_hashes(raw, offsets, lower=True)
    count = max(len(h) - shingle + 1, 0)
    runs = np.zeros(count, np.uint64)
    for j in range(shingle):
        runs += h[j : j + count] * SALTS[j]
    runs = mix(runs)
    out = []
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if a < b < a + shingle:
            s = mix(np.sum(h[a:b] * SALTS[shingle : shingle + b - a], keepdims=True))
        else:
            s = np.unique(runs[a : max(a, b - shingle + 1)])
        out.append((s ^ np.uint64(1 << 63)).view(np.int64))  # unsigned order as signed order
    return out


def _sketches(docs: DataFrame, k: int, shingle: int) -> DataFrame:
    """doc_id, key, n, sig (a digest of the set) and the set's ``k`` smallest values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in text_slices(batch):
                sets = shingle_sets(*text_buffer(rows.column(2)), shingle)
                sig = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                kept = [s[:k] for s in sets]
                ends = np.concatenate([[0], np.cumsum([len(s) for s in kept])]).astype(np.int32)
                flat = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(kept)))
                sizes = pa.array([len(s) for s in sets], pa.int32())
                cols = [rows.column(0), rows.column(1), sizes, pa.array(sig, pa.binary()), flat]
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "key", "n", "sig", "values"])

    return docs.mapInArrow(run, "doc_id long, key long, n int, sig binary, values array<long>")


def _full_sets(texts: DataFrame, shingle: int) -> DataFrame:
    """node, family, blocks, block, n and the whole set as bytes, of the rows of ``texts`` (with a text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # a repeated row goes on once from each task
        for batch in batches:
            new = [not (node in seen or seen.add(node)) for node in batch.column(0).to_pylist()]
            for rows in text_slices(batch.filter(pa.array(new, pa.bool_()))):
                sets = shingle_sets(*text_buffer(rows.column(4)), shingle)
                raw = pa.array([s.tobytes() for s in sets], pa.binary())
                cols = [*rows.columns[:4], pa.array([len(s) for s in sets], pa.int32()), raw]
                yield pa.RecordBatch.from_arrays(cols, names=["node", "family", "blocks", "block", "n", "set"])

    texts = texts.select("node", "family", "blocks", "block", "text")
    return texts.mapInArrow(run, "node long, family long, blocks int, block int, n int, set binary")


def cells(rows: DataFrame) -> DataFrame:
    """One row for each cell (family, i, j: two blocks, i <= j) of the family that a row's block belongs to."""
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    rows = rows.select("*", other).withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")})
    return rows.drop("other", "blocks").repartition("family", "i", "j").sortWithinPartitions("family", "i", "j")


class _Postings:
    """The members of a block by value: overlap counts of one set with all of them."""

    def __init__(self, sets: list[np.ndarray]):
        values = np.concatenate(sets)
        order = np.argsort(values, kind="stable")
        self.count = len(sets)
        self.values = values[order]
        self.owners = np.repeat(np.arange(len(sets)), [len(s) for s in sets])[order]

    def overlaps(self, values: np.ndarray) -> np.ndarray:
        a, b = np.searchsorted(self.values, values, "left"), np.searchsorted(self.values, values, "right")
        width = b - a
        at = np.repeat(b - np.cumsum(width), width) + np.arange(width.sum())
        return np.bincount(self.owners[at], minlength=self.count)


def _cell_links(members: list[tuple], i: int, j: int, fits: Callable) -> list[tuple[int, int]]:
    """Links (a, b) that join the classes of a cell; ``members``: (node, block, outer, start label, n, values)."""
    root: dict[int, int] = {}

    def find(c: int) -> int:
        while (up := root.get(c, c)) != c:
            root[c] = c = root.get(up, up)
        return c

    x = [m for m in members if m[1] == i]
    y = x if i == j else [m for m in members if m[1] == j]
    if not x or not y:
        return []
    postings, sizes = _Postings([m[5] for m in y]), np.array([m[4] for m in y], np.int64)
    y_outer, labels = np.array([m[2] for m in y]), [m[3] for m in y]
    found = []
    for node, _, outer, label, n, values in x:
        near = fits(postings.overlaps(values), n, sizes)
        if not outer:
            near &= y_outer
        for at in np.flatnonzero(near).tolist():
            a, b = find(label), find(labels[at])
            if a != b:
                root[a] = b
                found.append((min(node, y[at][0]), max(node, y[at][0])))
    return found


def _as_bytes(rows: DataFrame) -> DataFrame:
    """``rows`` with the values as bytes in a column ``set``."""
    names = [c for c in rows.columns if c != "values"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("values")
            flat, ends = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
            raw = [flat[a:b].tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(raw, pa.binary())], names=[*names, "set"])

    schema = T.StructType([*(rows.schema[c] for c in names), T.StructField("set", T.BinaryType())])
    return rows.select(*names, "values").mapInArrow(run, schema)


def _links(dealt: DataFrame, fits: Callable) -> DataFrame:
    """a, b: the links found in each cell of ``cells``; rows: node, block, outer, label, n, set, family, i, j."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, members = None, {}

        def close() -> pa.RecordBatch:
            found = _cell_links(list(members.values()), cell[1], cell[2], fits) if len(members) > 1 else []
            a, b = ([f[k] for f in found] for k in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            col = {name: batch.column(name).to_pylist() for name in ("family", "i", "j", "node", "block", "outer", "label", "n", "set")}
            for row in zip(*col.values(), strict=True):
                if row[:3] != cell:
                    if cell:
                        yield close()
                    cell, members = row[:3], {}
                members[row[3]] = (*row[3:8], np.frombuffer(row[8], np.int64))
        if cell:
            yield close()

    return dealt.select("family", "i", "j", "node", "block", "outer", "label", "n", "set").mapInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    k: int = 96,
    least: int = 52,
    percent: int = 80,
    most_broadcast: int = 500_000,
    block: int = 1 << 18,
    common: int = 8,
    shingle: int = 2,
    small: int = 16,
) -> DataFrame:
    """doc_id, key, n_shingles, component_id and kept of each row of ``docs`` (doc_id, text).

    ``block`` bounds the values of a block of a cell, but for a text that has more.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_key().alias("key"), "text")
    table = materialize(_sketches(docs, k, shingle), "sketches")
    found = table.where("n > 0").groupBy("sig")
    found = found.agg(F.min(F.struct("doc_id", "key")).alias("of"), F.min("doc_id").alias("low"), F.first("n").alias("n"), F.first("values").alias("values"))
    classes = materialize(found.withColumn("node", F.monotonically_increasing_id()), "classes")

    def needed(n):
        return F.when(n * 100 <= k * percent, F.ceil(n * percent / 100).cast("int")).otherwise(least)

    def fits(x, y):
        return F.least(x, y) * 100 >= F.greatest(x, y) * percent

    def in_nodes(rows: DataFrame, nodes: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(nodes) if nodes.count() <= most_broadcast else nodes, "node", "left_semi")

    # inverted lists of each sketch's rarest values
    values = classes.select("node", "n", F.explode("values").alias("key"))
    counts = values.groupBy("key").count().where("count > 1")
    own = values.join(counts, "key").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("count", "key"))).alias("shared"))
    need = F.least(needed(F.col("n")), F.lit(common))
    unshared = F.least("n", F.lit(k)) - F.size("shared")
    own = own.withColumns({"need": need, "take": (F.least("n", F.lit(k)) - needed(F.col("n")) + need - unshared).cast("int")})
    lists = own.where("take > 0").select(F.explode(F.slice("shared.key", F.lit(1), F.col("take"))).alias("key"), "node", "n", "need", unshared.alias("rank"))
    lists = materialize(lists, "lists")
    sizes = lists.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    sized = materialize(lists.join(sizes, "key"), "sized")
    drop_tables(lists)
    long_lists = sized.where(F.col("members") > small)

    # pairs of short lists, counted
    hot = long_lists.groupBy("node").agg(F.count("*").alias("hot"))
    short = sized.where(F.col("members") <= small).join(hot, "node", "left")
    short = short.select("key", "node", "n", (F.col("need") - F.coalesce("hot", F.lit(0))).cast("int").alias("need"))
    short = materialize(short, "short")
    x, y = (short.select("key", *(F.col(c).alias(f"{s}_{c}") for c in ("node", "n", "need"))) for s in "xy")
    both = x.join(y, "key").where("x_node < y_node").where(fits(F.col("x_n"), F.col("y_n")))
    both = both.groupBy(F.col("x_node").alias("a"), F.col("y_node").alias("b")).agg(F.count("*").alias("met"), F.first("x_need").alias("p"), F.first("y_need").alias("q"))
    pairs = both.where(F.col("met") >= F.least("p", "q")).select("a", "b")

    # members of longer lists against the most typical, the first and another member
    # chosen alike in all lists, so that a family's many lists ask for the same pairs
    turn = F.xxhash64("node")
    pivots = long_lists.groupBy("key").agg(F.array(F.min_by("node", F.struct("rank", "node")), F.min("node"), F.min_by("node", turn)).alias("pivots"))
    pivots = pivots.select("key", F.explode(F.array_distinct("pivots")).alias("pivot"))
    tried = long_lists.join(pivots, "key").where("node <> pivot")
    tried = tried.select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
    pairs = materialize(pairs.unionByName(tried).distinct(), "pairs")
    drop_tables(short)

    # families: pairs that the union of the sketches lets through
    sketches = in_nodes(classes.select("node", "n", "values"), pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
    x, y = (sketches.select(F.col("node").alias(c), F.col("values").alias(v), F.col("n").alias(f"n{v}")) for c, v in (("a", "x"), ("b", "y")))
    union = F.slice(F.sort_array(F.array_union("x", "y")), 1, k)
    estimate = F.size(F.array_intersect(F.array_intersect(union, "x"), "y")) / F.size(union)
    exact = (F.greatest("nx", "ny") <= k) & (F.size(F.array_union("x", "y")) <= k)
    likely = pairs.join(x, "a").join(y, "b").where(fits(F.col("nx"), F.col("ny")))
    likely = likely.where(estimate >= F.when(exact, percent / 100).otherwise(least / k - 0.01))
    likely = materialize(likely.select("a", "b"), "likely")
    families = components(likely)

    # longer lists that span families: by main family, members outside it against all
    named = long_lists.select("key", "node").join(families, "node", "left").select("key", "node", F.coalesce("component", "node").alias("label"))
    named = materialize(named, "named")
    main = named.groupBy("key", "label").count().groupBy("key").agg(F.max_by("label", F.struct("count", "label")).alias("family"), F.count("*").alias("parts"))
    split = named.join(main.where("parts > 1"), "key").groupBy("family", "node", "label").agg(F.max(F.col("label") != F.col("family")).alias("outer"))
    split = materialize(split, "split")
    drop_tables(named, sized)
    if not split.isEmpty():
        blocks = split.groupBy("family").agg(F.ceil(F.count("*") * k / block).cast("int").alias("blocks"))
        dealt = split.join(blocks, "family").join(classes.select("node", "n", "values"), "node")
        dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
        raw = _as_bytes(dealt.select("family", "node", "label", "outer", "n", "blocks", "block", "values"))

        def may_fit(overlap, n, sizes):
            small_set = np.ceil(np.minimum(n, sizes) * percent / 100)
            least_of = np.where(np.minimum(n, sizes) * 100 <= k * percent, small_set, least)
            return (overlap >= least_of) & (100 * np.minimum(n, sizes) >= percent * np.maximum(n, sizes))

        across = materialize(_links(cells(raw), may_fit), "across")
        if not across.isEmpty():
            families = components(likely.unionByName(across))

    # each family on the full sets
    totals = families.join(classes.select("node", "n", "of"), "node")
    blocks = totals.groupBy("component").agg(F.ceil(F.sum("n") / block).cast("int").alias("blocks"))
    owners = totals.join(blocks, "component").select(F.col("of.doc_id").alias("d"), F.col("of.key").alias("t"), "node", F.col("component").alias("family"), "blocks")
    owners = materialize(owners.withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int")), "owners")
    wanted = F.broadcast(owners) if owners.count() <= most_broadcast else owners
    texts = docs.join(wanted, docs["doc_id"].eqNullSafe(F.col("d")) & (docs["key"] == F.col("t")))

    def fit(overlap, n, sizes):
        return 100 * overlap >= percent * (n + sizes - overlap)

    dealt = _full_sets(texts, shingle).withColumns({"outer": F.lit(True), "label": F.col("node")})
    links = materialize(_links(cells(dealt), fit), "links")
    linked = components(links)
    grouped = classes.join(linked, "node", "left").select("sig", "low", F.coalesce("component", "node").alias("group"))
    lowest = grouped.groupBy("group").agg(F.min("low").alias("component_id"))
    by_sig = materialize(grouped.join(lowest, "group").select("sig", "component_id"), "named")
    drop_tables(classes, pairs, likely, split, owners, links)
    out = table.select("doc_id", "key", "n", "sig").join(by_sig, "sig", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "key", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), shingle=2).drop("key")
