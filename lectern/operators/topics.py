"""Density topics: a hierarchy of clusters by mutual reachability, and the most stable of them.

1. Each vector's nearest neighbours come from cells (``cells.py``); its core
   distance is that of the ``min_size``-th. An edge weighs the larger of its
   length and its ends' core distances; edges are ordered by (weight, ends).
2. The minimum spanning tree grows by Boruvka rounds, all joins: every component
   takes its least edge, and components hooked together become one. When the
   neighbour lists hold no more edges between components, all but the largest
   look for their least edge to any foreign vector, in all cells.
3. From each vector, ``min_size`` - 1 steps along the tree, always over the least
   edge in reach, tell the edge at which its component reaches ``min_size``. A tree
   edge lighter than both ends' edges of that kind splits no cluster off; the
   others are the splits, and what they leave connected are the leaves.
4. Splits form a tree of clusters. A vector leaves the cluster in which its own
   edge falls; clusters' stabilities are sums over vectors, and the most stable
   ones that don't overlap are the topics. Vectors that left above them are
   outliers, topic -1.

Only the tree of splits (``most_splits`` at most) is held in one place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.operators.cells import NEAREST, best, dealt, fit_cells, matrix, met, nearest_rows, squared
from lectern.operators.graph import components, kept, roots


def least_size(n: int) -> int:
    return max(2, min(10, n // 2))


def reach_edges(lists: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """Edges (a, b, w) of the neighbour lists by mutual reachability, and core distances (node, core)."""
    core = kept(lists.where(F.col("rank") == size).select(F.col("query_id").alias("node"), F.col("distance").alias("core")), "core")
    x, y = core.select(F.col("node").alias("query_id"), F.col("core").alias("cx")), core.select(F.col("node").alias("vec_id"), F.col("core").alias("cy"))
    rows = lists.join(x, "query_id").join(y, "vec_id")
    return rows.select(F.least("query_id", "vec_id").alias("a"), F.greatest("query_id", "vec_id").alias("b"), F.greatest("distance", "cx", "cy").alias("w")).distinct(), core


_FOREIGN = "comp long, other long, w double, a long, b long"


def _foreign(stored, asking):
    """An answer for ``met``: each asking component's least edge to a row of another component."""
    import pyarrow as pa

    x, q = (matrix(s.column("embedding"), True) for s in (stored, asking))
    (ids, comp, core), (asked, own, near) = (tuple(s.column(c).to_numpy() for c in ("vec_id", "comp", "core")) for s in (stored, asking))
    w = np.maximum(np.maximum(np.sqrt(squared(q, x)), core), near[:, None])
    w[own[:, None] == comp] = np.inf
    rows = np.arange(len(q))
    # ties are broken by the edge's ends, so all columns within rounding of the least are looked at
    r, c = np.nonzero((w <= w.min(axis=1)[:, None] + 1e-7) & np.isfinite(w)) if w.size else (rows[:0], rows[:0])
    exact = np.round(np.maximum(np.maximum(np.sqrt(((q[r] - x[c]) ** 2).sum(1)), core[c]), near[r]), 9)
    found = pd.DataFrame({"comp": own[r], "other": comp[c], "w": exact, "a": np.minimum(asked[r], ids[c]), "b": np.maximum(asked[r], ids[c])})
    found = found.sort_values(["comp", "w", "a", "b"]).drop_duplicates("comp")
    return pa.RecordBatch.from_pandas(found, preserve_index=False)


def spanning_tree(nodes: DataFrame, edges: DataFrame, foreign=None) -> DataFrame:
    """a, b, w of the minimum spanning tree. ``nodes``: node; ``foreign(labels)`` finds edges that ``edges`` lack (comp, other, w, a, b)."""
    labels = kept(nodes.select("node", F.col("node").alias("root")), "labels")
    edges, tree = kept(edges, "edges"), []
    while True:
        x, y = labels.select(F.col("node").alias("a"), F.col("root").alias("ra")), labels.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        between = kept(edges.join(x, "a").join(y, "b").where("ra <> rb"), "between")
        sides = between.select("ra", "rb", "w", "a", "b").unionByName(between.select(F.col("rb").alias("ra"), F.col("ra").alias("rb"), "w", "a", "b"))
        took = sides.groupBy("ra").agg(F.min(F.struct("w", "a", "b", "rb")).alias("e"))
        if between.isEmpty():
            if foreign is None or labels.select("root").distinct().limit(2).count() < 2:
                break
            found = foreign(labels)
            took = found.groupBy(F.col("comp").alias("ra")).agg(F.min(F.struct("w", "a", "b", F.col("other").alias("rb"))).alias("e"))
        edges = between.select("a", "b", "w")
        took = kept(took.select("ra", "e.w", "e.a", "e.b", "e.rb"), "took")
        tree.append(took.select("a", "b", "w").distinct())
        # of two components that took the same edge the smaller is the root; the order of edges allows no longer circle
        back = took.select(F.col("ra").alias("rb"), F.col("rb").alias("ra"), F.lit(True).alias("mutual"))
        parents = labels.select(F.col("root").alias("ra")).distinct().join(took, "ra", "left").join(back, ["ra", "rb"], "left")
        parents = parents.select(F.col("ra").alias("node"), F.when(F.col("rb").isNull() | (F.coalesce("mutual", F.lit(False)) & (F.col("ra") < F.col("rb"))), F.col("ra")).otherwise(F.col("rb")).alias("parent"))
        flat = roots(parents).select(F.col("node").alias("root"), F.col("root").alias("up"))
        labels = kept(labels.join(flat, "root").select("node", F.col("up").alias("root")), "labels")
    out = tree[0] if tree else edges.limit(0)
    for t in tree[1:]:
        out = out.unionByName(t)
    return kept(out.distinct(), "tree")


def joining_edges(tree: DataFrame, size: int) -> DataFrame:
    """node, edge: the tree edge (w, a, b) at which the node's component reaches ``size`` nodes."""
    both = tree.select(F.col("a").alias("node"), F.struct("w", "a", "b", F.col("b").alias("to")).alias("e")).unionByName(tree.select(F.col("b").alias("node"), F.struct("w", "a", "b", F.col("a").alias("to")).alias("e")))
    # a node's ``size`` least edges suffice: whoever comes to it over a heavier one has met enough nodes before
    ranked = both.withColumn("k", F.row_number().over(Window.partitionBy("node").orderBy("e"))).where(F.col("k") <= size)
    near = kept(ranked.groupBy("node").agg(F.array_sort(F.collect_list("e")).alias("edges")), "near")
    state = near.select("node", F.array("node").alias("seen"), F.col("edges").alias("reach"), F.lit(None).cast("struct<w:double,a:bigint,b:bigint>").alias("edge"))
    for step in range(size - 1):
        first = F.get("reach", F.lit(0))
        to = first["to"]
        taken = F.struct(first["w"].alias("w"), first["a"].alias("a"), first["b"].alias("b"))
        state = state.withColumns({"edge": F.when(F.col("edge").isNull() | (taken > F.col("edge")), taken).otherwise(F.col("edge")), "seen": F.concat("seen", F.array(to)), "last": to})
        if step < size - 2:
            more = near.select(F.col("node").alias("last"), "edges")
            state = state.join(more, "last")
            left = F.filter(F.array_sort(F.concat("reach", "edges")), lambda e: ~F.array_contains("seen", e["to"]))
            state = state.select("node", "seen", F.slice(left, 1, size).alias("reach"), "edge")
            if step % 3 == 2:
                state = kept(state, "state")
    return kept(state.select("node", "edge"), "joining")


class SplitTree:
    """The tree of clusters that splits make: leaves first, then one cluster a split, lightest first."""

    def __init__(self, leaves: list[int], splits: list[tuple]):
        self.leaf = {x: k for k, x in enumerate(leaves)}
        n = len(leaves) + len(splits)
        self.parent, self.edge, self.children = np.full(n, -1), [None] * n, [()] * n
        top = list(range(n))

        def find(x: int) -> int:
            while top[x] != x:
                top[x] = top[top[x]]
                x = top[x]
            return x

        for k, (w, a, b, la, lb) in enumerate(sorted(splits), len(leaves)):
            x, y = find(self.leaf[la]), find(self.leaf[lb])
            self.parent[[x, y]], self.edge[k], self.children[k] = k, (w, a, b), (x, y)
            top[x] = top[y] = k

    def where(self, leaf: int, edge: tuple) -> int:
        """The cluster that a vector of ``leaf`` leaves at ``edge``."""
        at = self.leaf[leaf]
        while self.parent[at] >= 0 and self.edge[self.parent[at]] < edge:
            at = self.parent[at]
        return int(at)

    def select(self, left: dict[int, tuple[int, float]]) -> dict[int, int]:
        """The chosen cluster of each cluster at or below one. ``left``: vectors that left each cluster, and the sum of their densities."""
        n = len(self.parent)
        size, stable, score = np.zeros(n), np.zeros(n), np.zeros(n)
        chosen = np.zeros(n, bool)
        for k in range(n):  # children come first
            birth = density(self.edge[self.parent[k]][0]) if self.parent[k] >= 0 else 0.0
            count, total = left.get(k, (0, 0.0))
            size[k], stable[k] = count, total - count * birth
            if self.children[k]:
                below = sum(size[c] for c in self.children[k])
                size[k] += below
                stable[k] += (density(self.edge[k][0]) - birth) * below
            sub = sum(score[c] for c in self.children[k])
            chosen[k] = self.parent[k] >= 0 and stable[k] >= sub
            score[k] = stable[k] if chosen[k] else sub
        out: dict[int, int] = {}
        for k in range(n - 1, -1, -1):  # parents come first
            above = out.get(int(self.parent[k]))
            if above is not None:
                out[k] = above
            elif chosen[k]:
                out[k] = k
        return out


def density(w):
    return 1 / np.maximum(w, 1e-12)


def density_topics(vectors: DataFrame, min_size: int | None = None, neighbours: int = 40, visits: int = 64, most_splits: int = 2_000_000) -> DataFrame:
    """vec_id and topic of every vector; topics are numbered by size, ties by their smallest vec_id, and -1 is none.

    ``vectors``: vec_id, embedding, compared by direction; null embeddings are left out.
    ``visits`` cells are searched for a vector's neighbours: all of them for up
    to 4,096 vectors, so the lists are exact there.
    """
    vectors = kept(vectors.where("embedding is not null").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding"), "vectors")
    n = vectors.count()
    if n < 2:
        raise ValueError(f"at least 2 vectors are needed for topics; got {n}")
    size = min_size or least_size(n)
    k = min(max(neighbours, size), n - 1)
    centres = fit_cells(vectors, n, unit=True)
    stored = kept(dealt(vectors, centres, 1, unit=True), "stored")
    lists = kept(best(met(stored, dealt(vectors, centres, visits, unit=True), nearest_rows(k, unit=True), NEAREST), k), "lists")
    edges, core = reach_edges(lists, min(size, n - 1))
    nodes = vectors.select(F.col("vec_id").alias("node"))

    def foreign(labels: DataFrame) -> DataFrame:
        told = labels.withColumnRenamed("root", "comp").join(core, "node").withColumnRenamed("node", "vec_id")
        largest = labels.groupBy("root").count().orderBy(F.desc("count"), "root").first()["root"]
        rows = stored.join(told, "vec_id")
        return met(rows, dealt(rows.where(F.col("comp") != largest).drop("cell"), centres, len(centres), unit=True), _foreign, _FOREIGN)

    tree = spanning_tree(nodes, edges, foreign)
    joins = joining_edges(tree, size)
    x, y = joins.select(F.col("node").alias("a"), F.col("edge").alias("ea")), joins.select(F.col("node").alias("b"), F.col("edge").alias("eb"))
    own = F.struct("w", "a", "b")
    marked = kept(tree.join(x, "a").join(y, "b").select("a", "b", "w", ((F.col("ea") < own) & (F.col("eb") < own)).alias("splits")), "marked")
    leaves = components(nodes, marked.where("not splits"))
    la, lb = leaves.select(F.col("node").alias("a"), F.col("root").alias("la")), leaves.select(F.col("node").alias("b"), F.col("root").alias("lb"))
    splits = marked.where("splits").join(la, "a").join(lb, "b").select("w", "a", "b", "la", "lb")
    count = splits.count()
    if count > most_splits:
        raise ValueError(f"{count} splits; ask for larger topics (min_size)")
    rows = [tuple(r) for r in splits.collect()]
    shape = SplitTree(sorted({x for r in rows for x in r[3:]}) or [r["root"] for r in leaves.select("root").distinct().collect()], rows)
    held = vectors.sparkSession.sparkContext.broadcast(shape)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            edge = zip(pdf["w"], pdf["a"], pdf["b"], strict=True)
            pdf["cluster"] = [held.value.where(leaf, e) for leaf, e in zip(pdf["root"], edge, strict=True)]
            yield pdf[["vec_id", "cluster", "w"]]

    placed = joins.join(leaves, "node").select(F.col("node").alias("vec_id"), "root", "edge.w", "edge.a", "edge.b")
    placed = kept(placed.mapInPandas(place, "vec_id long, cluster long, w double"), "placed")
    sums = placed.groupBy("cluster").agg(F.count("*").alias("n"), F.sum(1 / F.greatest("w", F.lit(1e-12))).alias("total")).collect()  # a row a cluster
    chosen = shape.select({r["cluster"]: (r["n"], r["total"]) for r in sums})
    of = vectors.sparkSession.createDataFrame([(k, c) for k, c in chosen.items()], "cluster long, chosen long")
    named = kept(placed.join(of, "cluster", "left").select("vec_id", "chosen"), "named")
    order = named.where("chosen is not null").groupBy("chosen").agg(F.count("*").alias("n"), F.min("vec_id").alias("first")).orderBy(F.desc("n"), "first").collect()
    topic = vectors.sparkSession.createDataFrame([(r["chosen"], k) for k, r in enumerate(order)], "chosen long, topic int")
    return named.join(topic, "chosen", "left").select("vec_id", F.coalesce("topic", F.lit(-1)).alias("topic"))


def topic_names(terms: DataFrame, words: int = 4) -> DataFrame:
    """topic, count and name of each topic. ``terms``: topic, doc, term, tf (a null term: a document without words).

    A term weighs its share of the topic's words times ln(1 + the mean number of
    words a topic / its number in all topics); the name holds the topic's number
    and its heaviest terms, ties by term. Counts are summed by (topic, term)
    before anything is ranked.
    """
    sizes = terms.groupBy("topic").agg(F.countDistinct("doc").alias("count"), F.coalesce(F.sum("tf"), F.lit(0)).alias("words"))
    by_term = terms.where("term is not null").groupBy("topic", "term").agg(F.sum("tf").alias("tf"))
    overall = by_term.groupBy("term").agg(F.sum("tf").alias("all"))
    mean = sizes.agg(F.avg("words")).first()[0] or 0.0
    rows = by_term.join(overall, "term").join(sizes, "topic")
    rows = rows.withColumn("weight", F.round(F.col("tf") / F.col("words") * F.log(1 + F.lit(mean) / F.col("all")), 9))
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("topic").orderBy(F.desc("weight"), "term"))).where(F.col("rank") <= words)
    top = ranked.groupBy("topic").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))), lambda x: x["term"]), "_").alias("top"))
    return sizes.join(top, "topic", "left").select("topic", "count", F.concat_ws("_", F.col("topic").cast("string"), "top").alias("name"))
