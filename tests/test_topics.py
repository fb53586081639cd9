"""Density topics against a plain version over all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lectern.operators import graph, topics

SF = "/root/testdata/sf0.001"


def plain_topics(ids, x, size):
    """Labels from the full distance matrix, top down: the whole tree is cut at its heaviest edge, again and again."""
    x = x / np.maximum(np.linalg.norm(x, axis=1), 1e-300)[:, None]
    d = np.round(np.sqrt(((x[:, None] - x) ** 2).sum(2)), 9)
    n = len(ids)
    core = np.sort(d + np.where(np.eye(n), np.inf, 0), axis=1)[:, min(size, n - 1) - 1]
    w = np.maximum(np.maximum(d, core), core[:, None])
    pairs = sorted((w[i, j], min(ids[i], ids[j]), max(ids[i], ids[j]), i, j) for i in range(n) for j in range(i))
    top = list(range(n))

    def find(k):
        while top[k] != k:
            k = top[k]
        return k

    tree = []
    for weight, _, _, i, j in pairs:
        a, b = find(i), find(j)
        if a != b:
            top[a] = b
            tree.append((weight, i, j))

    def part(nodes, edges):
        near = {k: [] for k in nodes}
        for _, i, j in edges:
            near[i].append(j)
            near[j].append(i)
        return near

    def side(near, start):
        seen, todo = {start}, [start]
        while todo:
            for k in near[todo.pop()]:
                if k not in seen:
                    seen.add(k)
                    todo.append(k)
        return seen

    def grow(nodes, edges, birth):
        """(stability, members chosen below, own members) of the cluster that ``nodes`` are when it is born."""
        stable, left = 0.0, set(nodes)
        while edges:
            weight, i, j = edges[-1]
            edges = edges[:-1]
            one = side(part(left, edges), i)
            other = left - one
            lam = 1 / max(weight, 1e-12)
            if len(one) >= size and len(other) >= size:
                stable += (lam - birth) * len(left)
                kids = [grow(s, [e for e in edges if e[1] in s], lam) for s in (one, other)]
                return stable, kids, set(nodes)
            for s in (one, other):
                if len(s) < size:
                    stable += (lam - birth) * len(s)
            left = max(one, other, key=len)
            if len(left) < size:
                return stable, [], set(nodes)
            edges = [e for e in edges if e[1] in left]
        return stable, [], set(nodes)

    def choose(c):
        below = [choose(k) for k in c[1]]
        total = sum(b[0] for b in below)
        return (c[0], [c[2]]) if c[0] >= total else (total, [s for b in below for s in b[1]])

    root = grow(range(n), tree, 0.0)
    found = [s for k in root[1] for s in choose(k)[1]]
    out = {i: -1 for i in ids}
    for t, s in enumerate(sorted(({ids[k] for k in s} for s in found), key=lambda s: (-len(s), min(s)))):
        out.update(dict.fromkeys(s, t))
    return out


def table(spark, x):
    return spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")


def test_embeddings(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    want = plain_topics([r["vec_id"] for r in rows], np.array([r["embedding"] for r in rows], np.float64), 10)
    got = {r["vec_id"]: r["topic"] for r in topics.density_topics(spark.read.parquet(f"{SF}/embeddings.parquet")).collect()}
    assert got == want


def test_nested_clusters_bridges_and_outliers(spark):
    """Groups of groups, far apart and each larger than a neighbour list: no list holds an edge between the tightest."""
    r = np.random.default_rng(1)
    centres = np.repeat(r.normal(size=(3, 6)), 3, axis=0) + r.normal(scale=0.25, size=(9, 6))
    x = np.concatenate([c + r.normal(scale=s, size=(m, 6)) for c, s, m in zip(centres, r.uniform(0.01, 0.09, 9), r.integers(42, 60, 9), strict=True)] + [r.normal(size=(12, 6)), np.repeat(r.normal(size=(1, 6)), 7, axis=0)])
    x = x.astype(np.float32)
    want = plain_topics(list(range(len(x))), x.astype(np.float64), 5)
    assert len(set(want.values())) > 3 and -1 in want.values()
    got = {k: {r["vec_id"]: r["topic"] for r in topics.density_topics(table(spark, x), min_size=5, neighbours=k).collect()} for k in (200, 40)}
    assert got[200] == want
    assert sum(got[40][i] != t for i, t in want.items()) <= 5  # single outliers, whose edges lie outside the shorter lists


def test_too_few(spark):
    with pytest.raises(ValueError, match="at least 2 vectors.*got 1"):
        topics.density_topics(table(spark, np.ones((1, 3))))
    two = topics.density_topics(table(spark, np.eye(2)))
    assert {r["topic"] for r in two.collect()} == {-1}
    assert [topics.least_size(n) for n in (2, 5, 9, 20, 1000)] == [2, 2, 4, 10, 10]


def test_components(spark):
    edges = [(i, i + 1) for i in range(40) if i != 20] + [(60, 50), (50, 60), (70, 70)]
    got = graph.components(spark.createDataFrame([(i,) for i in [*range(41), 50, 60, 70, 80]], "node long"), spark.createDataFrame(edges, "a long, b long"))
    want = {i: 0 if i <= 20 else 21 for i in range(41)} | {50: 50, 60: 50, 70: 70, 80: 80}
    assert {r["node"]: r["root"] for r in got.collect()} == want
    assert graph.components(got.limit(0).select("node"), got.limit(0).select(F.col("node").alias("a"), F.col("node").alias("b"))).isEmpty()
