"""Connected components by joins."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.sources.versions import shared_folder


def kept(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read back: the lineage ends here."""
    path = f"{shared_folder(df.sparkSession, 'steps')}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def roots(parents: DataFrame) -> DataFrame:
    """node, root of each node of a forest (node, parent; a root is its own parent), by pointer jumping."""
    now = kept(parents.select("node", F.col("parent").alias("root")), "roots")
    while True:
        further = now.select(F.col("node").alias("root"), F.col("root").alias("beyond"))
        step = kept(now.join(further, "root").select("node", F.col("beyond").alias("root"), (F.col("beyond") != F.col("root")).alias("moved")), "roots")
        now = step.drop("moved")
        if step.where("moved").isEmpty():
            return now


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) of every node. ``nodes``: node; ``edges``: a, b.

    Each round a component hooks itself to the smallest one it has an edge to, if
    that is smaller; hooks form a forest, which pointer jumping flattens.
    """
    labels = kept(nodes.select("node", F.col("node").alias("root")), "labels")
    edges = edges.select("a", "b")
    while True:
        x, y = labels.select(F.col("node").alias("a"), F.col("root").alias("ra")), labels.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        between = kept(edges.join(x, "a").join(y, "b").where("ra <> rb").select(F.greatest("ra", "rb").alias("high"), F.least("ra", "rb").alias("low")).distinct(), "between")
        if between.isEmpty():
            return labels
        hooks = between.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("parent"))
        every = labels.select(F.col("root").alias("node")).distinct().join(hooks, "node", "left").select("node", F.coalesce("parent", "node").alias("parent"))
        flat = roots(every).select(F.col("node").alias("root"), F.col("root").alias("up"))
        labels = kept(labels.join(flat, "root").select("node", F.col("up").alias("root")), "labels")
