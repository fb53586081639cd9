"""Connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import drop_tables, materialize


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node reachable) of every node of ``edges`` (a, b).

    Each round takes the smallest label among the neighbours, then that label's
    own label, so chains shorten by doubling; labels go to a shared table each
    round, and the loop ends when a round changes none.
    """
    back = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    both = materialize(edges.select("a", "b").unionByName(back).where("a <> b").distinct(), "edges")
    labels = both.groupBy("a").agg(F.min("b").alias("m"))
    labels = materialize(labels.select(F.col("a").alias("node"), F.least("a", "m").alias("component")), "labels")
    while True:
        around = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("component").alias("m"))
        step = labels.join(around, labels["node"] == around["a"])
        step = step.select("node", F.least("component", "m").alias("component"), F.col("component").alias("before"))
        jump = labels.select(F.col("node").alias("via"), F.col("component").alias("further"))
        step = step.join(jump, step["component"] == jump["via"], "left")
        step = step.select("node", F.least("component", "further").alias("component"), "before")
        done, labels = labels, materialize(step, "labels")
        drop_tables(done)
        if labels.where("component <> before").isEmpty():
            drop_tables(both)
            return labels.drop("before")
