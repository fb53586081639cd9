"""Comparing runs: fingerprints side by side, order statistics, fits, fences."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def compare(left: DataFrame, right: DataFrame, levels: list[str], key: str = "citekey") -> DataFrame:
    """key, side (both, left, right) and <level>_differs for keys of either run; null where one side is missing."""
    a = left.select(key, *(F.col(c).alias(f"a_{c}") for c in levels), F.lit(True).alias("a_"))
    b = right.select(key, *(F.col(c).alias(f"b_{c}") for c in levels), F.lit(True).alias("b_"))
    rows = a.join(b, key, "full")
    both = F.col("a_").isNotNull() & F.col("b_").isNotNull()
    side = F.when(both, "both").when(F.col("a_").isNotNull(), "left").otherwise("right")
    return rows.select(key, side.alias("side"), *(F.when(both, ~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))).alias(f"{c}_differs") for c in levels))


def spread(rows: DataFrame, by: str, value: str) -> DataFrame:
    """Best, median and worst value of each group."""
    return rows.groupBy(by).agg(F.min(value).alias("best"), F.percentile(value, F.lit(0.5)).alias("median"), F.max(value).alias("worst"))


def line_fit(rows: DataFrame, by: str, x: str, y: str) -> DataFrame:
    """Least squares of each group; a group with one x has slope 0."""
    x, y = F.col(x).cast("double"), F.col(y).cast("double")
    flat = F.min(x) == F.max(x)
    slope = F.when(flat, 0.0).otherwise(F.regr_slope(y, x))
    return rows.groupBy(by).agg(slope.alias("slope"), F.when(flat, F.avg(y)).otherwise(F.regr_intercept(y, x)).alias("intercept"))


def upper_fence(rows: DataFrame, by: str, value: str, least: int = 4) -> DataFrame:
    """Third quartile and one and a half times the quartiles' distance, by exclusive quantiles; infinite below ``least`` rows.

    Ranks come from counts of each value, so a large group is no single task's list.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(by, F.col(value).cast("double").alias("v")).agg(F.count("*").alias("c"))
    upto = F.sum("c").over(Window.partitionBy(by).orderBy("v"))
    ranked = counts.withColumns({"upto": upto, "n": F.sum("c").over(Window.partitionBy(by))})

    def at(rank):
        return F.min(F.when(F.col("upto") >= rank, F.col("v")))

    def quartile(k: int):
        place = F.col("n") * k / 4 + k / 4
        low = F.least(F.greatest(F.floor(place), F.lit(1)), F.col("n") - 1)
        return at(low), at(low + 1), F.first(place - low)

    q = {f"{name}{k}": c for k in (1, 3) for name, c in zip(("lo", "hi", "part"), quartile(k), strict=True)}
    out = ranked.groupBy(by).agg(F.first("n").alias("n"), *(c.alias(k) for k, c in q.items()))
    q1, q3 = (F.col(f"lo{k}") + (F.col(f"hi{k}") - F.col(f"lo{k}")) * F.col(f"part{k}") for k in (1, 3))
    return out.select(by, "n", F.when(F.col("n") < least, float("inf")).otherwise(q3 + 1.5 * (q3 - q1)).alias("fence"))
