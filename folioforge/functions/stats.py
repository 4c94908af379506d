"""Aggregates and statistics: three medians, intervals, bands, safe shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def upper_median(name: str) -> Column:
    """The element at place n div 2 (from 0) of the values in order; exact, from counts of the distinct values."""
    return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY `{name}` DESC)")


def true_median(name: str) -> Column:
    """The middle element, or the mean of the two in the middle."""
    return F.expr(f"percentile_cont(0.5) WITHIN GROUP (ORDER BY `{name}`)")


def exclusive_quantiles(rows: DataFrame, by: list[str], name: str, q: float) -> DataFrame:
    """by, value: between the elements around place q * (n + 1), counted from 1, of each group of two values or more.

    Places are counted from the numbers of equal values, which partial aggregation makes before the shuffle: no list or window holds a group.
    """
    n = rows.where(F.col(name).isNotNull()).groupBy(*by, F.col(name).alias("x")).agg(F.count("*").alias("c"))
    w = Window.partitionBy(*by)
    at = n.withColumn("upto", F.sum("c").over(w.orderBy("x"))).withColumn("n", F.sum("c").over(w))
    place = q * (F.col("n") + 1)
    low = F.least(F.greatest(F.floor(place), F.lit(1)), F.col("n") - 1)
    ends = at.where("n >= 2").groupBy(*by).agg(F.min(F.when(F.col("upto") >= low, F.col("x"))).alias("a"), F.min(F.when(F.col("upto") >= low + 1, F.col("x"))).alias("b"), F.max(place - low).alias("part"))
    return ends.select(*by, (F.col("a") + (F.col("b") - F.col("a")) * F.col("part")).alias("value"))


def share(part: Column, whole: Column, digits: int = 4) -> Column:
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")), digits)


def wilson(hits: Column, n: Column, z: float = 1.96) -> Column:
    """struct<lo, hi> of a share's 95 % interval; null for n = 0."""
    p, m = F.try_divide(hits.cast("double"), n), n.cast("double")
    centre, spread, scale = p + z * z / (2 * m), z * F.sqrt(p * (1 - p) / m + z * z / (4 * m * m)), 1 + z * z / m
    return F.when(n > 0, F.struct(((centre - spread) / scale).alias("lo"), ((centre + spread) / scale).alias("hi")))


def standard_error(hits: Column, n: Column) -> Column:
    p = F.try_divide(hits.cast("double"), n)
    return F.sqrt(p * (1 - p) / n)


def band(x: Column, edges: list[float]) -> Column:
    """Label of the half-open band [edge, next edge) that holds x; the last band is open."""
    out = F.lit(None).cast("string")
    for k in range(len(edges) - 1, -1, -1):
        label = f"{edges[k]:g}+" if k == len(edges) - 1 else f"{edges[k]:g}-{edges[k + 1]:g}"
        inside = x >= edges[k] if k == len(edges) - 1 else (x >= edges[k]) & (x < edges[k + 1])
        out = F.when(inside, label).otherwise(out)
    return out
