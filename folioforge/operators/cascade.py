"""The matching cascade: passes in order of strictness, each over what earlier passes left, and the rules that pick a winner."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Confidence floor, score threshold, polygon margin, coordinate score and radius.
MIN_CONFIDENCE, MIN_SCORE, POLYGON_MARGIN, COORD_SCORE, COORD_KM = 30.0, 80.0, 1.0, 70.0, 50.0


def confident(confidence: Column, floor: float = MIN_CONFIDENCE) -> Column:
    """A null confidence was not measured, and passes."""
    return F.coalesce(confidence >= floor, F.lit(True))


def winners(hits: DataFrame, key: list[str], threshold: float = MIN_SCORE, floor: float = MIN_CONFIDENCE, margin: float = POLYGON_MARGIN) -> DataFrame:
    """One hit a key: the best confident score (first in rank on ties) if it reaches the threshold; a polygon within the margin is taken over a point.

    hits: key, rank, score, confidence, has_geom and any others. One hash aggregation with partial results; no sort of all hits.
    """
    rest = F.struct(*(c for c in hits.columns if c not in key))
    order = F.struct(F.col("score"), -F.col("rank"))
    good = hits.where(confident(F.col("confidence"), floor))
    best = good.groupBy(*key).agg(F.max_by(rest, order).alias("top"), F.max_by(rest, F.when(F.col("has_geom"), order)).alias("area"))
    best = best.where(F.col("top.score") >= threshold)
    area = ~F.coalesce(F.col("top.has_geom"), F.lit(False)) & F.coalesce(F.col("area.score") >= F.col("top.score") - margin, F.lit(False))
    return best.select(*key, F.when(area, F.col("area")).otherwise(F.col("top")).alias("hit")).select(*key, "hit.*")


def by_coordinate(hits: DataFrame, key: list[str], threshold: float = COORD_SCORE, floor: float = MIN_CONFIDENCE, most_km: float = COORD_KM) -> DataFrame:
    """Of the confident hits near enough and good enough, the nearest (then first in rank)."""
    rest = F.struct(*(c for c in hits.columns if c not in key))
    good = hits.where(confident(F.col("confidence"), floor) & (F.col("score") >= threshold) & (F.col("km") <= most_km))
    return good.groupBy(*key).agg(F.min_by(rest, F.struct("km", "rank")).alias("hit")).select(*key, "hit.*")


def cascade(asks: DataFrame, key: str, passes: list[tuple[str, Callable[[DataFrame], DataFrame]]], keep: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """Union of the passes' answers with the pass's name; a pass (asks -> one row a key) sees only keys that no earlier pass answered.

    keep writes a pass's answers and gives them back as a table: they are then made once, however many passes follow, and a run that is
    broken off has lost one pass at most. Without it the plan of a pass holds those of all before it.
    """
    out, left = None, asks
    for name, answer in passes:
        got = answer(left).withColumn("pass", F.lit(name))
        got = keep(got, f"pass-{name}") if keep else got
        out = got if out is None else out.unionByName(got, allowMissingColumns=True)
        left = left.join(got.select(key), key, "left_anti")
    return out


def status_of(asks: DataFrame, matches: DataFrame, key: str, has_coords: Column) -> DataFrame:
    """asks with the match (if any) and status: reconciled, coord_only (printed coordinates without a match) or unmatched."""
    rest = [c for c in matches.columns if c != key]
    joined = asks.join(matches, key, "left")
    return joined.withColumn("status", F.when(F.col("pass").isNotNull(), "reconciled").when(has_coords, "coord_only").otherwise("unmatched")).select(*asks.columns, *rest, "status")


def resolve_chain(chains: DataFrame, key: str, resolve: Callable[[DataFrame], DataFrame], depth: int) -> DataFrame:
    """Levels of each chain in order; a level is resolved within the deepest resolved one above it, and unresolved levels are skipped.

    chains: key, level (from 0), name. resolve: distinct (name, container) -> name, container, place for those that resolve.
    The loop runs over depth, the length of the longest chain, not over rows.
    """
    at = chains.select(key).distinct().withColumn("container", F.lit(None).cast("string"))
    out = None
    for d in range(depth):
        asked = chains.where(F.col("level") == d).select(key, "name").join(at, key)
        answers = resolve(asked.select("name", "container").distinct()).select(F.col("name").alias("__n"), F.col("container").alias("__c"), "place")
        got = asked.join(answers, (F.col("name") == F.col("__n")) & F.col("container").eqNullSafe(F.col("__c")), "left").select(key, F.lit(d).alias("level"), "name", "container", "place")
        out = got if out is None else out.unionByName(got)
        at = at.join(got.select(key, "place"), key, "left").select(key, F.coalesce("place", "container").alias("container"))
    return out


def first_of(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; a full order is the caller's duty."""
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("__n = 1").drop("__n")
