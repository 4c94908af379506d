"""The cascade's passes as joins with a table of candidates: exact within the narrowest parent, then phonetic within it, within the next
broader one, and within the country alone; coordinates for those that print them.

A candidates table stands for the gateway: place_id, title, country_code, parents (its ancestors' ids), confidence of its phonetic hits,
has_geom, lat, lon. Retrieval is an equality join on the normalised name or on its phonetic key, never a comparison of all pairs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import haversine_km
from ..functions.text import fold
from . import cascade as C
from .joins import within_distance
from .records import requests

#: Name, mode and scope of the passes, in order.
PASSES = (("1-exact-in", "exact", "narrow"), ("2-phon-in", "phonetic", "narrow"), ("3-phon-broad", "phonetic", "broad"), ("4-phon-cc", "phonetic", "none"))


def phonetic_key(name: Column) -> Column:
    """Sound of a name: folded letters, of which alike-sounding groups become one and vowels but the first go; runs count once."""
    x = fold(name)
    for pattern, to in (("(?:sch|sh|ch|tch)", "s"), ("ph", "f"), ("(?:ck|c|q|kh|gh|g)", "k"), ("(?:th|dt|d)", "t"), ("(?:w|v|u(?=[aeiou]))", "f"), ("z", "s"), ("x", "ks"), ("b", "p"), ("(?<=.)[aeiouyh]", ""), (r"(.)\1+", "$1")):
        x = F.regexp_replace(x, pattern, to)
    return x


def candidates_for(asked: DataFrame, index: DataFrame, mode: str) -> DataFrame:
    """Hits of requests (place_id, query, ccode, contained_in): the index's records of the same name or sound, country and scope, with score and rank."""
    key = fold if mode == "exact" else phonetic_key
    a = asked.withColumn("__k", key(F.col("query")))
    b = index.select(key(F.col("title")).alias("__k"), F.col("place_id").alias("hit_id"), "title", F.col("country_code").alias("__cc"), F.col("parents").alias("__in"), "confidence", "has_geom", F.col("lat").alias("hit_lat"), F.col("lon").alias("hit_lon"))
    met = a.where("__k <> ''").join(b, "__k").where(F.col("ccode").isNull() | (F.col("ccode") == F.col("__cc"))).where(F.col("contained_in").isNull() | F.array_contains("__in", F.col("contained_in")))
    same = fold(F.col("query")) == fold(F.col("title"))
    score = F.when(same, 100.0).otherwise(100.0 - 5.0 * F.least(F.levenshtein(fold(F.col("query")), fold(F.col("title"))), F.lit(20)))
    return met.select("place_id", "hit_id", "title", score.alias("score"), F.when(F.lit(mode == "exact"), None).otherwise(F.col("confidence")).alias("confidence"), "has_geom", "hit_lat", "hit_lon", F.col("hit_id").alias("rank"))


def first_alike(index: DataFrame, alike: list[str], confident_only: bool) -> DataFrame:
    """The first record (by place_id) of those that are alike in all that a score and a scope can see; with confident_only of the confident ones."""
    good = index.where(C.confident(F.col("confidence"))) if confident_only else index
    rest = [c for c in index.columns if c not in alike]
    return good.groupBy(*alike).agg(F.min_by(F.struct(*rest), "place_id").alias("__v")).select(*alike, "__v.*")


def name_passes(places: DataFrame, index: DataFrame, keep: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """place_id, hit_id, title, score, ..., pass: what each pass finds for places that no earlier one answered. Identical requests are asked once,
    of the index's records that no pass can tell apart the first."""
    seen = ["title", "country_code", "parents", "has_geom"]
    known = {mode: first_alike(index, seen, mode == "phonetic") for mode in ("exact", "phonetic")}
    known = {mode: keep(df, f"index-{mode}") for mode, df in known.items()} if keep else known
    passes = []
    for name, mode, scope in PASSES:

        def answer(left: DataFrame, name: str = name, mode: str = mode, scope: str = scope) -> DataFrame:
            asked = requests(left, name, mode, scope)
            alike = ["query", "mode", "ccode", "contained_in"]
            once = asked.groupBy(*alike).agg(F.min("place_id").alias("place_id"))
            got = C.winners(candidates_for(once, known[mode], mode), ["place_id"])
            back = once.withColumnRenamed("place_id", "__first").join(got.withColumnRenamed("place_id", "__first"), "__first")
            same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in alike]
            return asked.alias("a").join(back.alias("b"), same).select("a.place_id", *(f"b.{c}" for c in got.columns if c != "place_id"))

        passes.append((name, answer))
    return C.cascade(places, "place_id", passes, keep)


def coordinate_pass(places: DataFrame, index: DataFrame, km: float = C.COORD_KM) -> DataFrame:
    """place_id, hit_id, km, pass for places with a printed point: the nearest good record of the same sound near it, else coord-only.
    Identical requests are asked once, and only records of their sound are met."""
    asks = places.select("name", "lat", "lon").distinct().withColumn("__k", phonetic_key(F.col("name")))
    known = first_alike(index.where("lat IS NOT NULL AND lon IS NOT NULL"), ["title", "lat", "lon"], True)
    known = known.select(F.col("place_id").alias("hit_id"), "title", "confidence", "has_geom", "lat", "lon", phonetic_key(F.col("title")).alias("__k"))
    like = within_distance(asks, known, km, by=["__k"])
    score = F.when(fold(F.col("name")) == fold(F.col("title")), 100.0).otherwise(100.0 - 5.0 * F.least(F.levenshtein(fold(F.col("name")), fold(F.col("title"))), F.lit(20)))
    hits = like.select("name", "lat", "lon", "hit_id", "title", score.alias("score"), "confidence", "has_geom", "km", F.col("hit_id").alias("rank"))
    best = C.by_coordinate(hits, ["name", "lat", "lon"], most_km=km).withColumn("pass", F.lit("coord-match"))
    alike = [F.col(f"p.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("name", "lat", "lon")]
    met = places.select("place_id", "name", "lat", "lon").alias("p").join(best.alias("b"), alike, "left")
    return met.select("p.place_id", *(f"b.{c}" for c in best.columns if c not in ("name", "lat", "lon", "pass")), F.coalesce("pass", F.lit("coord-only")).alias("pass"))


def reconciled(places: DataFrame, index: DataFrame, keep: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """place_id, hit_id, pass, km_from_printed, status of every place: printed coordinates by the coordinate pass, the others by name."""
    printed = F.col("lat").isNotNull() & F.col("lon").isNotNull()
    by_point = coordinate_pass(places.where(printed), index).select("place_id", "hit_id", "pass", F.col("km").alias("km_from_printed"))
    by_name = name_passes(places.where(~printed), index, keep).select("place_id", "hit_id", "pass", F.lit(None).cast("double").alias("km_from_printed"))
    out = places.select("place_id").join(by_point.unionByName(by_name), "place_id", "left")
    status = F.when(F.col("pass") == "coord-only", "coord_only").when(F.col("hit_id").isNotNull(), "reconciled").otherwise("unmatched")
    return out.select("place_id", "hit_id", "pass", "km_from_printed", status.alias("status"))


def residual_km(lat: Column, lon: Column, hit_lat: Column, hit_lon: Column) -> Column:
    """Distance of a match from the printed point; null without one."""
    return F.when(lat.isNotNull() & lon.isNotNull(), haversine_km(lat, lon, hit_lat, hit_lon))
