"""Coordinates: distance, boxes, cells, parsing."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    a, b, c, d = (F.radians(x) for x in (lat1, lon1, lat2, lon2))
    h = F.pow(F.sin((c - a) / 2), 2) + F.cos(a) * F.cos(c) * F.pow(F.sin((d - b) / 2), 2)
    return 2 * EARTH_KM * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def box_around(lat: Column, lon: Column, km: float, round_earth: bool = True) -> Column:
    """struct<south, west, north, east>; with round_earth the longitudes widen by 1 / max(0.15, cos lat)."""
    dy = km / 111.0
    dx = F.lit(dy) / F.greatest(F.lit(0.15), F.cos(F.radians(lat))) if round_earth else F.lit(dy)
    return F.struct((lat - dy).alias("south"), (lon - dx).alias("west"), (lat + dy).alias("north"), (lon + dx).alias("east"))


def both_or_neither(lat: Column, lon: Column) -> Column:
    """A lone latitude is no place."""
    return F.when(lat.isNotNull() & lon.isNotNull(), F.struct(lat.alias("lat"), lon.alias("lon")))


def cell(x: Column, size: float) -> Column:
    return F.floor(x / size).cast("int")


def lon_reach(km: float, size: float, lat: Column) -> Column:
    """How many cells of longitude a distance may span at a latitude (all, near the poles)."""
    widest = F.greatest(F.cos(F.radians(F.least(F.abs(lat) + km / 111.0, F.lit(90.0)))), F.lit(1e-6))
    return F.least(F.ceil(km / 111.0 / widest / size), F.lit(math.ceil(180 / size))).cast("int")


def degrees_minutes(text: Column) -> Column:
    """DD.MM (minutes after the point or comma) as degrees, a range by its middle; null if minutes are 60 or more."""
    pattern = r"^(\d{1,3})(?:[.,](\d{1,2}))?(?:\s*[-–]\s*(\d{1,3})(?:[.,](\d{1,2}))?)?"

    def one(d: int, m: int) -> Column:
        minutes = F.coalesce(F.regexp_extract(text, pattern, m).try_cast("int"), F.lit(0))
        return F.when(minutes < 60, F.regexp_extract(text, pattern, d).try_cast("int") + minutes / 60)

    ranged = F.regexp_extract(text, pattern, 3) != ""
    return F.when(ranged, (one(1, 2) + one(3, 4)) / 2).otherwise(one(1, 2))


def dms(text: Column) -> Column:
    """Degrees, minutes, seconds with a letter of direction, as decimal degrees; south and west are negative."""
    p = r"^\s*(\d{1,3})\s*°?\s*(?:(\d{1,2})\s*['′])?\s*(?:(\d{1,2}(?:\.\d+)?)\s*[\"″])?\s*([NSEWnsew])\s*$"
    part = lambda k: F.coalesce(F.regexp_extract(text, p, k).try_cast("double"), F.lit(0.0))
    value = part(1) + part(2) / 60 + part(3) / 3600
    return F.when(text.rlike(p), F.when(F.upper(F.regexp_extract(text, p, 4)).isin("S", "W"), -value).otherwise(value))


def plausible(lat: Column, lon: Column, south: float = 0, north: float = 90, west: float = 20, east: float = 180) -> Column:
    return lat.between(south, north) & lon.between(west, east)
