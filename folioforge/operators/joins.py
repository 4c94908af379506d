"""Joins that Spark has no operator for, composed of those it has: as-of, within a distance, nearest, request fan-out, islands."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import EARTH_KM, cell, haversine_km, lon_reach


def asof_backward(left: DataFrame, right: DataFrame, by: list[str], on: str, values: list[str], inclusive: bool = True, or_first: bool = False) -> DataFrame:
    """left with the ``values`` of the last right row at or before each row (strictly before if not inclusive).

    One union, one shuffle by the key and one window; no pair is formed. Equal times: right rows come first if inclusive. With
    or_first a left row before all right rows takes the key's first. Right rows of equal key and time: the last by values holds.
    """
    side = 0 if inclusive else 2
    held = F.struct(*(F.col(v) for v in values))
    r = right.select(*by, F.col(on), held.alias("__r"), F.lit(side).alias("__s"))
    l = left.select(*by, F.col(on), F.struct(*left.columns).alias("__l"), F.lit(1).alias("__s"))  # noqa: E741
    both = r.unionByName(l, allowMissingColumns=True)
    w = Window.partitionBy(*by).orderBy(F.col(on), "__s", "__r")
    got = F.last("__r", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    if or_first:
        got = F.coalesce(got, F.first("__r", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return both.withColumn("__r", got).where(F.col("__l").isNotNull()).select("__l.*", *(F.col(f"__r.{v}").alias(f"prev_{v}") for v in values))


def asof_backward_split(left: DataFrame, right: DataFrame, by: list[str], on: str, values: list[str], bucket: Column) -> DataFrame:
    """asof_backward for keys that may hold a large share of all rows: the window runs within (key, bucket), so that a hot key is many tasks.

    ``bucket`` is an expression of ``on`` that never falls as ``on`` rises (such as its day). What a bucket starts with is the last right
    row of any bucket before it, had from one row a key and bucket.
    """
    held = F.struct(F.col(on), F.struct(*(F.col(v) for v in values)).alias("__v"))
    last = right.withColumn("__b", bucket).groupBy(*by, "__b").agg(F.max(held).alias("__last"))
    marks = last.unionByName(left.select(*by, bucket.alias("__b")).distinct(), allowMissingColumns=True)
    one = marks.groupBy(*by, "__b").agg(F.max("__last").alias("__last"))
    w = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    keys = [*by, "__b"]
    start = one.select(*(F.col(k).alias(f"__k{n}") for n, k in enumerate(keys)), F.last("__last.__v", ignorenulls=True).over(w).alias("__start"))
    # whole rows are carried: a right row whose values are null is a row, and hides those before it
    whole = right.select(*by, on, F.struct(*(F.col(v) for v in values)).alias("__row")).withColumn("__b", bucket)
    inner = asof_backward(left.withColumn("__b", bucket), whole, keys, on, ["__row"])
    out = inner.join(start, [F.col(k).eqNullSafe(F.col(f"__k{n}")) for n, k in enumerate(keys)], "left")
    got = F.when(F.col("prev___row").isNotNull(), F.col("prev___row")).otherwise(F.col("__start"))
    return out.select(*left.columns, got.alias("__got")).select(*left.columns, *(F.col(f"__got.{v}").alias(f"prev_{v}") for v in values))


def spread(df: DataFrame, *columns: str) -> DataFrame:
    """df dealt by columns to as many tasks as a shuffle has: for rows that are few before a join or an explode, and many after it.

    Dealt by a hash of the columns: an exchange by the columns themselves is taken for the one below it, whose few bytes Spark puts into one task.
    """
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism), F.xxhash64(*columns))


def within_distance(left: DataFrame, right: DataFrame, km: float, size: float | None = None, by: list[str] | None = None, digits: int | None = None) -> DataFrame:
    """Pairs of points (columns lat, lon on both sides; other names distinct but for ``by``, which must agree) at most km apart, with their distance ``km`` (rounded to ``digits``, if given).

    Points of one place (and ``by``) are looked for once: places of the left are sent to all grid cells their circle can touch (wider in longitude
    towards the poles, and across the date line), places of the right to their own: an equality join on the cell, then the true distance.
    Pairs of places are then given back to the points at them, by two equality joins.
    """
    by = by or []
    size = size or max(km / 111.0, 0.05)
    cells = math.ceil(360 / size)
    dy = math.ceil(km / 111.0 / size)
    n = lon_reach(km, size, F.col("lat"))
    wrapped = lambda c: F.pmod(c, F.lit(cells))
    rows = F.sequence(cell(F.col("lat") + 90, size) - dy, cell(F.col("lat") + 90, size) + dy)
    cols = F.array_distinct(F.transform(F.sequence(cell(F.col("lon") + 180, size) - n - 1, cell(F.col("lon") + 180, size) + n + 1), wrapped))
    a = spread(left.select(*by, "lat", "lon").distinct(), *by, "lat", "lon").withColumn("__y", F.explode(rows)).withColumn("__x", F.explode(cols))
    b = right.select(*(F.col(c).alias(f"{c}_r" if c in ("lat", "lon") else c) for c in right.columns))
    spots = b.select(*by, "lat_r", "lon_r").distinct().withColumn("__y", cell(F.col("lat_r") + 90, size)).withColumn("__x", wrapped(cell(F.col("lon_r") + 180, size)))
    met = a.join(spots, [*by, "__y", "__x"]).withColumn("km", haversine_km(F.col("lat"), F.col("lon"), F.col("lat_r"), F.col("lon_r")))
    met = met.where(F.col("km") <= km).select(*by, "lat", "lon", "lat_r", "lon_r", (F.round("km", digits) if digits is not None else F.col("km")).alias("km"))
    # the right's points first: so the larger product is made last, from rows that need not be moved again
    return spread(left, *by, "lat", "lon").join(met.join(b, [*by, "lat_r", "lon_r"]).drop("lat_r", "lon_r"), [*by, "lat", "lon"]).select(*left.columns, *(c for c in right.columns if c not in (*by, "lat", "lon")), "km")


WHOLE_EARTH_KM, EARTH_LEVELS = 20100.0, 20


def _unit(df: DataFrame, name: str = "") -> DataFrame:
    """df with the place of its lat, lon on the unit sphere, and without rows that have none. The square of a straight line there is 4 h of haversine."""
    a, o = F.radians(f"lat{name}"), F.radians(f"lon{name}")
    at = df.withColumn(f"__x{name}", F.cos(a) * F.cos(o)).withColumn(f"__y{name}", F.cos(a) * F.sin(o)).withColumn(f"__z{name}", F.sin(a))
    whole = F.col(f"__x{name}") + F.col(f"__y{name}") + F.col(f"__z{name}")
    return at.where(whole.isNotNull() & ~F.isnan(whole))


def _cube(x: Column, level: Column) -> Column:
    """Number, along one axis, of the cube that holds x where the axis from -1 to 1 is halved ``level`` times."""
    n = F.call_function("shiftleft", F.lit(1).cast("bigint"), level)
    return F.greatest(F.lit(0), F.least(n - 1, F.floor((x + 1) / 2 * n)))


def _cube_id(x: Column, y: Column, z: Column) -> Column:
    return (x * (1 << EARTH_LEVELS) + y) * (1 << EARTH_LEVELS) + z


def nearest_points(left: DataFrame, right: DataFrame, by: list[str], tie: str, k: int = 1, most_km: float = WHOLE_EARTH_KM) -> DataFrame:
    """left with the columns of its k nearest right points of equal ``by`` at most most_km away, their distance ``km`` and number ``nth`` (from 1).

    Left points that have none are left out. Distances that agree to the millimetre are ties, settled by ``tie``. Points of one place are looked
    for once, and a place holds the k first of the right's points at it. The sphere lies in cubes that are halved EARTH_LEVELS times: the smallest cube
    round a left place with k right points says how far the k nearest can be, and only cubes within that reach are looked at. So a place meets
    some multiple of k points however many there are, unless most of the right's lie close together and the left's far from them.
    """
    rest = [c for c in right.columns if c not in (*by, "lat", "lon")]
    place, cube = [*by, "lat", "lon"], [*by, "__level", "__cube"]
    first = F.row_number().over(Window.partitionBy(*place).orderBy(tie))
    held = right.withColumn("__first", first).where(F.col("__first") <= k).select(*by, F.struct(*rest).alias("__v"), F.col("lat").alias("lat_r"), F.col("lon").alias("lon_r"))
    levels, level = F.explode(F.sequence(F.lit(0), F.lit(EARTH_LEVELS))).alias("__level"), F.col("__level")
    own = lambda name: _cube_id(*(_cube(F.col(f"__{c}{name}"), level) for c in "xyz")).alias("__cube")
    there = _unit(held, "_r").select("*", levels).select("*", own("_r"))
    full = there.groupBy(*cube).agg(F.count("*").alias("__points")).where((F.col("__points") >= k) | (level == 0)).drop("__points")
    asks = _unit(spread(left.select(*place).distinct(), *place))
    tops = asks.select("*", levels).select("*", own("")).join(full, cube).groupBy(*place, "__x", "__y", "__z").agg(F.max("__level").alias("__top"))
    slack = 1e-9  # six millimetres, for ties
    reach = F.least(2 * math.sqrt(3) / F.pow(F.lit(2.0), F.col("__top")), F.lit(2 * math.sin(min(most_km / (2 * EARTH_KM), math.pi / 2)))) + slack
    at = tops.withColumn("__r", reach).withColumn("__level", F.greatest(F.lit(0), F.least(F.lit(EARTH_LEVELS), F.floor(F.log2(2 / F.col("__r"))))).cast("int"))
    edge, gap = 2 / F.call_function("shiftleft", F.lit(1).cast("bigint"), level), F.lit(0.0)
    for c in "xyz":
        x = F.col(f"__{c}")
        at = at.withColumn(f"__c{c}", F.explode(F.sequence(_cube(x - F.col("__r"), level), _cube(x + F.col("__r"), level))))
        low = F.col(f"__c{c}") * edge - 1
        gap = gap + F.pow(F.greatest(low - x, x - low - edge, F.lit(0.0)), 2)
    at = at.where(gap <= F.pow("__r", 2) + slack).withColumn("__cube", _cube_id(*(F.col(f"__c{c}") for c in "xyz"))).select(*place, "__x", "__y", "__z", "__r", "__level", "__cube")
    line = sum((F.pow(F.col(f"__{c}") - F.col(f"__{c}_r"), 2) for c in "xyz"), F.lit(0.0))
    near = at.join(there, cube).where(line <= F.pow("__r", 2) + slack).select(*place, "__v", haversine_km(F.col("lat"), F.col("lon"), F.col("lat_r"), F.col("lon_r")).alias("km"))
    best = near.where(F.col("km") <= most_km).withColumn("nth", F.row_number().over(Window.partitionBy(*place).orderBy(F.round("km", 6), F.col(f"__v.{tie}")))).where(F.col("nth") <= k)
    return left.join(best, place).select(*left.columns, *(F.col(f"__v.{c}").alias(c) for c in rest), "km", "nth")


def nearest_within_key(left: DataFrame, right: DataFrame, by: list[str], key: str, tie: str, first_km: float | None = None, grow: float | None = None, keep: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """left with the columns of its nearest right point of equal ``by`` and its distance ``km`` (see nearest_points); left points without any are left out.

    keep writes the answers. first_km and grow set the pace of an earlier search by growing circles; they change nothing now.
    """
    out = nearest_points(left, right, by, tie).drop("nth")
    return keep(out, "nearest") if keep else out


def dedup_enrich(asks: DataFrame, request: list[str], answer) -> DataFrame:
    """Each distinct request is answered once (answer: DataFrame of requests -> with answers), then given to all who asked."""
    return asks.join(answer(asks.select(*request).distinct()), request, "left")


def islands(rows: DataFrame, by: list[str], order: str, flag: Column) -> DataFrame:
    """Runs of consecutive flagged rows: by, island (from 1), first, last, length. ``order`` counts rows without gaps within ``by``."""
    marked = rows.where(flag).withColumn("__g", F.col(order) - F.row_number().over(Window.partitionBy(*by).orderBy(order)))
    runs = marked.groupBy(*by, "__g").agg(F.min(order).alias("first"), F.max(order).alias("last"), F.count("*").alias("length"))
    return runs.withColumn("island", F.row_number().over(Window.partitionBy(*by).orderBy("first"))).drop("__g")


def with_next(rows: DataFrame, order: str, name: str, parts: int = 200) -> DataFrame:
    """rows with the next larger or equal value of a numeric column over the whole table (null for the last), ties in no order.

    The table is cut at ``parts`` approximate quantiles; each part looks ahead on its own, and its last row takes the next part's least value.
    """
    cuts = sorted(set(rows.approxQuantile(order, [k / parts for k in range(1, parts)], 0.5 / parts)))  # at most parts - 1 numbers
    part = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col(order))) if cuts else F.lit(0)
    cut = rows.withColumn("__part", part)
    least = cut.where(F.col(order).isNotNull()).groupBy("__part").agg(F.min(order).alias("__m"))  # at most ``parts`` rows
    after = least.withColumn("__after", F.lead("__m").over(Window.orderBy("__part"))).drop("__m")
    ahead = F.lead(order).over(Window.partitionBy("__part").orderBy(F.col(order).asc_nulls_first()))
    return cut.withColumn("__ahead", ahead).join(F.broadcast(after), "__part", "left").withColumn(name, F.when(F.col(order).isNotNull(), F.coalesce("__ahead", "__after"))).drop("__part", "__ahead", "__after")


def latest(rows: DataFrame, key: list[str], order: Column) -> DataFrame:
    """Upsert: of each key the row of the highest order. A hash aggregation with partial results in every task."""
    rest = [c for c in rows.columns if c not in key]
    return rows.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("__v")).select(*key, "__v.*")


def misses(asks: DataFrame, cache: DataFrame, key: list[str]) -> DataFrame:
    return asks.join(cache, key, "left_anti")


def point_in_rings(points: DataFrame, edges: DataFrame, tolerance: float = 0.0) -> DataFrame:
    """points joined to the areas that hold them: even-odd rule over ring edges, or within ``tolerance`` of an edge.

    points: point_id, x, y, area_id (the area to test); edges: area_id, x1, y1, x2, y2. Several rings of an area count together, so that
    a ring within another is a hole. Returns point_id, area_id, inside. Join and sum by area: no geometry is decoded here.
    """
    x, y, x1, y1, x2, y2 = (F.col(c) for c in ("x", "y", "x1", "y1", "x2", "y2"))
    crosses = ((y1 > y) != (y2 > y)) & (x < F.coalesce(F.try_divide((x2 - x1) * (y - y1), y2 - y1), F.lit(0.0)) + x1)
    along = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.try_divide((x - x1) * (x2 - x1) + (y - y1) * (y2 - y1), (x2 - x1) ** 2 + (y2 - y1) ** 2), F.lit(0.0))))
    gap = F.sqrt((x - x1 - along * (x2 - x1)) ** 2 + (y - y1 - along * (y2 - y1)) ** 2)
    return points.join(edges, "area_id").groupBy("point_id", "area_id").agg(((F.sum(crosses.cast("int")) % 2 == 1) | (F.min(gap) <= tolerance)).alias("inside"))


def ancestors(edges: DataFrame, most: int = 6) -> DataFrame:
    """child, depth, ancestor, path along the first parent (smallest), to ``most`` steps; a node met twice ends the walk."""
    step = edges.groupBy("child").agg(F.min("parent").alias("parent"))
    at = step.select("child", F.lit(1).alias("depth"), F.col("parent").alias("ancestor"), F.array("child", "parent").alias("path"))
    out = at
    for _ in range(most - 1):
        at = at.join(step.select(F.col("child").alias("ancestor"), F.col("parent").alias("__p")), "ancestor")
        at = at.where(~F.array_contains("path", F.col("__p"))).select("child", (F.col("depth") + 1).alias("depth"), F.col("__p").alias("ancestor"), F.concat("path", F.array("__p")).alias("path"))
        out = out.unionByName(at)
    return out
