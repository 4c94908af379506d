"""Sinks: idempotent loads, upserts, GeoJSON lines, sharded details with a manifest, CSV."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def replace_by(rows: DataFrame, path: str, keys: list[str]) -> None:
    """Writes rows in partitions by keys; only the partitions that rows has are replaced."""
    rows.write.partitionBy(*keys).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def replaced(stored: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """stored without the keys that fresh has (nulls are equal), and fresh."""
    gone = fresh.select(*(F.col(k).alias(f"__{k}") for k in keys)).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return stored.join(gone, same, "left_anti").unionByName(fresh, allowMissingColumns=True)


def added(stored: DataFrame, fresh: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """INSERT OR IGNORE: stored, and of each key it lacks one of fresh's rows: the first by ``order`` (by the other columns, if none is given).

    A key with a null is never equal to another, as in a unique index: such rows are all added.
    """
    rest = [c for c in fresh.columns if c not in keys]
    first = F.struct(*(order or [F.col(c) for c in rest] or [F.lit(0)]))
    whole = F.struct(*rest) if rest else F.struct(F.lit(0).alias("__none"))
    named = F.lit(True)
    for k in keys:
        named = named & F.col(k).isNotNull()
    one = fresh.where(named).groupBy(*keys).agg(F.min_by(whole, first).alias("__v")).select(*keys, *(F.col(f"__v.{c}").alias(c) for c in rest))
    news = one.join(stored.select(*keys), keys, "left_anti").unionByName(fresh.where(~named))
    return stored.unionByName(news, allowMissingColumns=True)


def point_feature(lon: Column, lat: Column, **properties: Column) -> Column:
    """A GeoJSON point feature as JSON; empty and null properties are left out."""
    shown = F.struct(*((F.nullif(c, F.lit("")) if isinstance(c, Column) and k.startswith("text_") else c).alias(k.removeprefix("text_")) for k, c in properties.items()))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")).alias("geometry"), shown.alias("properties")))


def write_lines(rows: DataFrame, column: str, path: str) -> None:
    rows.select(F.col(column).alias("value")).write.mode("overwrite").text(path)


def shards(rows: DataFrame, key: str, n: int = 256) -> DataFrame:
    """shard and its rows as one JSON object keyed by ``key``; a shard holds 1/n of the keys."""
    item = F.struct(F.col(key).cast("string").alias("k"), F.to_json(F.struct(*(c for c in rows.columns if c != key))).alias("v"))
    packed = rows.groupBy(F.pmod(F.col(key), F.lit(n)).cast("int").alias("shard")).agg(F.array_sort(F.collect_list(item)).alias("__i"))
    body = F.array_join(F.transform("__i", lambda x: F.concat(F.lit('"'), x["k"], F.lit('":'), x["v"])), ",")
    return packed.select("shard", F.size("__i").alias("n"), F.concat(F.lit("{"), body, F.lit("}")).alias("json"))


def write_csv(rows: DataFrame, path: str, order: list[Column]) -> None:
    rows.orderBy(*order).write.mode("overwrite").option("header", True).csv(path)


def flag_update(flags: Column, flag: str, on: Column) -> Column:
    """A sorted set of flags with one put in or taken out."""
    base = F.coalesce(flags, F.array().cast("array<string>"))
    return F.array_sort(F.when(on, F.array_union(base, F.array(F.lit(flag)))).otherwise(F.array_except(base, F.array(F.lit(flag)))))
