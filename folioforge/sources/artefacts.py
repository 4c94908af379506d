"""Stored artefacts: sharded details, reader chunks, search index, byte matrix, review shards, bridges, dictionaries, tiles, CSV and reports.

Every artefact is a folder of files that tasks write in parallel, and a manifest: one JSON line that says what is there. Rows are built as
columns; nothing but a manifest's few numbers is brought to the driver.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.search import chunked, postings, quantise, tile_of, trigrams

DETAIL_SHARDS, REVIEW_ROWS, READER_ROWS, CLUSTER_TO_ZOOM = 256, 200, 150, 6


def manifest(spark: SparkSession, path: str, **facts) -> None:
    """One line of JSON at path/manifest."""
    spark.createDataFrame([(json.dumps(facts, sort_keys=True, default=str),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/manifest")


def read_manifest(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(f"{path}/manifest").first()["value"])


def write_details(rows: DataFrame, path: str, key: str, n: int = DETAIL_SHARDS) -> None:
    """A row of JSON for each key, in folders by key modulo n: a reader of one key opens one folder. Rows stay rows, so a shard of any size is written by streaming."""
    body = F.to_json(F.struct(*rows.columns))
    out = rows.select(F.pmod(F.col(key).cast("bigint"), F.lit(n)).cast("int").alias("shard"), F.col(key).alias("__key"), F.concat(F.lit('"'), F.col(key).cast("string"), F.lit('":'), body).alias("value"))
    out.repartitionByRange("shard", "__key").sortWithinPartitions("shard", "__key").drop("__key").write.mode("overwrite").partitionBy("shard").text(f"{path}/details")
    manifest(rows.sparkSession, path, kind="details", key=key, shards=n, rows=rows.count())


def detail(spark: SparkSession, path: str, key: int) -> dict | None:
    """The details of one key, from its shard alone."""
    facts = read_manifest(spark, path)
    got = spark.read.text(f"{path}/details").where((F.col("shard") == key % facts["shards"]) & F.startswith("value", F.lit(f'"{key}":'))).first()
    return json.loads("{" + got["value"] + "}")[str(key)] if got else None


def id_points(rows: DataFrame, eid: str, lon: str, lat: str, ident: str, order: list[str]) -> DataFrame:
    """eid and the JSON array [lon, lat, id] of its last row in the given order."""
    last = rows.groupBy(eid).agg(F.max_by(F.struct(lon, lat, ident), F.struct(*order)).alias("p"))
    return last.select(eid, F.concat(F.lit("["), F.round(f"p.{lon}", 5).cast("string"), F.lit(","), F.round(f"p.{lat}", 5).cast("string"), F.lit(","), F.col(f"p.{ident}").cast("string"), F.lit("]")).alias("point"))


def shape_feature(kind: Column, rings: Column, **properties: Column) -> Column:
    """A GeoJSON feature of a LineString (one list of points) or a Polygon (a list of rings); points are arrays of two numbers."""
    shape = F.when(kind == "LineString", F.to_json(F.get(rings, F.lit(0)))).otherwise(F.to_json(rings))
    head = F.concat(F.lit('{"type":"Feature","geometry":{"type":"'), kind, F.lit('","coordinates":'), shape)
    return F.concat(head, F.lit('},"properties":'), F.to_json(F.struct(*(c.alias(k) for k, c in properties.items()))), F.lit("}"))


def reader_chunks(entries: DataFrame, volume: str, order: str, size: int = READER_ROWS) -> DataFrame:
    """entries with pos and chunk, by volume."""
    return chunked(entries, [order], size, [volume])


def reader_index(entries: DataFrame, volume: str, order: str, page: str, head: str, size: int = READER_ROWS) -> DataFrame:
    """For each chunk of each volume: its rows, first and last headword, first and last page, and its commonest first letter."""
    at = reader_chunks(entries, volume, order, size).withColumn("letter", F.upper(F.left(F.col(head), F.lit(1))))
    letters = at.groupBy(volume, "chunk", "letter").agg(F.count("*").alias("n"), F.min("pos").alias("seen")).groupBy(volume, "chunk").agg(F.max_by("letter", F.struct(F.col("n"), -F.col("seen"))).alias("letter"))
    ends = at.groupBy(volume, "chunk").agg(F.count("*").alias("n"), F.min_by(head, "pos").alias("first_head"), F.max_by(head, "pos").alias("last_head"), F.min(page).alias("first_page"), F.max(page).alias("last_page"))
    return ends.join(letters, [volume, "chunk"])


def write_reader(entries: DataFrame, path: str, volume: str, order: str, page: str, head: str, size: int = READER_ROWS) -> None:
    """Chunks in folders by volume and chunk, their index, and a manifest."""
    at = reader_chunks(entries, volume, order, size)
    at.select(volume, "chunk", "pos", F.to_json(F.struct(*entries.columns)).alias("value")).repartition(volume, "chunk").sortWithinPartitions(volume, "chunk", "pos").drop("pos").write.mode("overwrite").partitionBy(volume, "chunk").text(f"{path}/chunks")
    index = reader_index(entries, volume, order, page, head, size)
    index.write.mode("overwrite").json(f"{path}/index")
    manifest(entries.sparkSession, path, kind="reader", size=size, entries=entries.count(), chunks=index.count())


def write_search(docs: DataFrame, path: str, key: str, head: str, text: str, buckets: int = 64) -> None:
    """Token postings and trigrams of headwords, in folders by a hash of the token, so that a query reads the folders of its own tokens; and a manifest with what BM25 needs."""
    whole = docs.select(key, F.concat_ws(" ", head, text).alias("__all"))
    index = postings(whole, key, "__all")
    index.withColumn("bucket", F.pmod(F.xxhash64("token"), F.lit(buckets)).cast("int")).repartition("bucket", "token").sortWithinPartitions("bucket", "token", key).write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/tokens")
    grams = docs.select(key, F.col(head).alias("head"), trigrams(F.col(head)).alias("__g")).select(key, "head", F.size("__g").alias("n"), F.explode("__g").alias("gram"))
    grams.withColumn("bucket", F.pmod(F.xxhash64("gram"), F.lit(buckets)).cast("int")).repartition("bucket", "gram").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/grams")
    # of the stored index each text with a token has its length; the others count with 0
    size = docs.sparkSession.read.parquet(f"{path}/tokens").groupBy(key).agg(F.first("length").alias("l")).agg(F.sum("l").alias("all")).first()
    n = docs.count()
    manifest(docs.sparkSession, path, kind="search", buckets=buckets, texts=n, mean_length=(size["all"] or 0) / max(1, n))


def search_text(spark: SparkSession, path: str, key: str, words: list[str]) -> DataFrame:
    """key, score from the stored index: only the buckets of the query's tokens are read."""
    from ..operators.search import bm25

    facts = read_manifest(spark, path)
    numbers = [r["b"] for r in spark.createDataFrame([(w,) for w in words], "w string").select(F.pmod(F.xxhash64("w"), F.lit(facts["buckets"])).cast("int").alias("b")).collect()]  # one row a query word
    index = spark.read.parquet(f"{path}/tokens").where(F.col("bucket").isin(numbers))
    return bm25(index, key, facts["texts"], facts["mean_length"] or 1.0, words)


def search_heads(spark: SparkSession, path: str, key: str, name: str, least: float = 0.3) -> DataFrame:
    """key, head, overlap of stored headwords that share enough trigrams with the name."""
    facts = read_manifest(spark, path)
    asked = spark.createDataFrame([(name,)], "name string").select(F.explode(trigrams(F.col("name"))).alias("gram"))
    mine = [(r["gram"], r["b"]) for r in asked.select("gram", F.pmod(F.xxhash64("gram"), F.lit(facts["buckets"])).cast("int").alias("b")).collect()]  # a name's trigrams
    hits = spark.read.parquet(f"{path}/grams").where(F.col("bucket").isin(sorted({b for _, b in mine})) & F.col("gram").isin([g for g, _ in mine]))
    shared = hits.groupBy(key, "head", "n").agg(F.count("*").alias("s"))
    return shared.select(key, "head", (F.col("s") / (F.col("n") + len(mine) - F.col("s"))).alias("overlap")).where(F.col("overlap") >= least)


def write_matrix(vectors: DataFrame, path: str, key: str, vector: str, meta: list[str]) -> None:
    """Vectors as signed bytes with their metadata in the same rows (parallel arrays of a file are columns of a row group), in the order of keys."""
    rows = vectors.select(key, *meta, quantise(F.col(vector)).cast("array<tinyint>").alias("bytes"))
    rows.repartitionByRange(key).sortWithinPartitions(key).write.mode("overwrite").parquet(f"{path}/matrix")
    facts = rows.agg(F.count("*").alias("n"), F.max(F.size("bytes")).alias("d")).first()
    manifest(vectors.sparkSession, path, kind="matrix", rows=facts["n"], width=facts["d"], scale=127, meta=meta)


def review_shards(rows: DataFrame, order: list[Column], by: list[str], size: int = REVIEW_ROWS) -> DataFrame:
    """by, shard, n, json: rows in review order, so many to a shard, as one JSON array each."""
    at = chunked(rows, order, size, by)
    packed = at.groupBy(*by, "chunk").agg(F.array_sort(F.collect_list(F.struct("pos", F.to_json(F.struct(*rows.columns)).alias("j")))).alias("x"))  # at most ``size`` rows a shard
    return packed.select(*by, F.col("chunk").alias("shard"), F.size("x").alias("n"), F.concat(F.lit("["), F.array_join(F.transform("x", lambda r: r["j"]), ","), F.lit("]")).alias("json"))


def write_review(rows: DataFrame, path: str, order: list[Column], by: list[str], size: int = REVIEW_ROWS) -> None:
    out = review_shards(rows, order, by, size)
    out.write.mode("overwrite").partitionBy(*by).json(f"{path}/shards")
    manifest(rows.sparkSession, path, kind="review", size=size, rows=rows.count())


def bridge_rows(joined: DataFrame, key: str) -> DataFrame:
    """part (verified or rejected) and the JSON of each joined row; what could not be verified belongs to neither."""
    part = F.when(F.col("status") == "verified", "verified").when(F.col("status") == "rejected_by_coordinate", "rejected")
    return joined.withColumn("part", part).where("part IS NOT NULL").select(key, "part", F.to_json(F.struct(*joined.columns)).alias("json"))


def write_bridge(joined: DataFrame, path: str, key: str) -> None:
    bridge_rows(joined, key).select("part", F.col("json").alias("value")).write.mode("overwrite").partitionBy("part").text(f"{path}/bridge")


def write_dictionary(entries: DataFrame, path: str, key: str, value: Column) -> None:
    """Lines '"key":value' in the order of keys over all files."""
    entries.select(key, F.concat(F.lit('"'), F.col(key), F.lit('":'), value).alias("value")).repartitionByRange(key).sortWithinPartitions(key).select("value").write.mode("overwrite").text(f"{path}/dictionary")


def clustered(points: DataFrame, lon: str, lat: str, zoom: int, grid: int = 32) -> DataFrame:
    """Points of a zoom level. To zoom 6 those of one cell (a tile's width cut into ``grid``, 8 pixels of 256) become one with their number and mean place; beyond, all are kept."""
    at = points.where(F.col(lon).isNotNull() & F.col(lat).isNotNull())
    if zoom > CLUSTER_TO_ZOOM:
        tile = tile_of(F.col(lon), F.col(lat), zoom)
        return at.select(F.lit(zoom).alias("zoom"), tile["x"].alias("x"), tile["y"].alias("y"), F.col(lon).alias("lon"), F.col(lat).alias("lat"), F.lit(1).cast("bigint").alias("n"))
    fine = tile_of(F.col(lon), F.col(lat), zoom + grid.bit_length() - 1)
    cells = at.groupBy(fine["x"].alias("__x"), fine["y"].alias("__y")).agg(F.avg(lon).alias("lon"), F.avg(lat).alias("lat"), F.count("*").alias("n"))
    return cells.select(F.lit(zoom).alias("zoom"), F.floor(F.col("__x") / grid).cast("int").alias("x"), F.floor(F.col("__y") / grid).cast("int").alias("y"), "lon", "lat", "n")


def write_csv_bom(rows: DataFrame, path: str, pilot: Column, order: list[Column]) -> None:
    """CSV with pilot rows first; the header's first name bears the byte-order mark by which spreadsheets know UTF-8."""
    first = rows.columns[0]
    out = rows.orderBy(F.when(pilot, 0).otherwise(1), *order).withColumnRenamed(first, f"﻿{first}")
    out.write.mode("overwrite").option("header", True).csv(path)


def markdown_table(rows: DataFrame, title: str, most: int = 1000) -> str:
    """A small aggregate as a Markdown table; more than ``most`` rows are an error, not cut."""
    got = rows.limit(most + 1).collect()
    if len(got) > most:
        raise ValueError(f"{title}: more than {most} rows are no table for readers")
    head = ["| " + " | ".join(rows.columns) + " |", "|" + "---|" * len(rows.columns)]
    return "\n".join([f"## {title}", "", *head, *("| " + " | ".join("" if v is None else str(v) for v in r) + " |" for r in got), ""])


def reset(rows: DataFrame, affected: Column, cleared: list[str], **given: Column) -> DataFrame:
    """rows with the columns of affected ones cleared or set anew; all others as they are."""
    return rows.select(*(F.when(affected, given[c]).otherwise(F.col(c)).alias(c) if c in given else F.when(~affected, F.col(c)).alias(c) if c in cleared else F.col(c) for c in rows.columns))
