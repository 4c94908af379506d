"""Sources: page texts, numbered page files, geometry, tolerant JSON lines, triples, word lists, geometry shards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAGE_GEOMETRY = "w int, h int, layout array<struct<label:string,bbox:array<int>>>, lines array<struct<bbox:array<int>,text:string>>"


def merged_texts(spark: SparkSession, path: str) -> DataFrame:
    """volume (file name) and text, a row a file."""
    return spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.[^.]*)?$", 1).alias("volume"), F.col("value").alias("text"))


def page_files(spark: SparkSession, path: str) -> DataFrame:
    """page (the last number in the file's name) and text."""
    return spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)\D*$", 1).cast("int").alias("page"), F.col("value").alias("text"))


def page_geometry(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGE_GEOMETRY).json(path, multiLine=True).select("*", F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)\D*$", 1).cast("int").alias("idx"))


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of JSON lines; blank, broken and half-written lines are left out."""
    rows = spark.read.schema(f"{schema}, __bad string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "__bad").json(path)
    return rows.where("__bad IS NULL").drop("__bad").dropna("all")


def json_dim(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path, multiLine=True)


def triples(spark: SparkSession, path: str) -> DataFrame:
    """subject, predicate, object (without brackets or quotes), lang of N-Triples."""
    line = r'^<([^>]*)>\s+<([^>]*)>\s+(?:<([^>]*)>|"((?:[^"\\]|\\.)*)"(?:@([\w-]+))?\S*)\s*\.\s*$'
    part = lambda k: F.regexp_extract("value", line, k)
    rows = spark.read.text(path).where(F.col("value").rlike(line))
    return rows.select(part(1).alias("subject"), part(2).alias("predicate"), F.when(part(3) != "", part(3)).otherwise(part(4)).alias("object"), F.nullif(part(5), F.lit("")).alias("lang"))


def word_list(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.lower(F.trim("value")).alias("word")).where("word <> ''").distinct()


def images(spark: SparkSession, path: str, suffixes: tuple[str, ...] = ("jpg", "jpeg", "png", "tif", "tiff", "jp2")) -> DataFrame:
    """name and content of image files, by suffix; decoding is up to a function given the content."""
    rows = spark.read.format("binaryFile").load(path)
    return rows.where(F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1)).isin(*suffixes)).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "content")


def geometry_parts(rows: DataFrame, key: str = "key") -> DataFrame:
    """place_id and geometry_index from keys like place_3: an equality join then finds all parts of a place."""
    return rows.withColumn("place_id", F.regexp_extract(key, r"^(.*)_(\d+)$", 1)).withColumn("geometry_index", F.regexp_extract(key, r"^(.*)_(\d+)$", 2).cast("int"))


def wkb_rings(shapes: DataFrame, wkb: str = "wkb", keep: tuple[str, ...] = ("place_id",)) -> DataFrame:
    """Edges (ring, x1, y1, x2, y2) of WKB polygons and multipolygons, either byte order; other geometries give no rows."""
    import struct
    from collections.abc import Iterator

    import pandas as pd

    def rings(data: bytes, at: int = 0):
        order = "<" if data[at] else ">"
        kind, n = struct.unpack_from(order + "II", data, at + 1)
        at += 9
        out = []
        if kind % 1000 == 3:
            for _ in range(n):
                (m,) = struct.unpack_from(order + "I", data, at)
                xy = struct.unpack_from(f"{order}{2 * m}d", data, at + 4)
                out.append(list(zip(xy[::2], xy[1::2], strict=True)))
                at += 4 + 16 * m
        elif kind % 1000 == 6:
            for _ in range(n):
                more, at = rings(data, at)
                out += more
        return out, at

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for *ids, data in pdf[[*keep, wkb]].itertuples(index=False):
                for k, ring in enumerate(rings(bytes(data))[0] if data is not None else []):
                    out += [(*ids, k, *a, *b) for a, b in zip(ring, ring[1:], strict=False)]
            yield pd.DataFrame(out, columns=[*keep, "ring", "x1", "y1", "x2", "y2"])

    kinds = ", ".join(f"`{c}` {shapes.schema[c].dataType.simpleString()}" for c in keep)
    return shapes.select(*keep, wkb).mapInPandas(run, f"{kinds}, ring int, x1 double, y1 double, x2 double, y2 double")
