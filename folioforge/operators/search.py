"""Search: token postings with BM25, trigram overlap, vectors, snippets."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import fold, tokens, unaccent
from .joins import spread


def postings(docs: DataFrame, key: str, text: str) -> DataFrame:
    """token, key, tf, length: an inverted index over unaccented lower-case tokens."""
    at = docs.select(key, tokens(unaccent(F.coalesce(F.col(text), F.lit("")))).alias("__t"))
    return at.select(key, F.size("__t").alias("length"), F.explode("__t").alias("token")).groupBy("token", key, "length").agg(F.count("*").alias("tf"))


def bm25(index: DataFrame, key: str, n_docs: int, mean_length: float, query: list[str], k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """key, score of the documents that hold a query token. The query's tokens are pushed into the index scan."""
    hits = index.where(F.col("token").isin(query))
    df = hits.groupBy("token").agg(F.count("*").alias("df"))
    idf = F.log(1 + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("length") / mean_length))
    return hits.join(F.broadcast(df), "token").groupBy(key).agg(F.sum(part).alias("score"))  # df: a row for each query token


def bm25_scan(docs: DataFrame, key: str, text: str, query: list[str], k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """bm25 without an index: every text is cut into tokens once, and only its length and the query's counts go on.

    The corpus' statistics and the scores are read from the same exchange, so that it is made once.
    """
    cut = docs.select(F.col(key), tokens(unaccent(F.coalesce(F.col(text), F.lit("")))).alias("__t"))

    def times(word: str) -> Column:
        return F.size(F.filter("__t", lambda x: x == word))

    slim = cut.select(key, F.size("__t").alias("length"), *(times(w).alias(f"tf{i}") for i, w in enumerate(query))).repartition(key)
    df = [F.count_if(F.col(f"tf{i}") > 0).alias(f"df{i}") for i in range(len(query))]
    all_docs = slim.agg(F.count("*").alias("n"), F.max(key).alias("__key"), F.avg("length").alias("mean"), *df)  # one row; it reads the columns the scores read
    at = slim.crossJoin(F.broadcast(all_docs))
    score = F.lit(0.0)
    for i in range(len(query)):
        tf, idf = F.col(f"tf{i}"), F.log(1 + (F.col("n") - F.col(f"df{i}") + 0.5) / (F.col(f"df{i}") + 0.5))
        score = score + idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("length") / F.col("mean")))
    # a document with a query token has a score above 0; asked of the score, the test stays above the exchange
    return at.select(key, score.alias("score")).where("score > 0")


def trigrams(x: Column) -> Column:
    f = F.concat(F.lit(" "), fold(x, "0-9 "), F.lit(" "))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(f) - 2, F.lit(1))), lambda i: f.substr(i, F.lit(3))))


def trigram_matches(queries: DataFrame, names: DataFrame, key: str, name: str, query: str, least: float = 0.3) -> DataFrame:
    """query, key, name, overlap (shared over all trigrams) of names that share at least ``least`` (more than 0). A null name or query matches nothing.

    Each distinct name is compared once. Two sets that share so much have one of their rarest trigrams in common, of all but as many as
    must be shared of the set alone, and the smaller has at least ``least`` times as many trigrams: only such pairs are compared.
    """
    a = queries.where(F.col(query).isNotNull()).select(query).distinct().withColumn("__a", trigrams(F.col(query)))
    b = names.where(F.col(name).isNotNull()).select(name).distinct().withColumn("__b", trigrams(F.col(name)))
    seen = b.select(F.explode("__b").alias("__g")).groupBy("__g").agg(F.count("*").alias("__n"))  # at most 37 ** 3 trigrams of a-z, 0-9 and blank

    def rarest(df: DataFrame, text: str, grams: str) -> DataFrame:
        counted = df.select(text, F.explode(grams).alias("__g")).join(F.broadcast(seen), "__g", "left").groupBy(text).agg(F.array_sort(F.collect_list(F.struct(F.coalesce("__n", F.lit(0)).alias("n"), F.col("__g").alias("g")))).alias("__o"))
        size = F.size("__o")
        few = F.slice("__o", F.lit(1), size - F.ceil(size * least - 1e-9).cast("int") + 1)
        return counted.select(text, F.transform("__o", lambda x: x["g"]).alias(grams), size.alias(f"{grams}_n"), F.explode(few).alias("__x")).select(text, grams, f"{grams}_n", F.col("__x.g").alias("__g"))

    n, m = F.col("__a_n"), F.col("__b_n")
    met = rarest(a, query, "__a").join(rarest(b, name, "__b"), "__g").where((n >= m * least - 1e-9) & (m >= n * least - 1e-9))
    shared = F.size(F.array_intersect("__a", "__b"))
    like = met.withColumn("overlap", shared / (n + m - shared)).where(F.col("overlap") >= least).select(query, name, "overlap").distinct()
    return like.join(spread(names.select(key, name), key), name).select(query, key, name, "overlap")


def quantise(v: Column, scale: float = 127.0) -> Column:
    """Components as integers between -scale and scale, halves to even."""
    return F.transform(v, lambda x: F.greatest(F.lit(-scale), F.least(F.lit(scale), F.rint(x.cast("double") * scale))).cast("int"))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def nearest_by_dot(asked: DataFrame, stored: DataFrame, key: str, vector: str, k: int, asked_block: int = 2048, stored_block: int = 16384) -> DataFrame:
    """query_id, key, score, rank: for each asked vector the k stored ones (other keys) of the largest product, ties to the smaller key.

    Both sides are dealt to blocks of bounded size; a task multiplies one pair of blocks and returns k rows a query. Vectors meet those
    of their own length; nulls take no part.
    """
    n_a, n_s = (max(1, -(-df.count() // size)) for df, size in ((asked, asked_block), (stored, stored_block)))
    deal = lambda n, salt: F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(n)).cast("int")
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = lambda df: df.select(key, vector).where(F.col(key).isNotNull() & F.col(vector).isNotNull())
    left = rows(asked).withColumn("a", deal(n_a, 1)).withColumn("s", all_of(n_s)).withColumn("d", F.size(vector))
    right = rows(stored).withColumn("s", deal(n_s, 2)).withColumn("a", all_of(n_a)).withColumn("d", F.size(vector))
    schema = pa.schema([("query_id", pa.int64()), (key, pa.int64()), ("score", pa.float64())])

    def multiply(x: pa.Table, y: pa.Table) -> pa.Table:
        if not x.num_rows or not y.num_rows:
            return schema.empty_table()
        d = len(x.column(vector)[0])
        of = lambda t: t.column(vector).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
        ids, other = x.column(key).to_numpy(), y.column(key).to_numpy()
        order = np.argsort(other, kind="stable")
        other, held = other[order], of(y)[order]
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for at in range(0, len(ids), 256):
            scores = of(x.slice(at, 256)) @ held.T
            for q, row in zip(ids[at : at + 256].tolist(), scores, strict=True):
                row[other == q] = -np.inf
                floor = np.partition(row, len(row) - k)[len(row) - k] if len(row) > k else -np.inf
                some = np.flatnonzero((row >= floor) & (row > -np.inf))
                some = some[np.argsort(-row[some], kind="stable")][:k]
                found.append((np.full(len(some), q), other[some], row[some]))
        return pa.table([np.concatenate(c) for c in zip(*found, strict=True)], schema=schema)

    blocks = ["d", "a", "s"]
    hits = left.groupBy(*blocks).cogroup(right.groupBy(*blocks)).applyInArrow(multiply, f"query_id bigint, `{key}` bigint, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), key)
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def snippet(text: Column, word: Column, around: int = 30) -> Column:
    at = F.instr(F.lower(text), word)
    return F.when(at > 0, text.substr(F.greatest(at - around, F.lit(1)), F.lit(2 * around) + F.length(word)))


def edit_limit(word: Column) -> Column:
    """Edits allowed by length: 0 up to two letters, 1 up to five, 2 beyond."""
    return F.when(F.length(word) <= 2, 0).when(F.length(word) <= 5, 1).otherwise(2)


def chunked(rows: DataFrame, order: list, size: int, by: list[str] | None = None) -> DataFrame:
    """pos (from 0) and chunk = pos div size in the given order."""
    w = Window.partitionBy(*(by or [])).orderBy(*order)
    return rows.withColumn("pos", F.row_number().over(w) - 1).withColumn("chunk", F.floor(F.col("pos") / size).cast("int"))


def tile_of(lon: Column, lat: Column, zoom: int) -> Column:
    """struct<x, y> of the web-mercator tile that holds a point."""
    n = 2**zoom
    r = F.radians(F.greatest(F.lit(-85.0511), F.least(F.lit(85.0511), lat)))
    return F.struct(F.floor((lon + 180) / 360 * n).cast("int").alias("x"), F.floor((1 - F.log(F.tan(r) + 1 / F.cos(r)) / 3.141592653589793) / 2 * n).cast("int").alias("y"))
