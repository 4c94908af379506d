"""Exact top-k by inner product with a pivot table.

The distances of all vectors to P pivots are computed once. By the triangle inequality the largest |d(q, p) - d(x, p)| over the pivots
bounds the distance of q and x from below, and with the norms that bounds their inner product from above. A query evaluates candidates
in the order of these bounds and stops when the next bound is below its k-th best score; equal bounds are still evaluated, so that ties
are settled by id. Nothing is approximated: a pivot table only saves evaluations.

Queries and candidates are dealt to blocks of bounded size; a task handles one pair of blocks and returns at most k rows a query, from
which a window takes the best. Pivots come from a bounded sample of the vectors (``SAMPLE``, by a hash of the id, each next pivot the
one farthest from those before); the sample also gives each query a first k-th best score to stop at.

Defined cases: vectors that are null, empty, or hold a null or non-finite component take no part; vectors are compared with those of the same length
only; a query's own row is left out, other rows of its id are candidates like any; repeated rows are queries and candidates of their own;
scores beyond 64 bits are held at the limits; an empty table gives no rows; columns not named are not looked at.

How much a pivot table saves depends on the vectors: on clustered ones most evaluations, on vectors that point evenly in all of 64
directions next to none, since all distances are then alike (the README gives the shares measured).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, written

K, PIVOTS, SAMPLE, QUERY_BLOCK, CANDIDATE_BLOCK = 5, 32, 512, 4096, 8192
_EXACT, _EXACT_SMALL = 2.0**52, 2.0**24


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * component), in double; null for vectors that take no part."""
    usable = vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(usable, F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double"))))


def choose_pivots(sample: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """Farthest-first: the row farthest from the mean, then whichever is farthest from all chosen."""
    if not len(sample):
        return sample
    gap = ((sample - sample.mean(0)) ** 2).sum(1)
    at = [int(gap.argmax())]
    gap = ((sample - sample[at[0]]) ** 2).sum(1)
    while len(at) < min(n, len(sample)) and gap.max() > 0:
        at.append(int(gap.argmax()))
        gap = np.minimum(gap, ((sample - sample[at[-1]]) ** 2).sum(1))
    return sample[at]


def _scores(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact integer inner products of one query with rows, held within 64 bits."""
    return np.array([max(-(2**63), min(2**63 - 1, sum(int(a) * int(b) for a, b in zip(queries, x, strict=True)))) for x in rows], np.int64)


class Block:
    """Candidates of one block with their distances to the pivots; counts evaluations."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, pivots: np.ndarray, gaps: np.ndarray, rows: np.ndarray | None = None):
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors, self.gaps = ids[order], vectors[order], np.ascontiguousarray(gaps[order].T)
        self.rows = self.ids if rows is None else rows[order]
        self.values = vectors[order].astype(float)
        self.norms = (self.values**2).sum(1)
        self.largest = float(np.abs(self.values).max()) if len(ids) else 0.0
        self.small = self.values.astype(np.float32)
        self.evaluated = 0

    def best(self, query_rows: np.ndarray, queries: np.ndarray, gaps: np.ndarray, floors: np.ndarray, k: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(query's place, ids, scores) of each query's best candidates here, of those that can be among its k best anywhere."""
        out = []
        for at in range(0, len(queries), 64):
            part = slice(at, at + 64)
            q, gq = queries[part].astype(float), gaps[part]
            low = np.zeros((len(q), len(self.ids)), np.float32)
            for p in range(gq.shape[1]):
                gap = gq[:, p : p + 1] - self.gaps[p][None, :]
                np.maximum(low, np.abs(gap, out=gap), out=low)
            norm = (q**2).sum(1)
            low = np.maximum(low.astype(float) * (1 - 1e-5) - 1e-3, 0)
            both = norm[:, None] + self.norms[None, :]
            bound = both * (0.5 + 1e-6) - low**2 / 2 + 1
            for r in range(len(q)):
                most = self.largest * float(np.abs(q[r]).max(initial=0)) * q.shape[1]
                out.append((at + r, *self._one(int(query_rows[at + r]), queries[at + r], q[r], bound[r], float(floors[at + r]), k, most)))
        return out

    def _one(self, own: int, query: np.ndarray, q: np.ndarray, bound: np.ndarray, floor: float, k: int, most: float) -> tuple[np.ndarray, np.ndarray]:
        exact = most < _EXACT
        values, q = (self.small, q.astype(np.float32)) if most < _EXACT_SMALL else (self.values, q)
        able = np.flatnonzero(bound >= floor) if exact else np.arange(len(bound))
        order = able[np.argsort(-bound[able].astype(np.float32))]  # places of nearly equal bounds may change; the bound that stops is the exact one
        ahead = np.maximum.accumulate(bound[order][::-1])[::-1]  # the largest bound from here on
        ids, scores, step, at = np.zeros(0, np.int64), np.zeros(0, np.int64), 64, 0
        while at < len(order):
            if exact and ahead[at] < floor:
                break
            rows = order[at : at + step]
            at, step = at + step, min(4 * step, 4096)
            rows = rows[self.rows[rows] != own]
            self.evaluated += len(rows)
            got = (values[rows] @ q).astype(np.int64) if exact else _scores(query, self.vectors[rows])
            if exact and len(scores) == k:
                able = got >= scores[-1]
                rows, got = rows[able], got[able]
            ids, scores = np.concatenate([ids, self.ids[rows]]), np.concatenate([scores, got])
            best = np.lexsort((ids, -scores) if exact else (ids, [-int(x) for x in scores]))[:k]
            ids, scores = ids[best], scores[best]
            if len(scores) == k:
                floor = max(floor, float(scores[-1]))
        return ids, scores


def top_k(vectors: DataFrame, queries: Column, k: int = K, id_column: str = "vec_id", vector_column: str = "embedding", n_pivots: int = PIVOTS, scale: int = 256, query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: for each row where ``queries`` holds its k best other rows."""
    usable = vectors.select(F.col(id_column).cast("bigint").alias("id"), quantised(F.col(vector_column), scale).alias("v"), queries.alias("asks")).where("id IS NOT NULL AND v IS NOT NULL")
    lengths = {r["d"]: (r["n"], r["m"]) for r in usable.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n"), F.count_if("asks").alias("m")).collect()}  # a row for each length of vector
    samples: dict[int, list] = {d: [] for d in lengths}
    for d, n in lengths.items():  # vectors have one length, or few
        share = min(1.0, 4 * SAMPLE / n[0])
        near = usable.where((F.size("v") == d) & (F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < max(1, int(share * (1 << 20)))))
        samples[d] = [(r["id"], r["v"]) for r in near.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("id", "v").collect()]
    seeds = {d: (np.array([i for i, _ in s], np.int64), np.array([v for _, v in s], np.int64).reshape(-1, d)) for d, s in samples.items()}
    pivots = {d: choose_pivots(v.astype(float), n_pivots) for d, (_, v) in seeds.items()}

    def gaps(batches):
        for batch in batches:
            vs = batch.column(batch.schema.get_field_index("v")).to_pylist()
            out = []
            for v in vs:
                p = pivots[len(v)]
                out.append(np.sqrt(((p - np.array(v, float)) ** 2).sum(1)).astype(np.float32).tolist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(pa.float32()))], names=[*batch.schema.names, "gaps"])

    measured = usable.mapInArrow(gaps, "id bigint, v array<bigint>, asks boolean, gaps array<float>")
    rows = written(measured.withColumn("row", F.monotonically_increasing_id()), "pivot-table")
    blocks = lambda size, which: F.coalesce(*(F.when(F.size("v") == d, F.lit(max(1, -(-n[which] // size)))) for d, n in lengths.items()), F.lit(1)) if lengths else F.lit(1)
    n_q, n_c = blocks(query_block, 1), blocks(candidate_block, 0)
    spread = lambda n, salt: F.pmod(F.xxhash64("row", F.lit(salt)), n).cast("int")
    asked = rows.where("asks").select("id", "row", "v", "gaps", F.size("v").alias("d"), spread(n_q, 1).alias("qb"), F.explode(F.sequence(F.lit(0), (n_c - 1).cast("int"))).alias("cb"))
    offered = rows.select("id", "row", "v", "gaps", F.size("v").alias("d"), spread(n_c, 2).alias("cb"), F.explode(F.sequence(F.lit(0), (n_q - 1).cast("int"))).alias("qb"))

    def matrix(column: pa.ChunkedArray, d: int, kind) -> np.ndarray:
        return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(-1, d)

    schema = pa.schema([("query_id", pa.int64()), ("asked", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        d = len(left.column("v")[0])
        p = pivots[d]
        seed_ids, seed = seeds[d]
        q_ids, q_rows, q = left.column("id").to_numpy(), left.column("row").to_numpy(), matrix(left.column("v"), d, np.int64)
        block = Block(right.column("id").to_numpy(), matrix(right.column("v"), d, np.int64), p, matrix(right.column("gaps"), len(p), np.float32), right.column("row").to_numpy())
        floors = np.full(len(q), -np.inf)
        if len(seed) > k and float(np.abs(seed).max()) * float(np.abs(q).max()) * d < _EXACT:
            s = q.astype(float) @ seed.T.astype(float)
            s[q_ids[:, None] == seed_ids[None, :]] = -np.inf
            floors = np.sort(s, 1)[:, -k]  # rows that repeat an id may be left out of this first floor
        found = block.best(q_rows, q, matrix(left.column("gaps"), len(p), np.float32), floors, k)
        n = [len(ids) for _, ids, _ in found]
        return pa.table([np.repeat(q_ids, n), np.repeat(q_rows, n), np.concatenate([x for _, x, _ in found]), np.concatenate([x for _, _, x in found])], schema=schema)

    key = ["d", "qb", "cb"]
    found = asked.groupBy(*key).cogroup(offered.groupBy(*key)).applyInArrow(search, "query_id bigint, asked bigint, vec_id bigint, score bigint")
    order = Window.partitionBy("asked").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best other vectors of every vector whose id is divisible by 50."""
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP2_SQL = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.r AS asked, a.vec_id AS query_id, b.vec_id, list_inner_product(a.q::DOUBLE[], b.q::DOUBLE[])::BIGINT AS score
  FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 50 = 0
)
SELECT query_id, (row_number() OVER w)::INT AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY asked ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5
"""
