"""Queries over aggregates, windows, samples, search, vectors, exports and event windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import stats as S
from ..operators import search
from ..session import table
from ..sources import sinks
from ..streaming import windows
from .registry import query


@query("SELECT lang, count(*) AS n, round(avg(quality), 4) AS quality_share, round(avg(toxic), 4) AS toxic_share, count(*) FILTER (quality IS NULL) AS untested FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY lang")
def rates_by_group(spark: SparkSession, d: str) -> DataFrame:
    both = table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id", "left")
    return both.groupBy("lang").agg(F.count("*").alias("n"), F.round(F.avg("quality"), 4).alias("quality_share"), F.round(F.avg("toxic"), 4).alias("toxic_share"), F.count_if(F.col("quality").isNull()).alias("untested"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, count(*) FILTER (l_quantity > 25) AS large, round(100.0 * count(*) FILTER (l_quantity > 25) / count(*), 2) AS pct, grouping(l_returnflag, l_linestatus)::INT AS level FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)")
def pooled_rates(spark: SparkSession, d: str) -> DataFrame:
    large = F.count_if(F.col("l_quantity") > 25)
    return table(spark, d, "lineitem").rollup("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), large.alias("large"), F.round(100.0 * large / F.count("*"), 2).alias("pct"), F.grouping_id().cast("int").alias("level"))


@query("""WITH r AS (SELECT l_returnflag, l_quantity AS x, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_quantity) - 1 AS i, count(*) OVER (PARTITION BY l_returnflag) AS n FROM lineitem)
SELECT l_returnflag, max(x) FILTER (i = n // 2) AS upper_median, median(x) AS true_median, min(x) FILTER (i = n // 10) AS p10, max(x) FILTER (i = n * 9 // 10) AS p90 FROM r GROUP BY l_returnflag""")
def medians(spark: SparkSession, d: str) -> DataFrame:
    # places are counted from the numbers of equal values, so that no window or list holds a whole group
    n = table(spark, d, "lineitem").groupBy("l_returnflag", F.col("l_quantity").alias("x")).agg(F.count("*").alias("c"))
    w = Window.partitionBy("l_returnflag")
    upto = n.withColumn("upto", F.sum("c").over(w.orderBy("x"))).withColumn("n", F.sum("c").over(w))
    at = lambda place: F.min(F.when(F.col("upto") > place, F.col("x")))
    middle = (at(F.floor((F.col("n") - 1) / 2)) + at(F.floor(F.col("n") / 2))) / 2
    return upto.groupBy("l_returnflag").agg(at(F.floor(F.col("n") / 2)).alias("upper_median"), middle.alias("true_median"), at(F.floor(F.col("n") / 10)).alias("p10"), at(F.floor(F.col("n") * 9 / 10)).alias("p90"))


@query("""WITH r AS (SELECT s_nationkey, s_acctbal AS x, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal) AS i, count(*) OVER (PARTITION BY s_nationkey) AS n FROM supplier),
p AS (SELECT *, 0.25 * (n + 1) AS q FROM r), j AS (SELECT *, least(greatest(floor(q), 1), n - 1) AS j FROM p WHERE n >= 2)
SELECT s_nationkey, round(max(x) FILTER (i = j) + (max(x) FILTER (i = j + 1) - max(x) FILTER (i = j)) * (max(q) - max(j)), 4) AS q1 FROM j GROUP BY s_nationkey""")
def exclusive_quartile(spark: SparkSession, d: str) -> DataFrame:
    out = S.exclusive_quantiles(table(spark, d, "supplier"), ["s_nationkey"], "s_acctbal", 0.25)
    return out.select("s_nationkey", F.round("value", 4).alias("q1"))


@query("""SELECT CASE WHEN o_totalprice < 1000 THEN '0-1000' WHEN o_totalprice < 50000 THEN '1000-50000' WHEN o_totalprice < 200000 THEN '50000-200000' ELSE '200000+' END AS band, count(*) AS n FROM orders GROUP BY 1""")
def bands(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").groupBy(S.band(F.col("o_totalprice"), [0, 1000, 50000, 200000]).alias("band")).agg(F.count("*").alias("n"))


RADII = (5, 10, 25, 50, 100, 200, 500)


@query("SELECT r::INT AS radius, count(*) FILTER (l_extendedprice <= r * 100) AS n, round(count(*) FILTER (l_extendedprice <= r * 100) / count(*), 4) AS part FROM lineitem, (SELECT unnest([5, 10, 25, 50, 100, 200, 500]) AS r) GROUP BY r")
def sweep(spark: SparkSession, d: str) -> DataFrame:
    """Share within each of seven radii, in one pass: one sum for each radius rather than seven rows for each line."""
    sums = [F.count_if(F.col("l_extendedprice") <= r * 100).alias(f"r{r}") for r in RADII]
    got = table(spark, d, "lineitem").agg(F.count("*").alias("all"), *sums)
    each = F.explode(F.array(*(F.struct(F.lit(r).alias("radius"), F.col(f"r{r}").alias("n")) for r in RADII)))
    return got.select("all", each.alias("e")).select("e.radius", "e.n", F.round(F.col("e.n") / F.col("all"), 4).alias("part"))


@query("""WITH s AS (SELECT source, count(*) AS n, count(*) FILTER (quality = 1) AS k FROM documents JOIN labels USING (doc_id) GROUP BY source)
SELECT source, n, k, round((k / n + 3.8416 / (2 * n) - 1.96 * sqrt(k / n * (1 - k / n) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n), 4) AS lo, round((k / n + 3.8416 / (2 * n) + 1.96 * sqrt(k / n * (1 - k / n) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n), 4) AS hi, round(sqrt(k / n * (1 - k / n) / n), 4) AS se FROM s""")
def wilson(spark: SparkSession, d: str) -> DataFrame:
    both = table(spark, d, "documents").select("doc_id", "source").join(table(spark, d, "labels"), "doc_id")
    n = both.groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("quality") == 1).alias("k"))
    w = S.wilson(F.col("k"), F.col("n"))
    return n.select("source", "n", "k", F.round(w["lo"], 4).alias("lo"), F.round(w["hi"], 4).alias("hi"), F.round(S.standard_error(F.col("k"), F.col("n")), 4).alias("se"))


@query("""WITH u AS (SELECT user_id, bool_or(event_type = 'purchase') AS a, bool_or(event_type = 'signup') AS b FROM events GROUP BY user_id)
SELECT count(*) FILTER (a AND b) AS both, count(*) FILTER (b AND NOT a) AS gained, count(*) FILTER (a AND NOT b) AS lost, count(*) FILTER (NOT a AND NOT b) AS neither FROM u""")
def paired_2x2_all(spark: SparkSession, d: str) -> DataFrame:
    """How many users did both, the one or the other, or neither, over all events."""
    u = table(spark, d, "events").groupBy("user_id").agg(F.bool_or(F.col("event_type") == "purchase").alias("a"), F.bool_or(F.col("event_type") == "signup").alias("b"))
    a, b = F.col("a"), F.col("b")
    return u.agg(F.count_if(a & b).alias("both"), F.count_if(b & ~a).alias("gained"), F.count_if(a & ~b).alias("lost"), F.count_if(~a & ~b).alias("neither"))


@query("""WITH p AS (SELECT o_custkey, arg_max(o_orderkey, (o_totalprice, -o_orderkey)) AS a, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS b, max(o_totalprice) AS pa, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS pb FROM orders GROUP BY 1)
SELECT count(*) AS n, count(*) FILTER (a = b) AS same, count(*) FILTER (pa - pb > 100000) AS far, round(median(pa - pb), 2) AS gap FROM p""")
def paired_winners(spark: SparkSession, d: str) -> DataFrame:
    """The same asker under two rules: how often the answer is the same, and how far apart answers are."""
    o = table(spark, d, "orders")
    p = o.groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct(F.col("o_totalprice"), -F.col("o_orderkey"))).alias("a"), F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("b"), F.max("o_totalprice").alias("pa"), F.max_by("o_totalprice", F.struct("o_orderdate", "o_orderkey")).alias("pb"))
    gap = F.col("pa") - F.col("pb")
    return p.withColumn("gap", gap).agg(F.count("*").alias("n"), F.count_if(F.col("a") == F.col("b")).alias("same"), F.count_if(F.col("gap") > 100000).alias("far"), F.round(S.true_median("gap"), 2).alias("gap"))


@query("SELECT lang, round(100.0 * count(quality) / count(*), 2) AS labelled_pct, round(100.0 * count(*) FILTER (source <> 'src0') / count(*), 2) AS other_pct, round(avg(len(string_split(text, chr(10)))), 3) AS mean_lines, round(100.0 * count(*) FILTER (quality = 1 - toxic) / nullif(count(quality), 0), 2) AS agree_pct FROM documents LEFT JOIN labels USING (doc_id) GROUP BY lang")
def coverage_agreement(spark: SparkSession, d: str) -> DataFrame:
    both = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    pct = lambda a, b: F.round(100.0 * F.try_divide(a.cast("double"), b), 2)
    n = F.count("*")
    return both.groupBy("lang").agg(pct(F.count("quality"), n).alias("labelled_pct"), pct(F.count_if(F.col("source") != "src0"), n).alias("other_pct"), F.round(F.avg(F.size(F.split("text", "\n", -1))), 3).alias("mean_lines"), pct(F.count_if(F.col("quality") == 1 - F.col("toxic")), F.count("quality")).alias("agree_pct"))


@query("WITH p AS (SELECT p_partkey, p_name, p_brand, (row_number() OVER (PARTITION BY p_brand ORDER BY p_name, p_partkey) - 1)::INT AS pos FROM part) SELECT p_partkey, p_brand, pos, (pos // 15)::INT AS chunk FROM p")
def chunking(spark: SparkSession, d: str) -> DataFrame:
    return search.chunked(table(spark, d, "part"), ["p_name", "p_partkey"], 15, ["p_brand"]).select("p_partkey", "p_brand", "pos", "chunk")


@query("""WITH p AS (SELECT p_brand, p_size, p_name, (row_number() OVER (PARTITION BY p_brand ORDER BY p_name, p_partkey) - 1) // 15 AS chunk FROM part)
SELECT p_brand, p_size, min(chunk)::INT AS first_chunk FROM p GROUP BY ALL""")
def first_chunk(spark: SparkSession, d: str) -> DataFrame:
    return search.chunked(table(spark, d, "part"), ["p_name", "p_partkey"], 15, ["p_brand"]).groupBy("p_brand", "p_size").agg(F.min("chunk").alias("first_chunk"))


@query("""WITH p AS (SELECT p_brand, upper(left(p_type, 1)) AS letter, (row_number() OVER (PARTITION BY p_brand ORDER BY p_name, p_partkey) - 1) AS pos FROM part), c AS (SELECT p_brand, pos // 15 AS chunk, letter, count(*) AS n, min(pos) AS seen FROM p GROUP BY ALL)
SELECT p_brand, chunk::INT AS chunk, arg_max(letter, (n, -seen)) AS letter FROM c GROUP BY ALL""")
def dominant_letter(spark: SparkSession, d: str) -> DataFrame:
    p = search.chunked(table(spark, d, "part"), ["p_name", "p_partkey"], 15, ["p_brand"])
    c = p.groupBy("p_brand", "chunk", F.upper(F.left("p_type", F.lit(1))).alias("letter")).agg(F.count("*").alias("n"), F.min("pos").alias("seen"))
    return c.groupBy("p_brand", "chunk").agg(F.max_by("letter", F.struct(F.col("n"), -F.col("seen"))).alias("letter"))


@query("""WITH y AS (SELECT o_custkey, year(o_orderdate)::INT AS y, count(*) AS n FROM orders GROUP BY ALL)
SELECT o_custkey, max(y) AS latest_year, arg_max(n, y) AS latest_count, string_agg(n || ' (' || y || ')', ', ' ORDER BY y) AS shown FROM y GROUP BY o_custkey""")
def latest_population(spark: SparkSession, d: str) -> DataFrame:
    y = table(spark, d, "orders").groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(F.count("*").alias("count"))
    series = y.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("year", "count"))).alias("s"))
    shown = F.array_join(F.transform("s", lambda x: F.concat(F.format_number(x["count"], 0), F.lit(" ("), x["year"].cast("string"), F.lit(")"))), ", ")
    top = F.array_max("s")
    return series.select("o_custkey", top["year"].alias("latest_year"), top["count"].alias("latest_count"), shown.alias("shown"))


@query("WITH n AS (SELECT p_brand, p_type < lag(p_type) OVER (PARTITION BY p_brand ORDER BY p_partkey) AS inv FROM part) SELECT p_brand, count(inv) AS pairs, count(*) FILTER (inv) AS inversions, round(count(*) FILTER (inv) / nullif(count(inv), 0), 4) AS rate FROM n GROUP BY p_brand")
def inversion_rate(spark: SparkSession, d: str) -> DataFrame:
    inv = F.col("p_type") < F.lag("p_type").over(Window.partitionBy("p_brand").orderBy("p_partkey"))
    return table(spark, d, "part").select("p_brand", inv.alias("inv")).groupBy("p_brand").agg(F.count("inv").alias("pairs"), F.count_if("inv").alias("inversions"), S.share(F.count_if("inv"), F.count("inv")).alias("rate"))


@query("""WITH a AS (SELECT s_nationkey, s_suppkey, s_acctbal, row_number() OVER (PARTITION BY s_nationkey ORDER BY md5('a:' || s_suppkey)) AS i, row_number() OVER (PARTITION BY s_nationkey ORDER BY md5('b:' || s_suppkey)) AS j FROM supplier)
SELECT x.s_nationkey, count(*) AS n, count(*) FILTER (abs(x.s_acctbal - y.s_acctbal) < 1000) AS near FROM a x JOIN a y ON x.s_nationkey = y.s_nationkey AND x.i = y.j GROUP BY 1""")
def permutation_null(spark: SparkSession, d: str) -> DataFrame:
    """Each row given a random other row of its nation, as the control of a join."""
    s = table(spark, d, "supplier").select("s_nationkey", "s_suppkey", "s_acctbal")
    shuffled = lambda seed: F.row_number().over(Window.partitionBy("s_nationkey").orderBy(F.md5(F.concat(F.lit(seed), F.col("s_suppkey").cast("string")).cast("binary"))))
    x, y = s.withColumn("i", shuffled("a:")), s.withColumn("i", shuffled("b:")).withColumnRenamed("s_acctbal", "other")
    return x.join(y.select("s_nationkey", "i", "other"), ["s_nationkey", "i"]).groupBy("s_nationkey").agg(F.count("*").alias("n"), F.count_if(F.abs(F.col("s_acctbal") - F.col("other")) < 1000).alias("near"))


@query("SELECT o_orderpriority, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY md5('7:' || o_orderkey)) <= 20")
def strata_sample(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("o_orderpriority").orderBy(F.md5(F.concat(F.lit("7:"), F.col("o_orderkey").cast("string")).cast("binary")))
    return table(spark, d, "orders").select("o_orderpriority", "o_orderkey", F.row_number().over(w).alias("r")).where("r <= 20").drop("r")


@query("""WITH r AS (SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS i, count(*) OVER (PARTITION BY p_brand) AS n FROM part)
SELECT p_brand, p_partkey FROM r WHERE n <= 10 OR (i * 10 + 9) // n <> ((i - 1) * 10 + 9) // n OR i = 0""")
def even_sample(spark: SparkSession, d: str) -> DataFrame:
    """Ten evenly spaced rows of each brand: row i is taken where a multiple of n/10 falls in (i - 1, i]."""
    w = Window.partitionBy("p_brand")
    r = table(spark, d, "part").select("p_partkey", "p_brand", (F.row_number().over(w.orderBy("p_partkey")) - 1).alias("i"), F.count("*").over(w).alias("n"))
    step = lambda i: F.floor((i * 10 + 9) / F.col("n"))
    return r.where((F.col("n") <= 10) | (F.col("i") == 0) | (step(F.col("i")) != step(F.col("i") - 1))).select("p_brand", "p_partkey")


@query("""WITH r AS (SELECT c_custkey, c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS rn, count(*) OVER (PARTITION BY c_nationkey) AS size FROM customer)
SELECT c_custkey, c_nationkey, (row_number() OVER (ORDER BY rn, size DESC, c_nationkey))::INT AS pick FROM r ORDER BY pick LIMIT 40""")
def round_robin(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("c_nationkey")
    r = table(spark, d, "customer").select("c_custkey", "c_nationkey", F.row_number().over(w.orderBy("c_custkey")).alias("rn"), F.count("*").over(w).alias("size")).where("rn <= 40")
    best = r.orderBy("rn", F.desc("size"), "c_nationkey").limit(40)
    return best.select("c_custkey", "c_nationkey", F.row_number().over(Window.orderBy("rn", F.desc("size"), "c_nationkey")).alias("pick"))


@query("""WITH c AS (SELECT c_nationkey, c_mktsegment, CASE WHEN c_nationkey % 5 = 0 THEN 'A' WHEN c_nationkey % 5 = 1 THEN 'B' WHEN c_nationkey % 5 = 2 THEN 'C' ELSE 'D' END AS tier, c_acctbal FROM customer)
SELECT c_mktsegment, tier, count(*) AS n, count(*) FILTER (tier <> 'A') AS exposed, count(DISTINCT c_nationkey) AS namespaces FROM c GROUP BY ALL""")
def licence_audit(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_nationkey") % 5
    tier = F.when(k == 0, "A").when(k == 1, "B").when(k == 2, "C").otherwise("D")
    c = table(spark, d, "customer").select("c_nationkey", "c_mktsegment", tier.alias("tier"))
    return c.groupBy("c_mktsegment", "tier").agg(F.count("*").alias("n"), F.count_if(F.col("tier") != "A").alias("exposed"), F.countDistinct("c_nationkey").alias("namespaces"))


@query("SELECT CASE WHEN n_chars <= 800 THEN 'short' ELSE 'long' END AS bucket, count(*) AS n, sum(n_chars)::BIGINT AS chars, round(sum(n_chars) * 0.25 * 3 / 1e6, 4) AS cost FROM documents GROUP BY 1")
def cost_projection(spark: SparkSession, d: str) -> DataFrame:
    bucket = F.when(F.col("n_chars") <= 800, "short").otherwise("long").alias("bucket")
    return table(spark, d, "documents").groupBy(bucket).agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"), F.round(F.sum("n_chars") * 0.25 * 3 / 1e6, 4).alias("cost"))


QUERY_WORDS = ("the", "und", "que")
TOKENS_SQL = "list_filter(string_split_regex(lower(strip_accents(text)), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')"


@query(f"""WITH t AS (SELECT doc_id, {TOKENS_SQL} AS w FROM documents), s AS (SELECT count(*) AS n, avg(len(w)) AS mean FROM t), p AS (SELECT doc_id, len(w) AS length, unnest(w) AS token FROM t),
tf AS (SELECT doc_id, length, token, count(*) AS tf FROM p WHERE token IN ('the', 'und', 'que') GROUP BY ALL), df AS (SELECT token, count(*) AS df FROM tf GROUP BY token)
SELECT doc_id, round(sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean))), 4) AS score FROM tf JOIN df USING (token), s GROUP BY doc_id""")
def fts_bm25(spark: SparkSession, d: str) -> DataFrame:
    return search.bm25_scan(table(spark, d, "documents"), "doc_id", "text", list(QUERY_WORDS)).select("doc_id", F.round("score", 4).alias("score"))


@query("""WITH g AS (SELECT p_partkey, p_name, p_brand, list_distinct(list_transform(range(1, greatest(length(f) - 2, 1) + 1), lambda i: substr(f, i, 3))) AS t FROM (SELECT *, ' ' || regexp_replace(lower(strip_accents(p_name)), '[^a-z0-9 ]', '', 'g') || ' ' AS f FROM part)),
q AS (SELECT DISTINCT p_name AS query, t AS qt FROM g WHERE p_partkey % 100 = 0)
SELECT query, p_partkey, p_name, round(len(list_intersect(qt, t)) / (len(qt) + len(t) - len(list_intersect(qt, t))), 4) AS overlap FROM q, g WHERE len(list_intersect(qt, t)) / (len(qt) + len(t) - len(list_intersect(qt, t))) >= 0.6""")
def trigram_fuzzy(spark: SparkSession, d: str) -> DataFrame:
    """Names like each of the names whose key is divisible by 100."""
    p = table(spark, d, "part").select("p_partkey", "p_name")
    q = p.where("p_partkey % 100 = 0").select(F.col("p_name").alias("query")).distinct()
    return search.trigram_matches(q, p, "p_partkey", "p_name", "query", 0.6).select("query", "p_partkey", "p_name", F.round("overlap", 4).alias("overlap"))


@query("""WITH q AS (SELECT vec_id, list_transform(embedding, lambda x: greatest(-127, least(127, round_even(x::DOUBLE * 127, 0)))::INT) AS v FROM embeddings)
SELECT vec_id, list_sum(v)::BIGINT AS total, list_min(v) AS lo, list_max(v) AS hi FROM q""")
def quantise_int8(spark: SparkSession, d: str) -> DataFrame:
    v = table(spark, d, "embeddings").select("vec_id", search.quantise(F.col("embedding")).alias("v"))
    return v.select("vec_id", F.aggregate("v", F.lit(0).cast("bigint"), lambda s, x: s + x).alias("total"), F.array_min("v").alias("lo"), F.array_max("v").alias("hi"))


@query("""WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS q, list_transform(embedding, lambda x: greatest(-127, least(127, round_even(x::DOUBLE * 127, 0)))::DOUBLE) AS v FROM embeddings)
SELECT q.vec_id AS query_id, e.vec_id, (row_number() OVER w)::INT AS rank FROM e AS q JOIN e ON e.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0 WINDOW w AS (PARTITION BY q.vec_id ORDER BY list_inner_product(q.q, e.v) DESC, e.vec_id) QUALIFY row_number() OVER w <= 5""")
def knn_dot_all(spark: SparkSession, d: str) -> DataFrame:
    """The five nearest, by the product of the query's own components with the stored bytes, of every vector whose id is divisible by 100."""
    e = table(spark, d, "embeddings")
    stored = e.select("vec_id", search.quantise(F.col("embedding")).cast("array<double>").alias("v"))
    asked = e.where("vec_id % 100 = 0").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    return search.nearest_by_dot(asked, stored, "vec_id", "v", 5).select("query_id", "vec_id", "rank")


@query("""WITH i AS (SELECT s_suppkey, concat('"', s_suppkey, '":{"s_name":"', s_name, '","s_nationkey":', s_nationkey, '}') AS item FROM supplier)
SELECT (s_suppkey % 16)::INT AS shard, count(*)::INT AS n, '{' || string_agg(item, ',' ORDER BY s_suppkey::VARCHAR) || '}' AS json FROM i GROUP BY 1""")
def export_shards(spark: SparkSession, d: str) -> DataFrame:
    return sinks.shards(table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey"), "s_suppkey", 16)


@query("""SELECT concat('{"type":"Feature","geometry":{"type":"Point","coordinates":[', ((s_suppkey * 53) % 361 - 180)::DOUBLE, ',', ((s_suppkey * 37) % 181 - 90)::DOUBLE, ']},"properties":{"id":', s_suppkey, ',"name":"', s_name, '"}}') AS feature FROM supplier""")
def geojson_lines(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("s_suppkey")
    lon, lat = (F.pmod(k * 53, F.lit(361)) - 180).cast("double"), (F.pmod(k * 37, F.lit(181)) - 90).cast("double")
    return table(spark, d, "supplier").select(sinks.point_feature(lon, lat, id=k, text_name=F.col("s_name")).alias("feature"))


@query("""WITH t AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER w + INTERVAL 6 HOUR OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS k FROM t)
SELECT user_id, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us, count(*) AS n FROM s GROUP BY user_id, k""")
def sessionise(spark: SparkSession, d: str) -> DataFrame:
    s = windows.sessions(table(spark, d, "events"), "ts", "6 hours", ["user_id"])
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    return s.select("user_id", us("first_ts").alias("first_us"), us("last_ts").alias("last_us"), "n")


@query("SELECT epoch_us(time_bucket(INTERVAL 1 DAY, ts)) AS start_us, event_type, count(*) AS n FROM events GROUP BY ALL")
def tumbling_counts(spark: SparkSession, d: str) -> DataFrame:
    w = windows.tumbling_counts(table(spark, d, "events"), "ts", "1 day", ["event_type"])
    return w.select(F.unix_micros(F.col("window_start").cast("timestamp")).alias("start_us"), "event_type", "n")


@query("SELECT p_brand, count(*) AS n FROM part GROUP BY p_brand ORDER BY n DESC, p_brand LIMIT 8")
def top_values(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").groupBy("p_brand").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "p_brand").limit(8)


@query("SELECT doc_id, CASE WHEN length(text) > 6000 THEN 6000 + length(chr(10) || '[... truncated ...]') ELSE length(text) END AS kept, CASE WHEN length(text) > 3200 THEN 'large' ELSE 'small' END AS model FROM documents")
def route_by_length(spark: SparkSession, d: str) -> DataFrame:
    from ..functions.text import truncate_marked

    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", F.length(truncate_marked(t)).cast("bigint").alias("kept"), F.when(F.length(t) > 3200, "large").otherwise("small").alias("model"))


@query("SELECT c_nationkey, round(sqrt(count(*) / max(count(*)) OVER ()), 6) AS size FROM customer GROUP BY c_nationkey")
def normalised_size(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    top = n.agg(F.max("n").alias("top"))
    return n.crossJoin(F.broadcast(top)).select("c_nationkey", F.round(F.sqrt(F.col("n") / F.col("top")), 6).alias("size"))  # one row is broadcast


@query("""WITH m AS (SELECT c_custkey % 100 AS request, list(c_custkey ORDER BY c_acctbal DESC, c_custkey)[1:5] AS a, list(c_custkey ORDER BY c_acctbal DESC, c_custkey DESC)[1:5] AS b FROM customer GROUP BY 1)
SELECT count(*) AS n, count(*) FILTER (a = b) AS same_order, count(*) FILTER (list_sort(a) = list_sort(b)) AS same_set FROM m""")
def answer_agreement(spark: SparkSession, d: str) -> DataFrame:
    """Two orders of ties: how many requests get the same list, and the same set."""
    c = table(spark, d, "customer").select((F.col("c_custkey") % 100).alias("request"), "c_custkey", "c_acctbal")
    best = lambda tie: F.row_number().over(Window.partitionBy("request").orderBy(F.desc("c_acctbal"), tie))
    ranked = c.select("request", "c_custkey", best(F.col("c_custkey")).alias("i"), best(F.desc("c_custkey")).alias("j")).where("i <= 5 OR j <= 5")
    firsts = lambda r: F.transform(F.array_sort(F.collect_list(F.when(F.col(r) <= 5, F.struct(r, "c_custkey")))), lambda x: x["c_custkey"])
    m = ranked.groupBy("request").agg(firsts("i").alias("a"), firsts("j").alias("b"))
    return m.agg(F.count("*").alias("n"), F.count_if(F.col("a") == F.col("b")).alias("same_order"), F.count_if(F.array_sort("a") == F.array_sort("b")).alias("same_set"))
