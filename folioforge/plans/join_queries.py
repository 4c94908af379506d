"""Queries over joins, sets, the cascade and hierarchies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.geo import box_around, haversine_km
from ..functions.text import tokens
from ..operators import cascade as C
from ..operators import joins, layout, similar
from ..session import stored, table
from ..sources import sinks
from .registry import query

POINTS_SQL = """WITH s AS (SELECT s_suppkey, s_nationkey, ((s_suppkey * 37) % 181 - 90)::DOUBLE AS lat, ((s_suppkey * 53) % 361 - 180)::DOUBLE AS lon FROM supplier),
c AS (SELECT c_custkey, c_nationkey, ((c_custkey * 37) % 181 - 90)::DOUBLE AS lat, ((c_custkey * 53) % 361 - 180)::DOUBLE AS lon FROM customer),
d AS (SELECT c_custkey, s_suppkey, s_nationkey, c_nationkey, 2 * 6371.0 * asin(sqrt(least(1.0, pow(sin((radians(s.lat) - radians(c.lat)) / 2), 2) + cos(radians(c.lat)) * cos(radians(s.lat)) * pow(sin((radians(s.lon) - radians(c.lon)) / 2), 2)))) AS km FROM c, s)"""


def points(spark: SparkSession, d: str, name: str, key: str, *more: str) -> DataFrame:
    """Suppliers or customers with places computed from their keys."""
    k = F.col(key)
    return table(spark, d, name).select(key, *more, (F.pmod(k * 37, F.lit(181)) - 90).cast("double").alias("lat"), (F.pmod(k * 53, F.lit(361)) - 180).cast("double").alias("lon"))


@query("SELECT d.doc_id, d.lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def pending_anti(spark: SparkSession, d: str) -> DataFrame:
    return joins.misses(table(spark, d, "documents").select("doc_id", "lang"), table(spark, d, "labels"), ["doc_id"])


@query("SELECT l.doc_id, l.quality FROM labels l WHERE l.doc_id IN (SELECT doc_id FROM documents WHERE lang = 'en')")
def valid_semi(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "labels").join(table(spark, d, "documents").where("lang = 'en'"), "doc_id", "left_semi").select("doc_id", "quality")


@query("SELECT o_orderkey FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')")
def cache_miss(spark: SparkSession, d: str) -> DataFrame:
    done = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.misses(table(spark, d, "orders").select("o_orderkey"), done, ["o_orderkey"])


@query("SELECT c_mktsegment, o_orderstatus, count(*) AS n, round(sum(l_quantity), 2) AS quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey GROUP BY ALL")
def join3_inner(spark: SparkSession, d: str) -> DataFrame:
    l, o, c = (table(spark, d, n) for n in ("lineitem", "orders", "customer"))
    return l.join(o, F.col("l_orderkey") == F.col("o_orderkey")).join(c, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment", "o_orderstatus").agg(F.count("*").alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"))


@query("SELECT c_custkey, count(o_orderkey) AS n_orders, max(o_orderkey) AS last_order FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey")
def join2_left(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").join(table(spark, d, "orders"), F.col("o_custkey") == F.col("c_custkey"), "left").groupBy("c_custkey").agg(F.count("o_orderkey").alias("n_orders"), F.max("o_orderkey").alias("last_order"))


TIERS = ((0, "A"), (1, "B"), (3, "C"))
TIERS_SQL = "(VALUES (0, 'A'), (1, 'B'), (3, 'C')) t(k, tier)"


@query(f"SELECT n_nationkey, coalesce(tier, 'D') AS tier FROM nation LEFT JOIN {TIERS_SQL} ON k = n_regionkey")
def lookup_default(spark: SparkSession, d: str) -> DataFrame:
    tiers = spark.createDataFrame(TIERS, "k int, tier string")  # three rows
    return table(spark, d, "nation").join(F.broadcast(tiers), F.col("n_regionkey") == F.col("k"), "left").select("n_nationkey", F.coalesce("tier", F.lit("D")).alias("tier"))


ASOF_SQL = """WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'), e AS (SELECT user_id, ts, max(event_id) AS error_id FROM events WHERE event_type = 'error' GROUP BY ALL)
SELECT p.event_id, p.user_id, e.error_id AS prev_error_id FROM p ASOF LEFT JOIN e ON p.user_id = e.user_id AND p.ts >= e.ts"""


@query(ASOF_SQL)
def asof_prev(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    buys = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    errors = events.where("event_type = 'error'").select("user_id", "ts", F.col("event_id").alias("error_id"))
    return joins.asof_backward(buys, errors, ["user_id"], "ts", ["error_id"]).select("event_id", "user_id", "prev_error_id")


@query(ASOF_SQL)
def asof_prev_split(spark: SparkSession, d: str) -> DataFrame:
    """asof_prev with every user's events dealt out by day, for users with a large share of all events."""
    events = table(spark, d, "events")
    buys = events.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    errors = events.where("event_type = 'error'").select("user_id", "ts", F.col("event_id").alias("error_id"))
    return joins.asof_backward_split(buys, errors, ["user_id"], "ts", ["error_id"], F.to_date("ts")).select("event_id", "user_id", "prev_error_id")


@query("""WITH v AS (SELECT user_id, ts, max(event_id) AS click FROM events WHERE event_type = 'click' GROUP BY ALL), f AS (SELECT user_id, arg_min(click, ts) AS first_click FROM v GROUP BY 1),
a AS (SELECT s.event_id, s.user_id, s.ts, v.click FROM events s ASOF LEFT JOIN v ON s.user_id = v.user_id AND s.ts >= v.ts WHERE s.event_type = 'signup')
SELECT a.event_id, a.user_id, coalesce(a.click, f.first_click) AS owner, row_number() OVER (PARTITION BY a.user_id, coalesce(a.click, f.first_click) ORDER BY a.ts, a.event_id)::INT AS ord FROM a LEFT JOIN f ON f.user_id = a.user_id""")
def asof_splice(spark: SparkSession, d: str) -> DataFrame:
    """Rows put after the last owner at or before them (or the first owner), numbered within it."""
    events = table(spark, d, "events")
    plates = events.where("event_type = 'signup'").select("event_id", "user_id", "ts")
    owners = events.where("event_type = 'click'").select("user_id", "ts", F.col("event_id").alias("click"))
    got = joins.asof_backward(plates, owners, ["user_id"], "ts", ["click"], or_first=True)
    return got.select("event_id", "user_id", F.col("prev_click").alias("owner"), F.row_number().over(Window.partitionBy("user_id", "prev_click").orderBy("ts", "event_id")).alias("ord"))


@query("SELECT event_id, user_id, last_value(CASE WHEN event_type = 'view' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev_view FROM events")
def carry_forward(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    return table(spark, d, "events").select("event_id", "user_id", F.last(F.when(F.col("event_type") == "view", F.col("event_id")), ignorenulls=True).over(w).alias("prev_view"))


@query(POINTS_SQL + " SELECT c_custkey, s_suppkey, round(km, 3) AS km FROM d WHERE km <= 600.5")
def grid_range_join(spark: SparkSession, d: str) -> DataFrame:
    pairs = joins.within_distance(points(spark, d, "customer", "c_custkey"), points(spark, d, "supplier", "s_suppkey"), 600.5, digits=3)
    return pairs.select("c_custkey", "s_suppkey", "km")


@query(POINTS_SQL + " SELECT c_custkey, s_suppkey, round(km, 3) AS km FROM d WHERE c_nationkey = s_nationkey QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY round(km, 6), s_suppkey) = 1")
def nearest_match(spark: SparkSession, d: str) -> DataFrame:
    c = points(spark, d, "customer", "c_custkey", "c_nationkey").withColumnRenamed("c_nationkey", "nation")
    s = points(spark, d, "supplier", "s_suppkey", "s_nationkey").withColumnRenamed("s_nationkey", "nation")
    best = joins.nearest_within_key(c, s, ["nation"], "c_custkey", "s_suppkey")
    return best.select("c_custkey", "s_suppkey", F.round("km", 3).alias("km"))


@query(POINTS_SQL + " SELECT c_custkey, s_suppkey, (row_number() OVER w)::INT AS rank FROM d WHERE km <= 2000.5 QUALIFY row_number() OVER w <= 3 WINDOW w AS (PARTITION BY c_custkey ORDER BY round(km, 6), s_suppkey)".replace("QUALIFY row_number() OVER w <= 3 WINDOW w AS (PARTITION BY c_custkey ORDER BY round(km, 6), s_suppkey)", "WINDOW w AS (PARTITION BY c_custkey ORDER BY round(km, 6), s_suppkey) QUALIFY row_number() OVER w <= 3"))
def k_nearest(spark: SparkSession, d: str) -> DataFrame:
    near = joins.nearest_points(points(spark, d, "customer", "c_custkey"), points(spark, d, "supplier", "s_suppkey"), [], "s_suppkey", 3, 2000.5)
    return near.select("c_custkey", "s_suppkey", F.col("nth").alias("rank"))


@query("""WITH c AS (SELECT c_custkey, c_nationkey, ((c_custkey * 53) % 361 - 180)::DOUBLE AS x, ((c_custkey * 37) % 181 - 90)::DOUBLE AS y FROM customer)
SELECT c_custkey, c_nationkey, x BETWEEN -150.5 + c_nationkey * 3 AND 60.5 + c_nationkey * 3 AND y BETWEEN -60.5 AND 40.5 + c_nationkey AS inside FROM c""")
def point_in_polygon(spark: SparkSession, d: str) -> DataFrame:
    pts = points(spark, d, "customer", "c_custkey", "c_nationkey").select(F.col("c_custkey").alias("point_id"), F.col("c_nationkey").alias("area_id"), F.col("lon").alias("x"), F.col("lat").alias("y"))
    k = F.col("n_nationkey")
    w, e, s, n = (c.cast("double") for c in (-150.5 + k * 3, 60.5 + k * 3, F.lit(-60.5), 40.5 + k))
    sides = F.array(*(F.struct(a.alias("x1"), b.alias("y1"), c.alias("x2"), dd.alias("y2")) for a, b, c, dd in ((w, s, e, s), (e, s, e, n), (e, n, w, n), (w, n, w, s))))
    edges = table(spark, d, "nation").select(k.alias("area_id"), F.explode(sides).alias("e")).select("area_id", "e.*")
    return joins.point_in_rings(pts, edges).select(F.col("point_id").alias("c_custkey"), F.col("area_id").alias("c_nationkey"), "inside")


@query("SELECT c_custkey, c_mktsegment, c_nationkey, count(*) OVER (PARTITION BY c_mktsegment, c_nationkey) AS answer FROM customer")
def dedup_enrich(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    answers = c.groupBy("c_mktsegment", "c_nationkey").agg(F.count("*").alias("answer"))
    return joins.dedup_enrich(c, ["c_mktsegment", "c_nationkey"], lambda r: r.join(answers, ["c_mktsegment", "c_nationkey"])).select("c_custkey", "c_mktsegment", "c_nationkey", "answer")


@query("""WITH s AS (SELECT s_suppkey, s_nationkey, n_regionkey, s_suppkey % 7 AS seg, (50 + (s_suppkey * 13) % 51)::DOUBLE AS score FROM supplier JOIN nation ON s_nationkey = n_nationkey),
c AS (SELECT c_custkey, c_nationkey, n_regionkey, c_custkey % 7 AS seg, c_custkey % 5 = 0 AS has_coords FROM customer JOIN nation ON c_nationkey = n_nationkey),
a AS (SELECT c.*, s.s_suppkey, CASE WHEN s_nationkey = c_nationkey AND s.seg = c.seg THEN 1 WHEN s.n_regionkey = c.n_regionkey AND s.seg = c.seg THEN 2 ELSE 3 END AS p, score FROM c JOIN s ON s.n_regionkey = c.n_regionkey WHERE score >= 80),
w AS (SELECT c_custkey, s_suppkey, p FROM a QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY p, score DESC, s_suppkey) = 1)
SELECT c.c_custkey, w.s_suppkey, CASE p WHEN 1 THEN '1-nation' WHEN 2 THEN '2-region' WHEN 3 THEN '3-any' END AS pass, CASE WHEN p IS NOT NULL THEN 'reconciled' WHEN has_coords THEN 'coord_only' ELSE 'unmatched' END AS status FROM c LEFT JOIN w ON w.c_custkey = c.c_custkey""")
def cascade_first_hit(spark: SparkSession, d: str) -> DataFrame:
    """Customers matched to suppliers: same nation and segment, then same region and segment, then any in the region."""
    nation = table(spark, d, "nation").select("n_nationkey", "n_regionkey")
    c = table(spark, d, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_nationkey", "n_regionkey", (F.col("c_custkey") % 7).alias("seg"), (F.col("c_custkey") % 5 == 0).alias("has_coords"))
    s = table(spark, d, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    s = s.select("s_suppkey", "s_nationkey", F.col("n_regionkey").alias("s_region"), (F.col("s_suppkey") % 7).alias("s_seg"), (50 + (F.col("s_suppkey") * 13) % 51).cast("double").alias("score"))

    def answer(*on):
        # of each request (not asker) the best candidate is found once; then it goes to all who asked
        def run(asks: DataFrame) -> DataFrame:
            pairs = {"c_nationkey": "s_nationkey", "n_regionkey": "s_region", "seg": "s_seg"}
            hits = s.select(*(F.col(pairs[k]).alias(k) for k in on), "s_suppkey", "score", F.col("s_suppkey").alias("rank"), F.lit(None).cast("double").alias("confidence"), F.lit(False).alias("has_geom"))
            best = C.winners(hits, list(on))
            return asks.join(best, list(on)).select("c_custkey", "s_suppkey")

        return run

    passes = [("1-nation", answer("c_nationkey", "seg")), ("2-region", answer("n_regionkey", "seg")), ("3-any", answer("n_regionkey"))]
    return C.status_of(c, C.cascade(c, "c_custkey", passes, keep=stored), "c_custkey", F.col("has_coords")).select("c_custkey", "s_suppkey", "pass", "status")


HITS_SQL = """WITH h AS (SELECT l_orderkey AS ask, l_linenumber::BIGINT * 1000000000 + l_partkey AS rank, l_partkey, (60 + (l_partkey * 7 + l_suppkey) % 41)::DOUBLE AS score, CASE WHEN l_suppkey % 11 = 0 THEN NULL ELSE ((l_partkey * 3) % 100)::DOUBLE END AS confidence, l_suppkey % 3 = 0 AS has_geom, ((l_partkey * 5) % 90)::DOUBLE AS km FROM lineitem)"""


def _hits(spark: SparkSession, d: str) -> DataFrame:
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    return table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("ask"), (F.col("l_linenumber").cast("bigint") * 1000000000 + p).alias("rank"), "l_partkey", (60 + (p * 7 + s) % 41).cast("double").alias("score"),
        F.when(s % 11 == 0, None).otherwise((p * 3) % 100).cast("double").alias("confidence"), (s % 3 == 0).alias("has_geom"), ((p * 5) % 90).cast("double").alias("km"),
    )


@query(HITS_SQL + """, g AS (SELECT * FROM h WHERE coalesce(confidence >= 30, true)),
t AS (SELECT *, row_number() OVER (PARTITION BY ask ORDER BY score DESC, rank) AS r FROM g), top AS (SELECT * FROM t WHERE r = 1 AND score >= 80),
a AS (SELECT *, row_number() OVER (PARTITION BY ask ORDER BY score DESC, rank) AS r FROM g WHERE has_geom), area AS (SELECT * FROM a WHERE r = 1)
SELECT top.ask, CASE WHEN NOT top.has_geom AND area.score >= top.score - 1 THEN area.l_partkey ELSE top.l_partkey END AS l_partkey, CASE WHEN NOT top.has_geom AND area.score >= top.score - 1 THEN area.score ELSE top.score END AS score FROM top LEFT JOIN area ON area.ask = top.ask""")
def winner_tiebreak(spark: SparkSession, d: str) -> DataFrame:
    return C.winners(_hits(spark, d), ["ask"]).select("ask", "l_partkey", "score")


@query(HITS_SQL + " SELECT ask, l_partkey, km FROM h WHERE coalesce(confidence >= 30, true) AND score >= 70 AND km <= 50 QUALIFY row_number() OVER (PARTITION BY ask ORDER BY km, rank) = 1")
def coord_pass(spark: SparkSession, d: str) -> DataFrame:
    return C.by_coordinate(_hits(spark, d), ["ask"]).select("ask", "l_partkey", "km")


@query("""WITH c AS (SELECT c_custkey, n_nationkey, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT c_custkey, 0 AS level, 'R' || n_regionkey AS name, NULL::VARCHAR AS container, 'R' || n_regionkey AS place FROM c
UNION ALL SELECT c_custkey, 1, 'N' || n_nationkey, 'R' || n_regionkey, CASE WHEN n_nationkey % 4 <> 0 THEN 'R' || n_regionkey || '/N' || n_nationkey END FROM c
UNION ALL SELECT c_custkey, 2, 'S' || c_custkey % 5, CASE WHEN n_nationkey % 4 <> 0 THEN 'R' || n_regionkey || '/N' || n_nationkey ELSE 'R' || n_regionkey END, CASE WHEN n_nationkey % 4 <> 0 THEN 'R' || n_regionkey || '/N' || n_nationkey ELSE 'R' || n_regionkey END || '/S' || c_custkey % 5 FROM c""")
def hierarchy_chain(spark: SparkSession, d: str) -> DataFrame:
    """Region, nation, segment of every customer resolved one within the other; nations divisible by four do not resolve and are skipped."""
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    chain = F.array(F.concat(F.lit("R"), F.col("n_regionkey").cast("string")), F.concat(F.lit("N"), F.col("n_nationkey").cast("string")), F.concat(F.lit("S"), (F.col("c_custkey") % 5).cast("string")))
    chains = c.select("c_custkey", F.posexplode(chain).alias("level", "name"))

    def resolve(asks: DataFrame) -> DataFrame:
        number = F.regexp_extract("name", r"\d+", 0).cast("int")
        good = ~F.startswith("name", F.lit("N")) | (number % 4 != 0)
        return asks.where(good).withColumn("place", F.concat_ws("/", "container", "name"))

    return C.resolve_chain(chains, "c_custkey", resolve, 3)


EDGES = tuple((k, k // 3) for k in range(1, 40)) + ((100, 101), (101, 100))
EDGES_SQL = "(VALUES " + ", ".join(f"({a}, {b})" for a, b in EDGES) + ") e(child, parent)"


@query(f"""WITH RECURSIVE e AS (SELECT * FROM {EDGES_SQL}), r AS (
  SELECT child, 1 AS depth, parent AS ancestor, [child, parent] AS path FROM e
  UNION ALL SELECT r.child, depth + 1, e.parent, list_append(path, e.parent) FROM r JOIN e ON e.child = r.ancestor WHERE depth < 6 AND NOT list_contains(path, e.parent))
SELECT child, depth, ancestor, array_to_string(path, '>') AS path FROM r""")
def concept_path(spark: SparkSession, d: str) -> DataFrame:
    edges = spark.createDataFrame(EDGES, "child int, parent int")
    return joins.ancestors(edges).select("child", "depth", "ancestor", F.array_join(F.col("path").cast("array<string>"), ">").alias("path"))


@query()
def similarity_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Part names paired one to one with slightly changed copies."""
    p, key = table(spark, d, "part"), F.col("p_partkey").cast("string")
    a = p.select(F.concat("p_name", F.lit(" "), key).alias("name"))
    b = p.select(F.concat("p_name", F.lit(" "), F.when(F.col("p_partkey") % 8 == 0, F.lit("")).otherwise(F.lit("x")), key).alias("name"))
    return similar.pair_within_blocks(a.distinct(), b.distinct(), "name")


@query("""WITH r AS (SELECT p_name, min(p_partkey) AS rep FROM part GROUP BY p_name)
SELECT 'member' AS kind, p_partkey AS a, rep AS b, 0::INT AS edits FROM part JOIN r USING (p_name) WHERE p_partkey <> rep
UNION ALL SELECT 'pair', x.rep, y.rep, levenshtein(x.p_name, y.p_name)::INT FROM r x JOIN r y ON x.p_name <> y.p_name WHERE levenshtein(x.p_name, y.p_name) <= CASE WHEN length(x.p_name) <= 5 THEN 1 ELSE 2 END""")
def similarity_edits_all(spark: SparkSession, d: str) -> DataFrame:
    """Near names among all parts: the first part of each name stands for those of that name ('member'), and the first
    parts of near names are paired ('pair', by the edits that the length of a's name allows). Parts are linked where those that stand for them are."""
    p = table(spark, d, "part").select("p_partkey", "p_name")
    r = p.groupBy("p_name").agg(F.min("p_partkey").alias("rep"))
    members = p.join(r, "p_name").where("p_partkey <> rep").select(F.lit("member").alias("kind"), F.col("p_partkey").alias("a"), F.col("rep").alias("b"), F.lit(0).alias("edits"))
    near = similar.within_edits(r, "p_name", lambda n: F.when(F.length(n) <= 5, 1).otherwise(2))
    pairs = near.join(r.toDF("asked", "a"), "asked").join(r.toDF("word", "b"), "word")
    return members.unionByName(pairs.select(F.lit("pair").alias("kind"), "a", "b", "edits"))


@query()
def token_align(spark: SparkSession, d: str) -> DataFrame:
    """Texts against themselves with every tenth word changed."""
    words = F.split("text", " ")
    other = F.array_join(F.transform(words, lambda w, i: F.when(i % 10 == 9, F.concat(w, F.lit("x"))).otherwise(w)), " ")
    docs = table(spark, d, "documents").select("doc_id", "text", other.alias("other"))
    return similar.aligned_replacements(docs, "doc_id", "text", "other")


@query("""WITH t AS (SELECT item_id, list_distinct(list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> '')) AS w FROM benchmark)
SELECT a.item_id AS a, b.item_id AS b, round(len(list_intersect(a.w, b.w)) / (len(a.w) + len(b.w) - len(list_intersect(a.w, b.w))), 4) AS jaccard FROM t a JOIN t b ON b.item_id = a.item_id + 1""")
def jaccard_sets(spark: SparkSession, d: str) -> DataFrame:
    t = table(spark, d, "benchmark").select("item_id", F.array_distinct(tokens(F.col("text"))).alias("w"))
    n = t.select((F.col("item_id") - 1).alias("item_id"), F.col("item_id").alias("b"), F.col("w").alias("v"))
    union = F.size(F.array_union("w", "v"))
    return t.join(n, "item_id").select(F.col("item_id").alias("a"), "b", F.round(F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect("w", "v")) / union), 4).alias("jaccard"))


@query("""SELECT 'both' AS part, count(*) AS n FROM (SELECT c_custkey FROM customer INTERSECT SELECT o_custkey FROM orders)
UNION ALL SELECT 'only_customer', count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders) UNION ALL SELECT 'union', count(*) FROM (SELECT c_custkey FROM customer UNION SELECT o_custkey FROM orders)""")
def set_ops(spark: SparkSession, d: str) -> DataFrame:
    c, o = table(spark, d, "customer").select("c_custkey"), table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"))
    parts = (("both", c.intersect(o)), ("only_customer", c.subtract(o)), ("union", c.union(o).distinct()))
    counts = [x.agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "n") for name, x in parts]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("SELECT o_custkey, o_orderkey, o_orderstatus FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def upsert_latest(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate")
    return joins.latest(o, ["o_custkey"], F.struct("o_orderdate", "o_orderkey")).select("o_custkey", "o_orderkey", "o_orderstatus")


@query("SELECT s_suppkey, s_nationkey, round(s_acctbal, 2) AS s_acctbal FROM supplier WHERE s_nationkey IS DISTINCT FROM 3 UNION ALL SELECT s_suppkey + 1000000, s_nationkey, 0.0 FROM supplier WHERE s_nationkey = 3")
def replace_by_key(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey", F.round("s_acctbal", 2).alias("s_acctbal"))
    fresh = s.where("s_nationkey = 3").select((F.col("s_suppkey") + 1000000).alias("s_suppkey"), "s_nationkey", F.lit(0.0).alias("s_acctbal"))
    return sinks.replaced(s, fresh, ["s_nationkey"])


@query("SELECT s_suppkey, CASE WHEN s_acctbal < 0 AND s_suppkey % 2 = 0 THEN 'even,negative' WHEN s_acctbal < 0 THEN 'negative' WHEN s_suppkey % 2 = 0 THEN 'even' ELSE '' END AS flags FROM supplier")
def flag_sets(spark: SparkSession, d: str) -> DataFrame:
    start = F.when(F.col("s_suppkey") % 2 == 0, F.array(F.lit("even"), F.lit("negative"))).otherwise(F.array(F.lit("negative")))
    return table(spark, d, "supplier").select("s_suppkey", F.array_join(sinks.flag_update(start, "negative", F.col("s_acctbal") < 0), ",").alias("flags"))


@query("SELECT s_suppkey, round(((s_suppkey * 37) % 181 - 90) - 50 / 111.0, 6) AS south, round(((s_suppkey * 53) % 361 - 180) - 50 / 111.0 / greatest(0.15, cos(radians((s_suppkey * 37) % 181 - 90))), 6) AS west FROM supplier")
def coordinate_box(spark: SparkSession, d: str) -> DataFrame:
    p = points(spark, d, "supplier", "s_suppkey").select("s_suppkey", box_around(F.col("lat"), F.col("lon"), 50.0).alias("b"))
    return p.select("s_suppkey", F.round("b.south", 6).alias("south"), F.round("b.west", 6).alias("west"))


@query()
def layout_pages(spark: SparkSession, d: str) -> DataFrame:
    """Orders as pages, their lines as boxes in columns: reading order, tables and plates."""
    q = F.col("l_linenumber")
    box = F.array((q % 2 * 500 + 10).cast("int"), (q * 20).cast("int"), (q % 2 * 500 + 10 + F.col("l_quantity") * 8).cast("int"), (q * 20 + 14).cast("int"))
    line = F.struct(box.alias("bbox"), F.concat(F.lit("line "), q.cast("string"), F.lit(" "), F.repeat(F.lit("word "), 8)).alias("text"))
    pages = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(line)).alias("lines")).select("l_orderkey", F.lit(1000).alias("w"), F.lit(1400).alias("h"), "lines")
    return layout.assemble_pages(pages, ["l_orderkey"]).select("l_orderkey", "printed", "n_tables", "plate", F.length("text").alias("n_chars"))
