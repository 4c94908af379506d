"""Queries over judgements: swaps, verification, adjudication, routes, enrichment, index rows, reader layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import enrich, index_pages, quality
from ..session import stored, table
from .registry import query


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 5 = 0 THEN 'kept' WHEN l_suppkey % 2 = 0 THEN 'printed' WHEN l_linenumber % 3 = 0 THEN 'permissive' ELSE 'none' END AS route FROM lineitem")
def licence_routes(spark: SparkSession, d: str) -> DataFrame:
    tier = F.when(F.col("l_partkey") % 5 == 0, "A").otherwise("B")
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", quality.licence_route(tier, F.col("l_suppkey") % 2 == 0, F.col("l_linenumber") % 3 == 0).alias("route"))


@query("""WITH a AS (SELECT o_orderkey, o_custkey % 4 <> 0 AS has_coords FROM orders), c AS (SELECT l_orderkey AS o_orderkey, l_linenumber AS candidate_id, (l_partkey % 90)::DOUBLE AS km, l_suppkey % 3 = 0 AS named FROM lineitem),
m AS (SELECT a.o_orderkey, has_coords, count(*) FILTER (km <= 25 AND named) AS hits, count(*) FILTER (km <= 60) AS near, min(candidate_id) FILTER (km <= 25 AND named) AS id FROM a LEFT JOIN c ON c.o_orderkey = a.o_orderkey GROUP BY ALL),
l AS (SELECT *, CASE WHEN NOT has_coords THEN 'review' WHEN hits = 1 THEN 'match' WHEN hits > 1 THEN 'review' WHEN near = 0 THEN 'absent' ELSE 'review' END AS label FROM m)
SELECT o_orderkey, label, CASE WHEN label = 'match' THEN id END AS match_id FROM l""")
def adjudication(spark: SparkSession, d: str) -> DataFrame:
    cases = table(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 4 != 0).alias("has_coords"), F.array(F.lit("Aberdeen"), F.lit("")).alias("forms"))
    title = F.when(F.col("l_suppkey") % 3 == 0, "New Aberdeen").otherwise("Bath")
    hits = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("candidate_id"), title.alias("title"), (F.col("l_partkey") % 90).cast("double").alias("km"))
    return quality.adjudicate(cases, hits, "o_orderkey")


@query("""WITH p AS (SELECT c_custkey, 'n' || c_nationkey AS name, c_custkey % 3 <> 0 AS ok, ((c_custkey * 37) % 181 - 90)::DOUBLE AS lat, ((c_custkey * 53) % 361 - 180)::DOUBLE AS lon FROM customer),
k AS (SELECT 'n' || s_nationkey AS name, s_suppkey, ((s_suppkey * 37) % 181 - 90)::DOUBLE AS klat, ((s_suppkey * 53) % 361 - 180)::DOUBLE AS klon FROM supplier),
j AS (SELECT c_custkey, s_suppkey, CASE WHEN ok THEN 2 * 6371.0 * asin(sqrt(least(1.0, pow(sin((radians(klat) - radians(lat)) / 2), 2) + cos(radians(lat)) * cos(radians(klat)) * pow(sin((radians(klon) - radians(lon)) / 2), 2)))) END AS km FROM p JOIN k USING (name))
SELECT c_custkey, s_suppkey AS known_id, CASE WHEN km IS NULL THEN 'unverifiable_no_coordinate' WHEN km > 2000.5 THEN 'rejected_by_coordinate' ELSE 'verified' END AS status FROM j QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY coalesce(round(km, 6), 0), s_suppkey) = 1""")
def verified_names(spark: SparkSession, d: str) -> DataFrame:
    k, s = F.col("c_custkey"), F.col("s_suppkey")
    ok = k % 3 != 0
    places = table(spark, d, "customer").select("c_custkey", F.concat(F.lit("N."), F.col("c_nationkey").cast("string")).alias("name"), F.when(ok, (F.pmod(k * 37, F.lit(181)) - 90).cast("double")).alias("lat"), F.when(ok, (F.pmod(k * 53, F.lit(361)) - 180).cast("double")).alias("lon"))
    known = table(spark, d, "supplier").select(F.concat(F.lit("n "), F.col("s_nationkey").cast("string")).alias("name"), s.alias("known_id"), s.alias("rank"), (F.pmod(s * 37, F.lit(181)) - 90).cast("double").alias("klat"), (F.pmod(s * 53, F.lit(361)) - 180).cast("double").alias("klon"))
    return quality.verified_join(places, known, "c_custkey", "name", 2000.5, keep=stored).select("c_custkey", "known_id", "status")


@query("SELECT o_orderpriority, count(*) FILTER (o_custkey % 7 <> 0) AS tested, count(*) FILTER (o_custkey % 7 <> 0 AND o_orderkey % 3 = 0) AS failed, count(*) FILTER (o_custkey % 7 = 0) AS untestable FROM orders GROUP BY 1")
def containment_audit(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return quality.containment_audit(o, F.col("o_orderkey") % 3 != 0, F.col("o_custkey") % 7 != 0, "o_orderpriority")


LAT, LON = "CASE WHEN p_partkey % 11 <> 0 THEN p_retailprice / 20 - p_size END", "CASE WHEN p_partkey % 13 <> 0 THEN p_size * 4.0 - 20 END"


@query(f"""SELECT p_partkey, CASE WHEN (lat IS NULL) <> (lon IS NULL) THEN 'half' WHEN lon < 0 THEN 'negative_longitude' WHEN NOT (lat BETWEEN 18 AND 54 AND lon BETWEEN 73 AND 135) THEN 'outside_box' END AS flag
FROM (SELECT p_partkey, ({LAT})::DOUBLE AS lat, ({LON})::DOUBLE AS lon FROM part)""")
def coordinate_flags(spark: SparkSession, d: str) -> DataFrame:
    flag = quality.coordinate_flag(F.expr(LAT).cast("double"), F.expr(LON).cast("double"), F.lit(18.0), F.lit(54.0), F.lit(73.0), F.lit(135.0))
    return table(spark, d, "part").select("p_partkey", flag.alias("flag"))


OURS_TOKEN = "CASE c_custkey % 7 WHEN 0 THEN 'Isere' WHEN 1 THEN 'villnge' WHEN 2 THEN 'LOUD' WHEN 3 THEN 'page12' WHEN 4 THEN 'Malaber' WHEN 5 THEN '--' ELSE lower(c_mktsegment) END"
OTHER_TOKEN = "CASE c_custkey % 5 WHEN 0 THEN 'Isère' WHEN 1 THEN 'village' WHEN 2 THEN 'Malabar' WHEN 3 THEN 'loud' ELSE c_mktsegment END"
BITS = [f"(c_custkey // {3**k}) % 2 = 1" for k in range(5)]
WL_SQL, LO_SQL = "regexp_replace(lower({}), '[^\\p{{L}}\\p{{N}}]', '', 'g')", "regexp_replace(upper({}), '[^A-Z]', '', 'g')"


@query(f"""WITH t AS (SELECT c_custkey, {OURS_TOKEN} AS a, {OTHER_TOKEN} AS b, (c_custkey % 11) / 10.0 AS r, {", ".join(f"{x} AS x{k}" for k, x in enumerate(BITS))} FROM customer),
s AS (SELECT *, {WL_SQL.format("a")} = '' OR {WL_SQL.format("b")} = '' OR {WL_SQL.format("a")} = {WL_SQL.format("b")} OR (a = upper(a) AND length({LO_SQL.format("a")}) > 2) OR (b = upper(b) AND length({LO_SQL.format("b")}) > 2)
  OR regexp_matches(a, '[0-9½¼¾]') OR regexp_matches(b, '[0-9½¼¾]') OR r < 0.7 OR abs(length(a) - length(b)) > 3 AS skip, regexp_matches(a, '^\\p{{Lu}}') AS capital FROM t)
SELECT c_custkey, CASE WHEN skip THEN 'skip'
  WHEN capital AND x4 AND x0 THEN CASE WHEN regexp_matches(b, '[^\\x00-\\x7F]') AND NOT regexp_matches(a, '[^\\x00-\\x7F]') THEN 'take' ELSE 'keep' END
  WHEN capital AND x1 AND NOT x0 THEN 'take' WHEN capital AND x0 AND NOT x1 THEN 'keep' WHEN x3 AND NOT x2 THEN 'take' WHEN x2 AND NOT x3 THEN 'keep' ELSE 'flag' END AS decision FROM s""")
def swap_rules(spark: SparkSession, d: str) -> DataFrame:
    """Tokens of two readings under all combinations of what is known of them."""
    known = [F.expr(x.replace("//", "div")) for x in BITS]
    decision = quality.swap_decision(F.expr(OURS_TOKEN), F.expr(OTHER_TOKEN), F.expr("(c_custkey % 11) / 10.0"), *known)
    return table(spark, d, "customer").select("c_custkey", decision.alias("decision"))


@query("SELECT doc_id, 'len=' || length(coalesce(text, '')) || ';' || (CASE WHEN l.doc_id IS NULL THEN 'fresh' ELSE 'cached' END) AS response FROM documents LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)")
def cached_enrichment(spark: SparkSession, d: str) -> DataFrame:
    """Documents with a label count as answered before; the others are asked."""
    docs = table(spark, d, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.concat_ws(":", F.col("doc_id").cast("string"), F.sha2(F.col("text").cast("binary"), 256)))
    cache = docs.join(table(spark, d, "labels").select("doc_id").distinct(), "doc_id", "left_semi").select("key", F.concat(F.lit("len="), F.length("text").cast("string"), F.lit(";cached")).alias("response"))
    out, _ = enrich.enriched(docs, cache, lambda texts: [f"len={len(t)};fresh" for t in texts])
    return out.select("doc_id", "response")


def _place(n: int, kind: str) -> str:
    return f"""concat('{{"name":"P', o_custkey, '-{n}","aat_type_id":"', {kind}, '","latitude":', o_custkey % 90, '.5', CASE WHEN o_custkey % 2 = 0 THEN ',"longitude":20.0' ELSE '' END, '}}')"""


_FIRST, _SECOND = _place(1, "CASE WHEN o_orderkey % 7 = 0 THEN '999' ELSE '300008372' END"), _place(2, "'other'")
RESPONSE = f"""concat('{{"places":[', {_FIRST}, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE concat(',', {_SECOND}) END, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE ']}}' END)"""


@query(f"""WITH r AS (SELECT o_orderkey AS entry_id, {RESPONSE} AS t FROM orders), g AS (SELECT entry_id, t FROM r WHERE json_valid(t)),
p AS (SELECT entry_id, generate_series::INT AS place_no, json_extract(t, '$.places[' || (generate_series - 1) || ']') AS p, json_extract_string(t, '$.places[*].aat_type_id') AS kinds FROM g, generate_series(1, json_array_length(t, '$.places')::BIGINT))
SELECT entry_id, place_no, p->>'$.name' AS name, nullif(p->>'$.aat_type_id', 'other') AS type_id, CASE WHEN (p->>'$.longitude') IS NOT NULL THEN (p->>'$.latitude')::DOUBLE END AS lat FROM p WHERE list_has_all(['300008372', 'other'], kinds)""")
def extracted_places(spark: SparkSession, d: str) -> DataFrame:
    """Responses of one or two places: some are cut short, some name a type that is not on the list, some a latitude alone."""
    out = enrich.places_of(table(spark, d, "orders").select(F.col("o_orderkey").alias("entry_id"), F.expr(RESPONSE).alias("response")), ["300008372"])
    return out.select("entry_id", "place_no", F.col("place.name").alias("name"), F.col("place.aat_type_id").alias("type_id"), F.col("place.latitude").alias("lat"))


INDEX_LINE = "concat('Town', s_suppkey % 7, ', Prov ', 30 + s_suppkey % 5, '.', lpad(concat(s_suppkey % 75, ''), 2, '0'), ' N 110.', lpad(concat(s_suppkey % 50, ''), 2, '0'), ' E')"


@query(f"""WITH t AS (SELECT s_suppkey AS id, {INDEX_LINE} AS t FROM supplier), p AS (SELECT id, regexp_extract(t, '^(.*), ([^,]*?) (\\d+)\\.(\\d+) N (\\d+)\\.(\\d+) E$', ['name', 'province', 'a', 'am', 'b', 'bm']) AS m FROM t)
SELECT id, m.name AS name, m.province AS province, round(m.a::INT + m.am::INT / 60, 4) AS lat, round(m.b::INT + m.bm::INT / 60, 4) AS lon FROM p WHERE m.am::INT < 60 AND m.bm::INT < 60""")
def index_rows(spark: SparkSession, d: str) -> DataFrame:
    """Index lines with degrees and minutes; minutes of sixty and more make no coordinate."""
    out = index_pages.stateless_rows(table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.expr(INDEX_LINE).alias("text")))
    return out.select("id", "name", "province", F.round("lat", 4).alias("lat"), F.round("lon", 4).alias("lon"))


@query("""WITH b AS (SELECT p_brand AS province, floor(min(p_size)) AS south, ceil(max(p_size)) AS north FROM part GROUP BY 1)
SELECT p_partkey, CASE WHEN south IS NULL THEN 'no_province_box' WHEN p_size NOT BETWEEN south - 1 AND north + 1 THEN 'outside_province_box' ELSE '' END AS flags, south IS NULL OR p_size BETWEEN south - 1 AND north + 1 AS clean FROM part LEFT JOIN b ON province = p_brand""")
def province_check_all(spark: SparkSession, d: str) -> DataFrame:
    """Parts against the boxes of their brands."""
    p = table(spark, d, "part")
    size = F.col("p_size").cast("double")
    boxes = quality.province_boxes(p.select(F.col("p_brand").alias("province"), size.alias("lat_lo"), size.alias("lat_hi"), F.lit(1.0).alias("lon_lo"), F.lit(2.0).alias("lon_hi")))
    rows = p.select("p_partkey", F.col("p_brand").alias("province"), F.lit("Name").alias("name"), size.alias("lat"), F.lit(1.5).alias("lon"))
    return quality.box_flags(rows, boxes).select("p_partkey", F.array_join("flags", ",").alias("flags"), "clean")


@query("""WITH l AS (SELECT user_id, arg_max(event_type, event_id) AS decision FROM events GROUP BY user_id) SELECT c_custkey, CASE WHEN decision <> 'error' THEN decision END AS decision FROM customer LEFT JOIN l ON user_id = c_custkey""")
def latest_decisions(spark: SparkSession, d: str) -> DataFrame:
    action = F.when(F.col("event_type") == "error", "undo").otherwise(F.col("event_type")).alias("action")
    made = table(spark, d, "events").select(F.col("user_id").cast("bigint").alias("sig"), action, "event_id")
    rows = table(spark, d, "customer").select("c_custkey", F.col("c_custkey").alias("sig"))
    return quality.decided(rows, made, "sig", "event_id").select("c_custkey", "decision")


@query("WITH p AS (SELECT o_orderkey, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS pos FROM orders) SELECT o_orderkey, (pos // 4)::INT AS chunk, pos % 4 = 0 AS opens FROM p")
def reader_chunks(spark: SparkSession, d: str) -> DataFrame:
    return quality.first_covering(table(spark, d, "orders").select("o_orderkey", "o_custkey"), "o_custkey", "o_orderkey", 4).select("o_orderkey", "chunk", "opens")
