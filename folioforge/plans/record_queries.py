"""Queries over records and reviews: selections, set comparisons, attestation, review order, requests, artefacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geo
from ..functions import text as T
from ..operators import phonetic, records
from ..operators import quality as Q
from ..session import stored, table
from ..sources import artefacts, sinks
from ..streaming import windows
from .registry import query


# ---------------------------------------------------------------- selections


@query("SELECT o_orderkey, (o_orderkey % 7)::INT AS shard FROM orders")
def shard_numbers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", F.pmod("o_orderkey", F.lit(7)).cast("int").alias("shard"))


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('O', 'P') AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def places_open(spark: SparkSession, d: str) -> DataFrame:
    matched = table(spark, d, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, d, "orders").where(F.col("o_orderstatus").isin("O", "P")).select("o_orderkey", "o_orderstatus").join(matched, "o_orderkey", "left_anti")


@query("""WITH p AS (SELECT doc_id, CASE WHEN doc_id % 9 <> 0 THEN doc_id END AS printed, string_split(text, chr(10)) AS lines FROM documents), b AS (SELECT doc_id, printed, len(list_filter(lines, lambda x: x <> '' AND NOT starts_with(x, '##') AND NOT starts_with(x, '<!--'))) AS n_lines FROM p WHERE printed IS NOT NULL AND NOT list_contains(list_transform(lines, lambda x: starts_with(x, '<!-- table')), true)),
h AS (SELECT doc_id AS printed, count(DISTINCT w) AS n_heads FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-ZÀ-Þ][A-Za-zÀ-ÿ.''\\-]{2,}')) AS w FROM documents) GROUP BY 1)
SELECT doc_id AS page, printed, n_lines, n_heads FROM b JOIN h USING (printed) WHERE n_lines >= 3 AND n_heads >= 10""")
def prose_pages(spark: SparkSession, d: str) -> DataFrame:
    """Documents as pages: with a number, no table mark, three lines or more and ten capitalised words or more."""
    docs = table(spark, d, "documents")
    pages = docs.select(F.col("doc_id").alias("page"), F.when(F.col("doc_id") % 9 != 0, F.col("doc_id")).alias("printed"), F.split("text", "\n", -1).alias("lines"))
    heads = docs.select(F.col("doc_id").alias("printed"), F.explode(records.toponyms(F.col("text"))).alias("headword"))
    out = records.prose_pages(pages, heads, 3, 10)
    return out.select("page", "printed", F.col("n_lines").cast("bigint").alias("n_lines"), "n_heads")


@query("SELECT page_id, len(regexp_extract_all(html, '<(?:table|li|td)\\b'))::INT AS score FROM pages WHERE len(regexp_extract_all(html, '<(?:table|li|td)\\b')) >= 2")
def table_candidates(spark: SparkSession, d: str) -> DataFrame:
    return records.table_candidates(table(spark, d, "pages").select("page_id", "html"), F.regexp_count("html", F.lit(r"<(?:table|li|td)\b")).cast("int"), 2).select("page_id", "score")


PLACE = "c_custkey, CASE WHEN c_custkey % 11 = 0 THEN ' ' ELSE c_name END AS name, CASE WHEN c_acctbal > 0 THEN c_acctbal / 200 END AS lat, CASE WHEN c_custkey % 3 <> 0 THEN c_nationkey * 5.0 END AS lon, c_mktsegment AS cc, CASE WHEN c_nationkey % 4 = 0 THEN 0 ELSE 1 END AS n_hierarchy"


@query(f"SELECT c_custkey, name FROM (SELECT {PLACE} FROM customer) p WHERE (lat IS NULL OR lon IS NULL) AND trim(name) <> '' AND cc = 'MACHINERY' AND n_hierarchy > 0")
def name_population(spark: SparkSession, d: str) -> DataFrame:
    """Places without a printed point but with a name, of one country and with a stated hierarchy."""
    p = table(spark, d, "customer").select(*(F.expr(x) for x in _split(PLACE)))
    return p.where((F.col("lat").isNull() | F.col("lon").isNull()) & (F.trim("name") != "") & (F.col("cc") == "MACHINERY") & (F.col("n_hierarchy") > 0)).select("c_custkey", "name")


def _split(columns: str) -> list[str]:
    """Columns of a SELECT list; commas within parentheses or between CASE and END do not part them."""
    out, depth, at = [], 0, ""
    for token in columns.replace("(", " ( ").replace(")", " ) ").replace(",", " , ").split(" "):
        depth += (token in ("(", "CASE")) - (token in (")", "END"))
        if token == "," and depth == 0:
            out.append(at.strip())
            at = ""
        else:
            at += f"{token} " if token else " "
    return [*out, at.strip()]


@query("""WITH h AS (SELECT p_partkey, [p_size, p_partkey % 40, p_partkey % 7 * 30, 200 - p_size] AS h FROM part), f AS (SELECT p_partkey, (h[1] + h[2]) / list_sum(h) AS ink FROM h)
SELECT p_partkey, round(ink, 6) AS ink FROM f WHERE ink BETWEEN 0.02 AND 0.55""")
def ink_range(spark: SparkSession, d: str) -> DataFrame:
    """Images whose share of dark points lies in the range of plates, from histograms of four levels."""
    k = F.col("p_partkey")
    h = F.array(F.col("p_size").cast("bigint"), k % 40, k % 7 * 30, (200 - F.col("p_size")).cast("bigint"))
    return table(spark, d, "part").select("p_partkey", F.round(records.ink_fraction(h, 2), 6).alias("ink")).where(F.col("ink").between(0.02, 0.55))


@query("SELECT event_id FROM events WHERE props LIKE '%\"k\": 8%'")
def content_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").where(F.contains("props", F.lit('"k": 8'))).select("event_id")


# ---------------------------------------------------------------- set comparisons


@query("""WITH a AS (SELECT l_orderkey, list(DISTINCT l_partkey::VARCHAR) FILTER (l_returnflag <> 'A') AS x, list(DISTINCT l_partkey::VARCHAR) FILTER (l_linestatus = 'O') AS y FROM lineitem GROUP BY 1)
SELECT l_orderkey, array_to_string(list_sort(list_concat(list_filter(coalesce(x, []), lambda v: NOT list_contains(coalesce(y, []), v)), list_filter(coalesce(y, []), lambda v: NOT list_contains(coalesce(x, []), v)))), ',') AS moved FROM a""")
def answers_moved(spark: SparkSession, d: str) -> DataFrame:
    """Candidates that only one of two settings gives."""
    part = F.col("l_partkey").cast("string")
    a = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set(F.when(F.col("l_returnflag") != "A", part)).alias("x"), F.collect_set(F.when(F.col("l_linestatus") == "O", part)).alias("y"))
    return a.select("l_orderkey", F.array_join(records.symmetric_difference(F.col("x"), F.col("y")), ",").alias("moved"))


@query("""WITH c AS (SELECT DISTINCT p_partkey, 'geometry' AS found FROM part WHERE p_size > 25 UNION SELECT DISTINCT l_partkey, 'vision' FROM lineitem WHERE l_quantity > 45)
SELECT p_partkey, string_agg(found, '+' ORDER BY found) AS found_by FROM c GROUP BY p_partkey""")
def candidate_union(spark: SparkSession, d: str) -> DataFrame:
    """Candidates of two detectors, with which of them found each."""
    a = table(spark, d, "part").where("p_size > 25")
    b = table(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    return records.from_either({"geometry": a, "vision": b}, ["p_partkey"]).select("p_partkey", F.array_join("found_by", "+").alias("found_by"))


@query("SELECT o_custkey, bool_or(o_orderpriority = '1-URGENT') AS by_headword, bool_or(o_totalprice > 300000) AS by_postal, bool_or(o_orderpriority = '1-URGENT' OR o_totalprice > 300000) AS reached FROM orders GROUP BY o_custkey")
def either_hits(spark: SparkSession, d: str) -> DataFrame:
    a, b = F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") > 300000
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.bool_or(a).alias("by_headword"), F.bool_or(b).alias("by_postal"), F.bool_or(a | b).alias("reached"))


@query("""SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'crossref' WHEN length(lang) * 2 + doc_id % 4 <= 4 OR length(text) < 35 OR NOT regexp_matches(substr(text, 1, 90), '(?i)(?:^|[^\\p{L}\\p{N}_])(?:a|an|the|see|or|is|in|of|on|near|chief|town|vil|river|prov)(?:$|[^\\p{L}\\p{N}_])') THEN 'junk' ELSE 'real' END AS class FROM documents""")
def residual_classes(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("doc_id")
    name = F.repeat(F.lit("x"), (F.length("lang") * 2 + k % 4).cast("int"))
    return table(spark, d, "documents").select("doc_id", records.residual_class(F.when(k % 5 == 0, "crossref").otherwise("entry"), name, F.col("text")).alias("class"))


@query("SELECT count(*) AS n, count(*) FILTER (quality = toxic) AS same FROM labels JOIN documents USING (doc_id)")
def common_keys(spark: SparkSession, d: str) -> DataFrame:
    """Two sides compared on the keys they share; none shared is an error."""
    return records.in_common(table(spark, d, "labels"), table(spark, d, "documents").select("doc_id"), ["doc_id"]).agg(F.count("*").alias("n"), F.count_if(F.col("quality") == F.col("toxic")).alias("same"))


STARTS_TEXT = "concat(upper(p_type), ', a ', p_name, '. ', upper(p_name), ' (', p_brand, '), of old. Mere ', upper(p_type), ' here')"


@query(f"""WITH t AS (SELECT p_partkey, {STARTS_TEXT} AS t FROM part), s AS (SELECT p_partkey, list_transform(list_concat(regexp_extract_all(t, '^\\s*([A-ZÀ-Þ][A-ZÀ-Þ ''’.\\-]{{1,40}}?)(?: \\([^)]*\\))?,\\s+[a-z]', 1), regexp_extract_all(t, '\\. \\s*([A-ZÀ-Þ][A-ZÀ-Þ ''’.\\-]{{1,40}}?)(?: \\([^)]*\\))?,\\s+[a-z]', 1)), lambda x: regexp_replace(x, '[^A-Z]', '', 'g')) AS k FROM t)
SELECT p_partkey, array_to_string(list_filter(list_distinct(k), lambda x: length(x) >= 4).list_sort(), ',') AS starts FROM s""")
def entry_starts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", F.array_join(F.array_sort(records.entry_starts(F.expr(STARTS_TEXT))), ",").alias("starts"))


# ---------------------------------------------------------------- counts and attestation


@query("WITH n AS (SELECT l_partkey, l_returnflag AS name, count(*) AS n FROM lineitem GROUP BY ALL) SELECT l_partkey, max(n) AS n, arg_max(name, (n, -ascii(name))) AS name FROM n GROUP BY l_partkey")
def commonest_name(spark: SparkSession, d: str) -> DataFrame:
    return records.commonest(table(spark, d, "lineitem").select("l_partkey", F.col("l_returnflag").alias("name")), ["l_partkey"], "name")


@query("SELECT source AS volume, n_chars % 50 AS printed, arg_min(doc_id + 8, doc_id) AS image FROM documents WHERE n_chars % 50 <> 7 GROUP BY ALL")
def first_image(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("n_chars") % 50
    return records.first_image(table(spark, d, "documents").select(F.col("source").alias("volume"), F.when(k != 7, k).alias("printed"), (F.col("doc_id") + 8).alias("image"), F.col("doc_id").alias("place")))


@query("""WITH r AS (SELECT DISTINCT p_name FROM part), o AS (SELECT DISTINCT p_name FROM part WHERE p_size > 10), e AS (SELECT p_name FROM r SEMI JOIN o USING (p_name)), f AS (SELECT p_name FROM r ANTI JOIN o USING (p_name) WHERE length(p_name) > 11)
SELECT (SELECT count(*) FROM r) AS n, (SELECT count(*) FROM e) AS n_exact, (SELECT count(*) FROM f) AS n_fuzzy, round(100.0 * ((SELECT count(*) FROM e) + (SELECT count(*) FROM f)) / greatest((SELECT count(*) FROM r), 1), 2) AS match_pct""")
def match_rate(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part")
    reference, ours = p.select("p_name").distinct(), p.where("p_size > 10").select("p_name").distinct()
    return records.match_rate(reference.join(ours, "p_name", "left_semi"), reference.join(ours, "p_name", "left_anti").where(F.length("p_name") > 11), reference)


@query("""SELECT o_orderpriority, count(*)::INT AS n, substr(sha256('{' || string_agg('"' || o_orderkey || '": "' || o_custkey || '"', ', ' ORDER BY o_orderkey::VARCHAR) || '}'), 1, 16) AS digest FROM orders GROUP BY 1""")
def map_digest(spark: SparkSession, d: str) -> DataFrame:
    return records.map_digest(table(spark, d, "orders"), ["o_orderpriority"], "o_orderkey", "o_custkey")


@query("""WITH a AS (SELECT o_custkey, max(o_totalprice) FILTER (year(o_orderdate) < 1997) AS x, max(o_totalprice) FILTER (year(o_orderdate) >= 1997) AS y FROM orders GROUP BY 1)
SELECT count(*) FILTER (x IS NOT NULL AND y IS NOT NULL) AS both_hit, count(*) FILTER (x IS NULL AND y IS NOT NULL) AS gained, count(*) FILTER (x IS NOT NULL AND y IS NULL) AS lost, count(*) FILTER (y > x) AS rose, count(*) FILTER (y < x) AS fell FROM a""")
def confidence_moves(spark: SparkSession, d: str) -> DataFrame:
    """The same askers under two settings: who is answered by both, by one, and whether the confidence rose or fell."""
    late = F.year("o_orderdate") >= 1997
    a = table(spark, d, "orders").groupBy("o_custkey").agg(F.max(F.when(~late, F.col("o_totalprice"))).alias("x"), F.max(F.when(late, F.col("o_totalprice"))).alias("y"))
    x, y = F.col("x"), F.col("y")
    return a.agg(F.count_if(x.isNotNull() & y.isNotNull()).alias("both_hit"), F.count_if(x.isNull() & y.isNotNull()).alias("gained"), F.count_if(x.isNotNull() & y.isNull()).alias("lost"), F.count_if(y > x).alias("rose"), F.count_if(y < x).alias("fell"))


@query("""SELECT CASE WHEN n_chars <= 800 THEN '<=800' ELSE '>800' END AS bucket, count(*) AS entries, sum(1 + len(regexp_extract_all(text, '(?i)\\bthe\\b')))::BIGINT AS places, sum(n_chars)::BIGINT AS chars FROM documents GROUP BY 1""")
def places_per_bucket(spark: SparkSession, d: str) -> DataFrame:
    """Entries by length, and the places in them: one, and one for each further mention."""
    return table(spark, d, "documents").groupBy(F.when(F.col("n_chars") <= 800, "<=800").otherwise(">800").alias("bucket")).agg(F.count("*").alias("entries"), F.sum(1 + F.regexp_count("text", F.lit(r"(?i)\bthe\b"))).cast("bigint").alias("places"), F.sum("n_chars").alias("chars"))


@query("""WITH f AS (SELECT regexp_replace(lower(strip_accents(w)), '[^a-z]', '', 'g') AS key, w AS form, CASE WHEN doc_id % 2 = 0 THEN 'ancient' ELSE 'modern' END AS era FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-ZÀ-Þ][A-Za-zÀ-ÿ.''\\-]{2,}')) AS w FROM documents)),
n AS (SELECT key, form, count(*) AS c FROM f GROUP BY ALL)
SELECT n.key, arg_max(form, (regexp_matches(form, '[^\\x00-\\x7F]'), form <> upper(form), c, form)) AS canonical, sum(c)::BIGINT AS n, '{' || string_agg('"' || form || '":' || c, ',' ORDER BY form) || '}' AS forms, any_value(e.eras) AS eras
FROM n JOIN (SELECT key, string_agg(DISTINCT era, ',' ORDER BY era) AS eras FROM f GROUP BY key) e USING (key) GROUP BY n.key""")
def toponym_dictionary(spark: SparkSession, d: str) -> DataFrame:
    """Capitalised words by folded key: the best-attested spelling, all spellings with their numbers, and the eras they are met in."""
    w = table(spark, d, "documents").select(F.when(F.col("doc_id") % 2 == 0, "ancient").otherwise("modern").alias("era"), F.explode(records.toponyms(F.col("text"))).alias("form"))
    return records.attested(w.withColumn("key", T.fold(F.col("form"))))


@query("""WITH a AS (SELECT s_suppkey, s_nationkey, s_acctbal, row_number() OVER (PARTITION BY s_nationkey ORDER BY md5('a:' || s_suppkey)) AS i, row_number() OVER (PARTITION BY s_nationkey ORDER BY md5('b:' || s_suppkey)) AS j, row_number() OVER (ORDER BY md5('a:' || s_suppkey)) AS gi, row_number() OVER (ORDER BY md5('b:' || s_suppkey)) AS gj FROM supplier)
SELECT 'nation' AS scope, count(*) AS n, count(*) FILTER (abs(x.s_acctbal - y.s_acctbal) < 1000) AS near FROM a x JOIN a y ON x.s_nationkey = y.s_nationkey AND x.i = y.j
UNION ALL SELECT 'all', count(*), count(*) FILTER (abs(x.s_acctbal - y.s_acctbal) < 1000) FROM a x JOIN a y ON x.gi = y.gj""")
def permutation_scopes(spark: SparkSession, d: str) -> DataFrame:
    """Each row given a random other: of its own nation, and of all. Ranks over the whole table are counted part by part."""
    s = table(spark, d, "supplier").select("s_suppkey", "s_nationkey", "s_acctbal")
    lot = lambda seed: F.md5(F.concat(F.lit(seed), F.col("s_suppkey").cast("string")).cast("binary"))

    def placed(seed: str) -> DataFrame:
        """Rank by a hash: hashes are cut by their first two digits, and a part's rows follow those of all parts before it."""
        rows = s.withColumn("lot", lot(seed)).withColumn("part", F.substring("lot", 1, 2))
        sizes = rows.groupBy("part").agg(F.count("*").alias("c"))  # at most 256 rows
        before = sizes.withColumn("before", F.sum("c").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("c")).select("part", "before")
        within = F.row_number().over(Window.partitionBy("part").orderBy("lot"))
        return rows.join(F.broadcast(before), "part").select("s_nationkey", "s_acctbal", (F.col("before") + within).alias("g"), F.row_number().over(Window.partitionBy("s_nationkey").orderBy("lot")).alias("i"))

    x, y = placed("a:"), placed("b:").toDF("s_nationkey", "other", "g", "i")
    near = F.count_if(F.abs(F.col("s_acctbal") - F.col("other")) < 1000).alias("near")
    own = x.drop("g").join(y.drop("g"), ["s_nationkey", "i"]).agg(F.count("*").alias("n"), near).select(F.lit("nation").alias("scope"), "n", "near")
    return own.unionByName(x.select("g", "s_acctbal").join(y.select("g", "other"), "g").agg(F.count("*").alias("n"), near).select(F.lit("all").alias("scope"), "n", "near"))


# ---------------------------------------------------------------- order and draws


@query("""SELECT c_custkey, c_nationkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal <= 0, c_custkey % 4 = 0, lower(c_name), c_custkey)::INT AS rank FROM customer""")
def review_rank(spark: SparkSession, d: str) -> DataFrame:
    order = [*records.review_order(F.col("c_acctbal") > 0, F.col("c_custkey") % 4 != 0, F.col("c_name")), F.col("c_custkey").asc()]
    return records.ranked(table(spark, d, "customer"), ["c_nationkey"], order).select("c_custkey", "c_nationkey", "rank")


@query("SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY coalesce(CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice END, -1), length(o_orderpriority), o_orderkey)::INT AS place FROM orders")
def worst_first(spark: SparkSession, d: str) -> DataFrame:
    """Each asker's rows, worst first: what was not measured before all, then by likeness, then by length."""
    like = F.when(F.col("o_orderkey") % 5 != 0, F.col("o_totalprice"))
    return records.ranked(table(spark, d, "orders"), ["o_custkey"], [F.coalesce(like, F.lit(-1.0)).asc(), F.length("o_orderpriority").asc(), F.col("o_orderkey").asc()], "place").select("o_orderkey", "place")


@query("""WITH s AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'coords' WHEN o_orderstatus = 'O' THEN 'variants' ELSE 'neither' END AS stratum, md5('9:' || o_orderkey) AS lot FROM orders),
r AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY lot) AS i FROM s), a AS (SELECT * FROM r WHERE stratum = 'coords' AND i <= 60 OR stratum = 'variants' AND i <= 20)
SELECT o_orderkey, stratum FROM a UNION ALL SELECT o_orderkey, stratum FROM r WHERE stratum = 'neither' AND i <= greatest(100 - (SELECT count(*) FROM a), 0)""")
def weighted_draw(spark: SparkSession, d: str) -> DataFrame:
    """A hundred rows: sixty with coordinates, twenty with variants, the rest with neither."""
    stratum = F.when(F.col("o_orderstatus") == "F", "coords").when(F.col("o_orderstatus") == "O", "variants").otherwise("neither")
    return records.weighted_draw(table(spark, d, "orders").select("o_orderkey", "o_orderstatus"), stratum, "o_orderkey", 100, {"coords": 0.6, "variants": 0.2}, "9:").select("o_orderkey", "stratum")


@query("""WITH o AS (SELECT o_custkey, o_orderkey AS pos, o_orderpriority AS name FROM orders), t AS (SELECT DISTINCT o_custkey, o_orderpriority AS name FROM orders WHERE o_totalprice > 350000),
m AS (SELECT o.*, t.name IS NOT NULL AS shared FROM o LEFT JOIN t ON t.o_custkey = o.o_custkey AND t.name = o.name), e AS (SELECT o_custkey, min(pos) AS a, max(pos) AS b FROM m WHERE shared GROUP BY 1)
SELECT m.o_custkey, pos, name, shared FROM m JOIN e USING (o_custkey) WHERE pos BETWEEN a AND b""")
def headword_span(spark: SparkSession, d: str) -> DataFrame:
    """Our names from the first to the last that the other reading has too."""
    o = table(spark, d, "orders")
    ours = o.select("o_custkey", F.col("o_orderkey").alias("pos"), F.col("o_orderpriority").alias("name"))
    return records.span_between(ours, o.where("o_totalprice > 350000").select("o_custkey", F.col("o_orderpriority").alias("name")), "o_custkey", "pos", "name")


# ---------------------------------------------------------------- marks and shapes of values


@query("""SELECT o_orderkey, ((o_custkey % 4 * 90 + CASE WHEN o_orderkey % 3 = 0 THEN -90 ELSE 0 END) % 360 + 360) % 360 AS rotation, CASE o_orderkey % 8 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 3 THEN 4 WHEN 4 THEN 1 ELSE 5 END AS certainty,
coalesce(CASE WHEN o_orderkey % 6 <> 0 THEN o_totalprice / 4000 END < 60, false) AS low, strftime(o_orderdate + INTERVAL (o_custkey) MINUTE, '%Y-%m-%dT%H:%M:%S+00:00') AS stamp FROM orders""")
def place_marks(spark: SparkSession, d: str) -> DataFrame:
    """Rotation of a page, certainty of a match, the flag of low confidence, and a time stamp in UTC."""
    k = F.col("o_orderkey")
    names = F.array(*map(F.lit, ("1-exact-in", "2-phon-in", "3-phon-broad", "4-phon-cc", "coord-match", "coord-only", "other")))
    matched_by = F.get(names, (k % 8).cast("int"))
    ts = F.timestamp_add("MINUTE", F.col("o_custkey").cast("int"), F.col("o_orderdate").cast("timestamp"))
    return table(spark, d, "orders").select(
        "o_orderkey", records.rotation(F.col("o_custkey") % 4 * 90, F.when(k % 3 == 0, -90)).alias("rotation"), records.certainty(matched_by).alias("certainty"),
        records.low_confidence(F.when(k % 6 != 0, F.col("o_totalprice") / 4000)).alias("low"), records.utc_stamp(ts).alias("stamp"),
    )


DMS_TEXT = "concat(s_suppkey % 80, '°', CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE concat(' ', s_suppkey % 60, '''') END, CASE s_suppkey % 5 WHEN 0 THEN ' S' WHEN 1 THEN ' W' WHEN 2 THEN ' N' WHEN 3 THEN ' e' ELSE ' x' END)"


@query(f"""WITH t AS (SELECT s_suppkey, {DMS_TEXT} AS t FROM supplier), p AS (SELECT *, regexp_extract(t, '^\\s*(\\d{{1,3}})°\\s*(?:(\\d{{1,2}})'')?\\s*([NSEWnsew])\\s*$', ['d', 'm', 'l']) AS g FROM t),
v AS (SELECT s_suppkey, CASE WHEN g.l <> '' THEN (try_cast(g.d AS DOUBLE) + coalesce(try_cast(g.m AS DOUBLE), 0) / 60) * CASE WHEN upper(g.l) IN ('S', 'W') THEN -1 ELSE 1 END END AS deg FROM p)
SELECT s_suppkey, round(deg, 6) AS deg, deg BETWEEN 0 AND 90 AND s_suppkey % 200 BETWEEN 20 AND 180 AS plausible, round(deg - 50 / 111.0, 6) AS south, round(s_suppkey % 200 + 50 / 111.0, 6) AS east FROM v""")
def printed_degrees(spark: SparkSession, d: str) -> DataFrame:
    """Degrees as printed, whether they lie in the book's window, and the square box of 50 km around them."""
    deg, lon = geo.dms(F.expr(DMS_TEXT)), (F.col("s_suppkey") % 200).cast("double")
    at = table(spark, d, "supplier").select("s_suppkey", deg.alias("deg"), lon.alias("lon"))
    box = geo.box_around(F.col("deg"), F.col("lon"), 50.0, round_earth=False)
    return at.select("s_suppkey", F.round("deg", 6).alias("deg"), geo.plausible(F.col("deg"), F.col("lon")).alias("plausible"), F.round(box["south"], 6).alias("south"), F.round(box["east"], 6).alias("east"))


@query("""WITH g AS (SELECT o_custkey, list({'n': l_linenumber, 'x': l_quantity, 'y': l_discount} ORDER BY l_orderkey, l_linenumber, l_quantity, l_discount) AS g FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)
SELECT o_custkey, g[1].x AS lon, g[1].y AS lat, array_to_string(list_transform(list_append(list_transform(g[1:2], lambda e: e.n), 99), lambda v: v::VARCHAR), ',') AS grown, array_to_string(list_transform(range(1, least(len(g), 3) + 1), lambda i: g[i].n || ':' || g[i].x::INT), ',') AS zipped FROM g""")
def nested_values(spark: SparkSession, d: str) -> DataFrame:
    """The first geometry's point, a list grown by one, and parallel arrays put together as rows."""
    both = table(spark, d, "lineitem").join(table(spark, d, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    g = both.groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("l_orderkey", F.col("l_linenumber").alias("n"), F.col("l_quantity").alias("x"), F.col("l_discount").alias("y")))).alias("g"))
    first = F.get("g", F.lit(0))
    numbers, xs = F.transform("g", lambda e: e["n"]), F.transform("g", lambda e: e["x"].cast("int"))
    zipped = F.transform(F.slice(F.arrays_zip(numbers.alias("n"), xs.alias("x")), 1, 3), lambda e: F.concat(e["n"].cast("string"), F.lit(":"), e["x"].cast("string")))
    return g.select("o_custkey", first["x"].alias("lon"), first["y"].alias("lat"), F.array_join(F.array_append(F.slice(numbers, 1, 2), F.lit(99)).cast("array<string>"), ",").alias("grown"), F.array_join(zipped, ",").alias("zipped"))


@query("""SELECT l_orderkey, '{"containers":[' || string_agg(DISTINCT l_partkey::VARCHAR, ',' ORDER BY l_partkey::VARCHAR) || '],"name":"' || any_value(l_orderkey) || '"}' AS key FROM lineitem GROUP BY l_orderkey""")
def canonical_keys(spark: SparkSession, d: str) -> DataFrame:
    """Cache keys: JSON with its fields in order and its lists sorted, so that equal requests have equal keys."""
    got = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_set(F.col("l_partkey").cast("string"))).alias("p"))
    return got.select("l_orderkey", F.concat(F.lit('{"containers":['), F.array_join("p", ","), F.lit('],"name":"'), F.col("l_orderkey").cast("string"), F.lit('"}')).alias("key"))


@query("""SELECT o_custkey, '{' || string_agg('"' || o_orderkey || '":{"status":"' || o_orderstatus || '"' || CASE WHEN o_totalprice > 250000 THEN ',"audit":"' || o_orderpriority || '"' ELSE '' END || '}', ',' ORDER BY o_orderkey) || '}' AS linked FROM orders GROUP BY 1""")
def linked_relations(spark: SparkSession, d: str) -> DataFrame:
    """An object keyed by id; its audit field is there only where there was one."""
    item = F.to_json(F.struct(F.col("o_orderstatus").alias("status"), F.when(F.col("o_totalprice") > 250000, F.col("o_orderpriority")).alias("audit")))
    got = table(spark, d, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct(F.col("o_orderkey").alias("k"), item.alias("v")))).alias("x"))
    return got.select("o_custkey", F.concat(F.lit("{"), F.array_join(F.transform("x", lambda e: F.concat(F.lit('"'), e["k"].cast("string"), F.lit('":'), e["v"])), ","), F.lit("}")).alias("linked"))


@query("SELECT doc_id, sha256(regexp_replace(lower(strip_accents(text)), '[^a-z0-9]', '', 'g')) AS with_digits, sha256(regexp_replace(lower(strip_accents(text)), '[^a-z ()]', '', 'g')) AS sort_key FROM documents")
def fold_variants(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", F.sha2(T.fold(t, "0-9").cast("binary"), 256).alias("with_digits"), F.sha2(T.fold(t, " ()").cast("binary"), 256).alias("sort_key"))


SCRIPT_LIST = ", ".join(f"'{x}'" for x in records.SCRIPT_IDS)


@query(f"SELECT n_nationkey, coalesce(list_position([{SCRIPT_LIST}], [{SCRIPT_LIST}, 'RUNIC'][1 + n_nationkey % 21]) - 1, 19)::INT AS id FROM nation")
def script_ids(spark: SparkSession, d: str) -> DataFrame:
    names = F.array(*map(F.lit, (*records.SCRIPT_IDS, "RUNIC")))
    return table(spark, d, "nation").select("n_nationkey", records.script_id(F.lower(F.get(names, F.col("n_nationkey") % 21))).alias("id"))


# ---------------------------------------------------------------- text of second readings


@query("SELECT doc_id, sha256(replace(regexp_replace(regexp_replace(regexp_replace(t, '##\\s*p\\.[^\\n]*\\n', chr(10), 'g'), '([A-Za-zÀ-ÿ])-\\n([a-zà-ÿ])', '\\1\\2', 'g'), '(?m)^[A-Z][A-Z .''\\-]{1,30}$', '', 'g'), '|', ' ')) AS cleaned FROM (SELECT doc_id, '## p. 3 (#4)' || chr(10) || 'RUNNING HEAD' || chr(10) || text || chr(10) || 'bro-' || chr(10) || 'ken | ' || upper(lang) AS t FROM documents)")
def second_stream(spark: SparkSession, d: str) -> DataFrame:
    t = F.concat(F.lit("## p. 3 (#4)\nRUNNING HEAD\n"), F.col("text"), F.lit("\nbro-\nken | "), F.upper("lang"))
    return table(spark, d, "documents").select("doc_id", F.sha2(records.second_stream(t).cast("binary"), 256).alias("cleaned"))


@query("""WITH l AS (SELECT doc_id, list_transform(string_split(CASE doc_id % 3 WHEN 0 THEN 'XIV.' || chr(10) || text WHEN 1 THEN text || chr(10) || 'ABBEY ' || upper(lang) ELSE text END, chr(10)), lambda x: trim(x)) AS l FROM documents)
SELECT doc_id, coalesce(list_filter(l, lambda x: regexp_full_match(x, '[A-Z][A-Z .''\\-]{2,}') AND length(regexp_replace(x, '[^A-Z]', '', 'g')) >= 3 AND NOT regexp_full_match(x, '[IVXLCDM]+\\.?'))[1], '?') AS head FROM l""")
def running_heads(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("doc_id") % 3
    t = F.when(k == 0, F.concat(F.lit("XIV.\n"), F.col("text"))).when(k == 1, F.concat(F.col("text"), F.lit("\nABBEY "), F.upper("lang"))).otherwise(F.col("text"))
    return table(spark, d, "documents").select("doc_id", records.running_head(t).alias("head"))


@query("""SELECT doc_id, array_to_string(list_filter([CASE WHEN doc_id % 3 <> 0 AND NOT regexp_matches(t, '(?i)\\blat\\b') THEN 'latitude_not_in_source' END, CASE WHEN doc_id % 5 <> 0 AND NOT regexp_matches(t, '(?i)\\blong\\b') THEN 'longitude_not_in_source' END], lambda x: x IS NOT NULL), ',') AS flags
FROM (SELECT doc_id, text || CASE doc_id % 4 WHEN 0 THEN ' Lat. 3 N.' WHEN 1 THEN ' N lat. 3, E long. 4' WHEN 2 THEN ' latitude, longer' ELSE '' END AS t FROM documents)""")
def unprinted_axes(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("doc_id")
    t = F.concat("text", F.get(F.array(*map(F.lit, (" Lat. 3 N.", " N lat. 3, E long. 4", " latitude, longer", ""))), (k % 4).cast("int")))
    return table(spark, d, "documents").select("doc_id", F.array_join(records.unprinted_axes(t, F.when(k % 3 != 0, 1.0), F.when(k % 5 != 0, 1.0)), ",").alias("flags"))


@query("""WITH w AS (SELECT DISTINCT lower(unnest(string_split_regex(text, '[^\\p{L}]+'))) AS word FROM benchmark), t AS (SELECT DISTINCT unnest(string_split_regex(text, '[^\\p{L}]+')) AS token FROM documents)
SELECT token, lower(token) IN (SELECT word FROM w WHERE word <> '') OR regexp_replace(lower(token), 's$', '') IN (SELECT word FROM w WHERE word <> '') AS known FROM t""")
def known_words(spark: SparkSession, d: str) -> DataFrame:
    """Every distinct word of the documents: whether the benchmark's words have it, or have it without a plural s."""
    words = table(spark, d, "benchmark").select(F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word"))
    tokens = table(spark, d, "documents").select(F.explode(F.split("text", r"[^\p{L}]+")).alias("token")).distinct()
    return records.known_words(tokens, "token", words)


# ---------------------------------------------------------------- requests, parents, decisions


@query("""WITH h AS (SELECT l_orderkey, l_linenumber * 1000000 + l_partkey AS rank, CASE WHEN l_linenumber % 2 = 0 THEN 'phonetic' ELSE 'exact' END AS mode, l_quantity * 2 AS score, CASE WHEN l_partkey % 3 <> 0 THEN l_extendedprice / 1000 END AS confidence, l_suppkey % 2 = 0 AS has_geom, l_partkey AS place_id FROM lineitem),
g AS (SELECT *, score >= 80 AND (mode = 'exact' OR coalesce(confidence >= 30, true)) AS ok FROM h), o AS (SELECT DISTINCT l_orderkey FROM lineitem)
SELECT o.l_orderkey, a.place_id AS areal, b.place_id AS any_kind FROM o
LEFT JOIN (SELECT l_orderkey, arg_max(place_id, (CASE WHEN mode = 'exact' THEN 1 ELSE 0 END, score, -rank)) AS place_id FROM g WHERE ok AND has_geom GROUP BY 1) a USING (l_orderkey)
LEFT JOIN (SELECT l_orderkey, arg_max(place_id, (CASE WHEN mode = 'exact' THEN 1 ELSE 0 END, score, -rank)) AS place_id FROM g WHERE ok GROUP BY 1) b USING (l_orderkey)""")
def parent_policies(spark: SparkSession, d: str) -> DataFrame:
    """The parent each name resolves to under two policies: areas only, or any record."""
    l = table(spark, d, "lineitem")  # noqa: E741
    hits = l.select("l_orderkey", (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("rank"), F.when(F.col("l_linenumber") % 2 == 0, "phonetic").otherwise("exact").alias("mode"), (F.col("l_quantity") * 2).alias("score"), F.when(F.col("l_partkey") % 3 != 0, F.col("l_extendedprice") / 1000).alias("confidence"), (F.col("l_suppkey") % 2 == 0).alias("has_geom"), F.col("l_partkey").alias("place_id"))
    a, b = (records.parent_under(hits, ["l_orderkey"], areal).select("l_orderkey", F.col("place_id").alias(name)) for areal, name in ((True, "areal"), (False, "any_kind")))
    return l.select("l_orderkey").distinct().join(a, "l_orderkey", "left").join(b, "l_orderkey", "left")


@query("""WITH b AS (SELECT l_orderkey, arg_max(l_partkey, (coalesce(CASE WHEN l_partkey % 3 <> 0 THEN l_extendedprice END, 0), -(l_linenumber * 1000000 + l_partkey))) AS place_id FROM lineitem WHERE l_suppkey % 2 = 0 GROUP BY 1)
SELECT l_orderkey, place_id, coalesce(p_size > 25, false) AS applied FROM b LEFT JOIN part ON p_partkey = place_id""")
def by_confidence(spark: SparkSession, d: str) -> DataFrame:
    hits = table(spark, d, "lineitem").select("l_orderkey", (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("rank"), F.when(F.col("l_partkey") % 3 != 0, F.col("l_extendedprice")).alias("confidence"), (F.col("l_suppkey") % 2 == 0).alias("has_geom"), F.col("l_partkey").alias("place_id"))
    usable = table(spark, d, "part").select(F.col("p_partkey").alias("place_id"), (F.col("p_size") > 25).alias("applied"))
    return records.by_confidence(hits, ["l_orderkey"], usable).select("l_orderkey", "place_id", "applied")


@query("""WITH p AS (SELECT c_custkey AS place_id, c_name AS query, CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS ccode, list_transform(range(c_custkey % 4), lambda i: 'W' || (c_nationkey + i)) AS parents FROM customer)
SELECT place_id, '1-exact-in' AS pass, query, 'exact' AS mode, ccode, parents[len(parents)] AS contained_in FROM p WHERE len(parents) >= 1
UNION ALL SELECT place_id, '3-phon-broad', query, 'phonetic', ccode, parents[len(parents) - 1] FROM p WHERE len(parents) >= 2 UNION ALL SELECT place_id, '4-phon-cc', query, 'phonetic', ccode, NULL FROM p""")
def request_shapes(spark: SparkSession, d: str) -> DataFrame:
    """Requests of three passes: within the narrowest parent, the next broader one, or the country alone."""
    n = F.col("c_nationkey")
    parents = F.transform(F.filter(F.array(*map(F.lit, (0, 1, 2))), lambda i: i < F.col("c_custkey") % 4), lambda i: F.concat(F.lit("W"), (n + i).cast("string")))
    p = table(spark, d, "customer").select(F.col("c_custkey").alias("place_id"), F.col("c_name").alias("name"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")).alias("country_code"), parents.alias("parents"))
    out = [records.requests(p, *x) for x in (("1-exact-in", "exact", "narrow"), ("3-phon-broad", "phonetic", "broad"), ("4-phon-cc", "phonetic", "none"))]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query("""WITH l AS (SELECT user_id AS sig, arg_max(event_type, event_id) AS action, arg_max(event_id, event_id) AS e FROM events GROUP BY 1), j AS (SELECT c_custkey, c_name, coalesce(CASE action WHEN 'view' THEN 'keep' WHEN 'click' THEN 'split' WHEN 'purchase' THEN 'edit' WHEN 'error' THEN 'reject' ELSE CASE WHEN action IS NOT NULL THEN 'merge' END END, 'keep') AS action, e FROM customer LEFT JOIN l ON sig = c_custkey)
SELECT c_custkey, 0 AS part, CASE WHEN action = 'keep' THEN c_name ELSE 'N' || e END AS headword, action FROM j WHERE action <> 'reject' UNION ALL SELECT c_custkey, 1, 'M' || e, action FROM j WHERE action = 'split'""")
def decision_actions(spark: SparkSession, d: str) -> DataFrame:
    """Entries after the latest decision on each: kept, split, edited, merged or rejected."""
    kind = F.col("event_type")
    action = F.when(kind == "view", "keep").when(kind == "click", "split").when(kind == "purchase", "edit").when(kind == "error", "reject").otherwise("merge")
    e = F.col("event_id").cast("string")
    made = table(spark, d, "events").select(F.col("user_id").alias("sig"), action.alias("action"), F.array(F.concat(F.lit("N"), e), F.concat(F.lit("M"), e)).alias("payload"), "event_id")
    rows = table(spark, d, "customer").select("c_custkey", F.col("c_custkey").alias("sig"), F.col("c_name").alias("headword"))
    return records.as_decided(rows, made, "sig", "event_id").select("c_custkey", "part", "headword", "action")


@query("""WITH a AS (SELECT l_orderkey AS custom_id, arg_max(l_partkey, (l_linenumber, l_partkey, l_returnflag)) AS p, arg_max(l_returnflag, (l_linenumber, l_partkey, l_returnflag)) AS f FROM lineitem GROUP BY 1)
SELECT o_orderkey AS custom_id, CASE WHEN f <> 'R' THEN p::VARCHAR END AS response, CASE WHEN f IS NULL THEN 'missing' WHEN f = 'R' THEN 'failed' ELSE 'answered' END AS state FROM orders LEFT JOIN a ON custom_id = o_orderkey""")
def batch_collect(spark: SparkSession, d: str) -> DataFrame:
    failed = F.col("l_returnflag") == "R"
    answers = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("custom_id"), F.when(~failed, F.col("l_partkey").cast("string")).alias("response"), F.when(failed, "limit").alias("error"), F.struct("l_linenumber", "l_partkey", "l_returnflag").alias("arrived"))
    return records.collected(table(spark, d, "orders").select(F.col("o_orderkey").alias("custom_id")), answers)


@query("""WITH c AS (SELECT l_orderkey, count(*) AS n_near FROM lineitem WHERE l_quantity <= 20 GROUP BY 1)
SELECT o_orderkey, CASE WHEN o_custkey % 3 = 0 THEN 'match' ELSE 'review' END AS label, CASE WHEN o_custkey % 3 = 1 THEN n_near END AS n_near FROM orders LEFT JOIN c ON l_orderkey = o_orderkey""")
def refined_absent(spark: SparkSession, d: str) -> DataFrame:
    judged = table(spark, d, "orders").select("o_orderkey", F.get(F.array(*map(F.lit, ("match", "absent", "review"))), (F.col("o_custkey") % 3).cast("int")).alias("label"))
    near = table(spark, d, "lineitem").where("l_quantity <= 20").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n_near"))
    return records.refined(judged, near, "o_orderkey")


@query("SELECT CASE WHEN l_returnflag = 'N' THEN 'none' WHEN l_quantity < 5 THEN 'unlocated' WHEN l_quantity <= 25 THEN 'near' ELSE 'far' END AS class, count(*) AS n FROM lineitem GROUP BY 1")
def distance_classes(spark: SparkSession, d: str) -> DataFrame:
    km = F.when(F.col("l_quantity") >= 5, F.col("l_quantity"))
    return table(spark, d, "lineitem").groupBy(records.distance_class(km, F.col("l_returnflag") != "N", 25.0).alias("class")).agg(F.count("*").alias("n"))


@query("""SELECT c_custkey AS place_id, c_name AS name, n_name AS alias, CASE WHEN c_custkey % 2 = 0 THEN 'verified' ELSE 'rejected_by_coordinate' END AS status, round(CASE WHEN c_custkey % 7 <> 0 THEN c_acctbal / 70 END, 3) AS km FROM customer JOIN nation ON n_nationkey = c_nationkey""")
def alias_rows(spark: SparkSession, d: str) -> DataFrame:
    both = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    k = F.col("c_custkey")
    return records.alias_rows(both.select(k.alias("place_id"), F.col("c_name").alias("printed"), F.col("n_name").alias("alias"), F.when(k % 2 == 0, "verified").otherwise("rejected_by_coordinate").alias("status"), F.when(k % 7 != 0, F.col("c_acctbal") / 70).alias("km")), "printed", "alias")


@query("""WITH p AS (SELECT c_custkey, c_acctbal > 0 AND c_custkey % 3 <> 0 AS usable, c_nationkey < 20 AS inside FROM customer)
SELECT (SELECT count(*) FROM p WHERE usable AND inside) AS size, (SELECT count(*) FROM p WHERE usable AND NOT inside) AS dropped, c_custkey FROM p WHERE usable AND inside ORDER BY md5('3:' || c_custkey) LIMIT 25""")
def cohort(spark: SparkSession, d: str) -> DataFrame:
    """Twenty-five places drawn by a seed, and how many there were to draw from and how many fell outside."""
    drawn, counts = records.cohort(table(spark, d, "customer"), "c_custkey", (F.col("c_acctbal") > 0) & (F.col("c_custkey") % 3 != 0), F.col("c_nationkey") < 20, 25, "3:")
    return drawn.select("c_custkey").crossJoin(F.broadcast(counts))  # one row is broadcast


@query("SELECT c_mktsegment, max(c_acctbal) AS worst, arg_max(c_name, (c_acctbal, -c_custkey)) AS headline FROM customer WHERE c_custkey % 2 = 0 GROUP BY 1")
def headline(spark: SparkSession, d: str) -> DataFrame:
    """Of each group's pilot rows the one that is farthest off."""
    pilot = table(spark, d, "customer").withColumn("pilot", F.col("c_custkey") % 2 == 0)
    return pilot.groupBy("c_mktsegment").agg(F.max(F.when(F.col("pilot"), F.col("c_acctbal"))).alias("worst"), F.max_by("c_name", F.when(F.col("pilot"), F.struct(F.col("c_acctbal"), -F.col("c_custkey")))).alias("headline")).where("worst IS NOT NULL")


@query("SELECT l_orderkey, string_agg(l_linenumber || ':' || l_partkey, '|' ORDER BY l_linenumber, l_partkey) AS tables, count(*) AS n FROM lineitem GROUP BY 1")
def tables_by_entry(spark: SparkSession, d: str) -> DataFrame:
    got = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("x"), F.count("*").alias("n"))
    return got.select("l_orderkey", F.array_join(F.transform("x", lambda r: F.concat(r["l_linenumber"].cast("string"), F.lit(":"), r["l_partkey"].cast("string"))), "|").alias("tables"), "n")


@query("SELECT doc_id, 'https://example.org/pt?id=' || CASE source WHEN 'src0' THEN 'x.000' WHEN 'src1' THEN 'x.001' END || '?seq=' || CASE WHEN n_chars % 3 <> 0 THEN n_chars % 500 END AS link FROM documents")
def deep_links(spark: SparkSession, d: str) -> DataFrame:
    image = F.when(F.col("n_chars") % 3 != 0, F.col("n_chars") % 500)
    return table(spark, d, "documents").select("doc_id", records.deep_link({"src0": "x.000", "src1": "x.001"}, F.col("source"), image, "https://example.org/pt?id=").alias("link"))


@query("SELECT p_brand, p_brand || ': ' || string_agg(p_partkey || ' ' || p_name, '; ' ORDER BY p_partkey) AS line FROM part GROUP BY p_brand")
def class_blocks(spark: SparkSession, d: str) -> DataFrame:
    return records.class_block(table(spark, d, "part"), "p_brand", "p_partkey", "p_name")


@query("SELECT o_orderkey, o_custkey, 'P' || o_custkey AS name FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def from_cache(spark: SparkSession, d: str) -> DataFrame:
    """Results had from the cache alone: a request that is not in it gives nothing."""
    cache = table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("name"))
    return table(spark, d, "orders").select("o_orderkey", "o_custkey").join(cache, "o_custkey").select("o_orderkey", "o_custkey", "name")


@query("""SELECT doc_id, array_to_string(list_filter([CASE WHEN length(k) <= 3 THEN 'short' END, CASE WHEN NOT regexp_matches(k, '[AEIOUY]') THEN 'no_vowel' END, CASE WHEN length(text) < 35 THEN 'stub' END, CASE WHEN length(text) > 40000 THEN 'runaway' END,
CASE WHEN regexp_matches(k, 'AAA|EEE|III|OOO|TTT|NNN|SSS|RRR|HHH') THEN 'repeated' END, CASE WHEN regexp_matches(h, '\\d') THEN 'digits' END], lambda x: x IS NOT NULL), ',') AS flags FROM (SELECT doc_id, text, h, regexp_replace(upper(replace(h, 'ß', 'ss')), '[^A-Z]', '', 'g') AS k FROM (SELECT doc_id, text, regexp_extract(text, '^\\S+') || CASE WHEN doc_id % 6 = 0 THEN '7' ELSE '' END AS h FROM documents))""")
def entry_flags(spark: SparkSession, d: str) -> DataFrame:
    """What is odd about an entry from itself: its first word as headword, its text as body."""
    head = F.concat(F.regexp_extract("text", r"^\S+", 0), F.when(F.col("doc_id") % 6 == 0, "7").otherwise(""))
    return table(spark, d, "documents").select("doc_id", F.array_join(Q.intrinsic_flags(head, F.col("text")), ",").alias("flags"))


# ---------------------------------------------------------------- artefacts


@query("SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 'open' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_totalprice <= 200000 THEN o_custkey END AS o_custkey FROM orders")
def reset_rows(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_custkey", "o_totalprice")
    return artefacts.reset(o, F.col("o_totalprice") > 200000, ["o_custkey"], o_orderstatus=F.lit("open")).drop("o_totalprice")


@query("""SELECT c_nationkey, '[' || arg_max(round(lon, 5), (c_name, c_custkey)) || ',' || arg_max(round(lat, 5), (c_name, c_custkey)) || ',' || arg_max(c_custkey, (c_name, c_custkey)) || ']' AS point FROM (SELECT *, (c_custkey * 53 % 361 - 180)::DOUBLE AS lon, (c_custkey * 37 % 181 - 90)::DOUBLE AS lat FROM customer) GROUP BY 1""")
def id_points(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    rows = table(spark, d, "customer").select("c_nationkey", "c_custkey", "c_name", (F.pmod(k * 53, F.lit(361)) - 180).cast("double").alias("lon"), (F.pmod(k * 37, F.lit(181)) - 90).cast("double").alias("lat"))
    return artefacts.id_points(rows, "c_nationkey", "lon", "lat", "c_custkey", ["c_name", "c_custkey"])


@query("""SELECT '{"type":"Feature","geometry":{"type":"' || CASE WHEN s_suppkey % 2 = 0 THEN 'LineString' ELSE 'Polygon' END || '","coordinates":' || CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE '[' END || '[[' || (s_suppkey % 90)::DOUBLE || ',0.0],[' || (s_suppkey % 90)::DOUBLE || ',1.0],[0.0,' || (s_suppkey % 45)::DOUBLE || ']]' || CASE WHEN s_suppkey % 2 = 0 THEN '' ELSE ']' END || '},"properties":{"id":' || s_suppkey || ',"name":"' || s_name || '"}}' AS feature FROM supplier""")
def shape_features(spark: SparkSession, d: str) -> DataFrame:
    """Lines and areas as GeoJSON."""
    k = F.col("s_suppkey")
    x, y, zero, one = (k % 90).cast("double"), (k % 45).cast("double"), F.lit(0.0), F.lit(1.0)
    ring = F.array(F.array(x, zero), F.array(x, one), F.array(zero, y))
    return table(spark, d, "supplier").select(artefacts.shape_feature(F.when(k % 2 == 0, "LineString").otherwise("Polygon"), F.array(ring), id=k, name=F.col("s_name")).alias("feature"))


@query("""WITH e AS (SELECT p_brand, p_partkey, p_name, p_size, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS pos FROM part), c AS (SELECT *, pos // 15 AS chunk, upper(left(p_name, 1)) AS letter FROM e),
l AS (SELECT p_brand, chunk, letter, count(*) AS n, min(pos) AS seen FROM c GROUP BY ALL), t AS (SELECT p_brand, chunk, arg_max(letter, (n, -seen)) AS letter FROM l GROUP BY ALL)
SELECT c.p_brand, c.chunk::INT AS chunk, count(*) AS n, arg_min(p_name, pos) AS first_head, arg_max(p_name, pos) AS last_head, min(p_size) AS first_page, max(p_size) AS last_page, any_value(t.letter) AS letter FROM c JOIN t ON t.p_brand = c.p_brand AND t.chunk = c.chunk GROUP BY 1, 2""")
def reader_index(spark: SparkSession, d: str) -> DataFrame:
    return artefacts.reader_index(table(spark, d, "part"), "p_brand", "p_partkey", "p_size", "p_name", 15)


@query("""WITH r AS (SELECT c_nationkey, c_custkey, c_name, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal <= 0, c_name, c_custkey) - 1) AS pos FROM customer)
SELECT c_nationkey, (pos // 5)::INT AS shard, count(*)::INT AS n, '[' || string_agg('{"c_nationkey":' || c_nationkey || ',"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"}', ',' ORDER BY pos) || ']' AS json FROM r GROUP BY 1, 2""")
def review_shards(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").select("c_nationkey", "c_custkey", "c_name", "c_acctbal")
    at = artefacts.chunked(c, [(F.col("c_acctbal") <= 0).asc(), "c_name", "c_custkey"], 5, ["c_nationkey"]).select("c_nationkey", "c_custkey", "c_name", F.col("pos").alias("place"))
    return artefacts.review_shards(at, [F.col("place").asc()], ["c_nationkey"], 5).select("c_nationkey", "shard", "n", F.regexp_replace("json", ',"place":\\d+', "").alias("json"))


@query("""SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'verified' ELSE 'rejected' END AS part, '{"c_custkey":' || c_custkey || ',"status":"' || CASE WHEN c_custkey % 3 = 0 THEN 'verified' ELSE 'rejected_by_coordinate' END || '"}' AS json FROM customer WHERE c_custkey % 3 <> 2""")
def bridge_rows(spark: SparkSession, d: str) -> DataFrame:
    status = F.get(F.array(*map(F.lit, ("verified", "rejected_by_coordinate", "unverifiable_no_coordinate"))), (F.col("c_custkey") % 3).cast("int"))
    return artefacts.bridge_rows(table(spark, d, "customer").select("c_custkey", status.alias("status")), "c_custkey")


@query("""WITH p AS (SELECT (c_custkey * 53 % 361 - 180)::DOUBLE AS lon, greatest(-85.0511, least(85.0511, (c_custkey * 37 % 181 - 90)::DOUBLE)) AS lat, (c_custkey * 37 % 181 - 90)::DOUBLE AS y0 FROM customer), f AS (SELECT lon, y0 AS lat, floor((lon + 180) / 360 * 256)::INT AS x, floor((1 - ln(tan(radians(lat)) + 1 / cos(radians(lat))) / pi()) / 2 * 256)::INT AS y FROM p)
SELECT 3 AS zoom, (x // 32)::INT AS x, (y // 32)::INT AS y, round(avg(lon), 6) AS lon, round(avg(lat), 6) AS lat, count(*) AS n FROM f GROUP BY f.x, f.y""")
def tile_clusters(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    rows = table(spark, d, "customer").select((F.pmod(k * 53, F.lit(361)) - 180).cast("double").alias("lon"), (F.pmod(k * 37, F.lit(181)) - 90).cast("double").alias("lat"))
    return artefacts.clustered(rows, "lon", "lat", 3).select("zoom", "x", "y", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"), "n")


@query("SELECT epoch_us(s) AS start_us, event_type, count(*) AS n FROM (SELECT event_type, unnest([time_bucket(INTERVAL 6 HOUR, ts), time_bucket(INTERVAL 6 HOUR, ts) - INTERVAL 6 HOUR]) AS s FROM events) GROUP BY ALL")
def sliding_counts(spark: SparkSession, d: str) -> DataFrame:
    """Counts in windows of twelve hours that start every six."""
    w = windows.sliding_counts(table(spark, d, "events"), "ts", "12 hours", "6 hours", ["event_type"])
    return w.select(F.unix_micros(F.col("window_start").cast("timestamp")).alias("start_us"), "event_type", "n")


@query("SELECT user_id, count(*) AS n, count(*) FILTER (event_type = 'error') AS n_failed FROM events GROUP BY 1 HAVING count(*) >= 5 AND count(*) FILTER (event_type = 'error') > 0.2 * count(*)")
def health_alarm(spark: SparkSession, d: str) -> DataFrame:
    return windows.alarm(table(spark, d, "events"), ["user_id"], F.col("event_type") == "error", 5, 0.2)


@query()
def cascade_by_sound(spark: SparkSession, d: str) -> DataFrame:
    """Customers as places, suppliers as the index: exact and phonetic passes by scope, points for those that print them."""
    names = F.array(*map(F.lit, ("Keangsu", "Tchili", "Gwalior", "Phillipi", "Bathe", "Kanton", "Shansee")))
    heard = F.array(*map(F.lit, ("Keang-su", "Chili", "Gwaliyor", "Filipi", "Bath", "Canton", "Shansi")))
    c, s = F.col("c_custkey"), F.col("s_suppkey")
    parents = lambda k, n: F.when(k % 4 != 0, F.array(F.concat(F.lit("R"), (n % 5).cast("string")), F.concat(F.lit("N"), n.cast("string")))).otherwise(F.array().cast("array<string>"))
    printed = c % 6 == 0
    places = table(spark, d, "customer").select(c.alias("place_id"), F.get(names, (c % 7).cast("int")).alias("name"), F.concat(F.lit("C"), (F.col("c_nationkey") % 5).cast("string")).alias("country_code"), parents(c, F.col("c_nationkey")).alias("parents"), F.when(printed, (c % 60).cast("double")).alias("lat"), F.when(printed, (c % 100).cast("double")).alias("lon"))
    index = table(spark, d, "supplier").select(s.alias("place_id"), F.get(heard, (s % 7).cast("int")).alias("title"), F.concat(F.lit("C"), (F.col("s_nationkey") % 5).cast("string")).alias("country_code"), F.array(F.concat(F.lit("R"), (F.col("s_nationkey") % 5).cast("string")), F.concat(F.lit("N"), F.col("s_nationkey").cast("string"))).alias("parents"), (20.0 + s % 80).alias("confidence"), (s % 2 == 0).alias("has_geom"), (s % 60).cast("double").alias("lat"), (s % 100).cast("double").alias("lon"))
    return phonetic.reconciled(places, index, keep=stored)


@query("SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'fresh' ELSE 'stored' END AS kind FROM pages UNION ALL SELECT -1 - n_nationkey, 'seed' FROM nation")
def seeded_rows(spark: SparkSession, d: str) -> DataFrame:
    """Seed rows put in anew: those stored under their status go, the others stay, and pages read again replace the stored ones."""
    pages = table(spark, d, "pages").select("page_id", F.lit("stored").alias("kind"))
    fresh = table(spark, d, "pages").where("page_id % 4 = 0").select("page_id", F.lit("fresh").alias("kind"))
    seeds = table(spark, d, "nation").select((-1 - F.col("n_nationkey")).cast("bigint").alias("page_id"), F.lit("seed").alias("kind"))
    stored = pages.unionByName(seeds)
    return sinks.replaced(sinks.replaced(stored, fresh, ["page_id"]).where("kind <> 'seed'"), seeds, ["page_id"])
