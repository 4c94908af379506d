"""Queries over chains, page numbering, anchors, look-ups and the smaller exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import docstream, joins, layout, search, similar
from ..session import table
from ..sources import sinks
from .registry import query


CHAIN = ["concat('region', c_nationkey % 5)", "concat('Nation', c_nationkey)", "upper(concat('region', c_nationkey % 5))", "concat(' Nation', c_nationkey)", "concat(CASE c_custkey % 3 WHEN 0 THEN '' ELSE 'Seg ' END, 'Nation', c_nationkey)"]


@query(f"""WITH n AS (SELECT c_custkey, [{", ".join(CHAIN)}] AS names FROM customer), k AS (SELECT *, list_transform(names, lambda x: trim(regexp_replace(lower(x), '\\s+', ' ', 'g'))) AS keys FROM n)
SELECT c_custkey, array_to_string(list_transform(list_filter(range(1, 6), lambda i: list_position(keys, keys[i]) = i), lambda i: names[i]), ' > ') AS chain FROM k""")
def tidy_chain(spark: SparkSession, d: str) -> DataFrame:
    """A chain of names without repeats that differ in case or blanks only; the first of each is kept, in order."""
    return table(spark, d, "customer").select("c_custkey", T.distinct_names(F.array(*map(F.expr, CHAIN))).alias("names")).select("c_custkey", F.array_join("names", " > ").alias("chain"))


@query("SELECT c_nationkey, c_mktsegment, min(c_custkey) AS first_key, count(*) AS n FROM customer WHERE NOT regexp_matches(c_name, '^Q[0-9]+$') GROUP BY ALL")
def pick_list(spark: SparkSession, d: str) -> DataFrame:
    """Candidates without bare identifiers, one of each title and group (the first)."""
    c = table(spark, d, "customer").where(~F.col("c_name").rlike("^Q[0-9]+$"))
    return c.groupBy("c_nationkey", "c_mktsegment").agg(F.min("c_custkey").alias("first_key"), F.count("*").alias("n"))


@query("""WITH p AS (SELECT s_suppkey AS idx, CASE WHEN s_suppkey % 4 <> 0 THEN s_suppkey + 8 + s_suppkey // 50 END AS printed FROM supplier), s AS (SELECT unnest(range(min(printed), max(printed) + 1)) AS printed FROM p)
SELECT printed FROM s WHERE printed NOT IN (SELECT printed FROM p WHERE printed IS NOT NULL)""")
def missing_pages(spark: SparkSession, d: str) -> DataFrame:
    """Printed numbers between the first and the last that no page has."""
    k = F.col("s_suppkey")
    p = table(spark, d, "supplier").select(F.when(k % 4 != 0, k + 8 + F.floor(k / 50)).alias("printed")).where("printed IS NOT NULL")
    ends = p.agg(F.min("printed").alias("a"), F.max("printed").alias("b")).first()  # two numbers; the range between them is made by tasks
    every = spark.range(ends["a"] or 0, (ends["b"] if ends["b"] is not None else -1) + 1).toDF("printed")
    return every.join(p, "printed", "left_anti")


@query("""WITH v AS (SELECT user_id, min(event_id) AS first, max(event_id) AS last, arg_min(event_type, event_id) AS head, arg_max(event_type, event_id) AS tail FROM events GROUP BY user_id)
SELECT user_id, first, last, head, tail, lead(first) OVER (ORDER BY first) - last AS gap FROM v""")
def volume_coverage(spark: SparkSession, d: str) -> DataFrame:
    """First and last of each volume and the gap to the next one (negative: overlap). No task holds all volumes."""
    v = table(spark, d, "events").groupBy("user_id").agg(F.min("event_id").alias("first"), F.max("event_id").alias("last"), F.min_by("event_type", "event_id").alias("head"), F.max_by("event_type", "event_id").alias("tail"))
    return joins.with_next(v, "first", "next").select("user_id", "first", "last", "head", "tail", (F.col("next") - F.col("last")).alias("gap"))


@query("SELECT doc_id, instr(lower(text), 'tion') AS at, CASE WHEN instr(lower(text), 'tion') > 0 THEN substr(text, greatest(instr(lower(text), 'tion') - 20, 1), 44) END AS snippet FROM documents")
def snippets(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", F.instr(F.lower(t), "tion").cast("bigint").alias("at"), search.snippet(t, F.lit("tion"), 20).alias("snippet"))


@query("""WITH w AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS word FROM part), q AS (SELECT word AS asked, CASE WHEN length(word) <= 2 THEN 0 WHEN length(word) <= 5 THEN 1 ELSE 2 END AS most FROM w)
SELECT asked, word, levenshtein(asked, word)::INT AS edits FROM q JOIN w ON asked <> word WHERE levenshtein(asked, word) <= most""")
def fuzzy_words_all(spark: SparkSession, d: str) -> DataFrame:
    """Words within the edits their length allows, whatever their first letters."""
    return similar.within_edits(table(spark, d, "part").select(F.explode(F.split("p_name", " ")).alias("word")), "word", search.edit_limit)


@query("SELECT p_partkey, p_name FROM part WHERE starts_with(lower(p_name), (SELECT left(lower(min(p_name)), 3) FROM part)) ORDER BY p_name, p_partkey LIMIT 3")
def prefix_lookup(spark: SparkSession, d: str) -> DataFrame:
    p = table(spark, d, "part").select("p_partkey", "p_name")
    first = p.agg(F.left(F.lower(F.min("p_name")), F.lit(3)).alias("prefix"))
    return p.join(F.broadcast(first), F.startswith(F.lower("p_name"), F.col("prefix"))).orderBy("p_name", "p_partkey").limit(3).select("p_partkey", "p_name")  # one row is broadcast


@query("""WITH p AS (SELECT p_partkey, p_brand, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) - 1 AS pos FROM part)
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN (p_partkey % 9)::INT ELSE (pos // 150)::INT END AS chunk FROM p""")
def locator(spark: SparkSession, d: str) -> DataFrame:
    """Where a row is read: the chunk its file says, else its place divided by the chunk size."""
    p = search.chunked(table(spark, d, "part"), ["p_partkey"], 150, ["p_brand"])
    said = table(spark, d, "part").where("p_partkey % 3 = 0").select("p_partkey", (F.col("p_partkey") % 9).cast("int").alias("said"))
    return p.join(said, "p_partkey", "left").select("p_partkey", F.coalesce("said", "chunk").alias("chunk"))


@query("""WITH t AS (SELECT doc_id, string_split(text, ' ') AS w FROM documents), x AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS token FROM t),
a AS (SELECT doc_id, min(pos) AS at FROM x WHERE length(token) >= 8 GROUP BY doc_id)
SELECT a.doc_id, a.at::INT AS at, arg_max(x.token, (length(x.token), -x.pos)) AS best FROM a JOIN x ON x.doc_id = a.doc_id AND x.pos BETWEEN a.at AND a.at + 3 GROUP BY ALL""")
def anchor_search(spark: SparkSession, d: str) -> DataFrame:
    """The first long token of each stream, and the longest of the four from there: all within the row."""
    w = table(spark, d, "documents").select("doc_id", F.split("text", " ", -1).alias("w"))
    at = F.array_position(F.transform("w", lambda x: F.length(x) >= 8), True)
    part = F.transform(F.slice("w", F.col("at"), F.lit(4)), lambda x, i: F.struct(F.length(x).alias("n"), (-i).alias("i"), x.alias("x")))
    return w.withColumn("at", at.cast("int")).where("at > 0").select("doc_id", "at", F.array_max(part)["x"].alias("best"))


@query("""WITH h AS (SELECT doc_id, text, substr(text, 1, 1400) AS head FROM documents), c AS (SELECT *, regexp_extract(head, '^([\\s\\S]*[.!?])\\s', 1) AS cut FROM h),
t AS (SELECT doc_id, CASE WHEN length(text) <= 1400 THEN text WHEN length(cut) >= 700 THEN cut ELSE head || '…' END AS shown FROM c)
SELECT doc_id, length(shown) AS n, sha256(shown) AS shown_sha256 FROM t""")
def sentence_trim(spark: SparkSession, d: str) -> DataFrame:
    shown = T.trim_sentence(F.col("text"), 1400)
    return table(spark, d, "documents").select("doc_id", F.length(shown).cast("bigint").alias("n"), F.sha2(shown.cast("binary"), 256).alias("shown_sha256"))


SCRIPT_NAME = "CASE s_suppkey % 7 WHEN 0 THEN concat('Lyon ', s_suppkey) WHEN 1 THEN 'Lyon 里昂' WHEN 2 THEN 'Лион x' WHEN 3 THEN 'ليون' WHEN 4 THEN '12 とう' WHEN 5 THEN 'Αθήνα' ELSE s_name END"
SCRIPTS_SQL = " ".join(f"WHEN regexp_matches(letter, '\\p{{{p}}}') THEN '{n}'" for n, p in (("Han", "Han"), ("Kana", "Hiragana"), ("Katakana", "Katakana"), ("Hangul", "Hangul"), ("Cyrillic", "Cyrillic"), ("Arabic", "Arabic"), ("Greek", "Greek"), ("Hebrew", "Hebrew"), ("Devanagari", "Devanagari"), ("Thai", "Thai")))


@query(f"SELECT s_suppkey, CASE WHEN letter = '' THEN 'Latin' {SCRIPTS_SQL} ELSE 'Other' END AS script FROM (SELECT s_suppkey, regexp_extract({SCRIPT_NAME}, '[^\\P{{L}}\\p{{Latin}}]') AS letter FROM supplier)")
def scripts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").select("s_suppkey", T.script_of(F.expr(SCRIPT_NAME)).alias("script"))


OURS, THEIRS = "concat(upper(c_mktsegment), ' (LAKE)')", "CASE c_custkey % 4 WHEN 0 THEN concat('Lake ', c_mktsegment) WHEN 1 THEN concat('Mount ', c_mktsegment, ' or lake ', c_mktsegment) WHEN 2 THEN concat(c_mktsegment, '; Hill') ELSE concat('Lakes, ', c_mktsegment) END"
KEYS_SQL = "list_filter(list_transform(string_split_regex(upper({}), '\\s+OR\\s+|;'), lambda v: array_to_string(list_sort(list_filter(string_split_regex(regexp_replace(v, '[^A-Z ]', ' ', 'g'), ' +'), lambda t: t <> '')), ' ')), lambda k: k <> '')"


@query(f"SELECT c_custkey, list_has_any({KEYS_SQL.format(OURS)}, {KEYS_SQL.format(THEIRS)}) AS same FROM customer")
def heading_agreement(spark: SparkSession, d: str) -> DataFrame:
    """Headings agree if any of their keys do, whatever the order of their words."""
    return table(spark, d, "customer").select("c_custkey", F.arrays_overlap(T.heading_keys(F.expr(OURS)), T.heading_keys(F.expr(THEIRS))).alias("same"))


@query("SELECT l_orderkey, ((min(l_suppkey) * 90) % 360)::INT AS rotation FROM (SELECT l_orderkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, (l_suppkey * 90) % 360, l_suppkey) AS r FROM (SELECT l_orderkey, l_suppkey % 4 AS l_suppkey, sum(l_quantity) AS l_quantity FROM lineitem GROUP BY ALL)) WHERE r = 1 GROUP BY l_orderkey")
def page_rotation(spark: SparkSession, d: str) -> DataFrame:
    """The rotation under which a page's texts are longest, weighted by confidence."""
    scored = table(spark, d, "lineitem").select("l_orderkey", ((F.col("l_suppkey") % 4) * 90 % 360).cast("int").alias("rotation"), F.lit("x").alias("text"), F.col("l_quantity").alias("confidence"))
    return layout.best_rotation(scored, "l_orderkey")


@query("""WITH s AS (SELECT o_custkey, o_orderkey FROM orders WHERE o_orderkey % 3 = 0), f AS (SELECT o_custkey, o_orderkey FROM orders WHERE o_orderkey % 3 <> 0)
SELECT * FROM s UNION ALL SELECT o_custkey, min(o_orderkey) FROM f WHERE o_custkey NOT IN (SELECT o_custkey FROM s) GROUP BY o_custkey""")
def insert_or_ignore(spark: SparkSession, d: str) -> DataFrame:
    """A table with a unique key, and rows of which each new key enters once, by its least order; the two together are all orders."""
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey")
    return sinks.added(o.where("o_orderkey % 3 = 0"), o.where("o_orderkey % 3 <> 0"), ["o_custkey"])


@query("""SELECT c_custkey, c_nationkey, floor(((c_custkey * 53) % 361) / 360.0 * 8)::DOUBLE AS tile_x FROM customer""")
def map_tiles_all(spark: SparkSession, d: str) -> DataFrame:
    """The column of tiles that holds each customer's point."""
    k = F.col("c_custkey")
    lon, lat = (F.pmod(k * 53, F.lit(361)) - 180).cast("double"), (F.pmod(k * 37, F.lit(181)) - 90).cast("double")
    return table(spark, d, "customer").select("c_custkey", "c_nationkey", search.tile_of(lon, lat, 3)["x"].cast("double").alias("tile_x"))


@query("""WITH b AS (SELECT conv_id, count(*)::INT AS n_pages, string_agg(coalesce(text, ''), chr(12) ORDER BY turn) AS body FROM conversations GROUP BY conv_id),
t AS (SELECT conv_id, n_pages, '<!-- merge: pages=' || n_pages || ' sha256=' || sha256(body)[1:16] || ' -->' || chr(10) || body AS text FROM b)
SELECT conv_id, n_pages, length(text)::INT AS n_chars, sha256(text) AS sha256 FROM t""")
def merged_volumes(spark: SparkSession, d: str) -> DataFrame:
    """Each conversation's texts merged as pages, with the digest line."""
    c = table(spark, d, "conversations").select("conv_id", F.col("turn").alias("page"), F.coalesce("text", F.lit("")).alias("body"))
    return docstream.merged_text(c, "conv_id", "page", "body").select("conv_id", "n_pages", F.length("text").alias("n_chars"), F.sha2(F.col("text").cast("binary"), 256).alias("sha256"))
