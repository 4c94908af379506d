"""Queries over text: segmentation, normal forms, markers, nested values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import docstream, joins
from ..session import table
from .registry import query

LINES_SQL = """WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(range(1, len(parts) + 1)) AS line_no, unnest(parts) AS line FROM split)"""


@query(LINES_SQL + """, seg AS (
  SELECT *, sum(CASE WHEN length(line) <= 40 AND ends_with(line, '.') THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS seg FROM lines)
SELECT doc_id, seg::BIGINT AS seg, count(*) AS n_lines, min(line_no)::INT AS first_line, sum(length(line))::BIGINT AS n_chars FROM seg GROUP BY ALL""")
def segment_stateless(spark: SparkSession, d: str) -> DataFrame:
    rows = docstream.lines(table(spark, d, "documents"), "doc_id")
    starts = (F.length("line") <= 40) & F.endswith("line", F.lit("."))
    cut = docstream.segments(rows, ["doc_id"], starts)
    return cut.groupBy("doc_id", "seg").agg(F.count("*").alias("n_lines"), F.min("line_no").cast("int").alias("first_line"), F.sum(F.length("line")).cast("bigint").alias("n_chars"))


@query()
def segment_fold(spark: SparkSession, d: str) -> DataFrame:
    """Entries of every document as a volume; capitals and commas are put at line starts so that the grammar has headwords to find."""
    docs = table(spark, d, "documents").select("doc_id", F.regexp_replace("text", r"(?m)^(\p{Lu}\p{L}{2,}) (\p{Ll})", "\\U$1, $2").alias("text"))
    head = F.regexp_replace(F.col("text"), r"\\U", "")
    marked = F.array_join(F.transform(F.split(head, "\n"), lambda x: F.when(x.rlike(r"^\p{L}{3,}, "), F.concat(F.upper(F.substring_index(x, ",", 1)), x.substr(F.instr(x, ","), F.length(x)))).otherwise(x)), "\n")
    return docstream.fold_entries(docs.select("doc_id", marked.alias("text")), "doc_id").select("doc_id", "seq", "kind", "headword", "headword_disp", "see_target", "n_also", F.length("text").alias("n_chars"))


@query()
def clean_text_basic(spark: SparkSession, d: str) -> DataFrame:
    noisy = F.concat(F.col("text"), F.lit("\nPPPPPPPPPP -01-02-03-04 Digitized by Google"))
    return table(spark, d, "documents").select("doc_id", F.sha2(T.scrub(noisy).cast("binary"), 256).alias("clean_sha256"))


@query(LINES_SQL + """, h AS (SELECT doc_id, line_no, regexp_replace(line, '(\\p{Ll})[.,]$', '\\1-') AS line FROM lines),
b AS (SELECT *, lag(line) OVER (PARTITION BY doc_id ORDER BY line_no) AS before FROM h),
m AS (SELECT *, sum(CASE WHEN coalesce(regexp_matches(before, '[A-Za-zÀ-ÿ]-\\.?$') AND (regexp_matches(line, '^\\p{Ll}') OR regexp_matches(before, '[A-ZÀ-Þ][A-ZÀ-Þ0-9''’.\\-]*-\\.?$')), false) THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY line_no) AS run FROM b),
e AS (SELECT *, row_number() OVER (PARTITION BY doc_id, run ORDER BY line_no) AS i, count(*) OVER (PARTITION BY doc_id, run) AS n FROM m),
p AS (SELECT doc_id, run, line_no, CASE WHEN i > 1 THEN ltrim(line) ELSE line END AS s, i = n AS ends FROM e)
SELECT doc_id, min(line_no)::INT AS line_no, sum(length(CASE WHEN ends THEN s ELSE regexp_replace(s, '-\\.?$', '') END))::INT AS n_chars FROM p GROUP BY doc_id, run""")
def dehyphenate(spark: SparkSession, d: str) -> DataFrame:
    rows = docstream.lines(table(spark, d, "documents"), "doc_id").withColumn("line", F.regexp_replace("line", r"(\p{Ll})[.,]$", "$1-"))
    return docstream.heal_hyphens(rows, ["doc_id"]).select("doc_id", F.col("line_no").cast("int").alias("line_no"), F.length("line").alias("n_chars"))


@query("SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256, md5(coalesce(text, '')) AS text_md5, sha256(coalesce(source, '') || chr(0) || coalesce(lang, ''))[1:16] AS sig FROM documents")
def hash_keys(spark: SparkSession, d: str) -> DataFrame:
    t = F.coalesce("text", F.lit(""))
    return table(spark, d, "documents").select("doc_id", F.sha2(t.cast("binary"), 256).alias("text_sha256"), F.md5(t.cast("binary")).alias("text_md5"), T.stable_key(F.col("source"), F.col("lang"), length=16).alias("sig"))


@query("SELECT p_partkey, regexp_replace(upper(p_name), '[^A-Z]', '', 'g') AS letters, trim(regexp_replace(lower(p_name), '\\s+', ' ', 'g')) AS squeezed, regexp_replace(lower(p_name), '[^\\p{L}\\p{N}]', '', 'g') AS word_letters FROM part")
def norm_alpha(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("p_name")
    return table(spark, d, "part").select("p_partkey", T.letters_only(n).alias("letters"), T.squeeze(n).alias("squeezed"), T.word_letters(n).alias("word_letters"))


@query("SELECT doc_id, sha256(trim(regexp_replace(lower(text), '\\s+', ' ', 'g'))) AS squeezed_sha256 FROM documents")
def norm_ws(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.sha2(T.squeeze(F.col("text")).cast("binary"), 256).alias("squeezed_sha256"))


@query("SELECT doc_id, sha256(regexp_replace(lower(strip_accents(text)), '[^a-z]', '', 'g')) AS folded_sha256 FROM documents")
def accent_fold(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.sha2(T.fold(F.col("text")).cast("binary"), 256).alias("folded_sha256"))


SEE_LINE = "concat(p_name, '. ', CASE p_size % 4 WHEN 0 THEN 'See ' WHEN 1 THEN 'See also ' WHEN 2 THEN 'see ' ELSE 'Seen ' END, upper(p_type), CASE p_size % 3 WHEN 0 THEN '.' WHEN 1 THEN '; and more' ELSE '' END)"


@query(f"""SELECT p_partkey, nullif(trim(regexp_extract({SEE_LINE}, '\\bSee\\s+(?:also\\s+)?([A-ZÀ-Þ][A-Za-zÀ-ÿ .''()\\-,&]*?)\\.?\\s*$', 1)), '') AS see_target FROM part""")
def see_extract(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", T.see_target(F.expr(SEE_LINE)).alias("see_target"))


MARK_LINE = "concat(CASE s_suppkey % 5 WHEN 0 THEN 'p. ' ELSE '## p. ' END, CASE s_suppkey % 4 WHEN 0 THEN '?' WHEN 1 THEN 'xiv' ELSE concat(s_suppkey, '') END, ' (#', s_suppkey + 8, ') ####')"


@query(f"SELECT s_suppkey, try_cast(regexp_extract({MARK_LINE}, '^## p\\. (\\S+) \\(#(\\d+)\\)', 1) AS INT) AS printed, try_cast(regexp_extract({MARK_LINE}, '^## p\\. (\\S+) \\(#(\\d+)\\)', 2) AS INT) AS idx FROM supplier")
def page_marker(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").select("s_suppkey", T.page_mark(F.expr(MARK_LINE)).alias("m")).select("s_suppkey", "m.printed", "m.idx")


VOLUME_NAME = "concat(CASE s_suppkey % 4 WHEN 0 THEN 'Gazetteer Vol-0' WHEN 1 THEN 'volume_' WHEN 2 THEN 'notes-' ELSE 'v.' END, s_suppkey + 1, '.txt')"
VOLUME_RE = "'(?:^|[^a-z])v(?:ol(?:ume)?)?[ ._-]*0*(\\d{1,2})(?:\\D|$)'"


@query(f"SELECT s_suppkey, CASE WHEN regexp_extract(lower(n), {VOLUME_RE}, 1) <> '' THEN 'v' || regexp_extract(lower(n), {VOLUME_RE}, 1) ELSE regexp_replace(n, '\\.[^.]*$', '') END AS tag FROM (SELECT s_suppkey, {VOLUME_NAME} AS n FROM supplier)")
def volume_tag(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").select("s_suppkey", T.volume_tag(F.expr(VOLUME_NAME)).alias("tag"))


@query("SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS scheme, regexp_extract(url, '://([^/?#]+)', 1) AS host, regexp_extract(url, '://[^/]+(/[^?#]*)', 1) AS path, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, len(regexp_extract_all(html, '<li>'))::INT AS n_items FROM pages")
def url_parts(spark: SparkSession, d: str) -> DataFrame:
    part = lambda p: F.regexp_extract("url", p, 1)
    return table(spark, d, "pages").select("page_id", part("^([a-z]+)://").alias("scheme"), part("://([^/?#]+)").alias("host"), part("://[^/]+(/[^?#]*)").alias("path"), F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"), F.regexp_count("html", F.lit("<li>")).cast("int").alias("n_items"))


@query(LINES_SQL + """, f AS (SELECT doc_id, line_no, len(regexp_extract_all(line, '[0-9]+')) >= 2 AS hit FROM lines),
g AS (SELECT doc_id, line_no - row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS g FROM f WHERE hit),
r AS (SELECT doc_id, g, count(*) AS n FROM g GROUP BY ALL)
SELECT d.doc_id, coalesce(max(n), 0)::BIGINT AS longest FROM documents d LEFT JOIN r ON r.doc_id = d.doc_id GROUP BY d.doc_id""")
def table_run_longest(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    runs = joins.islands(docstream.lines(docs, "doc_id"), ["doc_id"], "line_no", F.regexp_count("line", F.lit("[0-9]+")) >= 2)
    return docs.select("doc_id").join(runs.groupBy("doc_id").agg(F.max("length").alias("n")), "doc_id", "left").groupBy("doc_id").agg(F.coalesce(F.max("n"), F.lit(0)).cast("bigint").alias("longest"))


@query("SELECT event_id, json_extract_string(props, '$.k')::INT AS k, json_extract_string(props, '$.none') AS missing, CASE WHEN json_extract_string(props, '$.k')::INT >= 50 THEN 'high' ELSE 'low' END AS class FROM events")
def json_props(spark: SparkSession, d: str) -> DataFrame:
    v = F.from_json("props", "k int, none string")
    return table(spark, d, "events").select("event_id", v.alias("v")).select("event_id", "v.k", F.col("v.none").alias("missing"), F.when(F.col("v.k") >= 50, "high").otherwise("low").alias("class"))


@query("SELECT event_id, coalesce(try_cast(regexp_extract(cut, '\"k\": (\\d+)', 1) AS INT), -1) AS k FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN left(props, length(props) - 1) ELSE props END AS cut FROM events)")
def json_salvage(spark: SparkSession, d: str) -> DataFrame:
    """Fields of values cut short are had by pattern where parsing fails."""
    cut = F.when(F.col("event_id") % 3 == 0, F.left("props", F.length("props") - 1)).otherwise(F.col("props"))
    rows = table(spark, d, "events").select("event_id", cut.alias("cut"))
    return rows.select("event_id", F.coalesce(F.get_json_object("cut", "$.k").try_cast("int"), F.regexp_extract("cut", r'"k": (\d+)', 1).try_cast("int"), F.lit(-1)).alias("k"))


@query("""WITH t AS (SELECT p_partkey, list_filter(string_split_regex(lower(p_name), '[^\\p{L}\\p{N}]+'), lambda x: x <> '') AS w FROM part)
SELECT p_partkey, unnest(range(1, len(w) + 1))::INT AS ord, unnest(w) AS token FROM t""")
def explode_ordinal(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", F.posexplode(T.tokens(F.col("p_name"))).alias("ord", "token")).withColumn("ord", F.col("ord") + 1)


@query("""SELECT doc_id, array_to_string(list_filter([CASE WHEN n_chars < 50 THEN 'short' END, CASE WHEN regexp_matches(text, '[*#$%&]{3}') THEN 'symbols' END,
 CASE WHEN text = upper(text) THEN 'capitals' END, CASE WHEN contains(text, ' | ') THEN 'table' END, CASE WHEN NOT regexp_matches(text, '[.!?]\\s*$') THEN 'open_end' END], lambda x: x IS NOT NULL), ',') AS flags FROM documents""")
def suspect_flags(spark: SparkSession, d: str) -> DataFrame:
    t = F.col("text")
    tests = {"short": F.col("n_chars") < 50, "symbols": t.rlike(r"[*#$%&]{3}"), "capitals": t == F.upper(t), "table": t.contains(" | "), "open_end": ~t.rlike(r"[.!?]\s*\z")}
    flags = F.filter(F.array(*(F.when(c, name) for name, c in tests.items())), lambda x: x.isNotNull())
    return table(spark, d, "documents").select("doc_id", F.array_join(flags, ",").alias("flags"))


@query("SELECT c_custkey, CASE WHEN regexp_matches(n, '\\s') THEN 'space' WHEN length(regexp_replace(n, '[\\p{L}\\p{N}\\s]', '', 'g')) * 4 > length(n) THEN 'punctuation' END AS reason FROM (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN replace(c_name, '#', ' ') WHEN 1 THEN c_name ELSE '#-.-#' || c_custkey END AS n FROM customer)")
def tokeniser_affected(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("c_custkey")
    n = F.when(k % 3 == 0, F.replace("c_name", F.lit("#"), F.lit(" "))).when(k % 3 == 1, F.col("c_name")).otherwise(F.concat(F.lit("#-.-#"), k.cast("string")))
    return table(spark, d, "customer").select("c_custkey", T.needs_retokenising(n).alias("reason"))


@query("""WITH w AS (SELECT DISTINCT doc_id, unnest(list_filter(string_split_regex(text, '[^\\p{L}]+'), lambda x: length(x) >= 4)) AS form FROM documents),
n AS (SELECT regexp_replace(lower(strip_accents(form)), '[^a-z]', '', 'g') AS key, form, count(*) AS c FROM w GROUP BY ALL)
SELECT key, arg_max(form, (strip_accents(form) <> form, upper(form) <> form, c, form)) AS best, sum(c)::BIGINT AS n, count(*) AS n_forms FROM n WHERE key <> '' GROUP BY key""")
def canonical_form(spark: SparkSession, d: str) -> DataFrame:
    form = F.explode(F.array_distinct(F.filter(F.split("text", r"[^\p{L}]+"), lambda x: F.length(x) >= 4))).alias("form")
    counts = table(spark, d, "documents").select(form).groupBy("form").agg(F.count("*").alias("c")).withColumn("key", T.fold(F.col("form")))
    rank = F.struct(T.unaccent(F.col("form")) != F.col("form"), F.upper("form") != F.col("form"), F.col("c"), F.col("form"))
    return counts.where("key <> ''").groupBy("key").agg(F.max_by("form", rank).alias("best"), F.sum("c").alias("n"), F.count("*").alias("n_forms"))


@query("SELECT l.doc_id, count(*) FILTER (line = '') AS n_blank, count(*) FILTER (length(line) > 80) AS n_long, max(length(line))::INT AS longest FROM (" + LINES_SQL + " SELECT * FROM lines) l GROUP BY l.doc_id")
def page_lines(spark: SparkSession, d: str) -> DataFrame:
    rows = docstream.lines(table(spark, d, "documents"), "doc_id")
    return rows.groupBy("doc_id").agg(F.count_if(F.col("line") == "").alias("n_blank"), F.count_if(F.length("line") > 80).alias("n_long"), F.max(F.length("line")).alias("longest"))


@query("SELECT conv_id, turn, role, lag(role) OVER w AS before, lead(role) OVER w AS after, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_user FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)")
def conversation_prev(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn")
    last = F.last(F.when(F.col("role") == "user", F.col("turn")), ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return table(spark, d, "conversations").select("conv_id", "turn", "role", F.lag("role").over(w).alias("before"), F.lead("role").over(w).alias("after"), last.alias("last_user"))


@query("SELECT c_custkey, upper(substr(b, 1, 1)) || lower(substr(b, 2)) || ' of ' || upper(substr(n_name, 1, 1)) || lower(substr(n_name, 2)) AS shown FROM (SELECT c_custkey, c_mktsegment AS b, regexp_replace(n_name, '[^A-Za-z]', '', 'g') AS n_name FROM customer JOIN nation ON c_nationkey = n_nationkey)")
def title_names(spark: SparkSession, d: str) -> DataFrame:
    both = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    raw = F.concat(F.upper("c_mktsegment"), F.lit(" OF "), F.upper(F.regexp_replace("n_name", "[^A-Za-z]", "")))
    return both.select("c_custkey", T.title_name(raw).alias("shown"))


@query("SELECT p_partkey, array_to_string(list_transform(regexp_extract_all(lower(p_name || ' ' || p_partkey), '[0-9]+|[^0-9]+'), lambda t: CASE WHEN regexp_matches(t, '^[0-9]') THEN lpad(t, 12, '0') ELSE t END), '') AS sort_key FROM part")
def natural_order(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", T.natural_key(F.concat("p_name", F.lit(" "), F.col("p_partkey").cast("string"))).alias("sort_key"))
