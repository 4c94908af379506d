"""URL filter by a dated list: every capture is judged by the entries that were active when it was fetched.

List entries are events: from a day on, a host (with all its subdomains), a host's path prefix, or a query parameter is to be blocked
or to be let through. Events of one key become validity intervals, each ending where the next begins. A capture is looked up under all
its keys (the suffixes of its host, the prefixes of its path, its parameters), and of the entries active at its fetch time the most
specific decides: more kind first (path, host, parameter), then the longer key.

A decision depends on the address and the fetch time alone, so each pair is judged once, however many captures share it.

Defined cases: a null or unparseable address has no host and is kept, as is one without an active entry; a null fetch time meets no entry; events of a key on the
same day: the last by action name holds; repeated rows get equal decisions; an empty list keeps all; columns not named are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import keyed_join, table

#: Kind, key, action, category, first day.
ENTRIES = (
    ("host", "ads-track.example.com", "block", "tracking", "2024-01-20"),
    ("host", "ads-track.example.com", "allow", "tracking", "2024-04-10"),
    ("host", "spam-farm.example.org", "block", "spam", "2024-01-01"),
    ("host", "casino-win.example.net", "block", "gambling", "2024-02-15"),
    ("host", "adult-x.example.com", "block", "adult", "2023-11-05"),
    ("host", "cheap-pills.example.net", "block", "pharmacy", "2024-03-01"),
    ("host", "cheap-pills.example.net", "allow", "pharmacy", "2024-03-20"),
    ("host", "cheap-pills.example.net", "block", "pharmacy", "2024-05-01"),
    ("host", "free-bets.example.net", "block", "gambling", "2024-01-10"),
    ("host", "m.ththin.example.org", "block", "mirror", "2024-02-01"),
    ("host", "ththin.example.org", "allow", "mirror", "2024-01-01"),
    ("path", "tionsh.example.net/es", "block", "withdrawn", "2024-03-15"),
    ("path", "adult-x.example.com/en", "allow", "appeal", "2024-05-20"),
    ("parameter", "utm_source", "block", "campaign", "2024-06-10"),
)
KINDS = ("parameter", "host", "path")
SAMPLED = 16  # one row in so many tells which keys are hot


def intervals(entries: DataFrame) -> DataFrame:
    """kind, key, action, category, since, until (null: still in force) from dated events."""
    w = Window.partitionBy("kind", "key").orderBy("day", "action", "category")
    return entries.select("kind", "key", "action", "category", F.col("day").alias("since"), F.lead("day").over(w).alias("until")).where("until IS NULL OR since < until")


def host_of(url: Column) -> Column:
    """The host in lower case, without port; null where there is none."""
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def keys_of(url: Column, host: Column) -> Column:
    """All (kind, key) pairs under which a list may name the address."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    path = F.regexp_extract(url, r"^[^:]+://[^/?#]*(/[^?#]*)?", 1)
    parts = F.filter(F.split(path, "/"), lambda x: x != "")
    prefixes = F.when(F.size(parts) > 0, F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.concat(host, F.lit("/"), F.array_join(F.slice(parts, 1, k), "/")))).otherwise(F.array().cast("array<string>"))
    names = F.transform(F.filter(F.split(F.regexp_extract(url, r"\?([^#]*)", 1), "&"), lambda x: x != ""), lambda x: F.substring_index(x, "=", 1))
    pair = lambda kind: lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("key"))
    return F.array_distinct(F.concat(F.transform(suffixes, pair("host")), F.transform(prefixes, pair("path")), F.transform(names, pair("parameter"))))


def _named(addresses: DataFrame) -> DataFrame:
    """A row ``k`` for each key of each address ``_u``."""
    return addresses.withColumn("_h", host_of(F.col("_u"))).where("_h IS NOT NULL").withColumn("k", F.explode(keys_of(F.col("_u"), F.col("_h"))))


def judge(captures: DataFrame, entries: DataFrame, url_column: str = "url", time_column: str = "fetched_at") -> DataFrame:
    """captures with host, decision (keep or block), rule, category and rule_since."""
    new = ("host", "decision", "rule", "category", "rule_since")
    kept = [c for c in captures.columns if c not in new]
    url, time = F.col(f"`{url_column}`"), F.col(f"`{time_column}`")
    # the rows' own columns travel in one struct, out of the way of the names used here
    rows = captures.select(F.struct(*(F.col(f"`{c}`") for c in kept)).alias("_row"), url.alias("_u"), time.alias("_t"))
    some = rows.select("_u", "_t", F.monotonically_increasing_id().alias("_n")).where(F.pmod(F.xxhash64("_n"), F.lit(SAMPLED)) == 0)  # for the dealing of hot keys alone
    n_some = some.count()
    asked = rows.select("_u", "_t").where("_u IS NOT NULL AND _t IS NOT NULL").distinct()
    some_named, named = (_named(x).select("_u", "_t", F.col("k.kind").alias("kind"), F.col("k.key").alias("key")) for x in (some, asked))
    met = keyed_join(named, intervals(entries), ["kind", "key"], ["_u", "_t"], some_named.groupBy("kind", "key").agg(F.count("*").alias("n")), n_some)
    active = met.where((F.col("_t") >= F.col("since")) & (F.col("until").isNull() | (F.col("_t") < F.col("until"))))
    strength = F.struct(F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")), F.length("key"), F.col("key"))
    best = active.groupBy("_u", "_t").agg(F.max_by(F.struct("kind", "key", "action", "category", "since"), strength).alias("_r"))
    out = keyed_join(rows, best, ["_u", "_t"], [F.monotonically_increasing_id()], some.groupBy("_u", "_t").agg(F.count("*").alias("n")), n_some, "left")
    blocked = F.coalesce(F.col("_r.action") == "block", F.lit(False))
    return out.select(
        *(F.col("_row").getField(c).alias(c) for c in kept), host_of(F.col("_u")).alias("host"), F.when(blocked, "block").otherwise("keep").alias("decision"), F.concat_ws(":", F.col("_r.kind"), F.col("_r.key")).alias("rule"),
        F.col("_r.category").alias("category"), F.col("_r.since").alias("rule_since"),
    )


def list_entries(spark: SparkSession, entries: tuple = ENTRIES) -> DataFrame:
    return spark.createDataFrame([(*e[:4], e[4]) for e in entries], "kind string, key string, action string, category string, day string").withColumn("day", F.to_date("day"))


def op6_url_temporal_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the list as it stood on its fetch day. The table has no fetch day; the query binds one to the page's id."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.date_add(F.lit("2024-01-01").cast("date"), F.pmod(F.col("page_id") * 7, F.lit(180)).cast("int")).alias("fetched_at"))
    return judge(pages, list_entries(spark)).select("page_id", "host", F.col("fetched_at").cast("string").alias("fetched_on"), "decision", "rule", "category", F.col("rule_since").cast("string").alias("rule_since"))


OP6_SQL = (
    "WITH events(kind, key, action, category, day) AS (VALUES "
    + ", ".join("('" + "', '".join(e[:4]) + f"', DATE '{e[4]}')" for e in ENTRIES)
    + r"""), iv AS (
  SELECT kind, key, action, category, day AS since, lead(day) OVER (PARTITION BY kind, key ORDER BY day, action, category) AS until FROM events
), p AS (
  SELECT page_id, url, DATE '2024-01-01' + ((page_id * 7) % 180)::INT AS t, nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') AS host,
    regexp_extract(url, '^[^:]+://[^/?#]*(/[^?#]*)?', 1) AS path, '&' || regexp_extract(url, '\?([^#]*)', 1) AS query FROM pages
), hit AS (
  SELECT p.page_id, p.url, p.t, iv.*, row_number() OVER (PARTITION BY p.page_id ORDER BY CASE kind WHEN 'path' THEN 3 WHEN 'host' THEN 2 ELSE 1 END DESC, length(key) DESC, key DESC) AS r
  FROM p JOIN iv ON p.t >= since AND (until IS NULL OR p.t < until) AND (
    kind = 'host' AND (host = key OR ends_with(host, '.' || key))
    OR kind = 'path' AND starts_with(host || path || '/', key || '/')
    OR kind = 'parameter' AND (contains(query, '&' || key || '=') OR contains(query || '&', '&' || key || '&')))
)
SELECT p.page_id, p.host, p.t::VARCHAR AS fetched_on, CASE WHEN hit.action = 'block' THEN 'block' ELSE 'keep' END AS decision,
  coalesce(kind || ':' || key, '') AS rule, category, since::VARCHAR AS rule_since
FROM p LEFT JOIN hit ON hit.page_id = p.page_id AND r = 1
"""
)
