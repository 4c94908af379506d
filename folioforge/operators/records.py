"""Records and reviews: selections, set comparisons, attestation, review order, request shapes, resolution under policies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import letters_only

#: The most certain pass has rank 1; unknown passes and places known by coordinate alone have 5.
CERTAINTY = {"1-exact-in": 1, "2-phon-in": 2, "3-phon-broad": 3, "4-phon-cc": 4, "coord-match": 1, "coord-only": 5}
#: Numbers of scripts in the order of their list.
SCRIPT_IDS = ("LATIN", "CYRILLIC", "GREEK", "ARABIC", "HEBREW", "DEVANAGARI", "BENGALI", "TAMIL", "TELUGU", "MALAYALAM", "KANNADA", "GUJARATI", "THAI", "GEORGIAN", "ARMENIAN", "HANGUL", "CJK", "HIRAGANA", "KATAKANA", "OTHER")
#: A residual name is junk up to so many letters or below so many characters of text, or without one of these words near its start.
JUNK_LETTERS, JUNK_CHARS, DESCRIBED_WITHIN = 4, 35, 90
DESCRIPTORS = r"(?i)\b(?:a|an|the|see|or|is|in|of|on|near|chief|town|vil|river|prov)\b"


def certainty(matched_by: Column) -> Column:
    known = F.create_map(*(F.lit(x) for pair in CERTAINTY.items() for x in pair))
    return F.coalesce(F.get(F.map_values(F.map_filter(known, lambda k, _: k == matched_by)), F.lit(0)), F.lit(5))


def script_id(name: Column) -> Column:
    """Number of a script; that of OTHER where the name is not on the list."""
    at = F.array_position(F.array(*map(F.lit, SCRIPT_IDS)), F.upper(name)).cast("int")
    return F.when(at > 0, at - 1).otherwise(len(SCRIPT_IDS) - 1)


def low_confidence(confidence: Column, floor: float = 30.0) -> Column:
    """Below twice the floor; a confidence that was not measured is not low."""
    return F.coalesce(confidence < 2 * floor, F.lit(False))


def rotation(base: Column, override: Column) -> Column:
    return F.pmod(F.coalesce(base, F.lit(0)) + F.coalesce(override, F.lit(0)), F.lit(360))


def utc_stamp(ts: Column) -> Column:
    """ISO 8601 to the second, in UTC."""
    return F.date_format(F.to_timestamp(F.from_unixtime(F.unix_seconds(ts.cast("timestamp")))), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def ink_fraction(histogram: Column, dark_below: int) -> Column:
    """Share of an image's points that are darker than a level, from its histogram."""
    total = F.aggregate(histogram, F.lit(0).cast("bigint"), lambda s, x: s + x)
    dark = F.aggregate(F.slice(histogram, 1, dark_below), F.lit(0).cast("bigint"), lambda s, x: s + x)
    return F.try_divide(dark.cast("double"), total.cast("double"))


def symmetric_difference(a: Column, b: Column) -> Column:
    """Elements of exactly one of two arrays, in order; nulls count as empty arrays."""
    none = F.array().cast("array<string>")
    x, y = F.coalesce(a.cast("array<string>"), none), F.coalesce(b.cast("array<string>"), none)
    return F.array_sort(F.concat(F.array_except(x, y), F.array_except(y, x)))


def from_either(candidates: dict[str, DataFrame], key: list[str]) -> DataFrame:
    """Keys that any detector found, once, with the sorted names of those that did."""
    rows = None
    for name, df in candidates.items():
        one = df.select(*key).distinct().withColumn("by", F.lit(name))
        rows = one if rows is None else rows.unionByName(one)
    return rows.groupBy(*key).agg(F.array_sort(F.collect_set("by")).alias("found_by"))


def in_common(a: DataFrame, b: DataFrame, key: list[str]) -> DataFrame:
    """Rows of both sides for the keys they share; no shared key at all is an error, since nothing would have been compared."""
    both = a.join(b, key)
    if both.limit(1).count() == 0:
        raise AssertionError("the two sides share no key")
    return both


def residual_class(kind: Column, name: Column, text: Column) -> Column:
    """crossref, junk or real: what a name is that only one of two lists has."""
    junk = (F.length(name) <= JUNK_LETTERS) | (F.length(F.coalesce(text, F.lit(""))) < JUNK_CHARS) | ~F.coalesce(text.substr(1, DESCRIBED_WITHIN), F.lit("")).rlike(DESCRIPTORS)
    return F.when(kind == "crossref", "crossref").when(junk, "junk").otherwise("real")


def entry_starts(text: Column) -> Column:
    """Letters-only keys (four at least) of names in capitals that a comma and a lower-case letter follow at the start of a line or sentence."""
    found = F.regexp_extract_all(text, F.lit(r"(?:^|\n|(?<=\. )|(?<=\.\n))\s*([A-ZÀ-Þ][A-ZÀ-Þ '’.\-]{1,40}?)(?: \([^)]*\))?,\s+[a-z]"), 1)
    return F.array_distinct(F.filter(F.transform(found, letters_only), lambda k: F.length(k) >= 4))


def commonest(rows: DataFrame, key: list[str], value: str) -> DataFrame:
    """The most frequent value of each key, of equals the least. Counts are made before the shuffle by key."""
    n = rows.where(F.col(value).isNotNull()).groupBy(*key, value).agg(F.count("*").alias("n"))
    # max_by takes one of equal ranks; of equal counts the least value is wanted
    top = n.groupBy(*key).agg(F.max("n").alias("n"))
    return n.join(top, [*key, "n"]).groupBy(*key, "n").agg(F.min(value).alias(value))


def first_image(marks: DataFrame) -> DataFrame:
    """volume, printed, image: the image of the first mark (by place) that bears a printed number."""
    return marks.where("printed IS NOT NULL").groupBy("volume", "printed").agg(F.min_by("image", "place").alias("image"))


def match_rate(exact: DataFrame, fuzzy: DataFrame, reference: DataFrame) -> DataFrame:
    """One row: how many of the reference's names were found exactly, by likeness, and their share."""
    n = reference.agg(F.count("*").alias("n")).crossJoin(F.broadcast(exact.agg(F.count("*").alias("n_exact")))).crossJoin(F.broadcast(fuzzy.agg(F.count("*").alias("n_fuzzy"))))  # one row each
    return n.select("n", "n_exact", "n_fuzzy", F.round(100.0 * (F.col("n_exact") + F.col("n_fuzzy")) / F.greatest(F.col("n"), F.lit(1)), 2).alias("match_pct"))


def map_digest(rows: DataFrame, by: list[str], key: str, value: str) -> DataFrame:
    """by, n, digest: of the JSON object of each group's keys in order, 16 characters of the SHA-256."""
    pairs = rows.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(F.col(key).cast("string").alias("k"), F.col(value).cast("string").alias("v")))).alias("p"))
    body = F.array_join(F.transform("p", lambda x: F.concat(F.lit('"'), x["k"], F.lit('": "'), x["v"], F.lit('"'))), ", ")
    return pairs.select(*by, F.size("p").alias("n"), F.sha2(F.concat(F.lit("{"), body, F.lit("}")).cast("binary"), 256).substr(1, 16).alias("digest"))


def review_order(has_coords: Column, has_hierarchy: Column, headword: Column, hyphens_count: bool = False) -> list[Column]:
    """Coordinates first, then a stated hierarchy, then (if asked) hyphenated names, then by name."""
    middle = [(~F.contains(F.coalesce(headword, F.lit("")), F.lit("-"))).asc()] if hyphens_count else []
    return [(~has_coords).asc(), (~has_hierarchy).asc(), *middle, F.lower(F.coalesce(headword, F.lit(""))).asc()]


def ranked(rows: DataFrame, by: list[str], order: list[Column], name: str = "rank") -> DataFrame:
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def weighted_draw(rows: DataFrame, stratum: Column, key: str, total: int, shares: dict[str, float], seed: str) -> DataFrame:
    """About ``total`` rows: of each named stratum its share, the rest from all others, in an order that a hash of seed and key makes."""
    lot = F.md5(F.concat(F.lit(seed), F.col(key).cast("string")).cast("binary"))
    marked = rows.withColumn("stratum", stratum).withColumn("__lot", lot)
    named = F.col("stratum").isin(*shares)
    marked = marked.withColumn("__part", F.when(named, F.col("stratum")).otherwise("rest"))
    first = marked.withColumn("__i", F.row_number().over(Window.partitionBy("__part").orderBy("__lot", key))).where(F.col("__i") <= total)  # a task keeps at most ``total`` rows of a part
    quota = F.lit(None).cast("int")
    for name, part in shares.items():
        quota = F.when(F.col("__part") == name, int(total * part)).otherwise(quota)
    sure = first.where(named & (F.col("__i") <= quota))
    left = F.greatest(F.lit(total) - F.col("__n"), F.lit(0))
    rest = first.where("__part = 'rest'").crossJoin(F.broadcast(sure.agg(F.count("*").alias("__n")))).where(F.col("__i") <= left).drop("__n")  # one row is broadcast
    return sure.unionByName(rest).drop("__lot", "__part", "__i")


def span_between(ours: DataFrame, theirs: DataFrame, by: str, position: str, name: str) -> DataFrame:
    """ours from the first to the last name that theirs has too, with whether each is among them."""
    marked = ours.join(theirs.select(by, name).distinct().withColumn("__hit", F.lit(True)), [by, name], "left")
    ends = marked.where("__hit").groupBy(by).agg(F.min(position).alias("__a"), F.max(position).alias("__b"))
    inside = marked.join(ends, by).where(F.col(position).between(F.col("__a"), F.col("__b")))
    return inside.select(by, position, name, F.coalesce("__hit", F.lit(False)).alias("shared"))


def prose_pages(pages: DataFrame, heads: DataFrame, least_lines: int = 30, least_heads: int = 10) -> DataFrame:
    """Pages (page, printed, lines) with a printed number, no table mark, enough lines and enough headwords (heads: printed, headword)."""
    body = F.filter("lines", lambda x: (x != "") & ~F.startswith(x, F.lit("##")) & ~F.startswith(x, F.lit("<!--")))
    dense = pages.where(F.col("printed").isNotNull() & ~F.exists("lines", lambda x: F.startswith(x, F.lit("<!-- table")))).withColumn("n_lines", F.size(body)).where(F.col("n_lines") >= least_lines)
    n = heads.groupBy("printed").agg(F.countDistinct("headword").alias("n_heads"))
    return dense.join(n, "printed").where(F.col("n_heads") >= least_heads).select("page", "printed", "n_lines", "n_heads")


def table_candidates(pages: DataFrame, score: Column, least: int = 1) -> DataFrame:
    """Pages that bear enough marks of tables, with their number of marks; the caller orders by it."""
    return pages.withColumn("score", score).where(F.col("score") >= least)


def refined(adjudicated: DataFrame, context: DataFrame, key: str) -> DataFrame:
    """'absent' becomes 'review', with what lies near as evidence: distance and absence of a name decide nothing by themselves."""
    out = adjudicated.join(context, key, "left")
    was = F.col("label") == "absent"
    extra = [c for c in context.columns if c != key]
    return out.select(*(c for c in adjudicated.columns if c != "label"), F.when(was, "review").otherwise(F.col("label")).alias("label"), *(F.when(was, F.col(c)).alias(c) for c in extra))


def distance_class(km: Column, has_record: Column, most_km: float) -> Column:
    """near, far, unlocated or none: whether a permissive record can stand for the one held."""
    return F.when(~has_record, "none").when(km.isNull(), "unlocated").when(km <= most_km, "near").otherwise("far")


def requests(places: DataFrame, pass_name: str, mode: str, scope: str) -> DataFrame:
    """A request for each place to which the pass's scope applies: query, mode, ccodes, contained_in.

    places: place_id, name, country_code, parents (broadest first). scope: narrow (the last parent), broad (the one before it) or none.
    """
    at = {"narrow": F.try_element_at("parents", F.lit(-1)), "broad": F.when(F.size("parents") >= 2, F.element_at("parents", -2)), "none": F.lit(None).cast("string")}[scope]
    asked = places.withColumn("contained_in", F.when(F.size(F.coalesce("parents", F.array().cast("array<string>"))) > 0, at) if scope != "none" else at)
    asked = asked if scope == "none" else asked.where(F.col("contained_in").isNotNull())
    return asked.select("place_id", F.lit(pass_name).alias("pass"), F.col("name").alias("query"), F.lit(mode).alias("mode"), F.col("country_code").alias("ccode"), "contained_in")


def parent_under(hits: DataFrame, key: list[str], areal_only: bool, threshold: float = 80.0, floor: float = 30.0) -> DataFrame:
    """The parent a name resolves to: an exact hit before a phonetic one, which must be confident; with areal_only a point cannot contain anything."""
    phonetic = F.col("mode") == "phonetic"
    good = hits.where((F.col("score") >= threshold) & (~phonetic | F.coalesce(F.col("confidence") >= floor, F.lit(True))))
    good = good.where("has_geom") if areal_only else good
    rest = [c for c in hits.columns if c not in key]
    order = F.struct(F.when(phonetic, 0).otherwise(1), F.col("score"), -F.col("rank"))
    return good.groupBy(*key).agg(F.max_by(F.struct(*rest), order).alias("h")).select(*key, "h.*")


def by_confidence(hits: DataFrame, key: list[str], usable: DataFrame) -> DataFrame:
    """Of each key's areal hits the most confident, and whether it can be used as a scope (usable: place_id, applied)."""
    rest = [c for c in hits.columns if c not in key]
    best = hits.where("has_geom").groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(F.coalesce("confidence", F.lit(0.0)), -F.col("rank"))).alias("h")).select(*key, "h.*")
    return best.join(usable, "place_id", "left").withColumn("applied", F.coalesce("applied", F.lit(False)))


def as_decided(rows: DataFrame, decisions: DataFrame, sig: str, order: str) -> DataFrame:
    """rows after the latest decision on each: rejected, table and people entries leave, edits rename, a split gives a row for each of its names,
    a merge gives the name it is merged into; undone and kept entries stay as they are. decisions: sig, action, payload (array of names), order."""
    last = decisions.groupBy(sig).agg(F.max_by(F.struct("action", "payload"), order).alias("d"))
    out = rows.join(last, sig, "left").withColumn("action", F.coalesce("d.action", F.lit("keep"))).where(~F.col("action").isin("reject", "table", "people"))
    one = F.array("headword")
    given = F.coalesce("d.payload", F.array().cast("array<string>"))
    names = F.when((F.col("action") == "split") & (F.size(given) > 0), given).when(F.col("action").isin("edit", "merge") & (F.size(given) > 0), F.slice(given, 1, 1)).otherwise(one)
    return out.select(*(c for c in rows.columns if c != "headword"), F.posexplode(names).alias("part", "headword"), "action")


def collected(submitted: DataFrame, answers: DataFrame, custom_id: str = "custom_id") -> DataFrame:
    """A batch's answers put to its requests by id: answered, failed (an answer with an error) or missing; of several answers the last."""
    last = answers.groupBy(custom_id).agg(F.max_by(F.struct("response", "error"), "arrived").alias("a"))
    state = F.when(F.col("a").isNull(), "missing").when(F.col("a.error").isNotNull(), "failed").otherwise("answered")
    return submitted.join(last, custom_id, "left").select(*submitted.columns, F.col("a.response").alias("response"), state.alias("state"))


def two_hop_labels(triples: DataFrame, label_of: str, form_of: str, lang: str) -> DataFrame:
    """concept, label: concepts lead to label nodes, and these to their literal forms in a language (triples: subject, predicate, object, lang)."""
    nodes = triples.where(F.col("predicate") == label_of).select(F.col("subject").alias("concept"), F.col("object").alias("node"))
    forms = triples.where((F.col("predicate") == form_of) & (F.col("lang") == lang)).select(F.col("subject").alias("node"), F.col("object").alias("label"))
    return nodes.join(forms, "node").groupBy("concept").agg(F.min("label").alias("label"))


def known_words(tokens: DataFrame, token: str, words: DataFrame) -> DataFrame:
    """tokens with whether the word list (word) has the token in lower case, or without a plural s."""
    low = F.lower(F.col(token))
    either = tokens.withColumn("__w", F.explode(F.array_distinct(F.array(low, F.regexp_replace(low, "s$", "")))))
    hit = either.join(words.select(F.col("word").alias("__w")).where("__w <> ''").distinct().withColumn("__known", F.lit(True)), "__w", "left")
    return hit.groupBy(*tokens.columns).agg(F.coalesce(F.bool_or("__known"), F.lit(False)).alias("known"))


def second_stream(text: Column) -> Column:
    """A second reading made comparable: page marks, hyphens at line ends, lines in capitals and gutter marks taken out."""
    for pattern, to in ((r"##\s*p\.[^\n]*\n", "\n"), (r"([A-Za-zÀ-ÿ])-\n([a-zà-ÿ])", "$1$2"), (r"(?m)^[A-Z][A-Z .'\-]{1,30}$", ""), (r"\|", " ")):
        text = F.regexp_replace(text, pattern, to)
    return text


def running_head(text: Column) -> Column:
    """The first line in capitals with three letters that is no numeral; '?' where there is none."""
    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), F.trim)
    head = F.filter(lines, lambda x: x.rlike(r"^[A-Z][A-Z .'\-]{2,}$") & (F.length(F.regexp_replace(x, "[^A-Z]", "")) >= 3) & ~x.rlike(r"^[IVXLCDM]+\.?$"))
    return F.coalesce(F.get(head, F.lit(0)), F.lit("?"))


def unprinted_axes(text: Column, lat: Column, lon: Column) -> Column:
    """Flags for coordinates of which the source text names no axis."""
    says = lambda word: F.coalesce(text.rlike(rf"(?i)\b{word}\b"), F.lit(False))
    marks = F.array(F.when(lat.isNotNull() & ~says("lat"), "latitude_not_in_source"), F.when(lon.isNotNull() & ~says("long"), "longitude_not_in_source"))
    return F.filter(marks, lambda x: x.isNotNull())


def toponyms(text: Column) -> Column:
    """Words of three letters and more that start with a capital."""
    return F.regexp_extract_all(text, F.lit(r"([A-ZÀ-Þ][A-Za-zÀ-ÿ.'\-]{2,})"), 1)


def attested(forms: DataFrame) -> DataFrame:
    """key, canonical, n, forms (JSON object of counts, in order), eras: how often each spelling of a folded name is met, and in what eras. forms: key, form, era."""
    n = forms.groupBy("key", "form").agg(F.count("*").alias("c"), F.collect_set("era").alias("e"))
    rank = F.struct(F.col("form").rlike(r"[^\x00-\x7F]"), F.col("form") != F.upper("form"), F.col("c"), F.col("form"))
    out = n.groupBy("key").agg(F.max_by("form", rank).alias("canonical"), F.sum("c").alias("n"), F.array_sort(F.collect_list(F.struct("form", "c"))).alias("f"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("e")))).alias("eras"))
    counts = F.array_join(F.transform("f", lambda x: F.concat(F.lit('"'), x["form"], F.lit('":'), x["c"].cast("string"))), ",")
    return out.select("key", "canonical", "n", F.concat(F.lit("{"), counts, F.lit("}")).alias("forms"), F.array_join("eras", ",").alias("eras"))


def deep_link(volume_ids: dict[str, str], volume: Column, image: Column, base: str) -> Column:
    """Address of a scanned page; null where the volume is not known or has no such page."""
    known = F.lit(None).cast("string")
    for name, ident in volume_ids.items():
        known = F.when(volume == name, ident).otherwise(known)
    return F.concat(F.lit(base), known, F.lit("?seq="), image.cast("string"))


def class_block(dims: DataFrame, cls: str, ident: str, label: str) -> DataFrame:
    """One line of text for each class: its concepts in order of their ids."""
    got = dims.groupBy(cls).agg(F.array_sort(F.collect_list(F.struct(ident, label))).alias("x"))
    return got.select(cls, F.concat(F.col(cls), F.lit(": "), F.array_join(F.transform("x", lambda r: F.concat(r[ident].cast("string"), F.lit(" "), r[label])), "; ")).alias("line"))


def alias_rows(joined: DataFrame, name: str, alias: str) -> DataFrame:
    """Additional names: the place, the name it is known by elsewhere, the join's status and the distance where it was measured."""
    return joined.select("place_id", F.col(name).alias("name"), F.col(alias).alias("alias"), "status", F.round("km", 3).alias("km")).where(F.col(alias).isNotNull() & (F.col(alias) != F.col(name)))


def cohort(rows: DataFrame, key: str, usable: Column, inside: Column, n: int, seed: str) -> tuple[DataFrame, DataFrame]:
    """(n rows drawn by a hash of seed and key from those usable and inside, one row of counts: usable and inside, dropped as outside)."""
    counts = rows.agg(F.count_if(usable & inside).alias("size"), F.count_if(usable & ~inside).alias("dropped"))
    lot = F.md5(F.concat(F.lit(seed), F.col(key).cast("string")).cast("binary"))
    return rows.where(usable & inside).orderBy(lot, key).limit(n), counts
