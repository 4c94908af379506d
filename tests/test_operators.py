"""Operators on small cases, and against brute force."""

import itertools
import math
import random
import re
import statistics
import time
from difflib import SequenceMatcher

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioforge.catalogue import QUERIES
from folioforge.functions import geo, stats, text
from folioforge.operators import cascade, docstream, joins, layout, search, similar
from folioforge.sources import readers, sinks


def values(spark, rows, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*columns).collect()]


def test_classify_line(spark):
    cases = {
        "MALABAR, a district of India": ("MALABAR", "entry"), "LUTTICH. See LIEGE.": ("LUTTICH", "crossref"), "ZALAD, or ZALA. See SZALAD.": ("ZALAD", "crossref"),
        "BUKKOLZ. BUCHHOLZ.": ("BUKKOLZ", "crossref"), "WNW, of the town": None, "XVI, the sixteenth": None, "TOTAL, in tons": None, "A.M. in the morning": None, "Prose line, and more": None,
        "SMITH. A surname here": None, "BATH (New), a village": ("BATH (New)", "entry"),
    }
    got = dict(values(spark, [(k,) for k in cases], "s string", "s", text.classify_line(F.col("s")).alias("c")))
    for line, want in cases.items():
        assert (got[line] and (got[line]["headword"], got[line]["kind"])) == want


def test_text_functions(spark):
    one = lambda x, f: values(spark, [(x,)], "s string", f(F.col("s")).alias("r"))[0][0]
    assert one("ISLE OF MAN", text.title_name) == "Isle of Man"
    assert one("L'AQUILA-DES-ALPES", text.title_name) == "L'Aquila-des-Alpes"
    assert one("aPPPPPPPPPPb -01-02-03 x", text.scrub) == "aPb x"
    assert one("oil and bone NEW ZEALAND. to chance", text.scrub) == "oil and bone to chance"
    assert one("Isère", text.fold) == "isere"
    assert one("See also TARGET TOWN.", text.see_target) == "TARGET TOWN"
    assert one("George (Lake)", lambda c: text.heading_keys(c)) == one("Lake George", lambda c: text.heading_keys(c))
    assert one("x 東京", text.script_of) == "Han"
    assert one("Plain", text.script_of) == "Latin"
    assert one("a <!-- table bbox=[1, 2, 3, 4] --> b", text.box_marks) == [[1, 2, 3, 4]]
    assert one("## p. ? (#21) ####", text.page_mark) == (None, 21)
    assert one(None, text.letters_only) == ""


@settings(max_examples=20, deadline=None)
@given(st.lists(st.text(max_size=20), min_size=1, max_size=20))
def test_fold_is_idempotent(spark, xs):
    f = text.fold(F.col("s"))
    got = values(spark, [(x.replace("\x00", ""),) for x in xs], "s string", f.alias("a"), text.fold(f).alias("b"))
    assert all(a == b for a, b in got)


def test_cheap_looks_before_patterns_lose_nothing(spark):
    r = random.Random(5)
    bits = ["Digitised by Google", "GOOGLE", "goo", "good", "Original From", "UNIVERSITY of Minnesota", "y of minnesota", "Of Minnesota", "received ON board", "Homeward voyage", "orders.", "Landed", "sailed,", "Fullarton", "gazetteer of the world", "Dictionary of Geography",
            "newgate street", "EUSTACE street", "leith walk", "stead’s place", "Stead place", "printers", "imprinters", "\u0130\u212a", "ſ", "é", "12", "1234", "12345", "999\r", "## p. 7 (#9)", "## p. x (#9)", "##  p. 7 (#9)", "AB", "A, b", "ÀB. See CD", "ABC, a town", "A\tBC, a town", "A", "", "a-", "a-.", "-1-2-3-4", "x" * 9]
    lines = [*bits, None, *("".join(r.choice((b, b.upper(), b.lower())) + r.choice(("", " ", "  ", "\n")) for b in r.choices(bits, k=r.randint(2, 4))) for _ in range(1500))]
    x, plain = F.col("x"), F.col("x")
    for pattern, to in ((r"(.)\1{7,}", "$1"), (r"(?:[-–]\d{1,4}){3,}", ""), (text.STAMP, ""), (text.COLOPHON, ""), (text.INLINE_HEAD, "")):
        plain = F.regexp_replace(plain, pattern, to)
    same = {
        "scrub": (text.scrub(x), F.trim(F.regexp_replace(plain, r"\s{2,}", " "))), "stamp": (text.is_stamp(x), x.rlike(text.STAMP)), "mark": (text.is_mark(x), x.rlike(text.STAMP) | x.rlike(text.COLOPHON)),
        "number": (text.is_number(x), x.rlike(r"^\d{1,4}$")), "page": (text.page_mark(x).isNull(), ~x.rlike(text.PAGE_MARK) | x.isNull()), "start": (x.substr(1, 2).rlike(text.HEAD_START) | ~x.rlike(text.HEAD), x.isNull() | F.lit(True)),
    }
    df = spark.createDataFrame([(n,) for n in lines], "x string")
    for name, (a, b) in same.items():
        ask = df if name != "start" else df.where("x IS NOT NULL")
        assert [tuple(y) for y in ask.where(~a.eqNullSafe(b)).collect()] == [], name
    assert df.where(text.is_mark(x)).count() > 500 and df.where(~text.may_be_marked(x)).count() > 20


def test_fold_entries(spark):
    volume = "\n".join([
        "## p. 12 (#20) ####", "<!-- table bbox=[1, 2, 3, 4] -->", "preface lost", "MALABAR, a district of India, on the W coast of the penin-", "sula. Pop. 657.",
        "NAGPUR", "The town lies in a plain — Also a village.", "NAGPUR", "and has the following table.", "LUTTICH. See LIEGE.", "OMEGA", "See ALPHA.",
    ])
    rows = docstream.fold_entries(spark.createDataFrame([(1, volume), (2, None), (3, "")], "v int, text string"), "v").orderBy("seq").collect()
    assert [(r["headword"], r["kind"]) for r in rows] == [("MALABAR", "entry"), ("NAGPUR", "entry"), ("LUTTICH", "crossref"), ("OMEGA", "crossref")]
    assert rows[0]["text"].endswith("of the peninsula. Pop. 657.") and rows[0]["page_start"] == 12
    assert rows[1]["n_also"] == 1 and rows[1]["table_missing"]
    assert rows[2]["see_target"] == "LIEGE" and rows[3]["see_target"] == "ALPHA"


CAPITALS = "A-ZÀ-Þ"


def fold_by_hand(lines, appendix_after):
    """The fold of clean lines as the survey's card tells it, one line after another: [headword, lines of the entry]."""
    key = lambda x: re.sub("[^A-Z]", "", x.upper())
    noise = lambda x: not x.strip() or re.fullmatch(r"\d{1,4}", x.strip()) or "Digitized by" in x
    alone = lambda x: re.fullmatch(rf"[{CAPITALS}][{CAPITALS} ]*[,.]?", x.strip())
    entries, rest = [], []
    for i, line in enumerate(lines):
        if line.strip() == "APPENDIX" and len(entries) > appendix_after:
            rest = lines[i:]
            break
        m = re.match(rf"([{CAPITALS}][{CAPITALS} ]{{2,}}), ([a-z].*)", line)
        if m and m[1] not in ("TOTAL", "XVII"):
            entries.append([m[1], m[2]])
            continue
        if alone(line):
            name = line.strip(" ,.")
            ahead = next((x for x in lines[i + 1 :] if not noise(x)), "")
            said = [x for x in (entries[-1][1:] if entries else []) if not noise(x)]
            ended = not said or said[-1].rstrip()[-1] in ".!?"
            if len(key(name)) >= 4 and len(name.split()) <= 5 and name not in ("TOTAL", "XVII") and key(name) > key(entries[-1][0] if entries else "") and ahead and not alone(ahead) and ended:
                entries.append([name])
                continue
            if entries and key(name) == key(entries[-1][0]):
                continue
        if entries:
            entries[-1].append(line)
    return entries, rest


@pytest.mark.parametrize("seed", range(4))
def test_fold_equals_the_card(spark, seed):
    rnd = random.Random(seed)
    names = ["ALFA", "BRAVO", "CHARLIE BAY", "DELTA", "ECHO", "TOTAL", "XVII", "ABC", "ALPHA BETA GAMMA DELTA EPSILON ZETA"]
    made = [lambda: rnd.choice(names), lambda: rnd.choice(names) + ", " + rnd.choice(["a town.", "a river", "see below"]), lambda: rnd.choice(["It lies low.", "and beyond", "Pop. 600.", "of the hills", "12", "Digitized by Google", "", "APPENDIX"])]
    volumes = [[rnd.choice(made)() for _ in range(rnd.randrange(40))] for _ in range(25)]
    for lines in volumes:
        lines.insert(0, "preface, in lower case.")  # no running head stands before it
    rows = [(v, k + 1, None, x) for v, lines in enumerate(volumes) for k, x in enumerate(lines)]
    df = spark.createDataFrame(rows, "v int, at long, page int, line string")
    got = docstream.folded(docstream.judged_lines(df, "v"), "v", appendix_after=3)
    entries = {(r["v"], r["seq"]): r["headword"] for r in docstream.entries_of(got, "v").collect()}
    texts = {(r["v"], r["seq"]): r["text"] for r in docstream.entries_of(got, "v").collect()}
    back = {r["v"]: r["n"] for r in got.where("part = 9").groupBy("v").agg(F.count("*").alias("n")).collect()}
    for v, lines in enumerate(volumes):
        want, rest = fold_by_hand(lines, 3)
        assert [entries[v, k] for k in range(len(want))] == [e[0] for e in want] and (v, len(want)) not in entries, (v, lines)
        assert back.get(v, 0) == len(rest)
        for k, e in enumerate(want):
            kept = " ".join(x.strip() for x in e[1:] if x.strip())
            assert texts[v, k].replace(" ", "").endswith(re.sub("Digitized by Google", "", kept).replace(" ", ""))


def test_pages_are_healed_before_the_fold_and_back_matter_is_kept(spark):
    volume = "## p. 3 (#5) ####\nALFA BRAVO\n3\nABBEVILLE, a town\nUNI-\nVERSITY OF MINNESOTA\nof France.\nBAN-\nGOR, a city.\fof wales.\nAPPENDIX\n1. Lists\nDELTA, a mouth."
    df = spark.createDataFrame([("v", volume)], "v string, text string")
    rows = docstream.fold_entries(df, "v", appendix_after=1).orderBy("seq").collect()
    assert [(r["headword"], r["page_start"]) for r in rows] == [("ABBEVILLE", 3), ("BANGOR", 3)]
    kept = docstream.back_matter(df, "v", appendix_after=1).collect()
    assert [(r["text"], r["n_lines"]) for r in kept] == [("APPENDIX\n1. Lists\nDELTA, a mouth.", 3)]


def test_pages_and_cleaning(spark):
    page = "## p. 7 (#9) ####\n7\nALPHA BETA\nDigitized by Google\nfirst penin-\nsula line\nCACHOE-\nIRA. See X.\nprose-\nNext, word"
    rows = docstream.pages(spark.createDataFrame([("v", page)], "v string, text string"), "v")
    healed = docstream.heal_hyphens(rows.select("v", "chunk", "printed", "line_no", "line"), ["v", "chunk", "printed"])
    got = [r["line"] for r in docstream.clean_body(healed, ["v", "chunk", "printed"]).orderBy("line_no").collect()]
    assert got == ["first peninsula line", "CACHOEIRA. See X.", "prose-", "Next, word"]


def test_merge_is_checked(spark):
    pages = spark.createDataFrame([("v", 2, "b"), ("v", 1, "a")], "v string, page int, body string")
    merged = docstream.merged_text(pages, "v", "page", "body").first()["text"]
    assert merged.endswith("\na\fb") and "pages=2" in merged


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 9)), max_size=15), st.lists(st.tuples(st.integers(0, 2), st.integers(0, 9)), max_size=15))
def test_asof_equals_brute_force(spark, left, right):
    l = spark.createDataFrame([(i, k, t) for i, (k, t) in enumerate(left)], "id int, k int, t int")  # noqa: E741
    r = spark.createDataFrame([(k, t, i) for i, (k, t) in enumerate(right)], "k int, t int, v int")
    got = {x["id"]: x["prev_v"] for x in joins.asof_backward(l, r, ["k"], "t", ["v"]).collect()}
    for i, (k, t) in enumerate(left):
        best = max(((rt, v) for v, (rk, rt) in enumerate(right) if rk == k and rt <= t), default=(None, None))
        assert got[i] == best[1]
    split = {x["id"]: x["prev_v"] for x in joins.asof_backward_split(l, r, ["k"], "t", ["v"], F.floor(F.col("t") / 3)).collect()}
    assert split == got


def test_split_as_of_carries_whole_rows_and_null_keys(spark):
    right = spark.createDataFrame([(1, 1, 7, 8), (1, 2, 9, None), (None, 1, 5, None)], "k int, t int, a int, b int")
    left = spark.createDataFrame([(1, 1, 3), (2, 1, 50), (3, None, 4), (4, 2, 9)], "id int, k int, t int")
    for bucket in (1, 3, 100):
        got = {r["id"]: (r["prev_a"], r["prev_b"]) for r in joins.asof_backward_split(left, right, ["k"], "t", ["a", "b"], F.floor(F.col("t") / bucket)).collect()}
        assert got == {r["id"]: (r["prev_a"], r["prev_b"]) for r in joins.asof_backward(left, right, ["k"], "t", ["a", "b"]).collect()} == {1: (9, None), 2: (9, None), 3: (5, None), 4: (None, None)}


def test_insert_or_ignore_adds_one_row_a_key(spark):
    stored = spark.createDataFrame([(1, "old")], "k int, v string")
    fresh = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a"), (None, "n"), (None, "n")], "k int, v string")
    assert sorted(map(tuple, sinks.added(stored, fresh, ["k"]).collect()), key=str) == [(1, "old"), (2, "a"), (None, "n"), (None, "n")]
    assert (2, "b") in map(tuple, sinks.added(stored, fresh, ["k"], [F.desc("v")] if False else [F.length("v"), F.when(F.col("v") == "b", 0).otherwise(1)]).collect())


def test_next_value_over_parts(spark):
    rnd = random.Random(2)
    rows = [(rnd.randrange(300),) for _ in range(500)] + [(None,)]
    got = sorted((r["x"], r["n"] if r["n"] is not None else 10**6) for r in joins.with_next(spark.createDataFrame(rows, "x int"), "x", "n", parts=7).collect() if r["x"] is not None)
    xs = sorted(x for (x,) in rows if x is not None)
    assert got == sorted(zip(xs, [*xs[1:], 10**6], strict=True))


def test_batches_that_come_again_replace_themselves(spark, tmp_path):
    from folioforge.streaming import windows

    spark.range(5).coalesce(1).write.parquet(str(tmp_path / "in"))
    for again in range(2):  # the second run has lost its checkpoint, and gives batch 0 again
        stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
        windows.enrich_stream(stream, lambda df: df.withColumn("x", F.col("id") * 2), str(tmp_path / "out"), str(tmp_path / f"cp{again}")).awaitTermination(60)
    assert sorted(r["x"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [0, 2, 4, 6, 8]


def test_distance_join_equals_brute_force(spark):
    rnd = random.Random(3)
    point = lambda: (rnd.choice([rnd.uniform(-90, 90), 89.9, -89.9]), rnd.choice([rnd.uniform(-180, 180), 179.9, -179.9]))
    a, b = [(i, *point()) for i in range(150)], [(i, *point()) for i in range(150)]

    def km(p, q):
        la, lo, lb, lp = map(math.radians, (p[1], p[2], q[1], q[2]))
        h = math.sin((lb - la) / 2) ** 2 + math.cos(la) * math.cos(lb) * math.sin((lp - lo) / 2) ** 2
        return 2 * 6371.0 * math.asin(math.sqrt(min(1, h)))

    got = joins.within_distance(spark.createDataFrame(a, "i int, lat double, lon double"), spark.createDataFrame(b, "j int, lat double, lon double"), 500.0)
    assert sorted((r["i"], r["j"]) for r in got.collect()) == sorted((p[0], q[0]) for p in a for q in b if km(p, q) <= 500.0)


def test_nearest_within_key_equals_brute_force(spark):
    rnd = random.Random(13)
    at = lambda: (round(rnd.uniform(-90, 90), 1), round(rnd.uniform(-180, 180), 1))
    left = [(i, rnd.choice("abc"), *at()) for i in range(60)]
    right = [(100 + i, rnd.choice("abd"), *at()) for i in range(40)] + [(500, "a", *left[0][2:]), (501, "a", *left[0][2:])]
    l = spark.createDataFrame(left, "id int, k string, lat double, lon double")  # noqa: E741
    r = spark.createDataFrame(right, "other int, k string, lat double, lon double")

    def km(a, b):
        p, q, x, y = map(math.radians, (*a, *b))
        h = math.sin((x - p) / 2) ** 2 + math.cos(p) * math.cos(x) * math.sin((y - q) / 2) ** 2
        return 2 * 6371.0 * math.asin(math.sqrt(min(1, h)))

    want = {}
    for i, k, *a in left:
        near = [(round(km(a, b), 6), j) for j, m, *b in right if m == k]
        if near:
            want[i] = min(near)[1]
    for first in (50.0, 5000.0):
        got = {x["id"]: x["other"] for x in joins.nearest_within_key(l, r, ["k"], "id", "other", first_km=first).collect()}
        assert got == want


def rows_of_joins(df):
    """Most rows that a join of the plan gave, once the query has run."""
    df.collect()
    found = []

    def walk(p):
        if p.nodeName().startswith("AdaptiveSparkPlan"):
            walk(p.executedPlan())
        elif "QueryStage" in p.nodeName():
            walk(p.plan())
        got = p.metrics().get("numOutputRows")
        if "Join" in p.nodeName() and got.isDefined():
            found.append(got.get().value())
        kids = p.children()
        for i in range(kids.size()):
            walk(kids.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return max(found)


def crowded(rnd, n, first):
    """Points of which many lie at few places, at the poles, at the date line and at either writing of one place."""
    places = [(90.0, 10.0), (90.0, -170.0), (-90.0, 0.0), (12.5, 180.0), (12.5, -180.0), (12.5, 179.95), (0.0, 0.0), (0.1, 0.0), (50.0, 7.0)]
    return [(first + i, rnd.choice("abc"), *(rnd.choice(places) if rnd.random() < 0.7 else (round(rnd.uniform(-90, 90), 1), round(rnd.uniform(-180, 180), 1)))) for i in range(n)]


def great_circle(a, b):
    p, q, x, y = map(math.radians, (*a, *b))
    h = math.sin((x - p) / 2) ** 2 + math.cos(p) * math.cos(x) * math.sin((y - q) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(min(1, h)))


def test_k_nearest_points_equal_brute_force(spark):
    rnd = random.Random(29)
    left, right = crowded(rnd, 150, 0), crowded(rnd, 200, 1000)
    l = spark.createDataFrame([*left, (990, "a", None, 3.0), (991, "a", float("nan"), 3.0)], "id int, k string, lat double, lon double")  # noqa: E741
    r = spark.createDataFrame([*right, (5000, "a", None, None), (5001, "a", float("nan"), 1.0)], "other int, k string, lat double, lon double")
    for by, k, most in (([], 3, 2000.5), (["k"], 1, 20100.0), (["k"], 4, 900.0), ([], 300, 20100.0)):
        other = r if by else r.drop("k")
        got = sorted((x["id"], x["nth"], x["other"]) for x in joins.nearest_points(l, other, by, "other", k, most).collect())
        want = []
        for i, key, *a in left:
            near = sorted((round(great_circle(a, b), 6), j) for j, m, *b in right if (m == key or not by) and great_circle(a, b) <= most)[:k]
            want += [(i, n + 1, j) for n, (_, j) in enumerate(near)]
        assert got == sorted(want)


def test_nearest_points_form_few_pairs(spark):
    """Copies of a place, and points far away, are not paired: 2,000 by 2,000 points would be 4,000,000 pairs, 2,000 by 2,000 / 3 within a key."""
    rnd = random.Random(31)
    l = spark.createDataFrame(crowded(rnd, 2000, 0), "id int, k string, lat double, lon double")  # noqa: E741
    r = spark.createDataFrame(crowded(rnd, 2000, 10000), "other int, k string, lat double, lon double")
    assert rows_of_joins(joins.nearest_within_key(l, r, ["k"], "id", "other", first_km=5000.0)) < 100_000


def test_distance_join_of_copies(spark):
    """Pairs of places are measured once and given to all points at them."""
    rnd = random.Random(37)
    a, b = crowded(rnd, 120, 0), crowded(rnd, 120, 1000)
    l = spark.createDataFrame([*a, (990, "a", None, 3.0)], "i int, k string, lat double, lon double")  # noqa: E741
    r = spark.createDataFrame(b, "j int, k string, lat double, lon double")
    got = joins.within_distance(l, r, 600.5, by=["k"], digits=3)
    assert got.columns == ["i", "k", "lat", "lon", "j", "km"]
    want = sorted((p[0], q[0], round(great_circle(p[2:], q[2:]), 3)) for p in a for q in b if p[1] == q[1] and great_circle(p[2:], q[2:]) <= 600.5)
    assert sorted((x["i"], x["j"], x["km"]) for x in got.collect()) == want


def test_point_in_rings_with_hole_and_tolerance(spark):
    square = lambda x0, x1: [(x0, x0, x1, x0), (x1, x0, x1, x1), (x1, x1, x0, x1), (x0, x1, x0, x0)]
    edges = spark.createDataFrame([(1, *map(float, e)) for e in square(0, 10) + square(4, 6)], "area_id int, x1 double, y1 double, x2 double, y2 double")
    pts = [(1, 2.0, 2.0), (2, 5.0, 5.0), (3, -0.019, 5.0), (4, -0.021, 5.0), (5, 20.0, 5.0)]
    got = dict(joins.point_in_rings(spark.createDataFrame([(i, 1, x, y) for i, x, y in pts], "point_id int, area_id int, x double, y double"), edges, 0.02).select("point_id", "inside").collect())
    assert got == {1: True, 2: False, 3: True, 4: False, 5: False}


def test_winner_rules(spark):
    hits = [
        ("a", 1, 100.0, None, False, "point"), ("a", 2, 99.0, 50.0, True, "poly"), ("b", 1, 100.0, 50.0, False, "point"), ("b", 2, 98.9, 50.0, True, "poly"), ("c", 1, 79.9, 90.0, False, "low"), ("d", 1, 95.0, 29.9, False, "unsure"),
        ("d", 2, 85.0, 30.0, False, "sure"), ("e", 1, 80.2, 40.0, False, "point"), ("e", 2, 79.5, 40.0, True, "poly"), ("f", 2, 90.0, 40.0, False, "second"), ("f", 1, 90.0, 40.0, False, "first"),
    ]
    df = spark.createDataFrame(hits, "k string, rank int, score double, confidence double, has_geom boolean, name string")
    assert {r["k"]: r["name"] for r in cascade.winners(df, ["k"]).collect()} == {"a": "poly", "b": "point", "d": "sure", "e": "poly", "f": "first"}


def test_cascade_passes_are_disjoint(spark):
    asks = spark.range(20).withColumnRenamed("id", "k")
    passes = [(f"p{m}", lambda left, m=m: left.where(F.col("k") % m == 0).withColumn("hit", F.lit(m))) for m in (6, 3, 2)]
    out = cascade.cascade(asks, "k", passes)
    got = {r["k"]: r["pass"] for r in out.collect()}
    assert got == {k: "p6" if k % 6 == 0 else "p3" if k % 3 == 0 else "p2" for k in range(20) if k % 6 == 0 or k % 3 == 0 or k % 2 == 0}
    assert out.count() == len(got)


def test_statistics(spark):
    xs = [1.0, 2.0, 3.0, 4.0, 10.0, 11.0]
    df = spark.createDataFrame([(1, x) for x in [*xs, 3.0, None]] + [(2, 5.0)], "g int, x double")
    r = spark.createDataFrame([(x,) for x in xs], "x double").agg(stats.upper_median("x").alias("u"), stats.true_median("x").alias("t")).first()
    assert (r["u"], r["t"]) == (sorted(xs)[len(xs) // 2], statistics.median(xs))
    for q in (1, 2, 3):
        got = stats.exclusive_quantiles(df, ["g"], "x", q / 4).collect()
        assert [r["g"] for r in got] == [1] and abs(got[0]["value"] - statistics.quantiles([*xs, 3.0], n=4)[q - 1]) < 1e-9
    w = values(spark, [(8, 10), (0, 0)], "k int, n int", stats.wilson(F.col("k"), F.col("n")).alias("w"))
    assert abs(w[0][0]["lo"] - 0.4902) < 1e-3 and w[1][0] is None


def test_geo_parsing(spark):
    got = values(spark, [("30.32",), ("30.60",), ("29-34",), ("x",)], "s string", geo.degrees_minutes(F.col("s")).alias("d"))
    assert [None if x[0] is None else round(x[0], 4) for x in got] == [30.5333, None, 31.5, None]
    assert [x[0] and round(x[0], 4) for x in values(spark, [("51°30'0\"N",), ("0° 7' W",), ("bad",)], "s string", geo.dms(F.col("s")).alias("d"))] == [51.5, -0.1167, None]


def test_layout():
    prose = [((10, 20 * k, 450, 20 * k + 14), f"left {k} " + "word " * 8) for k in range(45)] + [((520, 20 * k, 980, 20 * k + 14), f"right {k} " + "word " * 8) for k in range(45)]
    page = layout.assemble(prose, 1000, 1400)
    assert page["n_tables"] == 0 and not page["plate"] and page["text"].split("\n")[45].startswith("right 0")
    cells = [((30 + 160 * c, 30 * r + 10, 100 + 160 * c, 30 * r + 26), "12") for r in range(8) for c in range(3)]
    assert len(layout.table_regions([b for b, _ in cells], 1000)) == 1
    assert layout.table_regions([], 1000) == [] and layout.assemble([], 10, 10)["plate"]
    assert layout.column_starts([0] * 5 + [250] * 4 + [500] * 3 + [750] * 2, 1000) == ([-8, 240, 492, 740], True)
    assert layout.column_starts([], 1000)[1] is False


def test_layout_of_small_pages_and_null_lines(spark, monkeypatch):
    """Pages with too few boxes for a table are not clustered; pages without lines, and null texts, are pages."""
    few = [((10, 20 * k, 90, 20 * k + 14), f"line {k}") for k in range(6)]
    monkeypatch.setattr(layout, "cluster_rows", None)
    assert layout.assemble(few, 1000, 1400)["n_tables"] == 0
    monkeypatch.undo()
    rows = [(1, 1000, 1400, few), (2, 1000, 1400, None), (3, 1000, 1400, []), (4, 1000, 1400, [((10, 20, 40, 34), "12"), ((10, 200, 40, 214), None)])]
    pages = spark.createDataFrame(rows, "k long, w int, h int, lines array<struct<bbox array<int>, text string>>").coalesce(1)
    got = {r["k"]: (r["printed"], r["n_tables"], r["plate"], r["text"], r["table_boxes"]) for r in layout.assemble_pages(pages, ["k"]).collect()}
    assert got == {1: (None, 0, True, "", []), 2: (None, 0, True, "", []), 3: (None, 0, True, "", []), 4: (12, 0, True, "", [])}


def test_similarity(spark):
    name = lambda *xs: spark.createDataFrame([(x,) for x in xs], "name string")
    got = {tuple(r) for r in similar.pair_within_blocks(name("ABBEVILLE", "BATH", "CAMBRIDGESHIRE"), name("ABBEVILE", "BATH", "CAMBRIDGE"), "name").collect()}
    assert got == {("BATH", "BATH", "exact"), ("ABBEVILLE", "ABBEVILE", "ratio"), ("CAMBRIDGESHIRE", "CAMBRIDGE", "contained")} or ("CAMBRIDGESHIRE", "CAMBRIDGE", "ratio") in got
    fixed = similar.aligned_replacements(spark.createDataFrame([(1, "a villnge here", "a village here"), (2, None, "x")], "k int, a string, b string"), "k", "a", "b").collect()
    assert [tuple(r) for r in fixed] == [(1, 1, "villnge", "village")]


def test_replacements_in_slices(spark):
    """A batch with more tokens than are held at once gives the same rows, each with its own key."""
    assert similar.TOKENS_AT_ONCE == 200_000
    rows = [(k, " ".join(f"w{i}" for i in range(30_000)), " ".join("x" if i == 7 * k + 3 else f"w{i}" for i in range(30_000))) for k in range(9)] + [(None, "a b c", "a d c"), (10, "", None)]
    got = similar.aligned_replacements(spark.createDataFrame(rows, "k int, a string, b string").coalesce(1), "k", "a", "b").collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(k, 7 * k + 3, f"w{7 * k + 3}", "x") for k in range(9)] + [(None, 1, "b", "d")], key=repr)


def test_pairs_across_blocks(spark):
    name = lambda *xs: spark.createDataFrame([(x,) for x in xs], "name string")
    left, right = name("XABBEVILLE", "YABBEVILLE", "QLONDON", "ELSEWHERE", "PERTHSHIRE"), name("ABBEVILLE", "LONDON", "NELSEWHERES", "XPERTHSHIREX")
    got = {tuple(r) for r in similar.pair_within_blocks(left, right, "name").collect()}
    assert got == {("XABBEVILLE", "ABBEVILLE", "contained_across"), ("ELSEWHERE", "NELSEWHERES", "contained_across"), ("PERTHSHIRE", "XPERTHSHIREX", "contained_across")}


def test_closest_as_brute_force():
    r = random.Random(3)
    names = lambda: sorted({"a" + "".join(r.choice("abcd") for _ in range(r.randint(0, 12))) for _ in range(60)})
    for _ in range(20):
        free, out = names(), []
        asked, close = names(), similar.Closest(free)
        for n in asked:
            best = max(((similar.ratio(n, m), m) for m in free), default=(0.0, ""))
            hit = (best[1], "ratio") if best[0] >= 0.82 else next(((m, "contained") for m in free if min(len(m), len(n)) >= 6 and (m in n or n in m)), None)
            if hit:
                free.remove(hit[0])
            out.append(hit)
        assert [close.take(n, 0.82, 6) for n in sorted(asked)] == out


def test_pairs_as_greedy_brute_force(spark):
    r = random.Random(17)
    word = lambda: r.choice("abä") + "".join(r.choice("bcde") for _ in range(r.randint(3, 9)))
    left = sorted({word() for _ in range(90)} | {f"z{n} plate" for n in range(9)} | {"y", "same", "e\u0301t\u00e9"})
    right = {w[: (at := r.randint(0, len(w)))] + r.choice("cde") + w[at:] for w in left for _ in range(r.choice((0, 1, 1, 2)))} | {word() for _ in range(30)} | {f"z{n} xplate" for n in range(11)} | {"yy", "same"}
    want, free, asked = {(n, n, "exact") for n in right & set(left)}, sorted(right - set(left)), [n for n in left if n not in right]
    for n in asked:
        block = [m for m in free if m[:1] == n[:1]]
        best = max(((similar.ratio(n, m), m) for m in block), default=(0.0, ""))
        hit = (best[1], "ratio") if best[0] >= 0.82 else next(((m, "contained") for m in block if min(len(m), len(n)) >= 6 and (m in n or n in m)), None)
        if hit:
            free.remove(hit[0])
            want.add((n, *hit))
    names = lambda x: spark.createDataFrame([(n,) for n in x], "name string")
    got = {tuple(x) for x in similar.pair_within_blocks(names(left), names(sorted(right)), "name").collect()}
    assert {x for x in got if x[2] != "contained_across"} == want and sum(x[2] == "ratio" for x in want) > 40
    assert {x[2] for x in want} >= {"exact", "ratio"}


def test_copies_by_a_letter_are_not_compared_with_all(spark):
    # 4,000 names of the same letters: all of their copies have the same letters in common with each, so nothing short of the order tells them apart
    names = ["k" + "".join(p) for p in itertools.islice(itertools.permutations("abcdefgh"), 4000)]
    df = lambda x: spark.createDataFrame([(n,) for n in x], "name string")
    began = time.monotonic()
    got = {tuple(x) for x in similar.pair_within_blocks(df(names), df([n[:5] + "x" + n[5:] for n in names]), "name").collect()}
    assert got == {(n, n[:5] + "x" + n[5:], "ratio") for n in names}
    assert time.monotonic() - began < 90


def test_similarity_pairs_takes_every_part(spark):
    sf = "/root/testdata/sf0.001"
    got = QUERIES["similarity_pairs"](spark, sf).collect()
    assert len(got) == len({r["left_name"] for r in got}) == spark.read.parquet(f"{sf}/part.parquet").count()


def test_within_edits_as_brute_force(spark):
    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    r = random.Random(9)
    words = sorted({"".join(r.choice("abc") for _ in range(r.randint(0, 8))) for _ in range(120)} | {"old", "cold", "ä", "café"})
    most = lambda a: 0 if len(a) <= 2 else 1 if len(a) <= 5 else 2
    got = similar.within_edits(spark.createDataFrame([(w,) for w in [*words, *words[:9], None]], "w string"), "w", search.edit_limit).collect()
    assert sorted(tuple(x) for x in got) == sorted((a, b, edits(a, b)) for a in words for b in words if a != b and edits(a, b) <= most(a))


def test_edits_link_all_parts(spark):
    part = spark.read.parquet("/root/testdata/sf0.001/part.parquet")
    got = QUERIES["similarity_edits_all"](spark, "/root/testdata/sf0.001").collect()
    assert sum(r["kind"] == "member" for r in got) == part.count() - part.select("p_name").distinct().count() > 0


def test_fuzzy_words_of_any_first_letter(spark):
    got = {tuple(r) for r in QUERIES["fuzzy_words_all"](spark, "/root/testdata/sf0.001").collect()}
    assert {("old", "cold", 1), ("cold", "old", 1)} <= got


def test_pairs_tiles_and_boxes_of_all_rows(spark):
    sf = "/root/testdata/sf0.001"
    rows = lambda name: spark.read.parquet(f"{sf}/{name}.parquet")
    assert sum(QUERIES["paired_2x2_all"](spark, sf).first()) == rows("events").select("user_id").distinct().count()
    assert QUERIES["map_tiles_all"](spark, sf).count() == rows("customer").count()
    assert QUERIES["province_check_all"](spark, sf).where("flags <> ''").count() == 0


def test_knn_asks_for_every_hundredth_vector(spark):
    sf = "/root/testdata/sf0.001"
    asked = spark.read.parquet(f"{sf}/embeddings.parquet").where("vec_id % 100 = 0").count()
    assert QUERIES["knn_dot_all"](spark, sf).count() == 5 * asked > 15


def test_alignment_as_difflib():
    r = random.Random(5)
    for n, v in ((0, 3), (40, 4), (150, 60), (230, 9), (400, 30), (900, 200)):
        for _ in range(6):
            x = [str(int(r.random() ** 2 * v)) for _ in range(n)]
            y = [w + "x" if i % 10 == 9 else w for i, w in enumerate(x)]
            at = r.randint(0, n)
            y[at : at + r.randint(0, 5)] = r.choice([[], ["z"], y[: r.randint(0, 9)]])
            ops = SequenceMatcher(None, x, y).get_opcodes()
            assert list(similar.replacements(x, y)) == [(i, j) for tag, i, i2, j, j2 in ops if tag == "replace" and i2 - i == j2 - j == 1]


def test_token_align_takes_every_text(spark, tmp_path):
    words = [f"w{i}" for i in range(1500)]
    rows = [(1, " ".join(words), len(" ".join(words))), (2, " ".join(words[:30]), None), (3, " ".join(words[:20]), 100)]
    spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["token_align"](spark, str(tmp_path)).groupBy("doc_id").count().collect()
    assert {tuple(r) for r in got} == {(1, 150), (2, 3), (3, 2)}


def test_search(spark):
    docs = spark.createDataFrame([(1, "Le café du port"), (2, "cafe cafe"), (3, None)], "id int, t string")
    index = search.postings(docs, "id", "t")
    top = search.bm25(index, "id", 3, 2.0, ["cafe"]).orderBy(F.desc("score")).first()
    assert top["id"] == 2
    assert values(spark, [([0.5, -2.0, 0.0],)], "v array<double>", search.quantise(F.col("v")).alias("q"))[0][0] == [64, -127, 0]


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "page_2.txt").write_text("b")
    (tmp_path / "page_10.txt").write_text("a")
    assert [r["page"] for r in readers.page_files(spark, str(tmp_path)).orderBy("page").collect()] == [2, 10]
    (tmp_path / "x.jsonl").write_text('{"entry_id": 1, "model": "m"}\n\n{"entry_id": 2, "mod\n')
    assert readers.json_lines(spark, str(tmp_path / "x.jsonl"), "entry_id int, model string").count() == 1
    (tmp_path / "x.nt").write_text('<http://a/1> <http://p> "Stadt"@de .\n<http://a/2> <http://q> <http://a/1> .\nbad\n')
    assert {(r["object"], r["lang"]) for r in readers.triples(spark, str(tmp_path / "x.nt")).collect()} == {("Stadt", "de"), ("http://a/1", None)}
    rows = spark.createDataFrame([(1, "v1"), (None, "v2"), (3, "v1")], "page int, v string")
    fresh = spark.createDataFrame([(None, "v2"), (9, "v9")], "page int, v string")
    assert sinks.replaced(rows, fresh, ["page", "v"]).count() == 4
    sinks.replace_by(rows, str(tmp_path / "out"), ["v"])
    sinks.replace_by(spark.createDataFrame([(7, "v1")], "page int, v string"), str(tmp_path / "out"), ["v"])
    assert sorted(r["page"] or 0 for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [0, 7]


def test_wkb(spark):
    import struct

    ring = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 0.0)]
    polygon = struct.pack("<BII", 1, 3, 1) + struct.pack("<I", 4) + b"".join(struct.pack("<2d", *p) for p in ring)
    multi = struct.pack(">BII", 0, 6, 1) + polygon
    got = readers.wkb_rings(spark.createDataFrame([("a", bytearray(polygon)), ("b", bytearray(multi)), ("c", None)], "place_id string, wkb binary"))
    assert sorted((r["place_id"], r["x2"], r["y2"]) for r in got.collect()) == sorted((p, *q) for p in "ab" for q in ring[1:])


def test_streaming_counts(spark, tmp_path):
    from folioforge.streaming import windows

    spark.sql("SELECT timestamp'2024-01-01 00:00:01' ts, 'a' kind UNION ALL SELECT timestamp'2024-01-01 00:00:59', 'a' UNION ALL SELECT timestamp'2024-01-01 00:01:01', 'b'").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp, kind string").parquet(str(tmp_path / "in"))
    q = windows.tumbling_counts(stream, "ts", "1 minute", ["kind"], late="10 minutes").writeStream.outputMode("complete").format("memory").queryName("counts").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted((r["kind"], r["n"]) for r in spark.table("counts").collect()) == [("a", 2), ("b", 1)]


@pytest.mark.parametrize("empty", ["winners", "asof"])
def test_empty_tables(spark, empty):
    if empty == "winners":
        assert cascade.winners(spark.createDataFrame([], "k string, rank int, score double, confidence double, has_geom boolean"), ["k"]).count() == 0
    else:
        none = spark.createDataFrame([], "k int, t int, v int")
        assert joins.asof_backward(none, none, ["k"], "t", ["v"]).count() == 0


def test_index_pages_carry_names_over_rows_columns_and_pages(spark):
    from folioforge.operators import index_pages

    line = lambda x, y, t: ([x, y, x + 180, y + 10], t)
    first = [line(0, 20 * k, f"Town{k}, Prov 30.{10 + k} N 110.20 E") for k in range(6)] + [line(250, 20 * k, f"City{k}, Prov 31.10 N 111.20 E") for k in range(5)]
    first += [line(500, 20 * k, f"Port{k}, Prov 31.10 N 112.20 E") for k in range(4)] + [line(750, 20 * k, f"Cape{k}, Prov 30.75 N 112.20 E") for k in range(3)] + [line(750, 100, "Long Name That")]
    second = [line(0, 0, "Wraps, Prov 29-34 N 115-119 E"), line(0, 20, "Bad, Prov 137.19 N 110.0 E"), line(0, 40, "A, P 30.1 N 110.1 E B, Q 31.1 N 111.1 E")]
    rows = [("v", n, 1000, [{"bbox": b, "text": t} for b, t in page]) for n, page in ((1, first), (2, second))]
    pages = spark.createDataFrame(rows, "volume string, page int, w int, lines array<struct<bbox:array<int>,text:string>>")
    got = {r["name"]: r for r in index_pages.parse_pages(pages).collect()}
    assert {"Town0", "City4", "Port3", "Long Name That Wraps", "A", "B"} <= set(got) and "Cape0" not in got and "Bad" not in got
    assert got["Long Name That Wraps"]["is_range"] and got["Long Name That Wraps"]["lat"] == 31.5
    assert abs(got["Town0"]["lat"] - 30.1667) < 1e-3 and got["B"]["province"] == "Q"


def test_enrichment_asks_once_and_keeps_errors(spark):
    from folioforge.operators import enrich

    asks = spark.createDataFrame([("a", "x", 1), ("a", "x", 2), ("b", "boom", 3), ("c", "y", 4)], "key string, text string, n int")
    cache = spark.createDataFrame([("c", "known")], "key string, response string")

    def fn(texts):
        if "boom" in texts:
            raise ValueError("no answer")
        return [t.upper() for t in texts]

    out, fresh = enrich.enriched(asks, cache, fn, tries=2)
    assert {(r["n"], r["response"], r["error"]) for r in out.collect()} == {(1, "X", None), (2, "X", None), (3, None, "no answer"), (4, "known", None)}
    assert {r["key"] for r in fresh.collect()} == {"a"}


def test_expectations(spark):
    from folioforge.operators import quality

    df = spark.range(3)
    assert quality.expect(df, F.col("id") >= 0, "ids").count() == 3
    with pytest.raises(AssertionError, match="1 rows"):
        quality.expect(df, F.col("id") > 0, "ids")


def test_repeated_letters_are_those_of_the_sql(spark):
    """Only the letters that the SQL names count as repeated; other letters three times in a row do not."""
    from folioforge.operators import quality

    heads = ["BAAAD", "ZZZOE", "BALLLAD", "OTTTO", "PUUUR", "HHHO", "OXXX7"]
    got = values(spark, [(h, "x" * 40) for h in heads], "h string, b string", F.array_join(quality.intrinsic_flags(F.col("h"), F.col("b")), ",").alias("f"))
    assert [f[0] for f in got] == ["repeated", "", "", "repeated", "", "repeated", "digits"]


def test_salvage(spark):
    from folioforge.operators import enrich

    got = values(spark, [('{"type": "map", "n": 3',), ('{"type": "map"}',), ("x",)], "s string", enrich.salvage_field(F.col("s"), "type").alias("a"), enrich.salvage_field(F.col("s"), "n").alias("b"))
    assert got == [("map", "3"), ("map", None), (None, None)]


def test_passes_by_sound(spark):
    """Each place is answered by the first pass that can: by name within its parent, by sound there, in the next broader one, in its country."""
    from folioforge.operators import phonetic

    index = [(10, "Bath", "GB", ["R1", "N1"], 95.0, True, 51.0, -2.0), (11, "Kanton", "CN", ["R2", "N2"], 88.0, True, 23.0, 113.0), (12, "Shansi", "CN", ["R2", "N9"], 31.0, False, 37.0, 112.0), (13, "Shansi", "CN", ["R3", "N8"], 20.0, True, 38.0, 111.0), (14, "Filipi", None, ["R4"], None, True, None, None)]
    places = [(1, "BATH", "GB", ["R1", "N1"], None, None), (2, "Canton", "CN", ["R2", "N2"], None, None), (3, "Shan-see", "CN", ["R2", "N7"], None, None), (4, "Phillipi", None, [], None, None), (5, "Nowhere", "GB", ["R1"], None, None), (6, "Bathe", "GB", [], 51.1, -2.0), (7, "Bath", "GB", [], 40.0, -2.0), (8, "Shansee", "CN", ["R3", "N8"], None, None)]
    i = spark.createDataFrame(index, "place_id long, title string, country_code string, parents array<string>, confidence double, has_geom boolean, lat double, lon double")
    p = spark.createDataFrame(places, "place_id long, name string, country_code string, parents array<string>, lat double, lon double")
    got = {r["place_id"]: (r["hit_id"], r["pass"], r["status"]) for r in phonetic.reconciled(p, i).collect()}
    assert got == {1: (10, "1-exact-in", "reconciled"), 2: (11, "2-phon-in", "reconciled"), 3: (12, "3-phon-broad", "reconciled"), 4: (14, "4-phon-cc", "reconciled"), 5: (None, None, "unmatched"), 6: (10, "coord-match", "reconciled"), 7: (None, "coord-only", "coord_only"), 8: (12, "4-phon-cc", "reconciled")}
    assert {tuple(r) for r in phonetic.candidates_for(p.select("place_id", F.col("name").alias("query"), F.col("country_code").alias("ccode"), F.lit(None).cast("string").alias("contained_in")), i, "exact").select("place_id", "hit_id").collect()} == {(1, 10), (7, 10)}


def test_sound_passes_ask_once(spark):
    """Many places that ask alike, of many records alike: the pairs met do not grow with either. The first confident record answers all."""
    from folioforge.operators import phonetic

    p = spark.range(600).select(F.col("id").alias("place_id"), F.lit("Canton").alias("name"), F.lit("CN").alias("country_code"), F.array(F.lit("R2")).alias("parents"), F.when(F.col("id") % 2 == 0, 23.0).alias("lat"), F.when(F.col("id") % 2 == 0, 113.0).alias("lon"))
    i = spark.range(600).select((10000 + F.col("id")).alias("place_id"), F.lit("Kanton").alias("title"), F.lit("CN").alias("country_code"), F.array(F.lit("R2")).alias("parents"), F.when(F.col("id") < 3, 10.0).otherwise(90.0).alias("confidence"), F.lit(True).alias("has_geom"), F.lit(23.1).alias("lat"), F.lit(113.0).alias("lon"))
    out = phonetic.coordinate_pass(p.where("lat IS NOT NULL"), i)
    assert rows_of_joins(out) <= 600
    assert {(r["hit_id"], r["pass"]) for r in out.collect()} == {(10003, "coord-match")}
    out = phonetic.reconciled(p, i)
    assert rows_of_joins(out) <= 600
    assert {(r["hit_id"], r["pass"]) for r in out.collect()} == {(10003, "coord-match"), (10003, "2-phon-in")}


def test_trigrams_of_copies_and_unlike_names(spark):
    """Matches equal those of all pairs; copies of a name and names that share only frequent trigrams are not paired."""
    rnd = random.Random(41)
    words = ["red", "green", "blue", "tin", "steel", "brass", "old", "new"]
    some = [(k, " ".join(rnd.choice(words) for _ in range(3))) for k in range(150)] + [(900, ""), (901, "é"), (902, None)]
    names = spark.createDataFrame(some, "key long, name string")
    asked = spark.createDataFrame([(n,) for _, n in some[::10] if n is not None] + [("",), ("zzz",)], "q string").distinct()
    grams = lambda x: {f[i : i + 3] for f in [f" {x.replace('é', 'e')} "] for i in range(max(len(f) - 2, 1))}
    over = lambda x, y: len(grams(x) & grams(y)) / len(grams(x) | grams(y))
    for least in (0.3, 0.6, 1.0):
        got = sorted((r["q"], r["key"], round(r["overlap"], 9)) for r in search.trigram_matches(asked, names, "key", "name", "q", least).collect())
        assert got == sorted((r["q"], k, round(over(r["q"], n), 9)) for r in asked.collect() for k, n in some if n is not None and over(r["q"], n) >= least)
    copies = spark.range(3000).select(F.col("id").alias("key"), F.concat(F.lit("spring green part "), F.col("id") % 3).alias("name"))
    assert rows_of_joins(search.trigram_matches(copies.select(F.col("name").alias("q")).distinct(), copies, "key", "name", "q", 0.9)) <= 9000


def test_stored_artefacts(spark, tmp_path):
    from folioforge.sources import artefacts

    rows = spark.createDataFrame([(k, f"n{k}", k * 0.5) for k in range(1000)], "id long, name string, v double")
    artefacts.write_details(rows, str(tmp_path / "d"), "id", 16)
    assert artefacts.detail(spark, str(tmp_path / "d"), 37) == {"id": 37, "name": "n37", "v": 18.5} and artefacts.detail(spark, str(tmp_path / "d"), 5000) is None
    docs = spark.createDataFrame([(1, "ÉVREUX", "a town of France"), (2, "EVRAN", "a village in France"), (3, "BATH", "waters and baths")], "id int, head string, body string")
    artefacts.write_search(docs, str(tmp_path / "s"), "id", "head", "body", 8)
    got = {r["id"]: r["score"] for r in artefacts.search_text(spark, str(tmp_path / "s"), "id", ["france", "town"]).collect()}
    whole = search.postings(docs.select("id", F.concat_ws(" ", "head", "body").alias("t")), "id", "t")
    want = {r["id"]: r["score"] for r in search.bm25(whole, "id", 3, 14 / 3, ["france", "town"]).collect()}
    assert set(got) == {1, 2} and all(abs(got[k] - want[k]) < 1e-9 for k in got)
    heads = {r["head"]: r["overlap"] for r in artefacts.search_heads(spark, str(tmp_path / "s"), "id", "Evreux").collect()}
    assert heads["ÉVREUX"] == 1.0 and "BATH" not in heads
    vectors = spark.createDataFrame([(2, [0.5, -1.0], "b"), (1, [0.0, 1.0], "a")], "id int, v array<double>, label string")
    artefacts.write_matrix(vectors, str(tmp_path / "m"), "id", "v", ["label"])
    assert [(r["id"], r["label"], list(r["bytes"])) for r in spark.read.parquet(str(tmp_path / "m" / "matrix")).orderBy("id").collect()] == [(1, "a", [0, 127]), (2, "b", [64, -127])]
    assert artefacts.read_manifest(spark, str(tmp_path / "m"))["width"] == 2
    entries = spark.createDataFrame([("v1", k, k // 3, f"H{k:02}") for k in range(7)], "volume string, seq int, page int, head string")
    artefacts.write_reader(entries, str(tmp_path / "r"), "volume", "seq", "page", "head", 3)
    assert artefacts.read_manifest(spark, str(tmp_path / "r")) == {"kind": "reader", "size": 3, "entries": 7, "chunks": 3}
    assert spark.read.text(str(tmp_path / "r" / "chunks")).where("chunk = 2").count() == 1
    artefacts.write_review(entries, str(tmp_path / "w"), [F.col("seq").asc()], ["volume"], 4)
    assert [r["n"] for r in spark.read.json(str(tmp_path / "w" / "shards")).orderBy("shard").collect()] == [4, 3]
    artefacts.write_csv_bom(entries, str(tmp_path / "c"), F.col("seq") == 5, [F.col("seq")])
    lines = "".join(p.read_text() for p in sorted((tmp_path / "c").glob("part-*.csv"))).splitlines()
    assert lines[0].startswith("\ufeffvolume,") and lines[1].startswith("v1,5,")
    assert artefacts.markdown_table(entries.groupBy("page").count().orderBy("page"), "Pages").splitlines()[-1].startswith("| 2 |")
    with pytest.raises(ValueError):
        artefacts.markdown_table(entries, "Entries", 3)
    joined = spark.createDataFrame([(1, "verified"), (2, "rejected_by_coordinate"), (3, "unverifiable_no_coordinate")], "id int, status string")
    artefacts.write_bridge(joined, str(tmp_path / "b"), "id")
    assert spark.read.text(str(tmp_path / "b" / "bridge")).where("part = 'verified'").count() == 1
    artefacts.write_dictionary(entries, str(tmp_path / "t"), "head", F.to_json(F.struct("page")))
    words = [x for p in sorted((tmp_path / "t" / "dictionary").glob("part-*")) for x in p.read_text().splitlines()]
    assert words == sorted(words) and words[0] == '"H00":{"page":0}'


def test_two_hops_and_words(spark):
    from folioforge.operators import records

    t = [("c1", "label", "n1", None), ("n1", "form", "Stadt", "de"), ("n1", "form", "town", "en"), ("c2", "label", "n2", None), ("c3", "other", "n1", None)]
    triples = spark.createDataFrame(t, "subject string, predicate string, object string, lang string")
    assert [tuple(r) for r in records.two_hop_labels(triples, "label", "form", "en").collect()] == [("c1", "town")]
    tokens = spark.createDataFrame([("Towns",), ("ss",), ("s",), ("Bath",)], "t string")
    assert {r["t"]: r["known"] for r in records.known_words(tokens, "t", spark.createDataFrame([("town",), ("s",)], "word string")).collect()} == {"Towns": True, "ss": True, "s": True, "Bath": False}
    with pytest.raises(AssertionError):
        records.in_common(tokens, spark.createDataFrame([("zz",)], "t string"), ["t"])


def test_stream_progress_and_sliding_windows(spark, tmp_path):
    from folioforge.streaming import windows

    spark.sql("SELECT timestamp'2024-01-01 00:30:00' ts, 'a' kind UNION ALL SELECT timestamp'2024-01-01 01:30:00', 'a'").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("ts timestamp, kind string").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = windows.sliding_counts(stream, "ts", "2 hours", "1 hour", ["kind"], late="1 hour").writeStream.outputMode("complete").format("memory").queryName("sliding").trigger(availableNow=True).start()
    q.awaitTermination(60)
    assert sorted(r["n"] for r in spark.table("sliding").collect()) == [1, 1, 2]
    assert windows.progress(q)["batch"] >= 0
