"""TIFF, chat layouts and URL lists."""

import hashlib
import json
import math
import random
import zlib
from collections import Counter

import pytest
from edge import ROWS, documents
from oracle import compare, duck
from pyspark.sql import functions as F

from folioforge.llm import chat, tiff, urls

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("compression", sorted(tiff.NAMES))
@pytest.mark.parametrize("predictor", [1, 2])
@pytest.mark.parametrize("tile", [None, (16, 16)])
@pytest.mark.parametrize("order", "<>")
def test_tiff_round_trip(compression, predictor, tile, order):
    rnd = random.Random(4)
    for n in (1, 5, 700):
        for pool in (b"a", b"ab", bytes(range(256))):
            s = bytes(rnd.choice(pool) for _ in range(n * 7))
            pages = tiff.read_pages(tiff.encode_grey([(s, 7), (s[:7], 7)], compression, predictor, 100, tile, order))
            assert [p.get("pixels") for p in pages] == [s, s[:7]]


def test_broken_files_never_crash():
    good, rnd = tiff.encode_grey([(b"abc" * 300, 3)], "lzw"), random.Random(5)
    for k in range(len(good)):
        assert tiff.read_pages(good[:k])[-1].get("error") or k >= len(good) - 4
    for _ in range(1500):
        bad = bytearray(good)
        bad[rnd.randrange(len(bad))] = rnd.randrange(256)
        tiff.read_pages(bytes(bad))
    loop = bytearray(good)
    loop[-4:] = loop[4:8]  # the directory names itself as the next
    assert len(tiff.read_pages(bytes(loop))) == 1


def test_tiff_of_awkward_rows(spark):
    pages = tiff.tiff_pages(tiff.text_to_tiff(documents(spark)), keep=("doc_id", "n_bytes"))
    got = sorted((r["doc_id"] or 0, hashlib.sha256(r["pixels"]).hexdigest()) for r in pages.collect())
    fill = lambda t: t.encode().ljust(max(1, -(-len(t.encode()) // 64)) * 64, b"\0")
    assert got == sorted((r[0] or 0, hashlib.sha256(fill(r[1] or "")).hexdigest()) for r in ROWS)
    media = spark.createDataFrame([(1, None), (2, bytearray(b"nonsense"))], "doc_id bigint, media binary")
    assert [(r["doc_id"], bool(r["error"])) for r in tiff.tiff_pages(media).collect()] == [(2, True)]


def test_op4_digests(spark):
    rows = {r["doc_id"]: r for r in tiff.op4_tiff_media(spark, SF).collect()}
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        raw = r["text"].encode()
        want = raw.ljust(max(1, -(-len(raw) // 64)) * 64, b"\0")
        got = rows[r["doc_id"]]
        assert (got["n_bytes"], got["payload_bytes"], got["payload_sha256"], got["tail_crc32"]) == (len(raw), len(want), hashlib.sha256(want).hexdigest(), zlib.crc32(want[-64:]))
        n = Counter(want)
        mean = sum(want) / len(want)
        spread = math.sqrt(sum((x - mean) ** 2 for x in want) / len(want))
        entropy = -sum(k / len(want) * math.log2(k / len(want)) for k in n.values())
        step = sum(abs(a - b) for a, b in zip(want, want[1:])) / (len(want) - 1)  # noqa: B905
        made = dict(part.split("=") for part in got["feature"].split(";"))
        assert (int(made["min"]), int(made["max"])) == (min(want), max(want))
        assert all(abs(float(made[k]) - v) < 1e-3 for k, v in (("mean", mean), ("sd", spread), ("entropy", entropy), ("step", step)))
    stored = {r["doc_id"]: bytes(r["media"]) for r in tiff.text_to_tiff(spark.read.parquet(f"{SF}/documents.parquet")).collect()}
    assert {k: (hashlib.sha256(v).hexdigest(), len(v)) for k, v in stored.items()} == {k: (r["media_sha256"], r["media_bytes"]) for k, r in rows.items()}
    kinds = {(p["compression"], p["predictor"], p["tiled"]) for v in stored.values() for p in tiff.read_pages(v)}
    assert len(kinds) == 5  # every form is met on the query's path


RECORDS = {
    "messages": {"messages": [{"role": "human", "content": "hi"}, {"role": "gpt", "content": None}]},
    "conversations": {"conversations": [{"from": "human", "value": "x"}, {"value": "y", "from": "gpt"}]},
    "nested": {"data": {"prompt": "p", "completion": "c"}},
    "rows": {"rows": []},
    "instruction_input": {"instruction": "i", "output": "o", "input": "n"},
    None: {"zzz": 1},
}


def test_layouts(spark):
    rows = [(k, json.dumps(v)) for k, v in RECORDS.items()] + [("bad", "{"), ("null", None)]
    got = {r["id"]: (r["layout"], r["turns"]) for r in chat.canonical_turns(spark.createDataFrame(rows, "id string, record string")).collect()}
    for name in RECORDS:
        assert got[name][0] == name
    assert [tuple(t) for t in got["messages"][1]] == [("user", "hi"), ("assistant", "")]
    assert [tuple(t) for t in got["conversations"][1]] == [("user", "x"), ("assistant", "y")]
    assert [tuple(t) for t in got["instruction_input"][1]] == [("system", "i"), ("user", "n"), ("assistant", "o")]
    assert got["bad"] == (None, None) and got["null"] == (None, None)


def test_escapes(spark):
    rnd = random.Random(6)
    parts = ["<|end|>\n", "<|turn|>", "\\", "\\l", "\\e", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<", "[", "\n", "é", "x"]
    texts = ["".join(rnd.choices(parts, k=rnd.randint(0, 12))) for _ in range(300)] + ["", None]
    df = spark.createDataFrame([(i, [(rnd.choice(["user", "assistant", "a\nb"]), t or "")]) for i, t in enumerate(texts)], f"conv_id int, turns {chat.TURNS}")
    out = chat.format_turns(df).withColumn("whole", chat.formatted(F.col("segments")))
    for r in out.withColumn("back", chat.read_turns(F.col("whole"))).collect():
        assert r["back"] == r["turns"]
        assert r["whole"].count("<|turn|>") == 1 and r["whole"].count("<|end|>") == 1 and "[INST]" not in r["whole"]


def test_conversations_with_nulls_and_ties(spark):
    rows = [(1, 0, "user", None), (1, 0, "assistant", "b"), (1, None, None, "first"), (1, 0, "user", None), (None, 3, "user", "x")]
    got = chat.format_turns(chat.canonical_turns(chat.conversation_records(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))))
    turns = {r["conv_id"]: [tuple(t) for t in r["turns"]] for r in got.collect()}
    assert turns == {1: [("", "first"), ("assistant", "b"), ("user", ""), ("user", "")], None: [("user", "x")]}
    none = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.canonical_turns(chat.conversation_records(none)).count() == 0


@pytest.mark.parametrize("name", ["op2_pivot_top_k", "op6_url_temporal_list", "op9_chat_fingerprints"])
def test_queries_with_sql(spark, name):
    from folioforge.llm.queries import ORACLES, QUERIES

    assert compare(QUERIES[name](spark, SF), duck(SF), ORACLES[name]) == ""


def test_op9_runs_no_python(spark):
    plan = chat.op9_chat_fingerprints(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_url_list(spark):
    day = "date'2024-01-15'"
    cap = spark.sql(f"""SELECT * FROM VALUES (1, 'http://a.x.org/p/q?z=1', {day}), (2, 'http://x.org', date'2023-12-31'), (3, NULL, {day}), (4, 'not a url', {day}), (5, 'http://x.org/p', NULL),
        (6, 'http://b.x.org/p/qq', {day}), (6, 'http://b.x.org/p/qq', {day}), (7, 'HTTP://USER@X.ORG:80/other?k', {day}), (8, 'http://ax.org/', {day}) AS t(id, url, fetched_at)""").withColumn("rule", F.lit("old"))
    entries = (("host", "x.org", "block", "c", "2024-01-01"), ("host", "x.org", "allow", "c", "2024-02-01"), ("path", "a.x.org/p/q", "allow", "d", "2024-01-10"), ("path", "b.x.org/p/q", "block", "d", "2024-01-10"), ("parameter", "k", "allow", "e", "2024-01-01"))
    got = sorted((r["id"], r["decision"], r["rule"]) for r in urls.judge(cap, urls.list_entries(spark, entries)).collect())
    assert got == [(1, "keep", "path:a.x.org/p/q"), (2, "keep", ""), (3, "keep", ""), (4, "keep", ""), (5, "keep", ""), (6, "block", "host:x.org"), (6, "block", "host:x.org"), (7, "block", "host:x.org"), (8, "keep", "")]
    none = urls.list_entries(spark, entries).limit(0)
    assert {r["decision"] for r in urls.judge(cap, none).collect()} == {"keep"}


def test_captures_with_clashing_columns_and_a_hot_address(spark):
    """Columns named like the operator's own stay as they are; an address with most of the rows is dealt over tasks and judged alike."""
    rows = [(k, "http://a.x.org/p" if k % 10 else f"http://h{k}.y.org/", "t", "u", "r", 1, "k", "old") for k in range(6000)]
    cap = spark.createDataFrame(rows, "id int, url string, t string, u string, r string, _share int, `k.kind` string, rule string").withColumn("fetched_at", F.to_date(F.lit("2024-01-15")))
    entries = (("host", "x.org", "block", "c", "2024-01-01"), ("host", "org", "allow", "c", "2023-01-01"))
    got = urls.judge(cap, urls.list_entries(spark, entries)).collect()
    assert sorted((r["id"], r["decision"], r["rule"]) for r in got) == [(k, "block", "host:x.org") if k % 10 else (k, "keep", "host:org") for k in range(6000)]
    assert all((r["t"], r["u"], r["r"], r["_share"], r["k.kind"]) == ("t", "u", "r", 1, "k") for r in got)


def test_every_layout_is_met_and_long_conversations_come_back_whole(spark):
    """Turns of many records, of all layouts, and of roles that layouts would rename, come back in order."""
    rnd = random.Random(17)
    rows, want = [], {}
    for c in range(120):
        roles = [["user", "assistant"], ["system", "user", "assistant"], ["user", "assistant"] * 90, ["human", "gpt", "bot"], ["user"]][c % 5]
        want[c] = [(r, rnd.choice(["hi", "", "<|end|>\n", "\\\\l", "a\nb"]) + str(k)) for k, r in enumerate(roles)]
        rows += [(c, k, r, t) for k, (r, t) in enumerate(want[c])]
    rnd.shuffle(rows)
    records = chat.conversation_records(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"), 64)
    canonical = chat.canonical_turns(records)
    assert {r["layout"] for r in canonical.select("layout").distinct().collect()} == {m.name for m in chat.MAPPINGS}
    assert canonical.groupBy("conv_id").count().agg(F.max("count")).first()[0] == 3
    out = chat.joined(chat.format_turns(canonical)).withColumn("back", chat.read_turns(F.col("whole")))
    assert {r["conv_id"]: [tuple(t) for t in r["back"]] for r in out.collect()} == want
