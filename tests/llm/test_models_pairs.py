"""Classifiers on held-out labels, near-duplicates and top-k against brute force, the pipeline."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from edge import ROWS, documents
from pyspark.sql import functions as F

from folioforge.llm import linear, minhash, pivots, quality, toxicity
from folioforge.llm.common import table

SF = "/root/testdata/sf0.001"
SF2 = "/root/testdata/sf0.01"


def shingle_set(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}


def classes_by_brute_force(rows):
    """rows: (id, text); links at Jaccard similarity 0.8, equal texts together."""
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        s = len(sets[a] & sets[b])
        if (rows[a][1] or "") == (rows[b][1] or "") or s and s >= 0.8 * (len(sets[a]) + len(sets[b]) - s):
            root[find(b)] = find(a)
    low = {}
    for i, (k, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), k), k)
    return {k: low[find(i)] for i, (k, _) in enumerate(rows)}


def test_signature_agreement_estimates_similarity():
    rnd = random.Random(1)
    words = [f"w{k}" for k in range(300)]
    a = " ".join(rnd.choices(words, k=400))
    b = " ".join(a.split()[:300] + rnd.choices(words, k=100))
    t, v, n = minhash.shingles([a, b])
    sig = minhash.signatures(t, v, minhash.weights_of(n), 2, 2000)
    sets = [(v[t == k], n[t == k]) for k in (0, 1)]
    assert abs((sig[0] == sig[1]).mean() - minhash.similarity(*sets)) < 0.05


def test_weighted_similarity_by_definition():
    rnd = np.random.default_rng(3)
    x, y = rnd.integers(1, 5, 12).astype(float), rnd.integers(1, 5, 12).astype(float)
    only_x, only_y = [2.0, 1.0], [3.0]
    full_x, full_y = np.concatenate([x, only_x, [0.0]]), np.concatenate([y, [0.0, 0.0], only_y])
    want = sum(1 / np.maximum(full_x / full_x[i], full_y / full_y[i]).sum() for i in range(12))
    assert abs(minhash.probability_jaccard(x, y, sum(only_x), sum(only_y)) - want) < 1e-9


def test_shared_sums():
    rnd = np.random.default_rng(2)
    sets = [np.unique(rnd.integers(0, 300, 80)).astype(np.uint64) for _ in range(20)]
    counts = [rnd.integers(1, 9, len(x)) for x in sets]
    weights = [minhash.weights_of(c) for c in counts]
    n, of_left, of_right = minhash.shared_sums(sets[:12], sets[12:], counts[:12], counts[12:], step=50)
    for i, a in enumerate(sets[:12]):
        for j, b in enumerate(sets[12:]):
            assert np.allclose((n[i, j], of_left[i, j], of_right[i, j]), (len(np.intersect1d(a, b)), weights[i][np.isin(a, b)].sum(), weights[12 + j][np.isin(b, a)].sum()), rtol=1e-5)


def test_bounds_hold_for_the_probability_jaccard():
    rnd = np.random.default_rng(4)
    for _ in range(200):
        x, y = (minhash.weights_of(rnd.integers(1, 50, 8)) for _ in range(2))
        more_x, more_y = rnd.random(2) * 30
        p = minhash.probability_jaccard(x, y, more_x, more_y)
        assert p <= min(x.sum() / (x.sum() + more_x), y.sum() / (y.sum() + more_y)) + 1e-12


def weighted_classes_by_definition(rows):
    """rows: (id, text); a link where the larger of the plain and the probability Jaccard similarity, by their definitions, is 0.8; distinct texts are the nodes."""
    texts = sorted({t or "" for _, t in rows})
    bags = []
    for t in texts:
        w = t.lower().split()
        grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] * bool(w)
        bags.append({g: 1 + math.log(n) for g, n in Counter(grams).items()})
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(texts)), 2):
        x, y = bags[a], bags[b]
        both, every = x.keys() & y.keys(), x.keys() | y.keys()
        if both and (len(both) >= 0.8 * len(every) or sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in every) for i in both) >= 0.8):
            root[find(b)] = find(a)
    groups = {}
    for i, t in rows:
        groups.setdefault(find(texts.index(t or "")), []).append((i, t))
    return sorted(sorted(g, key=str) for g in groups.values())


def classes_found(spark, rows):
    """The partition of (id, text) rows that the operator gives; the ids of equal texts are interchangeable."""
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    of = {}
    for r in minhash.near_duplicate_classes(df).collect():
        of.setdefault((r["class_id"], r["class_key"]), []).append(r["doc_id"])
    return of


def test_repeated_ids_and_weighted_shingles_equal_the_definition(spark):
    rnd = random.Random(21)
    rows = []
    for k in range(90):
        family = k % 3
        words = [f"f{family}w{j}" for j in range(30)]
        for _ in range(rnd.randrange(4)):
            words[rnd.randrange(30)] = f"z{rnd.randrange(40)}"
        chorus = ["la", "li", "lo", "lu", f"le{family}"] * rnd.randrange(1, 40)
        rows.append((k % 40, " ".join(words + chorus)))  # ids come back with other texts
    want = sorted(sorted((i for i, _ in g), key=str) for g in weighted_classes_by_definition(rows))
    assert sorted(sorted(v, key=str) for v in classes_found(spark, rows).values()) == want


def test_texts_that_share_an_id(spark):
    a, b = (" ".join(f"{c}{k}" for k in range(50)) for c in "ab")
    rows = [(5, a), (5, b), (7, a + " tail"), (8, b + " tail"), (None, a), (None, "no such text")]
    assert sorted((sorted(v, key=str) for v in classes_found(spark, rows).values()), key=str) == [[5, 7, None], [5, 8], [None]]
    left = minhash.drop_near_duplicates(spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id bigint, text string, id0 int, key_a string"))
    assert sorted((r["doc_id"] or 0, r["text"], r["id0"], r["key_a"]) for r in left.collect()) == [(0, "no such text", 1, "k"), (5, a, 1, "k"), (5, b, 1, "k")]


def test_links_behind_decoys(spark):
    """Texts with few heavy shingles share all buckets with many that are not similar to them; sizes say nothing of their similarity."""
    text = lambda k, n: "a b c d e " * 20000 + " ".join(f"own{k}x{i}" for i in range(n))
    rows = [(k, text(k, 15)) for k in range(60)] + [(60, text(60, 1)), (61, text(61, 9))]
    got = sorted(len(v) for v in classes_found(spark, rows).values())
    assert got == [1] * 60 + [2]


def test_recall_against_brute_force_on_the_tables(spark):
    """Of the pairs of different texts that are similar by brute force, all lie in one class."""
    rows = [(r["doc_id"], r["text"] or "") for r in table(spark, SF, "documents").collect()]
    assert sorted(sorted(v, key=str) for v in classes_found(spark, rows).values()) == sorted(sorted((i for i, _ in g), key=str) for g in weighted_classes_by_definition(rows))


def test_near_duplicates_equal_brute_force(spark):
    rnd = random.Random(7)
    base = [f"t{rnd.randrange(500)}" for _ in range(120)]
    rows = []
    for k in range(120):  # a chain of copies, some near enough and some not
        words = list(base)
        for _ in range(rnd.randrange(9)):
            words[rnd.randrange(len(words))] = f"z{rnd.randrange(1000)}"
        rows.append((k, " ".join(words)))
    rows += [(200 + k, " ".join(f"u{rnd.randrange(5000)}" for _ in range(60))) for k in range(60)] + [(300, rows[5][1]), (301, rows[5][1]), (302, "one two"), (303, "One  two"), (304, ""), (305, None), (306, "\n")]
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicate_classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == classes_by_brute_force(rows)


def test_blocks_of_an_unfinished_bucket(spark, monkeypatch):
    """Small blocks give the same classes as large ones."""
    rnd = random.Random(9)
    base = [f"t{k}" for k in range(100)]
    rows = []
    for k in range(80):
        words = list(base)
        for _ in range(rnd.randrange(5)):
            words[rnd.randrange(100)] = f"z{rnd.randrange(10**6)}"
        rows.append((k, " ".join(words)))
    monkeypatch.setattr(minhash, "BLOCK", 7)
    got = {r["doc_id"]: r["class_id"] for r in minhash.near_duplicate_classes(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == classes_by_brute_force(rows)


def test_near_duplicates_of_awkward_rows(spark):
    got = sorted((r["doc_id"] or 0, r["class_id"] or 0) for r in minhash.near_duplicate_classes(documents(spark)).collect())
    assert got == sorted([(1, 1), (2, 1), (3, 3), (4, 3), (5, 5), (6, 6), (7, 7), (8, 8), (8, 8), (9, 9), (0, 0)])
    left = minhash.drop_near_duplicates(documents(spark))
    assert left.columns == documents(spark).columns
    assert sorted(r["doc_id"] or 0 for r in left.collect()) == [0, 1, 3, 5, 6, 7, 8, 9]
    assert minhash.near_duplicate_classes(documents(spark, [])).count() == 0
    assert minhash.drop_near_duplicates(documents(spark, [])).count() == 0


def top_by_brute_force(rows, asks, k):
    out = []
    for at, (q, v) in enumerate(rows):
        if q in asks:
            scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for n, (i, w) in enumerate(rows) if n != at and len(w) == len(v))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("kind", ["spread", "ties", "few", "large"])
def test_top_k_equals_brute_force(spark, kind):
    rnd = random.Random(kind)
    n = {"few": 4}.get(kind, 300)
    make = {"spread": lambda: [rnd.gauss(0, 1) for _ in range(6)], "ties": lambda: [float(rnd.choice([0, 1])) for _ in range(3)], "few": lambda: [rnd.random(), rnd.random()], "large": lambda: [rnd.choice([1e14, -1e14, 1.0, 3e15]) for _ in range(3)]}[kind]
    vectors = [(i, make()) for i in range(n)] + [(1000 + i, make() + [0.5]) for i in range(3)]
    odd = [(2000, None), (2001, []), (2002, [None, 1.0]), (2003, [float("nan")] * 6), (2004, [float("inf")] * 6), (None, make())]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in vectors + odd], "vec_id bigint, embedding array<double>, score string, rank int")
    got = pivots.top_k(df, F.col("vec_id") % 50 == 0, query_block=3, candidate_block=70)
    import math

    whole = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors]
    held = lambda r: (*r[:3], max(-(2**63), min(2**63 - 1, r[3])))
    if kind == "large":  # scores beyond 64 bits are held at the limits, so that ties follow
        full = []
        for q, v in whole:
            if q % 50 == 0:
                s = sorted((-max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(v, w, strict=True)))), i) for i, w in whole if i != q and len(w) == len(v))
                full += [(q, r + 1, i, -x) for r, (x, i) in enumerate(s[:5])]
        want = sorted(full)
    else:
        want = [held(r) for r in top_by_brute_force(whole, {i for i, _ in whole if i % 50 == 0}, 5)]
    assert sorted(tuple(r) for r in got.collect()) == want


def test_top_k_of_rows_that_repeat_an_id(spark):
    """Only a query's own row is no candidate; rows that repeat its id, and its vector, are; each of them asks on its own."""
    rnd = random.Random(12)
    vectors = [(i % 60, [rnd.gauss(0, 1) for _ in range(4)]) for i in range(150)]
    vectors += [vectors[0], vectors[50], vectors[50]]
    got = pivots.top_k(spark.createDataFrame(vectors, "vec_id bigint, embedding array<double>"), F.col("vec_id") % 50 == 0, query_block=3, candidate_block=40)
    want = top_by_brute_force([(i, [math.floor(256 * x) for x in v]) for i, v in vectors], {0, 50}, 5)
    assert sorted(tuple(r) for r in got.collect()) == want


def test_pivots_save_evaluations():
    rnd = np.random.default_rng(1)
    x = np.concatenate([rnd.normal(c, 0.05, (500, 8)) for c in rnd.normal(0, 1, (8, 8))]) * 256
    x = np.floor(x).astype(np.int64)
    p = pivots.choose_pivots(x[:400].astype(float), 16)
    gaps = np.sqrt(((x[:, None, :] - p[None]) ** 2).sum(2)).astype(np.float32)
    block = pivots.Block(np.arange(len(x)), x, p, gaps)
    for at, ids, scores in block.best(np.arange(20), x[:20], gaps[:20], np.full(20, -np.inf), 5):
        s = x @ x[at]
        s[at] = -(2**60)
        want = np.lexsort((np.arange(len(x)), -s))[:5]
        assert ids.tolist() == want.tolist() and scores.tolist() == s[want].tolist()
    assert block.evaluated < 0.6 * 20 * len(x)


def test_empty_vectors(spark):
    none = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    assert pivots.top_k(none, F.col("vec_id") % 50 == 0).count() == 0


def test_logistic_regression():
    rnd = np.random.default_rng(0)
    x = rnd.normal(size=(500, 3))
    y = (x[:, 0] + 0.1 * rnd.normal(size=500) > 0).astype(float)
    assert ((linear.fit(x, y).p(x) > 0.5) == y).mean() > 0.95
    assert 0.9 < linear.fit(x, np.ones(500)).p(x).min() <= 1
    assert linear.fit(np.zeros((0, 3)), np.zeros(0)).p(x).max() <= 0.5 + 1e-9


def test_quality_on_held_out_labels(spark):
    docs, labels = table(spark, SF2, "documents"), table(spark, SF2, "labels")
    even = labels.where("doc_id % 2 = 0")
    model = quality.train_quality(docs, even)
    got = quality.score_quality(docs, model).join(labels.withColumnRenamed("quality", "truth").where("doc_id % 2 = 1"), "doc_id").select("keep_quality", "truth").collect()
    assert sum(r["keep_quality"] == (r["truth"] == 1) for r in got) >= 0.97 * len(got)
    assert all(r["keep_quality"] for r in got if r["truth"] == 1)


def in_memory_pool(x, z, free, grow=10**9):
    def take(v, model, scale, r):
        good, bad = quality.sure_of(model, scale, (x, z)[v][free], quality.CONFIDENT)
        at = np.flatnonzero(good | bad)[:grow]
        return free[at], np.hstack([x, z])[free[at]], good[at].astype(float)

    return take


def test_co_training_uses_confident_views():
    rnd = np.random.default_rng(5)
    y = rnd.integers(0, 2, 800)
    x, z = y[:, None] + 0.2 * rnd.normal(size=(800, 1)), y[:, None] + 0.2 * rnd.normal(size=(800, 1))
    model = quality.co_train(x[:60], z[:60], y[:60], np.arange(60), in_memory_pool(x, z, np.arange(60, 800)))
    assert min(model.exchanged) > 100
    assert ((model.score(x, z) > 0.5) == y).mean() > 0.97


def test_pseudo_labels_from_a_strong_view_mend_a_weak_one():
    """The second view has a dimension that the few labelled rows do not show; the first view's labels bring it."""
    rnd = np.random.default_rng(8)
    y = rnd.integers(0, 2, 4000)
    x = y[:, None] + 0.15 * rnd.normal(size=(4000, 1))
    z = np.stack([y + 2.0 * rnd.normal(size=4000), np.where(np.arange(4000) < 40, 0.0, y + 0.1 * rnd.normal(size=4000))], 1)
    alone = quality.co_train(x[:40], z[:40], y[:40], np.arange(40), in_memory_pool(x, z, np.arange(40, 4000)), rounds=0)
    model = quality.co_train(x[:40], z[:40], y[:40], np.arange(40), in_memory_pool(x, z, np.arange(40, 4000)))
    hit = lambda m: ((m.views(x, z)[1] > 0) == y)[40:].mean()
    assert model.exchanged[0] > 1000 and hit(model) > hit(alone) + 0.1


def test_exchange_sees_every_document_without_label(spark):
    """The pool's counts and picks equal those made in memory, over the driver's tables."""
    docs, labels = table(spark, SF2, "documents"), table(spark, SF2, "labels").where("doc_id % 2 = 0")
    f = quality.measured(docs).join(labels.select("doc_id"), "doc_id", "left_anti").select("key", "f")
    rows = f.collect()
    m = np.array([r["f"] for r in rows], float)
    model = linear.fit(m[:, : quality.N_CONTENT], (m[:, 0] > np.median(m[:, 0])).astype(float))
    for grow in (10**6, 50):
        keys, got, label = quality.pool_of(f, grow, 0.9)(0, model, (1.0, 0.0), 0)
        p = model.p(m[:, : quality.N_CONTENT])
        want = {r["key"]: 1.0 for r, q in zip(rows, p, strict=True) if q >= 0.9} | {r["key"]: 0.0 for r, q in zip(rows, p, strict=True) if q <= 0.1}
        assert all(want[k] == y for k, y in zip(keys.tolist(), label.tolist(), strict=True))
        assert len(keys) == len(want) if grow > 50 else 50 < len(keys) < 160


def test_op7_equals_the_model_applied_row_by_row(spark):
    """The query's rows against the fitted views, combined by the formula in the docstring, one document at a time."""
    docs = table(spark, SF, "documents")
    model = quality.train_quality(docs, table(spark, SF, "labels"))
    got = {r["doc_id"]: r for r in quality.op7_quality_co_training(spark, SF).collect()}
    assert len(got) == docs.count()
    for r in docs.collect():
        x = quality.content_features([r["text"] or ""]).astype(np.float32).astype(float)
        z = quality.metadata_features([r["lang"]], [r["source"]], [r["n_chars"]]).astype(np.float32).astype(float)
        a = model.content_scale[0] * model.content.logit(x).item() + model.content_scale[1]
        b = model.metadata_scale[0] * model.metadata.logit(z).item() + model.metadata_scale[1]
        p = 1 / (1 + math.exp(-max(-40, min(40, a + b - model.prior))))
        assert abs(got[r["doc_id"]]["quality"] - p) < 2e-6 and got[r["doc_id"]]["keep_quality"] == (round(p, 6) >= 0.5)


def test_calibrated_views_agree_with_held_out_labels(spark):
    docs, labels = table(spark, SF2, "documents"), table(spark, SF2, "labels")
    model = quality.train_quality(docs, labels.where("doc_id % 2 = 0"))
    got = quality.score_quality(docs, model).join(labels.withColumnRenamed("quality", "truth").where("doc_id % 2 = 1"), "doc_id").select("quality_content", "truth").collect()
    mean = sum(r["quality_content"] for r in got) / len(got)
    assert abs(mean - sum(r["truth"] for r in got) / len(got)) < 0.05


def test_toxicity_on_held_out_labels(spark):
    docs, labels = table(spark, SF2, "documents"), table(spark, SF2, "labels")
    chain = toxicity.train_toxicity(docs, labels.where("doc_id % 4 <> 3"))
    assert len(chain.links) == 3
    got = toxicity.score_toxicity(docs, chain).join(labels.where("doc_id % 4 = 3"), "doc_id").select("is_toxic", "toxic").collect()
    assert not any(r["is_toxic"] for r in got if r["toxic"] == 0)
    assert sum(r["is_toxic"] for r in got if r["toxic"] == 1) >= 0.6 * sum(r["toxic"] for r in got)


def made_rows(rnd, n=200, vocabulary=12):
    fold, y = rnd.integers(0, toxicity.FOLDS, n), rnd.integers(0, 2, n)
    present = [sorted(set(rnd.integers(0, vocabulary, 3).tolist())) if v or rnd.random() < 0.3 else [] for v in y]
    lists = [(np.sort(rnd.permutation(vocabulary)[:8]), rnd.random(8) + 2) for _ in range(toxicity.FOLDS + 1)]
    hits = np.array([[sum(t in set(at.tolist()) for t in p) for at, _ in lists] for p in present])
    return toxicity.Rows(lists, np.cumsum([0, *map(len, present)]), np.array([t for p in present for t in p]), hits, rnd.integers(5, 50, n), y, fold, np.ones(n))


def test_earlier_probabilities_are_out_of_fold():
    """They equal models fitted by hand without the fold, and do not move when the fold's own labels and targets change."""
    rnd = np.random.default_rng(3)
    rows = made_rows(rnd)
    terms = [f"t{k}" for k in range(12)]
    chain, earlier = toxicity.fit_chain(rows, terms)
    assert earlier.shape == (200, 2) and len(chain.links) == 3
    for k in range(toxicity.FOLDS):
        out, seen = rows.fold == k, rows.fold != k
        x = rows.features(k)
        share = rows.hits[:, k] / rows.words
        usual = np.median(share[seen & (share > 0)])
        first = linear.fit(x[seen], (rows.hits[seen, k] > 0).astype(float), rows.weight[seen], penalty=2.0)
        assert np.allclose(earlier[out, 0], first.p(x[out]))
        both = np.hstack([x, earlier[:, :1]])
        second = linear.fit(both[seen], ((share >= usual) & (share > 0))[seen].astype(float), rows.weight[seen], penalty=2.0)
        assert np.allclose(earlier[out, 1], second.p(both[out]))
    inside = linear.fit(rows.features(5), (rows.hits[:, 5] > 0).astype(float), rows.weight, penalty=2.0).p(rows.features(5))
    assert not np.allclose(earlier[:, 0], inside)
    flipped = made_rows(np.random.default_rng(3))
    flipped.y = np.where(flipped.fold == 2, 1 - flipped.y, flipped.y)
    assert np.allclose(toxicity.fit_chain(flipped, terms)[1], earlier)  # the first categories are read off the texts: labels play no part but in the terms


def test_terms_leave_the_fold_out(spark, monkeypatch):
    """A word that only one fold's toxic documents have is in that fold's own list of terms for no one but the others."""
    docs = [(k, f"word{k} plain talk " + ("zzbad" if k % 2 else "good")) for k in range(200)]
    ids = spark.createDataFrame([(k,) for k, _ in docs], "doc_id bigint").selectExpr("doc_id", "xxhash64(doc_id) AS key").collect()
    fold = dict(zip([r["doc_id"] for r in ids], linear.folds(np.array([r["key"] for r in ids]), toxicity.FOLDS).tolist(), strict=True))
    docs = [(k, t + (" onlyhere" if fold[k] == 1 and k % 2 else "")) for k, t in docs]
    seen = {}
    monkeypatch.setattr(toxicity, "fit_chain", lambda rows, terms, spark=None, real=toxicity.fit_chain: seen.update(rows=rows, terms=terms) or real(rows, terms, spark))
    toxicity.train_toxicity(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame([(k, k % 2) for k, _ in docs], "doc_id bigint, toxic int"))
    lists = [{seen["terms"][i] for i in at} for at, _ in seen["rows"].lists]
    assert ["onlyhere" in x for x in lists] == [True, False, True, True, True, True] and all("zzbad" in x for x in lists)


def test_op8_equals_the_chain_applied_row_by_row(spark):
    """The query's rows against the links, fed with the probabilities before them, one document at a time."""
    docs = table(spark, SF, "documents")
    chain = toxicity.train_toxicity(docs, table(spark, SF, "labels"))
    got = {r["doc_id"]: r for r in toxicity.op8_toxicity_chain(spark, SF).collect()}
    assert len(got) == docs.count()
    for r in docs.collect():
        words = toxicity.words_of(r["text"] or "")
        hits = [[t for t in chain.terms if t in toxicity.terms_of({w})] for w in words]
        hits = [h for h in hits if h]
        x = [float(any(t in h for h in hits)) for t in chain.terms] + [len(hits) / max(1, len(words)), math.log1p(len(hits)), math.log1p(len(words)), max((chain.strength[chain.place[t]] for h in hits for t in h), default=0.0)]
        x = np.array(x, np.float32).astype(float)
        for name, link in zip(toxicity.CATEGORIES, chain.links, strict=True):
            p = link.p(x[None, :]).item()
            assert abs(p - got[r["doc_id"]][f"p_{name}"]) < 2e-6
            x = np.append(x, p)
        assert got[r["doc_id"]]["is_toxic"] == (round(p, 6) >= 0.5)


@pytest.mark.parametrize("labels", ["none", "one_class", "odd"])
def test_classifiers_of_awkward_rows(spark, labels):
    rows = {"none": [], "one_class": [(1, 1, 0), (2, 1, 0)], "odd": [(1, 1, 0), (1, 0, 1), (None, 1, 1), (5, None, None), (6, 0, 1), (777, 1, 1), (4, 7, -3), (7, 1, 2)]}[labels]
    known = spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
    docs = documents(spark)
    scored = quality.score_quality(docs, quality.train_quality(docs, known))
    assert scored.count() == len(ROWS) and set(docs.columns) <= set(scored.columns)
    assert scored.where("quality IS NULL OR isnan(quality)").count() == 0
    toxic = toxicity.score_toxicity(docs, toxicity.train_toxicity(docs, known))
    assert toxic.count() == len(ROWS) and toxic.where("p_toxic IS NULL OR isnan(p_toxic)").count() == 0
    empty = documents(spark, [])
    assert quality.score_quality(empty, quality.train_quality(empty, known)).count() == 0
    assert toxicity.score_toxicity(empty, toxicity.train_toxicity(empty, known)).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_duplicates", "packing"]
    docs = table(spark, SF, "documents")
    at = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, SF)
        assert at.columns == docs.columns
        if name == "near_duplicates":
            kept = {r["doc_id"]: r["text"] for r in at.collect()}
    labels = {r["doc_id"]: r for r in table(spark, SF, "labels").collect()}
    assert not any(labels[k]["quality"] == 0 for k in kept if k in labels)
    classes = classes_by_brute_force(sorted(kept.items()))
    assert all(k == v for k, v in classes.items())
    pieces = corpus_pipeline.run(spark, SF).select("doc_id", "length", "doc_tokens").collect()
    assert {r["doc_id"] for r in pieces} == set(kept)
    total = {r["doc_id"]: r["doc_tokens"] for r in pieces}
    assert sum(r["length"] for r in pieces) == sum(total.values())


def test_pipeline_of_awkward_rows(spark):
    """Columns named like the operators' own pass through every stage but the last as they are."""
    import corpus_pipeline

    at = documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, SF)
        rows = at.collect()
        if name != "packing":
            assert at.schema == documents(spark).schema
            assert all((r["ids"], r["turns"], r["label"], r["node"], r["quality"], r["band"]) == ("x", 1, 2, 3, "q", 5) for r in rows)
    empty = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
        assert empty.count() == 0


def test_shared_tables_are_removed(spark):
    from folioforge.llm import common

    kept = common.written(spark.range(3), "test-table")
    assert kept.count() == 3 and common.clear_shared(spark) >= 1 and common.clear_shared(spark) == 0
