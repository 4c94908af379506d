"""Near-duplicate classes by ProbMinHash signatures of weighted shingles, banding and verification.

Shingles are five words in a row (of the lower-cased text, cut at white space), weighted by 1 + ln(their count). For each shingle a
Poisson process of that rate sends arrivals to random registers; each register keeps its first arrival. A shingle's process is
followed only while its next arrival can still come before the latest first arrival, so that few are followed far. Two registers
agree with the probability Jaccard similarity of the texts (for equal weights: the Jaccard similarity of their shingle sets).

Texts that agree in a band of ``ROWS`` registers meet in a bucket. Equal texts are one node from the start. Links between nodes are
verified on the whole texts: a link holds if the probability Jaccard, or the Jaccard similarity of the shingle sets, is at least
``THRESHOLD``. Classes are the connected components. No bucket is ever expanded into all its pairs blindly:

1. every node is verified against its bucket's smallest node, and components are formed;
2. buckets whose nodes now lie in one component are finished, since no link within them can change a class;
3. in the others nodes of different components are compared within blocks of bounded size, however large the bucket: by signature, and
   where the estimate is not far below the threshold on the whole shingle sets. A block returns only links that join components, as
   few as join all that its similar pairs join, never the pairs themselves; components are formed again.

Step 3 leaves out pairs that a signature shows to be dissimilar (an estimate at least 5 standard deviations below), and of the others
only pairs whose bounds on both similarities lie below the threshold. Candidates are thus pairs that agree in a band: at a probability
Jaccard similarity of 0.8 all but 3 in 100,000; a pair that only its plain Jaccard similarity would link is met as often as its
probability Jaccard allows (the README states the recall measured against brute force).

A node is a distinct text, named by the 128 bits of its digest and numbered once; ids play no part in it. Copies are counted into one
row per text before anything is joined, and keys with many rows (hot texts, buckets, hubs, components) are dealt over many tasks.

Defined cases: a text of one to four words is one shingle; a text without words (or null) shares a class only with equal texts; rows that
share an id but not their text are documents of their own, each in its text's class (class_key tells classes of one smallest id apart);
rows without an id take part like any other, and a class without any id has a null class_id; an empty table gives no rows; columns not
named are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import by_size, clear_shared, every_of, keyed_join, one_of, shares_of, table, texts_of, written

WORDS, THRESHOLD, REGISTERS, ROWS = 5, 0.8, 80, 4
KEYS = ["id0", "no_id", "key_a", "key_b"]
LEAST_ESTIMATE, BLOCK, BLOCK_SHINGLES = 0.55, 512, 1_000_000
_P = np.uint64(0x9E3779B97F4A7C15)
_LIMIT = 1_000_000
_POWERS: list[np.ndarray] = []


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of x."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, _LIMIT + 100_000)
        odd, inverse = 0x2545F4914F6CDD1D, pow(0x2545F4914F6CDD1D, -1, 2**64)
        _POWERS[:] = [np.concatenate([[np.uint64(1)], np.full(size, np.uint64(k))]).cumprod(dtype=np.uint64) for k in (odd, inverse)]
    return _POWERS[0], _POWERS[1]


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle hash, count) of the distinct shingles of each text, in order of text and hash."""
    parts = [x.lower().encode() for x in texts]
    raw = b"\n" + b"\n".join(parts) + b"\n"
    b = np.frombuffer(raw, np.uint8)
    powers, inverse = _powers(len(b) + 1)
    blank = b <= 32
    start, end = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1, np.flatnonzero(~blank[:-1] & blank[1:]) + 1
    total = np.concatenate([[np.uint64(0)], (b * powers[: len(b)]).cumsum(dtype=np.uint64)])
    word = mixed((total[end] - total[start]) * inverse[start])
    first = np.cumsum([1, *(len(x) + 1 for x in parts)])[:-1]
    text = np.searchsorted(first, start, "right") - 1
    n = np.bincount(text, minlength=len(texts))
    value = word.copy()
    for k in range(1, min(WORDS, len(word))):
        value[: len(word) - k] = value[: len(word) - k] * _P + word[k:]
    whole = np.zeros(len(word), bool)
    whole[: max(0, len(word) - WORDS + 1)] = text[: max(0, len(word) - WORDS + 1)] == text[WORDS - 1 :]
    before = n.cumsum() - n
    for d in np.flatnonzero((n > 0) & (n < WORDS)).tolist():
        i = before[d]
        v = 0
        for w in word[i : i + n[d]].tolist():
            v = (v * int(_P) + w) % 2**64
        value[i], whole[i] = v, True
    text, value = text[whole], mixed(value[whole])
    order = np.lexsort((value, text)) if len(text) < 5000 else _by_text(text, value)
    text, value = text[order], value[order]
    fresh = np.ones(len(text), bool)
    fresh[1:] = (text[1:] != text[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(fresh)
    return text[at], value[at], np.diff(np.append(at, len(text)))


def _by_text(text: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Order by (text, value), sorting each text's stretch on its own."""
    edges = np.flatnonzero(np.diff(text)) + 1
    out = np.empty(len(text), np.int64)
    for i, j in zip([0, *edges.tolist()], [*edges.tolist(), len(text)], strict=True):
        out[i:j] = i + np.argsort(value[i:j])
    return out


def signatures(text: np.ndarray, value: np.ndarray, weight: np.ndarray, n_texts: int, registers: int = REGISTERS) -> np.ndarray:
    """ProbMinHash: the hash of the shingle whose arrival came first at each register, by text; texts without shingles have zeros."""
    first = np.full(n_texts * registers, np.inf)
    holder = np.zeros(n_texts * registers, np.uint64)
    t, step = np.zeros(len(text)), 0
    while len(text):
        step += 1
        r = mixed(value + np.uint64(step * int(_P) % 2**64))
        t = t - np.log(((r >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53) / weight
        at = text * registers + (mixed(r) % np.uint64(registers)).astype(np.int64)
        better = np.flatnonzero(t < first[at])
        np.minimum.at(first, at[better], t[better])
        won = better[t[better] == first[at[better]]]
        holder[at[won]] = value[won]
        latest = first.reshape(n_texts, registers).max(1)
        go = t < latest[text]
        text, value, weight, t = text[go], value[go], weight[go], t[go]
    return holder.reshape(n_texts, registers)


def bands_of(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """A 64-bit bucket for each band; the band's number is part of it."""
    out = np.broadcast_to(np.arange(1, signature.shape[1] // rows + 1, dtype=np.uint64) * _P, (len(signature), signature.shape[1] // rows))
    for k in range(rows):
        out = mixed(out + signature[:, k::rows][:, : out.shape[1]])
    return out.view(np.int64)


def probability_jaccard(x: np.ndarray, y: np.ndarray, only_x: float, only_y: float) -> float:
    """x, y: weights of the common shingles; only_x, only_y: sums of the others'. sum_i 1 / sum_j max(x_j / x_i, y_j / y_i)."""
    ratios, times = np.unique(x / y, return_inverse=True)
    if len(ratios) == 1:
        scale = float(ratios[0])
        return float(x.sum() / (x.sum() + only_x + only_y * scale))
    out = 0.0
    for k, scale in enumerate(ratios.tolist()):  # x_i = scale * y_i: the sum is that of max(x_j, scale * y_j), over x_i
        mine = x[times == k]
        out += float(mine.sum() / (np.maximum(x, scale * y).sum() + only_x + only_y * scale))
    return out


def weights_of(count: np.ndarray) -> np.ndarray:
    return 1 + np.log(count)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The larger of the two similarities of texts given as (sorted shingle hashes, counts); 0 where one has none."""
    (av, ac), (bv, bc) = a, b
    if not len(av) or not len(bv):
        return 0.0
    both, i, j = np.intersect1d(av, bv, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    plain = len(both) / (len(av) + len(bv) - len(both))
    x, y = weights_of(ac), weights_of(bc)
    cx, cy = x[i], y[j]
    return max(plain, probability_jaccard(cx, cy, float(x.sum() - cx.sum()), float(y.sum() - cy.sum())))


def keyed(docs: DataFrame, id_column: str, text_column: str, **more: Column) -> DataFrame:
    """Every row's id (id0: 0 where null, then no_id holds), text (null: empty) and key_a, key_b: the 128 bits of the text's digest."""
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    part = lambda at: F.conv(F.substring(F.md5(text), at, 16), 16, -10).cast("bigint")
    doc_id = F.col(f"`{id_column}`").cast("bigint")
    more = {"text": text} | more
    return docs.select(F.coalesce(doc_id, F.lit(0)).alias("id0"), doc_id.isNull().alias("no_id"), part(1).alias("key_a"), part(17).alias("key_b"), *(c.alias(k) for k, c in more.items()))


def signed(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """id0, no_id, key_a, key_b, bands array<bigint> (null without words), sketch binary (a byte per register), n_shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "text", _LIMIT):
            texts = texts_of(batch, "text")
            text, value, count = shingles(texts)
            sig = signatures(text, value, weights_of(count), len(texts))
            n = np.bincount(text, minlength=len(texts))
            small = (sig >> np.uint64(40)).astype(np.uint8)
            rows = [x if k else None for x, k in zip(bands_of(sig).tolist(), n.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*batch.select(KEYS).columns, pa.array(rows, pa.list_(pa.int64())), pa.array([x.tobytes() for x in small], pa.binary()), pa.array(n.astype(np.int32))],
                names=[*KEYS, "bands", "sketch", "n_shingles"],
            )

    return keyed(docs, id_column, text_column).mapInArrow(run, "id0 bigint, no_id boolean, key_a bigint, key_b bigint, bands array<bigint>, sketch binary, n_shingles int")


def verified(pairs: DataFrame, texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Of the pairs (u, v) those whose texts are similar. texts: node, text, of every node in the pairs. A v is in few pairs, a u in any number.

    Every u's text is sent once to each task that has pairs of it, ahead of the texts of its partners, and held while they pass.
    """
    counts = pairs.groupBy("u").agg(F.count("*").alias("n"))
    deal = shares_of(["u"], counts, pairs.count())
    hubs = texts.join(counts.hint("merge"), F.col("node") == F.col("u")).select("u", every_of(deal).alias("share"), F.lit(0).alias("turn"), "node", "text")
    partners = pairs.hint("merge").join(texts, F.col("v") == F.col("node")).select("u", one_of(deal, ["v"]).alias("share"), F.lit(1).alias("turn"), "node", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub: tuple[np.ndarray, np.ndarray] | None = None
        for batch in by_size(batches, "text", _LIMIT // 2):
            text, value, count = shingles(texts_of(batch, "text"))
            edges = np.searchsorted(text, np.arange(len(batch) + 1)).tolist()
            good = []
            for k, turn in enumerate(batch.column(2).to_pylist()):
                own = (value[edges[k] : edges[k + 1]], count[edges[k] : edges[k + 1]])
                if turn == 0:
                    hub = (own[0].copy(), own[1].copy())
                good.append(turn == 1 and similarity(hub, own) >= threshold)
            kept = batch.filter(pa.array(good, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(3)], names=["u", "v"])

    return hubs.union(partners).repartition("u", "share").sortWithinPartitions("u", "share", "turn").mapInArrow(run, "u bigint, v bigint")


def components(links: DataFrame, made: list[str] | None = None) -> DataFrame:
    """node and component (its smallest node) for every node that a link (u, v) touches. Labels fall to the smallest in reach."""
    edges = written(links.select("u", "v").union(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges", made)
    total = edges.count()
    degrees = written(edges.groupBy("v").agg(F.count("*").alias("n")), "degrees", made)
    labels = written(edges.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("label")), "labels", made)
    while True:
        near = keyed_join(edges, labels.withColumnRenamed("node", "v"), ["v"], ["u"], degrees, total).select(F.col("u").alias("node"), "label").union(labels)
        low = written(near.groupBy("node").agg(F.min("label").alias("label")), "labels", made)
        low = written(keyed_join(low, labels.select(F.col("node").alias("label"), F.col("label").alias("further")), ["label"], ["node"], how="left").select("node", F.least("label", F.coalesce("further", "label")).alias("label")), "labels", made)
        moved = low.select("node", F.col("label").alias("now")).join(labels, "node").where(F.col("now") != F.col("label")).limit(1).count()
        labels = low
        if not moved:
            return labels.select("node", F.col("label").alias("component"))


def shingle_sets(texts: DataFrame) -> DataFrame:
    """node, hashes and counts (sorted 64-bit shingle hashes, 32-bit counts) of texts: node, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "text", _LIMIT):
            text, value, count = shingles(texts_of(batch, "text"))
            edges = np.searchsorted(text, np.arange(len(batch) + 1)).tolist()
            spans = list(zip(edges, edges[1:], strict=False))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("node")), pa.array([value[a:b].tobytes() for a, b in spans], pa.binary()), pa.array([count[a:b].astype(np.uint32).tobytes() for a, b in spans], pa.binary())],
                names=["node", "hashes", "counts"],
            )

    return texts.select("node", "text").mapInArrow(run, "node bigint, hashes binary, counts binary")


def shared_sums(left: list[np.ndarray], right: list[np.ndarray], counts_left: list[np.ndarray], counts_right: list[np.ndarray], step: int = 2048) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every left with every right set: the number of common elements, and their weights' sum on the left and on the right. Products of sparse-row matrices over the elements both sides have."""
    sides = [(np.concatenate(sets), np.repeat(np.arange(len(sets), dtype=np.int32), [len(x) for x in sets]), weights_of(np.concatenate(counts)).astype(np.float32), len(sets)) for sets, counts in ((left, counts_left), (right, counts_right))]
    both = np.unique(sides[0][0])
    both = both[np.isin(both, sides[1][0])]
    n, a, b = (np.zeros((len(left), len(right)), np.float32) for _ in range(3))
    sides = [(value[met], of[met], weight[met], rows) for value, of, weight, rows in sides for met in [np.isin(value, both)]]
    for at in range(0, len(both), step):
        part = both[at : at + step]
        m = []
        for value, of, weight, rows in sides:
            k = np.minimum(np.searchsorted(part, value), len(part) - 1)
            here = part[k] == value
            x, w = np.zeros((rows, len(part)), np.float32), np.zeros((rows, len(part)), np.float32)
            x[of[here], k[here]] = 1
            w[of[here], k[here]] = weight[here]
            m.append((x, w))
        n += m[0][0] @ m[1][0].T
        a += m[0][1] @ m[1][0].T
        b += m[0][0] @ m[1][1].T
    return n, a, b


def block_links(band: int, node: np.ndarray, comp: np.ndarray, bands: np.ndarray, sketch: np.ndarray, sets: list[np.ndarray], counts: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float) -> list[tuple[int, int]]:
    """Links that join components within a pair of blocks (places ``left`` and ``right``): as few as join all that similar pairs join."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = x = root.get(up, up)
        return x

    size = np.array([len(x) for x in sets])
    whole = np.array([weights_of(c).sum() for c in counts])
    repeated = np.array([bool((c > 1).any()) for c in counts])
    mine = bands == band
    out: list[tuple[int, int]] = []
    for at in range(0, len(left), 128):
        rows = left[at : at + 128]
        todo = comp[rows][:, None] != comp[right][None, :]
        if left is right:
            todo &= rows[:, None] < right[None, :]
        a, b = np.nonzero(todo)
        agree = np.concatenate([(sketch[rows[a[k : k + 65536]]] == sketch[right[b[k : k + 65536]]]).mean(1) for k in range(0, len(a), 65536)]) if len(a) else np.zeros(0)
        a, b = a[agree >= LEAST_ESTIMATE], b[agree >= LEAST_ESTIMATE]
        x, y = rows[a], right[b]
        # a pair that shares several buckets is looked at in the first alone
        first = np.concatenate([(bands[x[k : k + 65536]] == bands[y[k : k + 65536]]).argmax(1) for k in range(0, len(x), 65536)]) if len(x) else np.zeros(0, np.int64)
        own = mine[x, first] if len(x) else np.zeros(0, bool)
        x, y = x[own], y[own]
        if not len(x):
            continue
        hopeful = np.ones(len(x), bool)
        if len(x) > 500:  # bounds on both similarities: 1 / sum_j max(x_j / x_i, y_j / y_i) is at most x_i / sum(x), and at most y_i / sum(y)
            us, vs = np.unique(x), np.unique(y)
            shared, of_x, of_y = (m[np.searchsorted(us, x), np.searchsorted(vs, y)] for m in shared_sums([sets[i] for i in us], [sets[i] for i in vs], [counts[i] for i in us], [counts[i] for i in vs]))
            plain = shared / (size[x] + size[y] - shared)
            bound = np.minimum(of_x / whole[x], of_y / whole[y])
            hopeful = (plain >= threshold - 1e-3) | ((bound >= threshold - 1e-3) & (repeated[x] | repeated[y]))  # without repeated shingles the two are the same
        for k in np.flatnonzero(hopeful).tolist():
            i, j = int(x[k]), int(y[k])
            u, v = find(int(comp[i])), find(int(comp[j]))
            if u != v and similarity((sets[i], counts[i]), (sets[j], counts[j])) >= threshold:
                root[max(u, v)] = min(u, v)
                out.append((min(int(node[i]), int(node[j])), max(int(node[i]), int(node[j]))))
    return out


def _views(column: pa.Array, kind: type) -> list[np.ndarray]:
    """The arrays in a binary column, as views of its buffer: texts' sets are large, and are not copied."""
    width = np.dtype(kind).itemsize
    ends = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    start = int(ends[0])
    whole = np.frombuffer(column.buffers()[2], np.uint8)[start : int(ends[-1])].view(kind) if len(column) and int(ends[-1]) > start else np.zeros(0, kind)
    at = ((ends - start) // width).tolist()
    return [whole[i:j] for i, j in zip(at, at[1:], strict=False)]


def _linked_in_blocks(members: DataFrame, threshold: float) -> DataFrame:
    """Links (u, v) between components found in the blocks of unfinished buckets. members: band, i, j, side, node, component, bands, sketch, hashes, counts."""

    def run(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        order = np.argsort(t.column("node").to_numpy(), kind="stable")
        node, comp, side = (t.column(c).to_numpy()[order] for c in ("node", "component", "side"))
        bands = t.column("bands").chunk(0).flatten().to_numpy().reshape(len(node), -1)[order]
        sketch = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint8).reshape(len(node), -1)[order]
        sets, counts = ([x[i] for i in order.tolist()] for x in (_views(t.column("hashes").chunk(0), np.uint64), _views(t.column("counts").chunk(0), np.uint32)))
        every = np.arange(len(node))
        left, right = (every, every) if (side == 2).all() else (np.flatnonzero(side == 0), np.flatnonzero(side == 1))
        found = block_links(int(t.column("band")[0].as_py()), node, comp, bands, sketch, sets, counts, left, right, threshold)
        return pa.table({"u": pa.array([x for x, _ in found], pa.int64()), "v": pa.array([y for _, y in found], pa.int64())})

    return members.groupBy("band", "i", "j").applyInArrow(run, "u bigint, v bigint")


def _classes(docs: DataFrame, threshold: float, id_column: str, text_column: str, made: list[str]) -> tuple[DataFrame, DataFrame]:
    """Every row's keys, and for every distinct text (key_a, key_b; n rows): whether it is the class's head, and the head's id and keys."""
    rows = written(signed(docs, id_column, text_column), "signatures", made)
    owner = F.min(F.struct("no_id", "id0")).alias("owner")
    nodes = rows.groupBy("key_a", "key_b").agg(owner, F.count("*").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"), F.first("n_shingles").alias("n_shingles"))
    nodes = written(nodes.select(F.monotonically_increasing_id().alias("node"), "key_a", "key_b", "owner.no_id", "owner.id0", "n", "bands", "sketch", "n_shingles"), "nodes", made)
    held = nodes.where("bands IS NOT NULL").select("node", "bands", "sketch", "n_shingles")
    spread = held.select("node", F.explode("bands").alias("band"))
    buckets = written(spread.groupBy("band").agg(F.count("*").alias("n"), F.min("node").alias("least")).where("n > 1"), "buckets", made)
    met = written(keyed_join(spread, buckets, ["band"], ["node"], buckets.select("band", "n"), nodes.count() * (REGISTERS // ROWS)), "members", made)
    pairs = written(met.where(F.col("node") != F.col("least")).select(F.col("least").alias("u"), F.col("node").alias("v")).distinct(), "pairs", made)
    touched = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    wanted = nodes.select("node", *KEYS).join(touched.hint("merge"), "node", "left_semi")
    # rows with one id and one text are made one before they are sent on; the ids grow with the documents: never broadcast, at any size
    texts = written(keyed(docs, id_column, text_column).dropDuplicates(KEYS).join(wanted.hint("merge"), KEYS).select("node", "text"), "texts", made)
    links = written(verified(pairs, texts, threshold), "links", made)
    label = components(links, made)
    sized = keyed_join(met.where("n > 2").select("band", "node").join(label, "node", "left").join(held.select("node", "n_shingles"), "node"), buckets.select("band"), ["band"], ["node"], buckets.select("band", "n"), nodes.count() * (REGISTERS // ROWS))
    placed = written(sized.select("band", "node", F.coalesce("component", "node").alias("component"), "n_shingles"), "placed", made)
    unfinished = placed.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n"), F.sum("n_shingles").alias("all")).where("lo < hi")
    blocks = F.ceil(F.greatest(F.col("n") / BLOCK, F.col("all") / BLOCK_SHINGLES)).cast("int")
    unfinished = written(unfinished.select("band", "n", blocks.alias("blocks")), "unfinished", made)
    if unfinished.limit(1).count():
        rest = written(keyed_join(placed.drop("n_shingles"), unfinished.select("band", "blocks"), ["band"], ["node"], unfinished.select("band", "n")), "rest", made)
        nodes_left = rest.select("node").distinct()
        sets = shingle_sets(texts.join(nodes_left.hint("merge"), "node", "left_semi")).join(held.select("node", "bands", "sketch"), "node")
        spread_out = rest.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        sided = spread_out.select("band", "node", "component", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), F.when(F.col("mine") == F.col("other"), 2).when(F.col("mine") < F.col("other"), 0).otherwise(1).alias("side"))
        found = written(_linked_in_blocks(sided.join(sets, "node"), threshold), "more-links", made)
        if found.limit(1).count():
            label = components(links.union(found), made)
    grouped = written(nodes.select("node", *KEYS, "n").join(label, "node", "left").withColumn("component", F.coalesce("component", "node")), "grouped", made)
    head = grouped.groupBy("component").agg(F.min(F.struct("no_id", "id0", "key_a", "key_b")).alias("head"))
    classes = keyed_join(grouped, head, ["component"], ["node"])
    return rows.select(*KEYS), written(classes.select("key_a", "key_b", "n", "head", (F.struct("no_id", "id0", "key_a", "key_b") == F.col("head")).alias("is_head")), "classes", made)


def near_duplicate_classes(docs: DataFrame, threshold: float = THRESHOLD, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, class_id (the smallest id of the class) and class_key (the digest of the class's head text), a row for each row of docs."""
    made: list[str] = []
    rows, classes = _classes(docs, threshold, id_column, text_column, made)
    every = keyed_join(rows, classes.select("key_a", "key_b", "head"), ["key_a", "key_b"], [F.monotonically_increasing_id()], classes.select("key_a", "key_b", "n"))
    known = lambda at: F.when(~F.col(f"{at}no_id"), F.col(f"{at}id0"))
    key = F.concat(*(F.lpad(F.lower(F.hex(f"head.{k}")), 16, "0") for k in ("key_a", "key_b")))
    out = written(every.select(known("").alias("doc_id"), known("head.").alias("class_id"), key.alias("class_key")), "near-duplicates")
    clear_shared(docs.sparkSession, made)
    return out


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """docs without all but one row of each class: a row of the smallest id (one without id only where none has one), of these of the smallest text digest."""
    made: list[str] = []
    _, classes = _classes(docs, threshold, id_column, text_column, made)
    heads = written(classes.where("is_head").select("head.*"), "heads")
    clear_shared(docs.sparkSession, made)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    kept = keyed(docs, id_column, text_column, row=row).drop("text").dropDuplicates(KEYS).join(heads.hint("merge"), KEYS, "left_semi")
    return kept.select("row.*")


def op5_probminhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's near-duplicate class."""
    return near_duplicate_classes(table(spark, sf_dir, "documents"))
