"""Sequence similarity in Python: ratios, one-to-one pairing within blocks, alignment of two token streams."""

from __future__ import annotations

from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import cached_property
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ratio(a: str, b: str) -> float:
    return SequenceMatcher(None, a, b).ratio()


def with_ratio(pairs: DataFrame, a: str, b: str, name: str = "ratio") -> DataFrame:
    """Adds the longest-block ratio of two text columns, in Arrow batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (a, b))
            got = pa.array([None if p is None or q is None else ratio(p, q) for p, q in zip(x, y, strict=True)], pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, got], names=[*batch.schema.names, name])

    return pairs.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pairs.schema) + f", {name} double")


class Closest:
    """Names, of which the free one with the highest ratio to another is found. A ratio is at most that of the letters in common, so ratios are only
    taken, from the highest such bound on, while a bound reaches the best ratio so far. Letters are counted once the first name is looked for."""

    def __init__(self, names: list[str]):
        self.names, self.free = sorted(names), np.ones(len(names), bool)

    @cached_property
    def length(self) -> np.ndarray:
        return np.array([len(m) for m in self.names], np.int64)

    @cached_property
    def counts(self) -> dict[str, np.ndarray]:
        counts: dict[str, np.ndarray] = {}
        for k, m in enumerate(self.names):
            for c, n in Counter(m).items():
                counts.setdefault(c, np.zeros(len(self.names), np.int32))[k] = n
        return counts

    def take_named(self, m: str) -> bool:
        """Takes the last free one of the names that equal m, if there is one."""
        k = bisect_right(self.names, m) - 1
        while k >= 0 and self.names[k] == m:
            if self.free[k]:
                self.free[k] = False
                return True
            k -= 1
        return False

    def bounds(self, n: str) -> np.ndarray:
        common = np.zeros(len(self.names), np.int32)
        for c, k in Counter(n).items():
            if c in self.counts:
                common += np.minimum(self.counts[c], k)
        return np.where(self.free, 2.0 * common / np.maximum(self.length + len(n), 1), -1.0)

    def take(self, n: str, cutoff: float, contained: int) -> tuple[str, str] | None:
        """(name, how): the free name of the highest ratio, of equals the last; else the first that contains the other."""
        if not len(self.names):
            return None
        bound = self.bounds(n)
        first = int(bound.argmax())
        best = (ratio(n, self.names[first]), first) if bound[first] >= cutoff else (0.0, -1)
        some = np.flatnonzero(bound >= max(cutoff, best[0]))
        for k in some[np.argsort(-bound[some], kind="stable")].tolist():
            if bound[k] < best[0]:
                break
            best = max(best, (ratio(n, self.names[k]), k))
        how, at = "ratio", best[1]
        if best[0] < cutoff:
            fits = (m for m in np.flatnonzero(self.free & (self.length >= contained)).tolist() if len(n) >= contained and (self.names[m] in n or n in self.names[m]))
            how, at = "contained", next(fits, -1)
        if at < 0:
            return None
        self.free[at] = False
        return self.names[at], how


def grams(name: str, size: int) -> Column:
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(name) - (size - 1)), lambda i: F.col(name).substr(i, F.lit(size))))


def containing(short: DataFrame, long: DataFrame, size: int) -> DataFrame:
    """s, l of all names with at least ``size`` letters where s stands in l. They meet at that part of s which the fewest l have."""
    s = short.where(F.length("s") >= size).select("s", F.explode(grams("s", size)).alias("g"))
    have = long.where(F.length("l") >= size).select("l", F.explode(grams("l", size)).alias("g"))
    n = have.groupBy("g").agg(F.count("*").alias("n"))
    rarest = s.join(n, "g", "left").groupBy("s").agg(F.min_by("g", F.struct(F.coalesce("n", F.lit(0)), F.col("g"))).alias("g"))
    return rarest.join(have, "g").where(F.contains("l", "s")).select("s", "l")


def used_once(pairs: DataFrame) -> DataFrame:
    """Of left_name, right_name, in order, each pair whose names have not been used. One stream holds the names used, not the pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken: tuple[set, set] = (set(), set())
        for batch in batches:
            keep = []
            for n, m in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                keep.append(n not in taken[0] and m not in taken[1])
                if keep[-1]:
                    taken[0].add(n)
                    taken[1].add(m)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return pairs.repartition(1).sortWithinPartitions("left_name", "right_name").mapInArrow(run, "left_name string, right_name string")


def closest_by_a_letter(a: DataFrame, b: DataFrame, cutoff: float) -> DataFrame:
    """n, block, m: the closest m of b, in the block, of those n of a that become it by one more letter. Where the ratio finds all letters of n
    in m, only n itself would come closer, so all others of b need not be looked at; of equals the last is closest."""
    shorter = F.transform(F.sequence(F.lit(1), F.length("m")), lambda i: F.concat(F.col("m").substr(F.lit(1), i - 1), F.col("m").substr(i + 1, F.length("m"))))
    near = b.where(F.length("n") > 1).withColumnRenamed("n", "m").select("m", "block", F.explode(F.array_distinct(shorter)).alias("n"))
    best = F.lit(2.0) * F.length("n") / (F.length("n") + F.length("m"))
    return with_ratio(a.join(near, ["n", "block"]), "n", "m").where((F.col("ratio") == best) & (F.col("ratio") >= cutoff)).groupBy("n", "block").agg(F.max("m").alias("m"))


def pair_within_blocks(left: DataFrame, right: DataFrame, name: str, cutoff: float = 0.82, contained: int = 6, across: int = 7) -> DataFrame:
    """left name, right name, how: each right name is used once. Exact pairs first (a join), then the closest by ratio, then containment,
    greedily in name order within blocks of one first letter; then containment among all names left over, of at least ``across`` letters.

    Most names have a copy that differs by a letter: these are found by a join. Where all of a block have one and no two the same, the order does
    not matter and the block is done; the others are gone through in order, and only a name without such a copy, or whose copy is used, is compared with the rest."""
    exact = left.join(right, name).select(F.col(name).alias("left_name"), F.col(name).alias("right_name"), F.lit("exact").alias("how"))
    block = F.substring(name, 1, 1)
    a = left.join(right, name, "left_anti").select(F.col(name).alias("n"), block.alias("block"))
    # kept, as is what follows from it, since several steps read it
    b = right.join(left, name, "left_anti").select(F.col(name).alias("n"), block.alias("block")).persist()
    wanted = a.join(closest_by_a_letter(a, b, cutoff), ["n", "block"], "left").persist()
    uses = wanted.groupBy("block", "m").agg(F.count("*").alias("k"))
    settled = uses.groupBy("block").agg(F.max((F.col("m").isNull() | (F.col("k") > 1)).cast("int")).alias("open")).where("open = 0").select("block").persist()
    pairs = wanted.join(settled, "block").select("n", "m", "block")

    def run(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        names, out = Closest(list(y["n"])), []
        for n, m in sorted(zip(x["n"], x["m"], strict=True), key=lambda r: r[0]):
            if isinstance(m, str) and names.take_named(m):
                out.append((n, m, "ratio"))
            else:
                out.append((n, *(names.take(n, cutoff, contained) or (None, None))))
        out += [(None, names.names[k], None) for k in np.flatnonzero(names.free).tolist()]
        return pd.DataFrame(out, columns=["left_name", "right_name", "how"])

    rest = wanted.join(settled, "block", "left_anti").groupBy("block").cogroup(b.join(settled, "block", "left_anti").groupBy("block"))
    fuzzy = rest.applyInPandas(run, "left_name string, right_name string, how string").persist()
    spare = b.join(settled, "block").select("n").exceptAll(pairs.select("m")).select(F.lit(None).cast("string").alias("left_name"), F.col("n").alias("right_name"))
    left_over = fuzzy.where(F.col("how").isNull()).select("left_name", "right_name").unionByName(spare).persist()
    x, y = (left_over.where(F.col(c).isNotNull()).select(c) for c in ("left_name", "right_name"))
    one = containing(x.toDF("s"), y.toDF("l"), across).select(F.col("s").alias("left_name"), F.col("l").alias("right_name"))
    other = containing(y.toDF("s"), x.toDF("l"), across).select(F.col("l").alias("left_name"), F.col("s").alias("right_name"))
    crossed = used_once(one.unionByName(other)).withColumn("how", F.lit("contained_across"))
    close = pairs.select(F.col("n").alias("left_name"), F.col("m").alias("right_name"), F.lit("ratio").alias("how"))
    return exact.unionByName(close).unionByName(fuzzy.where(F.col("how").isNotNull())).unionByName(crossed)


def deletions(word: Column, depth: Column) -> Column:
    """The word and what is left of it without up to ``depth`` (at most two) of its letters."""
    none = F.array().cast("array<string>")
    one = lambda w: F.when(F.length(w) > 0, F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(w.substr(F.lit(1), i - 1), w.substr(i + 1, F.length(w))))).otherwise(none)
    first = one(word)
    return F.array_distinct(F.concat(F.array(word), F.when(depth >= 1, first).otherwise(none), F.when(depth >= 2, F.flatten(F.transform(first, one))).otherwise(none)))


def within_edits(words: DataFrame, word: str, limit) -> DataFrame:
    """asked, word, edits of all distinct words that differ by no more edits than ``limit`` (a function of columns, at most two) allows the asked one.
    Two such words always share one of their deletions, so no pair is lost."""
    w = words.select(F.col(word).alias("word")).where("word IS NOT NULL").distinct()
    have = w.select("word", F.explode(deletions(F.col("word"), F.lit(2))).alias("k"))
    asked = w.where(limit(F.col("word")) > 0).select(F.col("word").alias("asked"), F.explode(deletions(F.col("word"), limit(F.col("word")))).alias("k"))
    met = asked.join(have, "k").where("asked <> word").select("asked", "word").distinct()
    return met.withColumn("edits", F.levenshtein("asked", "word")).where(F.col("edits") <= limit(F.col("asked")))


PAIRS_AT_ONCE, TOKENS_AT_ONCE = 2_000_000, 200_000


def equal_runs(x: np.ndarray, y: np.ndarray, box: tuple, least: int) -> list[tuple[int, int, int]]:
    """(-length, i, j) of the longest runs x[i:i+length] == y[j:j+length] within a box (a0, a1, b0, b1), from ``least`` items on. Pairs of equal items
    are held a bounded number at a time; runs cut by such a bound are put together again."""
    a0, a1, b0, b1 = box
    order = np.argsort(y[b0:b1], kind="stable")
    vals, xs = y[b0:b1][order], x[a0:a1]
    lo = np.searchsorted(vals, xs, "left")
    n = np.searchsorted(vals, xs, "right") - lo
    ends, width, kept, at = np.cumsum(n), a1 - a0 + 2, [], 0
    while at < len(xs):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS_AT_ONCE, "right")))
        c = n[at:to]
        if c.sum():
            i = np.repeat(np.arange(at, to), c)
            j = order[np.repeat(lo[at:to] - np.cumsum(c) + c, c) + np.arange(len(i))]
            key = np.sort((j - i + width) * width + i)
            first = np.flatnonzero(np.diff(key, prepend=key[0] - 2) != 1)
            size = np.diff(first, append=len(key))
            i = key[first] % width
            hold = (size >= least) | (i == at) | (i + size == to)
            kept.append((key[first][hold], size[hold]))
        at = to
    if not kept:
        return []
    key, size = np.concatenate([k for k, _ in kept]), np.concatenate([k for _, k in kept])
    if len(kept) > 1:
        by = np.argsort(key)
        key, size = key[by], size[by]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1] + size[:-1]))
        key, size = key[first], np.add.reduceat(size, first)
    key, size = key[size >= least], size[size >= least]
    i = key % width
    j = key // width - width + i
    return list(zip((-size).tolist(), (i + a0).tolist(), (j + b0).tolist(), strict=True))


def matching_blocks(a: list[str], b: list[str]) -> list[tuple[int, int, int]]:
    """The blocks of SequenceMatcher(None, a, b), in order. That looks for the longest run in every window anew, which for long texts takes time with the
    cube of their length; here runs are found once, and taken longest first, cut to the windows that are left: first the runs of four items on, then, in
    the windows between those, all."""
    count = Counter(b)
    most = len(b) // 100 + 1 if len(b) >= 200 else len(b)
    ids = {w: k for k, w in enumerate(count)}
    x = np.array([ids[w] if 0 < count[w] <= most else -1 for w in a], np.int64)
    y = np.array([ids[w] if count[w] <= most else -2 for w in b], np.int64)
    found, todo = [], [(0, len(a), 0, len(b))]
    for least in (4, 1):
        boxes, todo = todo, []
        for box in boxes:
            a0, a1, b0, b1 = box
            if a1 - a0 == b1 - b0 == 1:
                if a[a0] == b[b0]:
                    found.append((a0, b0, 1))
                continue
            runs = equal_runs(x, y, box, least)
            heapify(runs)
            left = [box]
            while runs:
                size, i, j = heappop(runs)
                size = -size
                k = max(bisect_right(left, (i, len(a) + 1)) - 1, 0)
                while k < len(left) and left[k][0] < i + size:
                    p0, p1, q0, q1 = left[k]
                    lo, hi = max(i, p0, q0 + i - j), min(i + size, p1, q1 + i - j)
                    if hi - lo == size:
                        s, t, e = i, j, i + size
                        while s > p0 and t > q0 and a[s - 1] == b[t - 1]:
                            s, t = s - 1, t - 1
                        while e < p1 and t + e - s < q1 and a[e] == b[t + e - s]:
                            e += 1
                        found.append((s, t, e - s))
                        left[k : k + 1] = [w for w in ((p0, s, q0, t), (e, p1, t + e - s, q1)) if w[0] < w[1] and w[2] < w[3]]
                        break
                    if hi - lo >= least:
                        heappush(runs, (lo - hi, lo, lo + j - i))
                    k += 1
            todo += left
    for a0, a1, b0, b1 in todo:  # common words alone are only matched from a window's start on
        k = 0
        while a0 + k < a1 and b0 + k < b1 and a[a0 + k] == b[b0 + k]:
            k += 1
        if k:
            found.append((a0, b0, k))
    return sorted(found)


def replacements(x: list[str], y: list[str]) -> Iterator[tuple[int, int]]:
    """Places where exactly one item on either side stands between two matching blocks."""
    i = j = 0
    for i2, j2, n in [*matching_blocks(x, y), (len(x), len(y), 0)]:
        if i2 - i == j2 - j == 1:
            yield i, j
        i, j = i2 + n, j2 + n


def aligned_replacements(pairs: DataFrame, key: str, ours: str, other: str) -> DataFrame:
    """key, place, our token, other token where the streams differ in exactly one token on either side."""
    kind = pairs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, x_of, y_of = batch.columns
            at = 0
            while at < len(keys):  # texts become tokens one pair at a time, and results go on every TOKENS_AT_ONCE tokens
                out, seen, first = [], 0, at
                while at < len(keys) and seen < TOKENS_AT_ONCE:
                    x, y = ((c[at].as_py() or "").split() for c in (x_of, y_of))
                    out += [(at - first, i, x[i], y[j]) for i, j in replacements(x, y)]
                    seen, at = seen + len(x) + len(y), at + 1
                which, place, ours_, theirs = zip(*out, strict=True) if out else ((), (), (), ())
                got = keys.slice(first, at - first).take(pa.array(which, pa.int64()))
                yield pa.RecordBatch.from_arrays([got, pa.array(place, pa.int32()), pa.array(ours_, pa.string()), pa.array(theirs, pa.string())], names=[key, "place", "ours", "theirs"])

    return pairs.select(key, ours, other).mapInArrow(run, f"`{key}` {kind}, place int, ours string, theirs string")
