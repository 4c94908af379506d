"""Packing of tokenised documents into training windows by Karmarkar-Karp multiway differencing.

Documents are tokenised and cut in place; nothing is shuffled. Each task packs its rows in batches of about ``windows``
windows, so that memory is bounded by a batch and a lost task is simply run again. Whole windows are cut off long documents;
what is left is cut into items of at most ``quantum`` ids, and the items of a batch go to k windows by differencing: partial
partitions with the largest spreads are merged, the fullest windows of one with the emptiest of the other. Where the fullest
window would exceed the capacity, k rises by one. Neighbouring items of a document that meet in a window become one piece.
Ends of fewer than ``bundle`` ids are bundled in order into one item first, so that a batch has a bounded number of items however
short its documents are, and differencing a bounded number of steps and bytes.

Defined cases: a null or empty text has only the end id; repeated rows and repeated ids are separate documents, each packed
whole; an empty table gives no rows; other columns of the input, whatever their names, are not looked at.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from .common import by_size, table, texts_of, vocabulary

CAPACITY, QUANTUM, WINDOWS, BUNDLE = 2048, 512, 128, 64


def differencing(sizes: list[int], k: int) -> tuple[np.ndarray, int]:
    """Window of each item, and the sum of the fullest window, by k-way largest differencing.

    Every item starts as a partition of its own (its size in one window, the others empty). The two partitions of largest
    spread are merged until one is left; ties go to the older one. The merges form a tree, walked down at the end.
    """
    n = len(sizes)
    if k == 1 or n == 0:
        return np.zeros(n, np.int64), sum(sizes)
    sums: dict[int, np.ndarray] = {}
    heap = [(-s, i) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    merges: list[tuple[int, int, np.ndarray]] = []

    def of(i: int) -> np.ndarray:
        if i >= n:
            return sums.pop(i)
        x = np.zeros(k, np.int64)
        x[0] = sizes[i]
        return x

    while len(heap) > 1:
        _, i = heapq.heappop(heap)
        _, j = heapq.heappop(heap)
        both = of(i) + of(j)[::-1]  # windows of a partition are kept fullest first
        order = np.argsort(-both, kind="stable")
        made = n + len(merges)
        both = both[order]
        sums[made] = both - both[-1]
        merges.append((i, j, order.astype(np.int32)))
        heapq.heappush(heap, (-int(sums[made][0]), made))
    place: dict[int, np.ndarray] = {heap[0][1]: np.arange(k)}
    out = np.zeros(n, np.int64)
    for made in range(n + len(merges) - 1, n - 1, -1):
        i, j, order = merges[made - n]
        at = np.empty(k, np.int64)
        at[order] = place.pop(made)  # where each window before sorting has come to lie
        for part, windows in ((i, at), (j, at[::-1])):
            if part < n:
                out[part] = windows[0]
            else:
                place[part] = windows
    full = np.bincount(out, weights=sizes, minlength=k)
    return out, int(full.max())


def pack(lengths: list[int], capacity: int = CAPACITY, quantum: int = QUANTUM, bundle: int = BUNDLE) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, window, offset) of pieces that cover the documents, by window and offset."""
    windows = 0
    out: list[tuple[int, int, int, int, int]] = []
    items: list[list[tuple[int, int, int]]] = []  # parts (document, start, length) that stay together
    sizes: list[int] = []
    bundle, quantum = min(bundle, quantum), min(quantum, capacity)
    open_item = -1  # the bundle that still takes ends
    for d, n in enumerate(lengths):
        at = 0
        while n - at >= capacity:
            out.append((d, at, capacity, windows, 0))
            windows, at = windows + 1, at + capacity
        while at < n:
            size = min(quantum, n - at)
            if size < bundle and open_item >= 0 and sizes[open_item] + size <= quantum:
                items[open_item].append((d, at, size))
                sizes[open_item] += size
            else:
                items.append([(d, at, size)])
                sizes.append(size)
                if size < bundle:
                    open_item = len(items) - 1
            if open_item >= 0 and sizes[open_item] >= bundle:
                open_item = -1
            at += size
    if items:
        k = -(-sum(sizes) // capacity)
        while True:
            place, most = differencing(sizes, k)
            if most <= capacity:
                break
            k += 1
        fill = [0] * k
        last: list[list[int] | None] = [None] * k
        pieces: list[list[int]] = []
        for item, w in zip(items, place.tolist(), strict=True):
            for d, at, size in item:
                p = last[w]
                if p and p[0] == d and p[1] + p[2] == at:
                    p[2] += size
                else:
                    last[w] = p = [d, at, size, windows + w, fill[w]]
                    pieces.append(p)
                fill[w] += size
        out += [tuple(p) for p in sorted(pieces, key=lambda p: (p[3], p[4]))]
    return out


def pack_documents(
    docs: DataFrame, vocabulary_path: str, end_id: int, capacity: int = CAPACITY, quantum: int = QUANTUM, windows: int = WINDOWS, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row for each piece: its document, place in the document, ids (little-endian 32-bit), window and place there.

    A window's id is the task's number and a count within the task.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"doc_id {kind}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = bpe.encoder(vocabulary_path).encode_many
        base = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        seen, held, held_ids, size = 0, [], [], 0
        end = np.array([end_id], np.uint32)

        def flush() -> pa.RecordBatch:
            nonlocal seen, held, held_ids, size
            rows = pack([len(x) for x in held], capacity, quantum)
            cols = list(zip(*rows, strict=True))
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([held_ids[d] for d in cols[0]], id_type),
                    pa.array(cols[1], pa.int64()),
                    pa.array(cols[2], pa.int64()),
                    pa.array([len(held[d]) for d in cols[0]], pa.int64()),
                    pa.array([base + seen + w for w in cols[3]], pa.int64()),
                    pa.array(cols[4], pa.int64()),
                    pa.array([held[d][at : at + n].tobytes() for d, at, n in zip(*cols[:3], strict=True)], pa.binary()),
                ],
                names=["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"],
            )
            seen += max(cols[3]) + 1
            held, held_ids, size = [], [], 0
            return out

        for batch in by_size(batches, "text"):
            id_type = batch.schema.field("id").type
            for i, ids in zip(batch.column(batch.schema.get_field_index("id")).to_pylist(), encode(texts_of(batch, "text")), strict=True):
                held.append(np.concatenate([ids.astype("<u4"), end]))
                held_ids.append(i)
                size += len(held[-1])
                if size >= windows * capacity:
                    yield flush()
        if held:
            yield flush()

    return docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).mapInArrow(run, schema)


def op1_pack_karmarkar_karp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents in windows of 2,048 ids, with a checksum of each piece's ids."""
    packed = pack_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=1)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
