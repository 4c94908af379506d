"""Token-id files compressed with a Re-Pair grammar per block, with random access by document.

Rows are range-partitioned by document id, so that task t holds the t-th stretch of the ascending order. A task tokenises its
documents in order and closes a block when it holds about ``block_ids`` ids. In a block, frequent pairs of neighbouring ids are
replaced by new ids (nonterminals) over several rounds; a round replaces many pairs at once, each from left to right without
overlap, instead of one pair per pass over the data. Rounds go on until no pair recurs ``LEAST`` times or the 16-bit ids are used
up; rarer pairs are left, since a rule costs as much as four pairs save and the time of a round. A block row stores the rules, the length each nonterminal expands to, the
compressed sequence and the documents' ids and lengths. Since the expansion lengths give the position of every symbol, a
document is decoded from its own stretch of symbols alone.

The files are Parquet tables of such block rows in the folder that all executors share; Spark's committer makes lost tasks harmless.

Defined cases: a null or empty text has the end id only; rows with equal ids stand in the order of a hash of their texts; a null
id comes first; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from .common import by_size, shared_dir, table, texts_of, vocabulary

BLOCK_IDS, ROUNDS, RULES_A_ROUND, LEAST = 1 << 20, 64, 2000, 12
_BUCKETS = 20


def compress(ids: np.ndarray, n_terminals: int, rounds: int = ROUNDS, rules_a_round: int = RULES_A_ROUND, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, rules, expansion lengths): nonterminal n_terminals + k stands for the two ids in rules[k]. All fit 16 bits."""
    seq = ids.astype(np.uint32)
    rules = np.zeros((0, 2), np.uint32)
    lengths = np.ones(n_terminals, np.int64)
    for _ in range(rounds):
        room = min(rules_a_round, 65536 - n_terminals - len(rules))
        if len(seq) < 2 * least or room <= 0:
            break
        key = seq[:-1] << np.uint32(16) | seq[1:]
        bucket = (key * np.uint32(0x9E3779B1)) >> np.uint32(32 - _BUCKETS)
        n = np.bincount(bucket, minlength=1 << _BUCKETS)
        as_many = np.bincount(np.minimum(n, 65535))[::-1].cumsum()  # buckets with at least 65535, 65534, ... pairs
        floor = max(least, len(as_many) - 1 - int(np.searchsorted(as_many, room)))
        found, times = np.unique(key[n[bucket] >= floor], return_counts=True)
        found = np.sort(found[times >= least][np.argsort(-times[times >= least], kind="stable")][:room])
        if not len(found):
            break
        hot = np.zeros(1 << _BUCKETS, bool)
        hot[(found * np.uint32(0x9E3779B1)) >> np.uint32(32 - _BUCKETS)] = True
        at = np.flatnonzero(hot[bucket])
        rule = np.minimum(np.searchsorted(found, key[at]), len(found) - 1)
        same = found[rule] == key[at]
        at, rule = at[same], rule[same]
        fresh = np.ones(len(at), bool)  # where a run of touching places starts
        fresh[1:] = at[1:] != at[:-1] + 1
        order = np.arange(len(at))
        kept = (order - np.maximum.accumulate(np.where(fresh, order, 0))) % 2 == 0  # each other place of a run
        at, rule = at[kept], rule[kept]
        used, rule = np.unique(rule, return_inverse=True)
        pairs = found[used]
        new = np.stack([pairs >> np.uint32(16), pairs & np.uint32(0xFFFF)], 1)
        seq[at] = (n_terminals + len(rules) + rule).astype(np.uint32)
        keep = np.ones(len(seq), bool)
        keep[at + 1] = False
        seq = seq[keep]
        rules = np.concatenate([rules, new])
        lengths = np.concatenate([lengths, lengths[new[:, 0]] + lengths[new[:, 1]]])
    return seq.astype("<u2"), rules.astype("<u2"), lengths[n_terminals:].astype("<u4")


class Block:
    """A compressed block, open for reading."""

    def __init__(self, n_terminals: int, rules: bytes, lengths: bytes, sequence: bytes):
        self.seq = np.frombuffer(sequence, "<u2").astype(np.int64)
        pairs, more = np.frombuffer(rules, "<u2").reshape(-1, 2).astype(np.int64), np.frombuffer(lengths, "<u4").astype(np.int64)
        self.length = np.concatenate([np.ones(n_terminals, np.int64), more])
        self.start = np.concatenate([np.arange(n_terminals), n_terminals + more.cumsum() - more])
        self.pool = np.concatenate([np.arange(n_terminals, dtype=np.uint32), np.zeros(int(more.sum()), np.uint32)])
        pool, start, length = self.pool, self.start.tolist(), self.length.tolist()
        for k, (a, b) in enumerate(pairs.tolist()):  # a rule stands after those it names
            at, n, m = start[n_terminals + k], length[a], length[b]
            pool[at : at + n] = pool[start[a] : start[a] + n]
            pool[at + n : at + n + m] = pool[start[b] : start[b] + m]
        self.ends = self.length[self.seq].cumsum()

    def ids(self, start: int, n: int) -> np.ndarray:
        """The n ids from position ``start``, from the symbols that cover them alone."""
        i = int(np.searchsorted(self.ends, start, "right"))
        j = int(np.searchsorted(self.ends, start + n, "left")) + 1
        part = self.seq[i:j]
        length = self.length[part]
        total = length.cumsum()
        if not len(part):
            return self.pool[:0]
        out = self.pool[np.repeat(self.start[part] - (total - length), length) + np.arange(total[-1])]
        skip = start - (int(self.ends[i]) - int(length[0]))
        return out[skip : skip + n]


def write_token_files(docs: DataFrame, path: str, vocabulary_path: str, end_id: int, id_column: str = "doc_id", text_column: str = "text", block_ids: int = BLOCK_IDS) -> None:
    """Writes block rows: shard, block, before (ids of the shard before it), n_ids, n_terminals, doc_ids, doc_lengths, rules, lengths, sequence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = bpe.encoder(vocabulary_path)
        terminals = len(model.tokens)
        shard, block, before = TaskContext.get().partitionId(), 0, 0
        held, doc_ids, size = [], [], 0
        end = np.array([end_id], np.uint16)

        def flush() -> pa.RecordBatch:
            nonlocal block, before, held, doc_ids, size
            seq, rules, lengths = compress(np.concatenate([y for x in held for y in (x, end)]), terminals)
            row = {
                "shard": [shard], "block": [block], "before": [before], "n_ids": [size], "n_terminals": [terminals], "doc_ids": [doc_ids], "doc_lengths": [[len(x) + 1 for x in held]],
                "rules": [rules.tobytes()], "lengths": [lengths.tobytes()], "sequence": [seq.tobytes()],
            }
            block, before, held, doc_ids, size = block + 1, before + size, [], [], 0
            return pa.RecordBatch.from_pydict(row, schema=schema_arrow)

        for batch in by_size(batches, "text"):
            for i, ids in zip(batch.column(batch.schema.get_field_index("id")).to_pylist(), model.encode_many(texts_of(batch, "text")), strict=True):
                held.append(ids)
                doc_ids.append(i)
                size += len(ids) + 1
                if size >= block_ids:
                    yield flush()
        if held:
            yield flush()

    schema_arrow = pa.schema(
        [("shard", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64()), ("n_terminals", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("doc_lengths", pa.list_(pa.int32())), ("rules", pa.binary()), ("lengths", pa.binary()), ("sequence", pa.binary())]
    )
    schema = "shard int, block int, before bigint, n_ids bigint, n_terminals int, doc_ids array<bigint>, doc_lengths array<int>, rules binary, lengths binary, sequence binary"
    rows = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    tie = F.xxhash64("text")
    rows.repartitionByRange(F.col("id").asc_nulls_first(), tie).sortWithinPartitions(F.col("id").asc_nulls_first(), tie).mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row for each document of the files: doc_id, start (ids of all documents before it), n_tokens, ids (little-endian 32-bit)."""
    blocks = spark.read.parquet(path)
    totals = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n"))  # a row for each task that wrote
    from pyspark.sql import Window

    first = totals.select(F.col("shard").alias("of"), (F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("first"))
    placed = blocks.join(F.broadcast(first), F.col("shard") == F.col("of"))  # as many rows as tasks that wrote, no more

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                row = batch.slice(k, 1).to_pylist()[0]
                block = Block(row["n_terminals"], row["rules"], row["lengths"], row["sequence"])
                n = np.array(row["doc_lengths"], np.int64)
                start = n.cumsum() - n
                for at in range(0, len(n), 1000):
                    part = slice(at, at + 1000)
                    ids = [block.ids(s, m).astype("<u4").tobytes() for s, m in zip(start[part].tolist(), n[part].tolist(), strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(row["doc_ids"][part], pa.int64()), pa.array(start[part] + row["first"] + row["before"]), pa.array(n[part]), pa.array(ids, pa.binary())], names=["doc_id", "start", "n_tokens", "ids"]
                    )

    columns = ["n_terminals", "rules", "lengths", "sequence", "doc_ids", "doc_lengths", "first", "before"]
    return placed.select(*columns).mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids binary")


def op10_repair_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document's ids, read back from the files."""
    path = shared_dir(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_50k.json"), end_id=0)
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
