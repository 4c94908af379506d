"""BPE encoding with content-defined chunk reuse, and decoding.

A rolling hash over each text's bytes cuts it into chunks whose ends depend only on the bytes around them, so that copied
passages give the same chunks whatever surrounds them. Each distinct chunk is encoded once per task and kept in a bounded
memo. A chunk's first and last words may be torn by the cut; at every join of two chunks the torn words, with a whole word on
either side, are encoded again. The join holds when the whole words come out as they did within their chunks; until then the
stretch grows by whole chunks, at last to the whole text. Ids equal those of encoding the whole text at once.

The memo is per task rather than global: sending every chunk to a common place and its ids back would shuffle more bytes than
the texts have, and encoding a chunk again costs less.

Defined cases: a null text counts as empty and has no ids; texts without blanks are one chunk; repeated rows give repeated
results; other columns of the input are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe
from .common import by_size, table, texts_of, vocabulary

WINDOW_BITS, MEAN_BITS = 5, 10
_GEAR = np.random.default_rng(20240229).integers(0, 2**32, 256, dtype=np.uint32)
_MEMO_BYTES = 48_000_000


def cut_points(data: np.ndarray, mean_bits: int = MEAN_BITS) -> np.ndarray:
    """Where a gear hash of the last 32 bytes has ``mean_bits`` zero bits at its top; never within a UTF-8 character.

    The hash of 2w bytes is that of the later w plus that of the earlier w shifted by w bits, so five doublings do.
    """
    h = _GEAR[data]
    for k in range(WINDOW_BITS):
        w = 1 << k
        if len(h) > w:
            h[w:] += h[:-w] << np.uint32(w)
    at = np.flatnonzero(h >> np.uint32(32 - mean_bits) == 0) + 1
    at = at[at < len(data)]
    while len(inside := np.flatnonzero((data[at] & 0xC0) == 0x80)):
        at[inside] += 1
        at = at[at < len(data)]
    return np.unique(at)


class Chunk:
    """Ids of a chunk: of its torn first and last words and of what lies between, and the whole words next to them."""

    __slots__ = ("text", "head", "tail", "first", "last", "first_ids", "last_ids", "body")


class ChunkEncoder:
    def __init__(self, path: str, mean_bits: int = MEAN_BITS, memo_bytes: int = _MEMO_BYTES):
        self.bpe, self.mean_bits, self.most = bpe.PieceEncoder(path), mean_bits, memo_bytes
        self.memo: dict[bytes, Chunk] = {}
        self.held = self.met = self.encoded = self.repaired = self.widened = 0

    def _breaks(self, text: str) -> tuple[int, int, int, int] | None:
        """The first two and the last two places where any text may be cut, in order; None where there are fewer."""
        if not self.bpe.by_word:
            at = [m.start() for m in bpe._SAFE.finditer(text)]
            return (at[0], at[1], at[-2], at[-1]) if len(at) > 3 else None
        a = text.find(" ")
        b, d = text.find(" ", a + 1), text.rfind(" ")
        c = text.rfind(" ", 0, d)
        return (a, b, c, d) if 0 <= a < b < c < d else None

    def chunks_of(self, text: str) -> list[bytes]:
        data = (text.replace("\n", " ") if self.bpe.by_word else text).encode()
        at = cut_points(np.frombuffer(data, np.uint8), self.mean_bits).tolist() if len(data) > 64 else []
        out, start = [], 0
        for i, j in zip(at, [*at[1:], len(data)], strict=False):
            # a chunk has whole words at both ends, or else is left with its neighbour
            if data.count(b" ", start, i) >= 8 and data.count(b" ", i, j) >= 8:
                out.append(data[start:i])
                start = i
        out.append(data[start:])
        return out

    def learn(self, found: set[bytes]) -> None:
        if self.held > self.most:
            self.memo, self.held = {}, 0
        new = [x for x in found if x not in self.memo]
        self.encoded += len(new)
        parts: list[str] = []
        for raw in new:
            text, c = raw.decode(), Chunk()
            if at := self._breaks(text):
                c.text, c.head, c.first, c.last, c.tail = text, text[: at[0]], text[at[0] : at[1]], text[at[2] : at[3]], text[at[3] :]
                parts += [c.first, c.last, text[at[0] : at[3]]]
            else:
                c.text, c.head, c.first, c.last, c.tail = text, None, "", "", None
                parts += ["", "", text]
            self.memo[raw] = c
            self.held += len(raw) + 400
        ids = self.bpe.encode_bytes(parts)
        for k, raw in enumerate(new):
            c = self.memo[raw]
            c.first_ids, c.last_ids, c.body = ids[3 * k : 3 * k + 3]

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian 16-bit numbers."""
        cut = [self.chunks_of(x) for x in texts]
        self.met += sum(map(len, cut))
        self.learn({x for xs in cut for x in xs})
        rows = [[self.memo[x] for x in xs] for xs in cut]
        ends: list[str] = []  # torn first and last words of whole texts
        joins: list[tuple[Chunk, Chunk]] = []
        for cs in rows:
            ends += [cs[0].head or "", cs[-1].tail or ""]
            joins += zip(cs, cs[1:], strict=False)
        again = self.bpe.encode_bytes([a.last + (a.tail or "") + (b.head or "") + b.first for a, b in joins])
        outer = self.bpe.encode_bytes(ends)
        self.repaired += len(joins)
        out, k = [], 0
        for n, cs in enumerate(rows):
            parts, good = [outer[2 * n], cs[0].body], True
            for a, b in zip(cs, cs[1:], strict=False):
                ids = again[k]
                k += 1
                i, j = len(a.last_ids), len(ids) - len(b.first_ids)
                good &= a.tail is not None and b.head is not None and i <= j and ids.startswith(a.last_ids) and ids.endswith(b.first_ids)
                parts += [ids[i:j], b.body]
            out.append(b"".join([*parts, outer[2 * n + 1]]) if good else self._widened(cs))
        return out

    def _widened(self, cs: list[Chunk]) -> bytes:
        """A text one of whose joins didn't hold: neighbours are joined two by two until the joins hold or one is left."""
        self.widened += 1
        texts = [c.text for c in cs]
        while len(texts) > 1:
            texts = ["".join(texts[i : i + 2]) for i in range(0, len(texts), 2)]
            if len(texts) == 1:
                break
            made = ChunkEncoder.__new__(ChunkEncoder)
            made.__dict__ |= self.__dict__ | {"memo": {}, "held": 0}
            made.learn({x.encode() for x in texts})
            row = [made.memo[x.encode()] for x in texts]
            if any(c.head is None for c in row):
                continue
            again = self.bpe.encode_bytes([a.last + a.tail + b.head + b.first for a, b in zip(row, row[1:], strict=False)])
            if all(x.startswith(a.last_ids) and x.endswith(b.first_ids) and len(x) >= len(a.last_ids) + len(b.first_ids) for x, a, b in zip(again, row, row[1:], strict=False)):
                first, last = self.bpe.encode_bytes([row[0].head, row[-1].tail])
                mid = [x[len(a.last_ids) : len(x) - len(b.first_ids)] + b.body for x, a, b in zip(again, row, row[1:], strict=False)]
                return b"".join([first, row[0].body, *mid, last])
        return self.bpe.encode_bytes(texts)[0]


def encode_decode(docs: DataFrame, vocabulary_path: str, id_column: str = "doc_id", text_column: str = "text", mean_bits: int = MEAN_BITS) -> DataFrame:
    """One row for each text: doc_id, ids array<int>, decoded string (as decode(ids, skip_special_tokens=False))."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = ChunkEncoder(vocabulary_path, mean_bits)
        tokens = encode.bpe.tokens
        for batch in by_size(batches, "text"):
            ids = [np.frombuffer(x, "<u2") for x in encode.encode_many(texts_of(batch, "text"))]
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            flat = np.concatenate(ids).astype(np.int32)
            if encode.bpe.by_word:
                decoded = [" ".join(map(tokens.__getitem__, x.tolist())) for x in ids]
            else:
                decoded = encode.bpe.library.decode_batch([x.tolist() for x in ids], skip_special_tokens=False)
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index("id")), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())), pa.array(decoded, pa.string())],
                names=["doc_id", "ids", "decoded"],
            )

    return docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def op3_bpe_chunk_reuse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the text decoded from them."""
    out = encode_decode(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return out.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
