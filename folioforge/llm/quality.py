"""Quality classifier by co-training of two views.

The content view sees measures of a text's letters, words and lines; the metadata view sees language, source and stated
length. Each is a calibrated logistic model. Both start from the labelled sample; in every round each view labels documents
without label of which it is confident (calibrated probability beyond ``confident``) for the other view, which is fitted again on its
labelled rows and these; labels that make a view worse on the labelled rows set aside are given back. Each view is calibrated on
those rows, the log-odds of the views are added (the prior counted once), and every document is scored.

Fitting sees a bounded sample of the labelled documents: about ``sample`` ids (a hash of the id chooses them; a documented
parameter). The exchange sees all documents without label: both views' measures of every document are written to a table once, every
round counts over it how many documents of either class a view is confident of, and takes about ``grow`` of each, spread evenly over
these by a hash of the id. Scoring sees all documents and their whole texts.

Defined cases: a null text counts as empty; null language, source or length are values of their own; an empty or one-class label
table gives the smoothed share of that class to all documents; labels that disagree count as the larger, labels other than 0 and 1
not at all; of rows that share a labelled id one is fitted on; repeated rows get equal scores; columns of the input named like a
result column are replaced by it; all other columns are kept as they are.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from .common import by_size, clear_shared, keyed_join, table, texts_of, written
from .linear import Logistic, fit, folds, hashed_share, in_share, labels_of, platt, sigmoid

SAMPLE, ROUNDS, GROW, CONFIDENT, REJECT = 24_000, 4, 2_000, 0.97, 0.5
SOURCES, LANGS = 16, 8
N_CONTENT = 26


def content_features(texts: list[str]) -> np.ndarray:
    """A row of measures for each text, from counts of bytes, words and lines."""
    out = np.zeros((len(texts), N_CONTENT))
    for k, text in enumerate(texts):
        raw = text.encode()
        n = max(1, len(raw))
        c = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
        words = text.split()
        m = max(1, len(words))
        kinds = set(words)
        lines = text.split("\n")
        upper = int(c[65:91].sum())
        lower = int(c[97:123].sum())
        letters = upper + lower + int(c[128:].sum()) / 2
        marks = n - int(c[48:58].sum()) - upper - lower - int(c[128:].sum()) - int(c[32]) - int(c[10])
        same = sum(map(str.__eq__, words, words[1:]))
        row = (
            np.log1p(len(words)), np.log1p(len(raw)), upper / max(1.0, letters), lower / n, int(c[48:58].sum()) / n, marks / n, c[33] / n, c[124] / n, int(c[[35, 36, 37, 38]].sum()) / n, c[42] / n,
            c[46] / n, c[44] / n, c[32] / n, 100 * c[10] / n, int(c[[47, 58, 64, 95]].sum()) / n, int(c[[60, 62, 123, 125, 91, 93, 92]].sum()) / n, int(c[128:].sum()) / n,
            len(raw) / m, len(kinds) / m, len(kinds) / m**0.75, same / m, len(set(lines)) / len(lines), np.log1p(len(lines)), sum(map(str.istitle, words)) / m, float(len(words) == 0), float(c[0:9].sum()) / n,
        )
        out[k] = row
    return out


def metadata_features(lang: list, source: list, n_chars: list) -> np.ndarray:
    """Hashed language and source, and the stated length. (Reading and hashing of short values only.)"""
    out = np.zeros((len(lang), LANGS + SOURCES + 2))
    for k, (a, b, n) in enumerate(zip(lang, source, n_chars, strict=True)):
        out[k, zlib.crc32(str(a).encode()) % LANGS] = 1
        out[k, LANGS + zlib.crc32(str(b).encode()) % SOURCES] = 1
        out[k, -2:] = (0, 1) if n is None else (np.log1p(max(0, n)), 0)
    return out


@dataclass
class CoTrained:
    content: Logistic
    metadata: Logistic
    content_scale: tuple[float, float]
    metadata_scale: tuple[float, float]
    prior: float
    exchanged: tuple[int, int]

    def views(self, x: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return tuple(a * m.logit(f) + b for (a, b), m, f in ((self.content_scale, self.content, x), (self.metadata_scale, self.metadata, z)))

    def score(self, x: np.ndarray, z: np.ndarray) -> np.ndarray:
        a, b = self.views(x, z)
        return sigmoid(a + b - self.prior)


#: (view, its model, its calibration, round) to (key, both views, label) of documents without label of which the view is confident
Pool = Callable[[int, Logistic, tuple[float, float], int], tuple[np.ndarray, np.ndarray, np.ndarray]]


def sure_of(model: Logistic, scale: tuple[float, float], f: np.ndarray, confident: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows a view calls good, and rows it calls bad, with confidence."""
    p = sigmoid(scale[0] * model.logit(f) + scale[1])
    return p >= confident, 1 - p >= confident


def co_train(x: np.ndarray, z: np.ndarray, y: np.ndarray, keys: np.ndarray, pool: Pool, rounds: int = ROUNDS) -> CoTrained:
    """x, z: the views of the labelled rows; y: 1 good, 0 bad; keys: what folds are chosen by; pool: the documents without label."""
    views = [x, z]
    d = x.shape[1]
    held = folds(keys, 5) == 0
    train = ~held
    if len(np.unique(y[held])) < 2 or len(np.unique(y[train])) < 2:
        held = train = np.ones(len(y), bool)  # too few labels to set some aside
    share = (float(y.sum()) + 0.5) / (len(y) + 1)
    none = (np.zeros(0, np.int64), np.zeros((0, d + z.shape[1])), np.zeros(0))
    own = [none, none]  # pseudo-labelled rows a view was given
    models, scales = [None, None], [(1.0, 0.0), (1.0, 0.0)]

    def refit(v: int) -> None:
        _, f, label = own[v]
        more = f[:, :d] if v == 0 else f[:, d:]
        weight = np.concatenate([np.ones(int(train.sum())), np.full(len(label), 0.5)])
        models[v] = fit(np.concatenate([views[v][train], more]), np.concatenate([y[train].astype(float), label]), weight)
        scales[v] = platt(models[v].logit(views[v][held]), y[held].astype(float)) if held.any() else (1.0, 0.0)

    def loss(v: int) -> float:
        a, b = scales[v]
        p = np.clip(sigmoid(a * models[v].logit(views[v][held]) + b), 1e-6, 1 - 1e-6)
        return float(-np.mean(np.where(y[held] == 1, np.log(p), np.log(1 - p)))) if held.any() else 0.0

    for v in (0, 1):
        refit(v)
    for r in range(rounds if len(y) else 0):
        given = [pool(v, models[v], scales[v], r) for v in (0, 1)]
        for v in (0, 1):
            old, new = own[v], given[1 - v]
            fresh = ~np.isin(new[0], old[0])
            if not fresh.any():
                continue
            before, kept = loss(v), (models[v], scales[v])
            own[v] = tuple(np.concatenate([a, b[fresh]]) for a, b in zip(old, new, strict=True))
            refit(v)
            if loss(v) > before + 1e-3:  # labels that make the view worse on rows set aside are not taken
                (models[v], scales[v]), own[v] = kept, old
    return CoTrained(models[0], models[1], scales[0], scales[1], float(np.log(share / (1 - share))), (len(own[1][0]), len(own[0][0])))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, key (a hash of it) and f, the measures of both views, of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "text"):
            get = lambda c: batch.column(batch.schema.get_field_index(c))  # noqa: B023, E731
            f = np.hstack([content_features(texts_of(batch, "text")), metadata_features(*(get(c).to_pylist() for c in ("lang", "source", "n_chars")))])
            flat = pa.array(f.astype(np.float32).ravel())
            yield pa.RecordBatch.from_arrays([get("doc_id"), get("key"), pa.FixedSizeListArray.from_arrays(flat, f.shape[1]).cast(pa.list_(pa.float32()))], names=["doc_id", "key", "f"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64("doc_id").alias("key"), "text", "lang", "source", "n_chars").mapInArrow(run, f"doc_id {kind}, key bigint, f array<float>")


def _matrix(t: pa.Table, width: int) -> np.ndarray:
    return np.array(t.column("f").combine_chunks().flatten().to_numpy(zero_copy_only=False), float).reshape(-1, width)


def pool_of(free: DataFrame, grow: int = GROW, confident: float = CONFIDENT) -> Pool:
    """The documents without label, as a table of key and f, read by every round."""
    width = N_CONTENT + LANGS + SOURCES + 2

    def sure(batch: pa.RecordBatch, v: int, model: Logistic, scale: tuple[float, float]) -> tuple[np.ndarray, np.ndarray]:
        f = batch.column(1).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)
        return sure_of(model, scale, f[:, :N_CONTENT] if v == 0 else f[:, N_CONTENT:], confident)

    def take(v: int, model: Logistic, scale: tuple[float, float], r: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            n = np.zeros(2, np.int64)
            for batch in batches:
                n += [int(s.sum()) for s in sure(batch, v, model, scale)]
            yield pa.RecordBatch.from_arrays([pa.array(n[:1]), pa.array(n[1:])], names=["good", "bad"])

        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                good, bad = sure(batch, v, model, scale)
                key = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
                lot = ((key + np.uint64(r + 1)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(float) / 2.0**32
                some = (good & (lot < shares[0])) | (bad & (lot < shares[1]))
                rows = batch.filter(pa.array(some))
                yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), pa.array(good[some].astype(np.int32))], names=["key", "f", "label"])

        n = free.mapInArrow(count, "good bigint, bad bigint").agg(F.sum("good"), F.sum("bad")).first()
        shares = [hashed_share(k or 0, grow) for k in n]
        # rows that repeat an id are one; about 2 * grow are left
        got = free.mapInArrow(pick, "key bigint, f array<float>, label int").groupBy("key").agg(F.min(F.struct("f", "label")).alias("r")).select("key", "r.f", "r.label").orderBy("key").toArrow()
        return got.column("key").to_numpy(), _matrix(got, width), got.column("label").to_numpy().astype(float)

    return take


def train_quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, grow: int = GROW, confident: float = CONFIDENT) -> CoTrained:
    """Fits on about ``sample`` labelled ids; pseudo-labels come from all documents without label."""
    made: list[str] = []
    kind = docs.schema["doc_id"].dataType.simpleString()
    known = written(labels_of(labels, "quality").select(F.col("label_id").cast(kind).alias("doc_id"), "label"), "quality-labels", made)
    share = hashed_share(known.count(), sample)
    f = written(measured(docs), "quality-measures", made)
    rows = written(keyed_join(f, known, ["doc_id"], ["f"], how="left").select("doc_id", "key", "f", "label"), "quality-rows", made)
    one = rows.where(F.col("label").isNotNull() & in_share("doc_id", share, 7)).groupBy("key").agg(F.min(F.struct("f", "label")).alias("r")).select("key", "r.f", "r.label").orderBy("key").toArrow()
    m = _matrix(one, N_CONTENT + LANGS + SOURCES + 2)
    pool = pool_of(rows.where("label IS NULL").select("key", "f"), grow, confident)
    model = co_train(m[:, :N_CONTENT], m[:, N_CONTENT:], one.column("label").to_numpy(), one.column("key").to_numpy(), pool)
    clear_shared(docs.sparkSession, made)
    return model


def _judged(batch: pa.RecordBatch, model: CoTrained, reject_below: float) -> tuple[np.ndarray, ...]:
    """Both calibrated views, the combined score and whether a row is kept."""
    get = lambda c: batch.column(batch.schema.get_field_index(c))
    x, z = content_features(texts_of(batch, "text")), metadata_features(*(get(c).to_pylist() for c in ("lang", "source", "n_chars")))
    x, z = x.astype(np.float32).astype(float), z.astype(np.float32).astype(float)
    a, b = model.views(x, z)
    q = np.round(model.score(x, z), 6)
    return np.round(sigmoid(a), 6), np.round(sigmoid(b), 6), q, q >= reject_below


def score_quality(docs: DataFrame, model: CoTrained, reject_below: float = REJECT) -> DataFrame:
    """All columns of docs with quality_content, quality_metadata, quality and keep_quality."""
    new = ["quality_content", "quality_metadata", "quality", "keep_quality"]
    base = docs.select(*(c for c in docs.columns if c not in new))
    schema = StructType([*base.schema.fields, *(StructField(c, DoubleType()) for c in new[:3]), StructField(new[3], BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "text"):
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, _judged(batch, model, reject_below))], names=schema.names)

    return base.mapInArrow(run, schema)


def keep_quality(docs: DataFrame, model: CoTrained, reject_below: float = REJECT) -> DataFrame:
    """The rows of docs that the model keeps, with docs' own columns whatever their names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "text"):
            yield batch.filter(pa.array(_judged(batch, model, reject_below)[3]))

    return docs.mapInArrow(run, docs.schema)


def op7_quality_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's calibrated views, combined score and whether it is kept."""
    docs = table(spark, sf_dir, "documents")
    model = train_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, model).select("doc_id", "quality_content", "quality_metadata", "quality", "keep_quality")
