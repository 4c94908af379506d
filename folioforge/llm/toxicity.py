"""Toxicity by a classifier chain.

Terms (whole words, and stems of four to six letters) that labelled toxic documents have far more often than others are counted over
a bounded labelled sample. Three categories are predicted in order: ``mention`` (the text has such a term), ``severe`` (terms make up
at least the usual share of the words of a text that has any) and ``toxic`` (the label). The first two are read off a text, without its
label. Every link is a linear (logistic) model of the term features and the probabilities of all earlier links.

A later link learns from earlier probabilities as they will be at scoring time: in fitting they are out-of-fold predictions. For every
fold the terms, the usual share and the link are made again from the other folds alone, and the fold's rows are predicted by that
model; a row's own label and text have no part in the terms, targets or weights behind its earlier probabilities. (As usual in
stacking, the second link's model for a fold learns from rows whose first probability came from models that saw that fold.)
The models of a link, one for each fold and one for all rows, are fitted in parallel tasks.

Fitting sees about ``sample`` labelled ids of either class (a hash of the id chooses them; a documented parameter); scoring sees all
documents and their whole texts.

Defined cases: a null text counts as empty and has no terms; an empty or one-class label table gives that class's smoothed share to all;
labels other than 0 and 1 do not count; of rows that share a labelled id the least text is fitted on; repeated rows get equal scores;
columns of the input named like a result column are replaced; all others are kept.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from .common import by_size, clear_shared, table, texts_of, written
from .linear import Logistic, fit, folds, hashed_share, in_share, labels_of

SAMPLE, TERMS, FOLDS, REJECT = 8_000, 400, 5, 0.5
CATEGORIES = ("mention", "severe", "toxic")
STEMS = (4, 5, 6)
LEAST_ODDS, DOUBT = 2.0, 1.0
MEMORY = 150_000  # words whose terms a task remembers
_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def terms_of(words: set[str]) -> set[str]:
    """Whole words as they are; stems end in a hyphen."""
    return words.union(*({f"{w[:n]}-" for w in words if len(w) > n} for n in STEMS))


@dataclass
class Chain:
    terms: list[str]
    strength: np.ndarray
    links: list[Logistic] = field(default_factory=list)
    usual: float = 1.0

    def __post_init__(self) -> None:
        self.place = {t: i for i, t in enumerate(self.terms)}
        self.known: dict[str, tuple[int, ...]] = {}

    def of_word(self, w: str) -> tuple[int, ...]:
        got = self.known.get(w)
        if got is None:
            if len(self.known) > MEMORY:
                self.known.clear()
            got = self.known[w] = tuple(self.place[t] for t in terms_of({w}) if t in self.place)
        return got

    def features(self, texts: list[str]) -> np.ndarray:
        """Presence of each term; share of words with a term, logarithm of their number and of the text's length, strongest term."""
        d = len(self.terms)
        out = np.zeros((len(texts), d + 4))
        for k, text in enumerate(texts):
            words = words_of(text)
            hits = [h for w in words if (h := self.of_word(w))]
            for h in hits:
                out[k, list(h)] = 1
            top = max((self.strength[list(h)].max() for h in hits), default=0.0)
            out[k, d:] = len(hits) / max(1, len(words)), np.log1p(len(hits)), np.log1p(len(words)), top
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probabilities of the categories, each from the features and those before it."""
        p = np.zeros((len(x), 0))
        for link in self.links:
            p = np.hstack([p, link.p(np.hstack([x, p]))[:, None]])
        return p


@dataclass
class Rows:
    """The fitted-on rows with features for every term list: list k leaves out fold k, the last list is that of all rows."""

    lists: list[tuple[np.ndarray, np.ndarray]]  # places in the common vocabulary, and strengths there
    edges: np.ndarray  # row r has the vocabulary's terms present[edges[r] : edges[r + 1]]
    present: np.ndarray
    hits: np.ndarray  # row, list: number of words with a term
    words: np.ndarray
    y: np.ndarray
    fold: np.ndarray
    weight: np.ndarray

    def features(self, k: int, earlier: np.ndarray | None = None) -> np.ndarray:
        """As Chain.features of the list's terms, in single precision, with the earlier probabilities behind them."""
        at, strength = self.lists[k]
        n, d = len(self.y), len(at)
        row = np.repeat(np.arange(n), np.diff(self.edges))
        place = np.full(int(max(self.present.max(initial=-1), at.max(initial=-1))) + 1, -1)
        place[at] = np.arange(d)
        col = place[self.present] if len(self.present) else np.zeros(0, np.int64)
        more = 0 if earlier is None else earlier.shape[1]
        out = np.zeros((n, d + 4 + more), np.float32)
        out[row[col >= 0], col[col >= 0]] = 1
        if d:
            np.maximum.at(out[:, d + 3], row[col >= 0], strength[col[col >= 0]].astype(np.float32))
        out[:, d] = self.hits[:, k] / np.maximum(1, self.words)
        out[:, d + 1], out[:, d + 2] = np.log1p(self.hits[:, k]), np.log1p(self.words)
        if more:
            out[:, d + 4 :] = earlier
        return out

    def usual(self, k: int, rows: np.ndarray) -> float:
        share = self.hits[rows, k] / np.maximum(1, self.words[rows])
        return float(np.median(share[share > 0])) if (share > 0).any() else 1.0

    def target(self, link: int, k: int, usual: float) -> np.ndarray:
        if link == 2:
            return (self.y == 1).astype(float)
        return ((self.hits[:, k] > 0) if link == 0 else (self.hits[:, k] > 0) & (self.hits[:, k] / np.maximum(1, self.words) >= usual)).astype(float)


def fit_link(rows: Rows, link: int, k: int, earlier: np.ndarray) -> tuple[Logistic, float, np.ndarray]:
    """The model of a link without fold k (or of all rows, for the last k), the usual share it went by, and its probabilities for the rows it left out."""
    seen = rows.fold != k
    usual = rows.usual(k, np.flatnonzero(seen))
    full = rows.features(k, earlier)
    left_out, full = full[~seen].astype(float), full[seen]
    model = fit(full, rows.target(link, k, usual)[seen], rows.weight[seen], penalty=2.0)
    return model, usual, model.p(left_out)


def fit_chain(rows: Rows, terms: list[str], spark: SparkSession | None = None) -> tuple[Chain, np.ndarray]:
    """The chain of all rows' terms, and the out-of-fold probabilities its later links were fitted on. With a session, fits run as tasks."""
    earlier = np.zeros((len(rows.y), 0))
    links: list[Logistic] = []
    usual = 1.0
    for link in range(len(CATEGORIES)):
        which = range(FOLDS + 1) if link < len(CATEGORIES) - 1 else [FOLDS]  # nothing follows the last link

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in batch.column(0).to_pylist():
                    yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([pickle.dumps(fit_link(rows, link, k, earlier))], pa.binary())], names=["k", "made"])  # noqa: B023

        if spark is None:
            made = {k: fit_link(rows, link, k, earlier) for k in which}
        else:
            tasks = spark.range(which[0], which[-1] + 1, 1, len(which)).mapInArrow(run, "k bigint, made binary")
            made = {r["k"]: pickle.loads(bytes(r["made"])) for r in tasks.collect()}  # one row for each fold
        links.append(made[FOLDS][0])
        usual = made[FOLDS][1]
        if link < len(CATEGORIES) - 1:
            out = np.zeros(len(rows.y))
            for k in range(FOLDS):
                out[rows.fold == k] = made[k][2]
            earlier = np.hstack([earlier, out[:, None]])
    at, strength = rows.lists[FOLDS]
    return Chain([terms[i] for i in at.tolist()], strength, links, usual), earlier


def train_toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, n_terms: int = TERMS) -> Chain:
    spark, made = docs.sparkSession, []
    known = labels_of(labels, "toxic")
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    shares = {k: hashed_share(counts.get(k, 0), sample) for k in (0, 1)}
    picked = known.where(F.when(F.col("label") == 1, in_share("label_id", shares[1], 11)).otherwise(in_share("label_id", shares[0], 11)))
    rows = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("label_id"))  # about 2 * sample labels, one per id
    rows = rows.groupBy("doc_id", "label").agg(F.min("text").alias("text")).select(F.xxhash64("doc_id").alias("key"), "text", "label")
    rows = written(rows, "toxicity-sample", made)

    def all_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "text"):
            label = batch.column(batch.schema.get_field_index("label")).to_numpy()
            fold = folds(batch.column(batch.schema.get_field_index("key")).to_numpy(), FOLDS)
            n: dict[str, list[int]] = {}
            for text, at in zip(texts_of(batch, "text"), (FOLDS * label + fold).tolist(), strict=True):
                for t in terms_of(set(words_of(text))):
                    n.setdefault(t, [0] * 2 * FOLDS)[at] += 1
            cells = np.array(list(n.values()), np.int64).reshape(-1, 2 * FOLDS)
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), *(pa.array(cells[:, c]) for c in range(2 * FOLDS))], names=["term", *cells_of])

    cells_of = [f"{c}{k}" for c in ("clean", "toxic") for k in range(FOLDS)]
    per_fold = rows.select("key", "label").toArrow()  # about 2 * sample keys
    fold, y = folds(per_fold.column("key").to_numpy(), FOLDS), per_fold.column("label").to_numpy()
    found = rows.mapInArrow(all_terms, "term string, " + ", ".join(f"{c} bigint" for c in cells_of)).groupBy("term").agg(*(F.sum(c).alias(c) for c in cells_of))
    found = written(found.where(sum(F.col(f"toxic{k}") for k in range(FOLDS)) >= 2), "toxicity-terms", made)
    lists: list[dict[str, float]] = []
    for k in range(FOLDS + 1):  # the strongest terms without fold k; the last list is that of all folds
        clean, toxic = (sum(F.col(f"{c}{j}") for j in range(FOLDS) if j != k) for c in ("clean", "toxic"))
        n0, n1 = (max(1, int(((fold != k) & (y == v)).sum())) for v in (0, 1))
        odds = F.log((toxic + 0.5) / n1) - F.log((clean + 0.5) / n0) - DOUBT * F.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))  # a lower bound: few texts show little
        top = found.select("term", odds.alias("odds"), toxic.alias("toxic")).where((F.col("toxic") >= 2) & (F.col("odds") > LEAST_ODDS))
        lists.append({r["term"]: r["odds"] for r in top.orderBy((F.col("odds") * F.log1p("toxic")).desc(), "term").limit(n_terms).collect()})
    terms = sorted(set().union(*lists))
    place = {t: i for i, t in enumerate(terms)}
    has = {t: sum(1 << k for k, found_in in enumerate(lists) if t in found_in) for t in terms}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of: dict[str, tuple[list[int], int]] = {}
        for batch in by_size(batches, "text"):
            present, hits, n_words = [], np.zeros((len(batch), FOLDS + 1), np.int64), []
            for r, text in enumerate(texts_of(batch, "text")):
                words, here = words_of(text), set()
                for w in words:
                    if w not in of:
                        if len(of) > MEMORY:
                            of.clear()
                        mine = [t for t in terms_of({w}) if t in place]
                        bits = 0
                        for t in mine:
                            bits |= has[t]
                        of[w] = ([place[t] for t in mine], bits)
                    at, bits = of[w]
                    if bits:
                        here.update(at)
                        for k in range(FOLDS + 1):
                            hits[r, k] += bits >> k & 1
                present.append(sorted(here))
                n_words.append(len(words))
            get = lambda c: batch.column(batch.schema.get_field_index(c))  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays([get("key"), get("label"), pa.array(present, pa.list_(pa.int32())), pa.array(hits.tolist(), pa.list_(pa.int64())), pa.array(n_words, pa.int64())], names=["key", "label", "present", "hits", "words"])

    got = rows.mapInArrow(run, "key bigint, label int, present array<int>, hits array<bigint>, words bigint").orderBy("key", "label").toArrow()
    keys, y = got.column("key").to_numpy(), got.column("label").to_numpy()
    present = got.column("present").to_pylist()
    weight = np.where(y == 1, 1 / max(shares[1], 1e-9), 1 / max(shares[0], 1e-9))  # as in the whole label table
    made_rows = Rows(
        [(np.array([place[t] for t in sorted(of)], np.int64), np.array([of[t] for t in sorted(of)], float)) for of in lists], np.cumsum([0, *map(len, present)]), np.array([i for x in present for i in x], np.int64),
        np.array(got.column("hits").to_pylist(), np.int64).reshape(-1, FOLDS + 1), got.column("words").to_numpy(), y, folds(keys, FOLDS), weight / weight.mean() if len(weight) else weight,
    )
    chain, _ = fit_chain(made_rows, terms, spark)
    clear_shared(spark, made)
    return chain


def _predicted(batch: pa.RecordBatch, chain: Chain) -> np.ndarray:
    return np.round(chain.predict(chain.features(texts_of(batch, "text")).astype(np.float32).astype(float)), 6)


def score_toxicity(docs: DataFrame, chain: Chain, reject_from: float = REJECT) -> DataFrame:
    """All columns of docs with p_mention, p_severe, p_toxic and is_toxic."""
    new = [f"p_{c}" for c in CATEGORIES] + ["is_toxic"]
    base = docs.select(*(c for c in docs.columns if c not in new))
    schema = StructType([*base.schema.fields, *(StructField(c, DoubleType()) for c in new[:3]), StructField(new[3], BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "text"):
            p = _predicted(batch, chain)
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(p[:, k]) for k in range(3)), pa.array(p[:, 2] >= reject_from)], names=schema.names)

    return base.mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, chain: Chain, reject_from: float = REJECT) -> DataFrame:
    """The rows of docs that the chain does not call toxic, with docs' own columns whatever their names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_size(batches, "text"):
            yield batch.filter(pa.array(_predicted(batch, chain)[:, 2] < reject_from))

    return docs.mapInArrow(run, docs.schema)


def op8_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's category probabilities and whether it counts as toxic."""
    docs = table(spark, sf_dir, "documents")
    chain = train_toxicity(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, chain).select("doc_id", "p_mention", "p_severe", "p_toxic", "is_toxic")
