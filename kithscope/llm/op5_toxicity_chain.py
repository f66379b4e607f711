"""Toxicity by a classifier chain.

Categories are predicted one after the other by linear models over words and word beginnings; a later model also sees the
probabilities of the earlier categories. While training, those probabilities are out of fold: each comes from a model that has not seen its
document. Models are fitted on a bounded sample of labelled documents (``most_per_pattern`` of each combination of labels, the
smallest by hash of id, so the choice is stable); every document of the table is then scored.

Cases: a null or empty text has no features and gets the models' intercepts; labels that are null count as missing and the row is
not trained on; a document labelled twice takes the larger label; labels of unknown documents are ignored; without any
labelled document all probabilities are null; repeated rows score alike; an empty table gives an empty table; extra columns are
ignored; long texts are worked off whole.
"""

from __future__ import annotations

import functools
import itertools
import operator
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kithscope.llm.arrays import HASH, LOWER, NOT_ALNUM, Texts, find_words, mix, slices

BITS = 18
BEGINNINGS = (4, 5)


def features(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(document, feature) of lower-cased words and of the first 4 and 5 bytes of longer ones, with repeats."""
    texts = Texts(LOWER[texts.buf], texts.offs)
    words = find_words(texts, NOT_ALNUM)
    sums = HASH.prefix(HASH.table[texts.buf])
    doc = words.doc()
    docs, found = [doc], [HASH.ranges(sums, words.start, words.end)]
    for size in BEGINNINGS:
        longer = np.flatnonzero(words.end - words.start > size)
        docs.append(doc[longer])
        found.append(mix(HASH.ranges(sums, words.start[longer], words.start[longer] + size) + np.uint64(size)))
    return np.concatenate(docs), (np.concatenate(found) >> np.uint64(64 - BITS)).astype(np.int64)


def _distinct(doc: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    key = np.unique((doc << BITS) | feature)
    return key >> BITS, key & ((1 << BITS) - 1)


class Linear(NamedTuple):
    weights: np.ndarray
    bias: float
    earlier: np.ndarray

    def margin(self, doc: np.ndarray, feature: np.ndarray, earlier: np.ndarray) -> np.ndarray:
        return np.bincount(doc, weights=self.weights[feature], minlength=len(earlier)) + earlier @ self.earlier + self.bias


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


def fit_linear(
    doc: np.ndarray, feature: np.ndarray, earlier: np.ndarray, label: np.ndarray, use: np.ndarray, steps: int = 150, min_docs: int = 12, lasso: float = 1e-3, ridge: float = 1e-4
) -> Linear:
    """Logistic regression on the documents of ``use``, both classes weighing the same, by proximal Adam steps on the full sample.

    Features of fewer than ``min_docs`` documents keep weight 0 (they could only be learned by heart), and ``lasso`` sets those to
    0 that say little, so that long documents do not add up noise.
    """
    size = 1 << BITS
    weight = np.where(use, np.where(label == 1, 0.5 / max(1, (use & (label == 1)).sum()), 0.5 / max(1, (use & (label == 0)).sum())), 0.0)
    keep = use[doc]
    doc, feature = doc[keep], feature[keep]
    common = np.bincount(feature, minlength=size) >= min_docs
    keep = common[feature]
    doc, feature = doc[keep], feature[keep]
    names, feature = np.unique(feature, return_inverse=True)
    n, m = len(names), earlier.shape[1]
    x, first, second = np.zeros(n + m + 1), np.zeros(n + m + 1), np.zeros(n + m + 1)
    for step in range(1, steps + 1):
        margin = np.bincount(doc, weights=x[:n][feature], minlength=len(label)) + earlier @ x[n : n + m] + x[-1]
        error = (_sigmoid(margin) - label) * weight
        slope = np.concatenate([np.bincount(feature, weights=error[doc], minlength=n) + ridge * x[:n], error @ earlier, [error.sum()]])
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        rate = 0.1 / (np.sqrt(second / (1 - 0.99**step)) + 1e-3)
        x -= rate * first / (1 - 0.9**step)
        x[:n] = np.sign(x[:n]) * np.maximum(np.abs(x[:n]) - lasso * rate[:n], 0)
    weights = np.zeros(size)
    weights[names] = x[:n]
    return Linear(weights, float(x[-1]), x[n : n + m].copy())


def fit_chain(doc: np.ndarray, feature: np.ndarray, labels: np.ndarray, fold: np.ndarray, folds: int) -> list[Linear]:
    """One model per column of ``labels``; inputs from earlier categories are predictions of models fitted on the other folds."""
    n, chain, earlier = len(labels), [], np.zeros((len(labels), 0))
    for c in range(labels.shape[1]):
        label = labels[:, c]
        chain.append(fit_linear(doc, feature, earlier, label, np.ones(n, dtype=bool)))
        if c + 1 < labels.shape[1]:
            out = np.zeros(n)
            for k in range(folds):
                part = fit_linear(doc, feature, earlier, label, fold != k)
                out[fold == k] = _sigmoid(part.margin(doc, feature, earlier))[fold == k]
            earlier = np.column_stack([earlier, out])
    return chain


def training_sample(labels: DataFrame, categories: list[str], label_id: str, most_per_pattern: int) -> DataFrame:
    """(doc_id, categories) of at most ``most_per_pattern`` documents of each combination of labels."""
    clean = labels.select(F.col(label_id).cast("long").alias("doc_id"), *(F.col(c).cast("int") for c in categories)).dropna()
    clean = clean.groupBy("doc_id").agg(*(F.max(c).alias(c) for c in categories))
    parts = []
    for pattern in itertools.product((0, 1), repeat=len(categories)):
        same = functools.reduce(operator.and_, (F.col(c) == v for c, v in zip(categories, pattern, strict=True)))
        parts.append(clean.filter(same).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_per_pattern))
    return functools.reduce(DataFrame.unionByName, parts)


def train(docs: DataFrame, sample: DataFrame, categories: list[str], id_col: str, text_col: str, folds: int) -> list[Linear]:
    """The chain fitted on ``sample``, whose size is bounded: only its features reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in slices(batch.column("text")):
                doc, feature = _distinct(*features(texts))
                cuts = np.searchsorted(doc, np.arange(hi - lo + 1))
                packed = [feature[a:b].astype(np.int32).tobytes() for a, b in itertools.pairwise(cuts)]
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(part.column(c) for c in categories), pa.array(packed, pa.binary())], names=["doc_id", *categories, "features"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    chosen = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "text", *categories)
    schema = "doc_id long, " + "".join(f"{c} int, " for c in categories) + "features binary"
    rows = sorted(chosen.mapInArrow(run, schema).collect(), key=lambda r: (r["doc_id"], r["features"]))
    if not rows:
        return []
    lists = [np.frombuffer(r["features"], dtype=np.int32) for r in rows]
    doc = np.repeat(np.arange(len(rows)), [len(x) for x in lists])
    table = np.array([[r[c] for c in categories] for r in rows])
    fold = mix(np.array([r["doc_id"] for r in rows], dtype=np.int64).view(np.uint64)) % np.uint64(folds)
    return fit_chain(doc, np.concatenate(lists).astype(np.int64), table, fold.astype(np.int64), folds)


def score(docs: DataFrame, chain: list[Linear], categories: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, p_<category> ...) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        used = np.any([m.weights != 0 for m in models], axis=0) if models else None
        for batch in batches:
            for lo, hi, texts in slices(batch.column("text")):
                n, earlier = hi - lo, np.zeros((hi - lo, 0))
                if models:
                    doc, feature = features(texts)
                    keep = used[feature]
                    doc, feature = _distinct(doc[keep], feature[keep])
                    for m in models:
                        earlier = np.column_stack([earlier, _sigmoid(m.margin(doc, feature, earlier))])
                columns = [pa.array(earlier[:, i]) if models else pa.nulls(n, pa.float64()) for i in range(len(categories))]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, n), *columns], names=["doc_id", *(f"p_{c}" for c in categories)])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long" + "".join(f", p_{c} double" for c in categories))


def toxicity_chain(
    docs: DataFrame,
    labels: DataFrame,
    categories: list[str],
    id_col: str = "doc_id",
    text_col: str = "text",
    label_id: str = "doc_id",
    *,
    most_per_pattern: int = 3000,
    folds: int = 3,
) -> DataFrame:
    """Probabilities of each category for each document; ``categories`` are 0/1 columns of ``labels`` in the order of the chain."""
    sample = training_sample(labels, categories, label_id, most_per_pattern)
    return score(docs, train(docs, sample, categories, id_col, text_col, folds), categories, id_col, text_col)
