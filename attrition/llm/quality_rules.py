"""Quality rules: fixed base rules and a hashed n-gram logistic regression.

Base rules (fixed thresholds): a document fails with fewer than ``MIN_WORDS``
words, or with more than ``REPEAT_PERCENT`` % of its words inside a 5-word
window that the text holds more than once.

Model: relative frequencies of word 1-2-grams and of 1-4-grams of characters
(over the UTF-8 bytes), each family hashed into ``DIM`` shared cells, feed a
logistic regression that MLlib fits on at most ``FIT_ROWS`` labelled rows.
Platt scaling on labelled rows that the fit has not seen (``hash mod 5 = 0``)
turns its margin into a probability; ``good_prob >= KEEP_AT`` keeps a document
that the base rules pass.  A linear score needs no feature vector: scoring
looks up the weight of every n-gram of an Arrow batch and sums it by document.

Defined results: null and empty texts have 0 in every count and fail the base
rules; null ids and repeated rows are kept; without labelled rows of both
classes the model gives 1.0 (or 0.0, if all labelled rows are bad); an empty
table gives no rows; other columns are not read by :func:`score` and stay as they are in
:func:`keep_good`.  Texts of any length are taken whole; a probability equal to ``KEEP_AT`` keeps.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from attrition.llm.docstats import Parsed, base_counts, base_failed, parse
from attrition.llm.labelled import labelled_sample
from attrition.llm.textbatch import chunks, mix64, per_doc

BITS = 16
DIM = 1 << BITS
CHAR_N = (1, 2, 3, 4)
FIT_ROWS = 4_000
KEEP_AT = 0.5
SCALE = 100.0  # features are percentages, so that the penalty is of one size for all
REG = 1e-3

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCHEMA = "doc_id long, " + ", ".join(f"{c} long" for c in BASE) + ", base_failed boolean, good_prob double, kept boolean"


def families(p: Parsed) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each n-gram family: hashed cells, and the range of each document in them."""
    t = p.t
    shift = np.uint64(64 - BITS)
    key = t.data.astype(np.uint64)
    with np.errstate(over="ignore"):
        for n in CHAR_N:
            if n > 1:
                key = key[:-1] * np.uint64(257) + t.data[n - 1 :]
            cells = ((key + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> shift
            s = np.minimum(t.starts, len(key))
            yield cells.astype(np.int64), s, np.maximum(np.minimum(t.ends - (n - 1), len(key)), s)
            if len(key) < 2:
                break
        yield (p.wh >> shift).astype(np.int64), p.bounds[:-1], p.bounds[1:]
        pair = mix64(p.wh[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + p.wh[1:])
        s = np.minimum(p.bounds[:-1], len(pair))
        yield (pair >> shift).astype(np.int64), s, np.maximum(np.minimum(p.bounds[1:] - 1, len(pair)), s)


def features(p: Parsed) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sparse features (cells ascending, values) of each document of the chunk."""
    per = [[] for _ in range(len(p.t))]
    for cells, s, e in families(p):
        for i in range(len(p.t)):
            if e[i] > s[i]:
                c, n = np.unique(cells[s[i] : e[i]], return_counts=True)
                per[i].append((c, n * (SCALE / (e[i] - s[i]))))
    for parts in per:
        if not parts:
            yield np.zeros(0, np.int64), np.zeros(0)
            continue
        c = np.concatenate([a for a, _ in parts])
        v = np.concatenate([b for _, b in parts])
        cells, at = np.unique(c, return_inverse=True)
        yield cells, np.bincount(at, weights=v)


@dataclass
class NgramModel:
    """Weights by cell, intercept, and Platt's slope and offset."""

    weights: np.ndarray
    intercept: float
    slope: float = 1.0
    offset: float = 0.0

    def margins(self, p: Parsed) -> np.ndarray:
        out = np.full(len(p.t), self.intercept)
        for cells, s, e in families(p):
            out += per_doc(self.weights[cells], s, e) * (SCALE / np.maximum(e - s, 1))
        return out

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -60, 60)))


def platt(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of Platt scaling (smoothed targets, damped Newton steps)."""
    pos, neg = label.sum(), len(label) - label.sum()
    target = np.where(label > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    theta = np.array([1.0, 0.0])
    x = np.stack([margin, np.ones_like(margin)], axis=1)
    for _ in range(50):
        q = 1 / (1 + np.exp(-np.clip(x @ theta, -60, 60)))
        grad = x.T @ (q - target) + 1e-3 * (theta - [1.0, 0.0])
        hess = (x * (q * (1 - q))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        theta = theta - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(theta[0], 1e-3)), float(theta[1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = FIT_ROWS) -> NgramModel:
    """Fit the model on at most ``rows`` labelled documents (four fifths fit, one fifth calibrates)."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import VectorUDT

    sample = labelled_sample(docs, labels, rows, id_col=id_col, text_col=text_col)
    held = F.pmod(F.xxhash64(F.lit("calibrate"), "doc_id"), F.lit(5)) == 0

    # the stored form of a sparse vector, so that no second Python worker has to make it
    vector = pa.struct([("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [f for t in chunks(batch.column(0)) for f in features(parse(t))]
            for k in range(0, len(found), 256):
                part = found[k : k + 256]
                parts = [
                    pa.array([0] * len(part), pa.int8()), pa.array([DIM] * len(part), pa.int32()),
                    pa.array([c for c, _ in part], pa.list_(pa.int32())), pa.array([v for _, v in part], pa.list_(pa.float64())),
                ]
                rows = pa.StructArray.from_arrays(parts, fields=list(vector))
                yield pa.RecordBatch.from_arrays([rows, batch.column(1).slice(k, 256).cast(pa.float64())], names=["features", "label"])

    train = sample.where(~held).select("text", "label").mapInArrow(vectors, StructType([StructField("features", VectorUDT()), StructField("label", DoubleType())]))
    train = train.repartition(shuffle_width(rows)).persist()
    try:
        found = {int(r["label"]) for r in train.select("label").distinct().collect()}
        if found != {0, 1}:
            return NgramModel(np.zeros(DIM), -60.0 if found == {0} else 60.0)
        lr = LogisticRegression(regParam=REG, maxIter=60, standardization=False).fit(train)
        model = NgramModel(np.asarray(lr.coefficients.toArray()), float(lr.intercept))
    finally:
        train.unpersist()

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = np.concatenate([model.margins(parse(t)) for t in chunks(batch.column(0))] or [np.zeros(0)])
            yield pa.RecordBatch.from_arrays([pa.array(m), batch.column(1)], names=["margin", "label"])

    seen = sample.where(held).select("text", "label").mapInArrow(margins, "margin double, label int").toPandas()
    if len(seen):
        model.slope, model.offset = platt(seen["margin"].to_numpy(), seen["label"].to_numpy())
    return model


def shuffle_width(rows: int) -> int:
    """Partitions of the training rows: a function of the sample bound alone."""
    return max(1, rows // 500)


def score(docs: DataFrame, model: NgramModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base counts, ``base_failed``, ``good_prob`` and ``kept`` of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for t in chunks(batch.column(1)):
                p = parse(t)
                c = base_counts(p)
                failed, prob = base_failed(c), m.probability(m.margins(p))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(t.first, len(t)),
                        *(pa.array(c[k], pa.int64()) for k in BASE),
                        pa.array(failed),
                        pa.array(prob),
                        pa.array(~failed & (prob >= KEEP_AT)),
                    ],
                    names=["doc_id", *BASE, "base_failed", "good_prob", "kept"],
                )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)


def keep_good(docs: DataFrame, model: NgramModel, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns, in one pass over the texts."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            keep = [np.zeros(0, bool)]
            for t in chunks(batch.column(at)):
                p = parse(t)
                keep.append(~base_failed(base_counts(p)) & (m.probability(m.margins(p)) >= KEEP_AT))
            yield batch.filter(pa.array(np.concatenate(keep)))

    return docs.mapInArrow(run, docs.schema)
