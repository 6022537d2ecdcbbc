"""Quality classifier: histogram gradient-boosted trees over document statistics.

``statistics`` computes ``len(NAMES)`` numbers of each text (lengths, shares of
character classes, repetition, line shape), vectorised over an Arrow batch.
``fit`` learns boosted regression trees with the logistic loss on the
statistics of at most ``FIT_ROWS`` labelled rows (a documented bound: those of
smallest id hash); features are cut into at most ``BINS`` quantile bins and each
level of a tree is grown from one histogram of gradients.  The trees are perfect
binary trees of depth ``DEPTH`` kept as three flat arrays (feature, threshold,
leaf value), so scoring walks all rows of a batch down all trees with numpy
indexing and no per-row code.

Defined results: null and empty texts have all-zero statistics and get the
model's score for those; without labelled rows of both classes the score is the
smoothed share of label 1 (0.5 without any row); null ids and repeated rows are
kept; an empty table gives no rows; other columns are not read.  Texts of any length are
taken whole; of cuts with equal gain the first is taken.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.llm.docstats import Parsed, base_counts, byte_flags, doc_salt, lines, parse
from attrition.llm.labelled import labelled_sample
from attrition.llm.textbatch import chunks, doc_of, per_doc, seen_before, span_hashes

FIT_ROWS = 20_000
TREES = 80
DEPTH = 4
BINS = 64
RATE = 0.15
L2 = 2.0
MIN_HESSIAN = 2.0

_CLASSES = {
    "upper": byte_flags(bytes(range(0x41, 0x5B))),
    "lower": byte_flags(bytes(range(0x61, 0x7B))),
    "digit": byte_flags(b"0123456789"),
    "space": byte_flags(b" \t\n\r\x0b\x0c"),
    "newline": byte_flags(b"\n"),
    "period": byte_flags(b"."),
    "comma": byte_flags(b",;:"),
    "bang": byte_flags(b"!?"),
    "pipe": byte_flags(b"|"),
    "mark": byte_flags(b"#*$%&<>"),
    "bracket": byte_flags(b"()[]{}=_/\\@~^+\"'`"),
    "high": byte_flags(bytes(range(0x80, 0x100))),
}

NAMES = (
    "n_bytes", "n_words", "mean_word", "long_words", "short_words", "distinct_words", "repeat_words", "dup_lines",
    "n_lines", "words_by_line", "line_end_period", "marked_words", "banged_words", "upper_words", "same_as_previous",
    *(f"{c}_share" for c in _CLASSES),
)


def statistics(p: Parsed) -> np.ndarray:
    """Matrix (documents x ``NAMES``) of a parsed chunk; shares are 0 where there is nothing to share."""
    t, n = p.t, len(p.t)
    size = (t.ends - t.starts).astype(float)
    c = base_counts(p)
    words = c["n_words"].astype(float)
    w1 = np.maximum(words, 1)
    length = (p.we - p.ws).astype(float)
    b0, b1 = p.bounds[:-1], p.bounds[1:]
    doc = doc_of(p.bounds)
    ls, le, ld = lines(p)
    n_lines = np.bincount(ld, minlength=n).astype(float)
    l1 = np.maximum(n_lines, 1)
    first = t.data[p.ws] if len(p.ws) else np.zeros(0, np.uint8)
    last = t.data[p.we - 1] if len(p.we) else np.zeros(0, np.uint8)
    second = t.data[np.minimum(p.ws + 1, np.maximum(p.we - 1, 0))] if len(p.ws) else first
    upper = _CLASSES["upper"]
    new = ~seen_before(p.wh ^ doc_salt(doc))
    same = np.zeros(len(p.wh), dtype=bool)
    same[1:] = (p.wh[1:] == p.wh[:-1]) & (doc[1:] == doc[:-1])
    period_end = np.bincount(ld, weights=(t.data[le - 1] == 0x2E), minlength=n) if len(le) else np.zeros(n)

    def share(flags: np.ndarray) -> np.ndarray:
        return per_doc(flags, b0, b1) / w1

    columns = [
        np.log1p(size), np.log1p(words), share(length), share(length > 12), share(length <= 3), share(new),
        c["n_repeat_words"] / w1, c["n_dup_lines"] / l1, np.log1p(n_lines), words / l1, period_end / l1,
        share(_CLASSES["mark"][last]), share(_CLASSES["bang"][last]), share(upper[first] & upper[second] & (length > 1)), share(same),
        *(per_doc(flags[t.data], t.starts, t.ends) / np.maximum(size, 1) for flags in _CLASSES.values()),
    ]
    return np.stack(columns, axis=1)


@dataclass
class Trees:
    """Perfect trees in flat arrays: node k has children 2k+1 and 2k+2 (within its tree)."""

    prior: float
    feature: np.ndarray  # (trees, 2**DEPTH - 1) int32
    cut: np.ndarray  # (trees, 2**DEPTH - 1): go right where the value is above
    leaf: np.ndarray  # (trees, 2**DEPTH)

    def score(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))
        margin = np.full(len(x), self.prior)
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            margin += leaf[node - (2**DEPTH - 1)]
        return 1 / (1 + np.exp(-margin))


def bin_edges(x: np.ndarray) -> list[np.ndarray]:
    """At most ``BINS - 1`` distinct quantile cuts of every column."""
    q = np.linspace(0, 1, BINS + 1)[1:-1]
    return [np.unique(np.quantile(col, q, method="lower")) for col in x.T]


def grow(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boost ``TREES`` trees on the rows ``x`` with 0/1 labels ``y``."""
    n, f = x.shape if x.ndim == 2 and len(x) else (0, len(NAMES))
    share = (y.sum() + 0.5) / (n + 1)
    prior = float(np.log(share / (1 - share)))
    inner = 2**DEPTH - 1
    if n == 0 or y.min() == y.max():
        return Trees(prior, np.zeros((0, inner), np.int32), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    edges = bin_edges(x)
    binned = np.stack([np.searchsorted(e, col, "left") for e, col in zip(edges, x.T, strict=True)], axis=1)  # value > e[b-1]
    at = binned + np.arange(f) * BINS
    margin = np.full(n, prior)
    out_f, out_c, out_l = [], [], []
    for _ in range(TREES):
        prob = 1 / (1 + np.exp(-margin))
        g, h = prob - y, prob * (1 - prob)
        feature, cut = np.zeros(inner, np.int32), np.full(inner, np.inf)
        node = np.zeros(n, dtype=np.int64)
        for level in range(DEPTH):
            width = 2**level
            local = node - (width - 1)
            key = (local[:, None] * (f * BINS) + at).ravel()
            shape = (width, f, BINS)
            gs = np.bincount(key, np.repeat(g, f), width * f * BINS).reshape(shape)
            hs = np.bincount(key, np.repeat(h, f), width * f * BINS).reshape(shape)
            gl, hl = np.cumsum(gs, axis=2)[:, :, :-1], np.cumsum(hs, axis=2)[:, :, :-1]
            gt, ht = gs.sum(axis=2, keepdims=True), hs.sum(axis=2, keepdims=True)
            gain = gl**2 / (hl + L2) + (gt - gl) ** 2 / (ht - hl + L2) - gt**2 / (ht + L2)
            gain[(hl < MIN_HESSIAN) | (ht - hl < MIN_HESSIAN)] = -1
            flat = gain.reshape(width, -1)
            best = flat.argmax(axis=1)
            for k in range(width):
                j, b = divmod(int(best[k]), BINS - 1)
                if flat[k, best[k]] > 1e-6 and b < len(edges[j]):
                    feature[width - 1 + k], cut[width - 1 + k] = j, edges[j][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > cut[node])
        local = node - inner
        leaf = -RATE * np.bincount(local, g, inner + 1) / (np.bincount(local, h, inner + 1) + L2)
        margin += leaf[local]
        out_f.append(feature)
        out_c.append(cut)
        out_l.append(leaf)
    return Trees(prior, np.array(out_f), np.array(out_c), np.array(out_l))


def _statistics_of(texts: pa.Array) -> np.ndarray:
    return np.concatenate([statistics(parse(t)) for t in chunks(texts)] or [np.zeros((0, len(NAMES)))])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    where: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    rows: int = FIT_ROWS,
) -> Trees:
    """Fit on the statistics of at most ``rows`` labelled documents that meet ``where`` (on ``doc_id``)."""
    sample = labelled_sample(docs, labels, rows, where, id_col, text_col, label_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _statistics_of(batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(list(x), pa.list_(pa.float64())), batch.column(1), batch.column(2)], names=["x", "label", "doc_id"])

    # bounded: at most ``rows`` vectors of len(NAMES) numbers
    found = sample.select("text", "label", "doc_id").mapInArrow(run, "x array<double>, label int, doc_id long").toPandas()
    found = found.sort_values("doc_id", kind="stable")  # the fit does not depend on the partitioning
    x = np.stack(found["x"].to_list()) if len(found) else np.zeros((0, len(NAMES)))
    return grow(x, found["label"].to_numpy(dtype=float))


def score(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` (0 to 1, higher: label 1 likelier) of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = shared.value.score(_statistics_of(batch.column(1)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(s)], names=["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, score double")
