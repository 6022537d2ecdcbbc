"""Language identification with a linear-chain conditional random field over words.

Every word of a text gets a language label; the label sequence is scored by
hashed emission features of each word (the whole word as lexicon feature,
affixes of 1-4 bytes, byte 2-3-grams, character class) plus learned start and
transition weights.  Forward-backward gives the marginal of each language at
each word, so a code-switched text is labelled word by word; a document's score
for a language is the mean marginal over its words with a letter.

Training maximises the conditional log-likelihood by Adam over the whole texts
of at most ``FIT_DOCS`` labelled documents (a documented bound: those of
smallest id hash).  The texts are cut into pieces of ``PIECE`` words that are
shuffled and joined, so the training sequences switch language and the
transition weights are learned from such changes.

Long texts: forward and backward values need the product of one L x L matrix
for each word.  The words of a batch are cut into blocks of ``BLOCK``; block
products are taken for all blocks at once, then carried from block to block,
then spread inside the blocks, so a text of any length takes few numpy steps.

Defined results: ``und`` with score 0 where a text is null or has no letter, or
where no labelled row exists; null ids and repeated rows are kept; rows with a
null language are not learned from; an empty table gives no rows.  Of languages with equal
marginals the first by name is predicted; texts of any length are taken whole; other columns are not read, so their
names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from attrition.llm.labelled import one_text
from attrition.llm.textbatch import Texts, chunks, doc_of, hash_prefix, mix64, per_doc, span_hashes, words

BITS = 17
DIM = 1 << BITS
FIT_EACH = 50  # documents of each language that come first
FIT_BYTES = 1 << 17
FIT_DOCS = 1_500
PIECE = 12  # words of one document in a row in a training sequence
SEQUENCE = 24
STEPS = 30
RATE = 0.1
L2 = 1e-4
BLOCK = 32

UNKNOWN = "und"
_SHIFT = np.uint64(64 - BITS)

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


def has_letter(t: Texts, ws: np.ndarray, we: np.ndarray) -> np.ndarray:
    """Words with a Unicode letter (exact: non-ASCII words are looked at as text)."""
    if not len(ws):
        return np.zeros(0, dtype=bool)
    run = np.concatenate([[0], np.cumsum(_LETTER[t.data])])
    found = run[we] > run[ws]
    high = np.concatenate([[0], np.cumsum(t.data >= 0x80)])
    for i in np.flatnonzero(~found & (high[we] > high[ws])):
        found[i] = any(c.isalpha() for c in t.data[ws[i] : we[i]].tobytes().decode("utf-8", "replace"))
    return found


def word_features(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashed feature cells of each distinct word: (cells, bounds), all words in one flat array."""
    prefix = hash_prefix(data)
    n = len(s)
    length = e - s
    cells, owner = [], []

    def add(h: np.ndarray, which: np.ndarray, kind: int) -> None:
        with np.errstate(over="ignore"):
            cells.append((mix64(h + np.uint64(kind) * np.uint64(0x9E3779B97F4A7C15)) >> _SHIFT).astype(np.int32))
        owner.append(which)

    every = np.arange(n)
    add(span_hashes(prefix, s, e), every, 1)
    for k in (1, 2, 3, 4):
        w = every[length > k]
        add(span_hashes(prefix, s[w], s[w] + k), w, 10 + k)
        add(span_hashes(prefix, e[w] - k, e[w]), w, 20 + k)
    for k in (2, 3):
        count = np.maximum(length - k + 1, 0)
        w = np.repeat(every, count)
        at = s[w] + np.arange(len(w)) - np.repeat(np.cumsum(count) - count, count)
        add(span_hashes(prefix, at, at + k), w, 30 + k)
    shape = np.minimum(length, 15).astype(np.uint64) * np.uint64(2) + (data[s] >= 0x80)
    add(mix64(shape + np.uint64(1)), every, 40)
    cells, owner = np.concatenate(cells), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    return cells[order], np.searchsorted(owner[order], np.arange(n + 1))


def emissions(weights: np.ndarray, cells: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the feature weights of each word (every word has features)."""
    if len(bounds) < 2:
        return np.zeros((0, weights.shape[1]))
    return np.add.reduceat(weights[cells], bounds[:-1], axis=0).astype(np.float64)


def _norm(x: np.ndarray, axes: int | tuple[int, ...] = -1) -> np.ndarray:
    return x / x.sum(axis=axes, keepdims=True)


@dataclass
class Crf:
    labels: list[str]
    weights: np.ndarray  # (DIM, labels) float32
    start: np.ndarray
    trans: np.ndarray

    def marginals(self, emit: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Marginal of each label at each word; ``bounds`` are the words before each document."""
        n, k = emit.shape
        if not n:
            return emit
        a, start = np.exp(self.trans), np.exp(self.start)
        count = np.diff(bounds)
        blocks = -(-count // BLOCK)
        first_block = np.cumsum(blocks) - blocks
        doc = doc_of(bounds)
        place = np.arange(n) - bounds[:-1][doc]
        b, slot = first_block[doc] + place // BLOCK, place % BLOCK
        total = int(blocks.sum())
        psi = np.ones((total, BLOCK, k))
        psi[b, slot] = np.exp(emit - emit.max(axis=1, keepdims=True))
        valid = np.zeros((total, BLOCK), dtype=bool)
        valid[b, slot] = True
        ordinal = np.arange(total) - np.repeat(first_block, blocks)
        opens = ordinal == 0  # the first block of a document
        last = ordinal == np.repeat(blocks, blocks) - 1

        prod = np.broadcast_to(np.eye(k), (total, k, k)).copy()
        for t in range(BLOCK):
            step = (prod @ a) * psi[:, t, None, :]
            if t == 0:
                step[opens] = (start * psi[opens, 0])[:, None, :]
            prod = np.where(valid[:, t, None, None], step / step.sum(axis=(1, 2), keepdims=True), prod)
        before, after = np.full((total, k), 1.0 / k), np.ones((total, k))
        by_ordinal = np.argsort(ordinal, kind="stable")
        cut = np.searchsorted(ordinal[by_ordinal], np.arange(ordinal.max() + 2))
        for o in range(1, len(cut) - 1):
            at = by_ordinal[cut[o] : cut[o + 1]]
            before[at] = _norm(np.einsum("ni,nij->nj", before[at - 1], prod[at - 1]))
        for o in range(len(cut) - 2, 0, -1):
            at = by_ordinal[cut[o] : cut[o + 1]]
            after[at - 1] = _norm(np.einsum("nij,nj->ni", prod[at], after[at]))
        after[last] = 1.0
        alpha, beta = np.empty_like(psi), np.empty_like(psi)
        v = before
        for t in range(BLOCK):
            step = (v @ a) * psi[:, t]
            if t == 0:
                step[opens] = start * psi[opens, 0]
            v = np.where(valid[:, t, None], _norm(step), v)
            alpha[:, t] = v
        v = after
        for t in range(BLOCK - 1, -1, -1):
            beta[:, t] = v
            v = np.where(valid[:, t, None], _norm((psi[:, t] * v) @ a.T), v)
        return _norm(alpha[b, slot] * beta[b, slot])

    def word_labels(self, t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Word starts, ends, document bounds and label marginals of a chunk of texts."""
        low = t.lower()
        ws, we, bounds = words(low)
        h = span_hashes(hash_prefix(low.data), ws, we)
        _, at, back = np.unique(h, return_index=True, return_inverse=True)
        emit = emissions(self.weights, *word_features(low.data, ws[at], we[at]))[back]
        return ws, we, bounds, self.marginals(emit, bounds)

    def predict(self, t: Texts) -> tuple[list[str], np.ndarray]:
        """Language and score of each document of a chunk."""
        if not self.labels:
            return [UNKNOWN] * len(t), np.zeros(len(t))
        ws, we, bounds, gamma = self.word_labels(t)
        letters = has_letter(t, ws, we)
        n = per_doc(letters, bounds[:-1], bounds[1:])
        mean = np.stack([per_doc(g * letters, bounds[:-1], bounds[1:]) for g in gamma.T], axis=1) / np.maximum(n, 1)[:, None]
        best = mean.argmax(axis=1)
        names = [self.labels[i] if k else UNKNOWN for i, k in zip(best, n, strict=True)]
        return names, np.where(n > 0, np.clip(mean[np.arange(len(best)), best], 0, 1), 0.0)


def train(texts: list[str], langs: list[str]) -> Crf:
    """Maximum conditional likelihood on the given documents (already bounded and ordered)."""
    labels = sorted(set(langs))
    k = len(labels)
    if not k:
        return Crf([], np.zeros((DIM, 0), np.float32), np.zeros(0), np.zeros((0, 0)))
    data = "\n".join(texts).encode("utf-8", "replace")
    size = np.array([len(x.encode("utf-8", "replace")) for x in texts])
    starts = np.cumsum(size + 1) - size - 1
    t = Texts(np.frombuffer(data, dtype=np.uint8), starts, starts + size, 0).lower()
    ws, we, bounds = words(t)
    if not len(ws):
        return Crf([], np.zeros((DIM, 0), np.float32), np.zeros(0), np.zeros((0, 0)))
    _, at, word = np.unique(span_hashes(hash_prefix(t.data), ws, we), return_index=True, return_inverse=True)
    cells, cell_bounds = word_features(t.data, ws[at], we[at])
    owner = doc_of(cell_bounds)
    doc = doc_of(bounds)
    gold = np.searchsorted(labels, langs)[doc]
    # pieces of PIECE words, shuffled and joined, cut into sequences (the last is filled from the front)
    place = np.arange(len(word)) - bounds[:-1][doc]
    piece = np.cumsum((place % PIECE) == 0) - 1
    shuffled = np.random.default_rng(7).permutation(piece[-1] + 1)
    order = np.lexsort((np.arange(len(word)), shuffled[piece]))
    rows = -(-len(order) // SEQUENCE)
    order = np.resize(order, rows * SEQUENCE).reshape(rows, SEQUENCE)
    x, y = word[order], gold[order]
    one = np.eye(k)
    w, start, trans = np.zeros((DIM, k)), np.zeros(k), np.zeros((k, k))
    params = [w, start, trans]
    m1, m2 = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, STEPS + 1):
        emit = emissions(w, cells, cell_bounds)
        emit -= emit.max(axis=1, keepdims=True)
        psi, a = np.exp(emit), np.exp(trans)
        alpha = np.empty((SEQUENCE, rows, k))
        beta = np.ones((SEQUENCE, rows, k))
        alpha[0] = _norm(np.exp(start) * psi[x[:, 0]])
        for i in range(1, SEQUENCE):
            alpha[i] = _norm((alpha[i - 1] @ a) * psi[x[:, i]])
        for i in range(SEQUENCE - 2, -1, -1):
            beta[i] = _norm((psi[x[:, i + 1]] * beta[i + 1]) @ a.T)
        g_word, g_trans = np.zeros((len(at), k)), np.zeros((k, k))
        for i in range(SEQUENCE):
            gamma = _norm(alpha[i] * beta[i]) - one[y[:, i]]
            if i == 0:
                g_start = gamma.sum(axis=0)
            for c in range(k):
                g_word[:, c] += np.bincount(x[:, i], gamma[:, c], len(at))
            if i:
                right = psi[x[:, i]] * beta[i]
                z = ((alpha[i - 1] @ a) * right).sum(axis=1, keepdims=True)
                g_trans += a * ((alpha[i - 1] / z).T @ right)
                g_trans -= np.bincount(y[:, i - 1] * k + y[:, i], minlength=k * k).reshape(k, k)
        g_w = np.stack([np.bincount(cells, g_word[owner, c], DIM) for c in range(k)], axis=1)
        for p, g, a1, a2 in zip(params, (g_w, g_start, g_trans), m1, m2, strict=True):
            g = g / len(word) + L2 * p
            a1 += 0.1 * (g - a1)
            a2 += 0.01 * (g * g - a2)
            p -= RATE * (a1 / (1 - 0.9**step)) / (np.sqrt(a2 / (1 - 0.99**step)) + 1e-8)
    return Crf(labels, w.astype(np.float32), start, trans)


def fit(
    docs: DataFrame,
    where: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rows: int = FIT_DOCS,
) -> Crf:
    """Train on at most ``rows`` documents with a text and a language that meet ``where`` (on ``doc_id``).

    Documents of smallest id hash, of every language ``FIT_EACH`` first (as far as ``rows`` allows), so that
    rare languages are learned, too.  Texts of more than ``FIT_BYTES`` are not fitted on, and of the rows of an id one is
    taken: the driver holds ``rows * FIT_BYTES`` at most.
    """
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    usable = named.where((F.octet_length("text") <= FIT_BYTES) & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    if where is not None:
        usable = usable.where(where)
    ids = usable.groupBy("doc_id").agg(F.min("lang").alias("lang")).withColumn("h", F.xxhash64("doc_id"))
    mine = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))
    ids = ids.withColumn("at", mine).where(F.col("at") <= rows)  # the limit is taken before the shuffle, too
    ids = ids.orderBy(F.when(F.col("at") <= FIT_EACH, F.col("at")).otherwise(FIT_EACH + 1), "h", "doc_id").limit(rows)
    found = one_text(usable.join(F.broadcast(ids.select("doc_id")), "doc_id"), "lang").collect()
    found = sorted((r["doc_id"], r["text"], r["lang"]) for r in found)
    return train([r[1] for r in found], [r[2] for r in found])


def predict(docs: DataFrame, model: Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` of every row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in chunks(batch.column(1)):
                names, score = shared.value.predict(t)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(t.first, len(t)), pa.array(names, pa.string()), pa.array(score, pa.float64())],
                    names=["doc_id", "lang_pred", "score"],
                )

    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return named.mapInArrow(run, "doc_id long, lang_pred string, score double")


def label_spans(docs: DataFrame, model: Crf, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Runs of words of one language: ``doc_id, start_byte, end_byte, lang, n_words, score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in batches:
            for t in chunks(batch.column(1)):
                if not m.labels:
                    continue
                ws, we, bounds, gamma = m.word_labels(t)
                best, doc = gamma.argmax(axis=1), doc_of(bounds)
                head = np.ones(len(ws), dtype=bool)
                head[1:] = (best[1:] != best[:-1]) | (doc[1:] != doc[:-1])
                s = np.flatnonzero(head)
                e = np.append(s[1:], len(ws))
                if not len(s):
                    continue
                base = t.starts[doc[s]]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(t.first + doc[s])),
                        pa.array(ws[s] - base),
                        pa.array(we[e - 1] - base),
                        pa.array([m.labels[i] for i in best[s]], pa.string()),
                        pa.array(e - s),
                        pa.array(np.add.reduceat(gamma.max(axis=1), s) / (e - s)),
                    ],
                    names=["doc_id", "start_byte", "end_byte", "lang", "n_words", "score"],
                )

    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return named.mapInArrow(run, "doc_id long, start_byte long, end_byte long, lang string, n_words long, score double")
