"""Ranked lexical search with per-term geometric blocking.

Terms are the maximal runs of ASCII digits, ASCII letters and non-ASCII characters,
A-Z lower-cased.  A document's score for an item is the sum over the item's terms
(repeats included) of ``w * impact``, with the term's weight w from its document
frequency and the impact from its occurrences and the document's length; both are
whole numbers, so scores are exact and the same on any machine.

1. *Statistics.*  One pass counts documents, terms and the document frequencies
   of the terms that items ask for; tasks send sums only.
2. *Shards.*  A task cuts its documents into shards of at most ``CELLS`` impacts.
   In a shard every term has a posting list.  Lists of more than ``BLOCK``
   documents are clustered: representatives spread over the list, every document
   joins the one it is most similar to (inner product of weighted impacts, from one
   similarity matrix of the shard).  Each cluster is a block, and its summary is the
   largest impact of every term among its documents.
3. *Search.*  The bound of a block for an item is the score of its summary: no
   document of the block scores higher.  Blocks of an item's terms are visited
   from the highest bound on; a block is left out only if its bound is below the
   tenth best score so far (a tie may win by its id) or not above 0.  The best are
   carried from shard to shard of a task, and each task sends its ten best of each
   item, from which Spark takes the final ten.

Every document with a term of the item lies in a block of each such term, so none
that belongs to the result is left out.  Items are handled in blocks of about
``PAIRS`` (item, term) pairs; their number does not change with the documents.

Defined results: a null or empty text has no term; a document without terms does
not count in N.  Items without terms, or without a document that scores above 0, give
no rows.  Equal scores rank by ascending document id (a null id first).
Repeated document rows are documents of their own; repeated rows of an item count
once, several texts under one item id make up one item.  Texts are taken whole,
whatever their length; other columns are not read, so their names cannot clash.  Empty
tables give no rows.  Terms are matched by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from attrition.llm.textbatch import Texts, chunks, hash_prefix, span_hashes

TOP = 10
PAIRS = 10_000
CELLS = 2_000_000
BLOCK = 64
VISIT = 4  # blocks looked at before the threshold is read again

# Fixed values of the ranking.
TERM_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LENGTH_PERCENT = 75

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_TERM_BYTE = np.zeros(256, dtype=bool)
_TERM_BYTE[0x80:] = True
for _first, _last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A)):
    _TERM_BYTE[_first : _last + 1] = True


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``item_id, term, repeats`` of every item."""
    rows = items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")).distinct()
    lower = F.translate(F.coalesce("text", F.lit("")), _UPPER, _LOWER)
    rows = rows.select("item_id", F.explode(F.regexp_extract_all(lower, F.lit(TERM_PATTERN), F.lit(0))).alias("term"))
    return rows.groupBy("item_id", "term").agg(F.count("*").alias("repeats"))


def term_spans(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and document of every term of a chunk (lower-cased), and the terms of each document."""
    inside = _TERM_BYTE[t.data]
    full = t.ends > t.starts
    before = np.empty(len(inside), dtype=bool)
    before[1:] = inside[:-1]
    before[t.starts[full]] = False
    starts = np.flatnonzero(inside & ~before)
    after = before
    after[:-1] = inside[1:]
    after[t.ends[full] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    count = np.diff(np.append(np.searchsorted(starts, t.starts), len(starts)))
    return span_hashes(hash_prefix(t.data), starts, ends), np.repeat(np.arange(len(t)), count), count


@dataclass
class Vocabulary:
    """The distinct terms of a block of items, by hash."""

    hashes: np.ndarray  # sorted

    @classmethod
    def of(cls, terms: list[str]) -> tuple[Vocabulary, np.ndarray]:
        """The vocabulary and the place of each given term in it."""
        raw = [t.encode() for t in terms]
        ends = np.cumsum([len(r) for r in raw], dtype=np.int64)
        prefix = hash_prefix(np.frombuffer(b"".join(raw), dtype=np.uint8))
        found, place = np.unique(span_hashes(prefix, np.append(0, ends[:-1]), ends), return_inverse=True)
        return cls(found), place

    def __len__(self) -> int:
        return len(self.hashes)

    def counts(self, t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Document, term and occurrences of every vocabulary term in a chunk, and all terms of each document."""
        h, doc, total = term_spans(t.lower())
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        known = self.hashes[at] == h
        key, tf = np.unique(doc[known] * len(self.hashes) + at[known], return_counts=True)
        return key // len(self.hashes), key % len(self.hashes), tf, total


@dataclass
class Corpus:
    """Statistics of all documents."""

    n_docs: int
    n_terms: int
    df: np.ndarray

    def weights(self) -> np.ndarray:
        return np.array([math.floor(1000 * math.log((2 * self.n_docs + 2) / (2 * int(d) + 1))) for d in self.df], dtype=np.int64)

    def impacts(self, tf: np.ndarray, length: np.ndarray) -> np.ndarray:
        """``(10^9 tf) div (1000 tf + 8 m)`` of occurrences in documents of these lengths."""
        if LENGTH_PERCENT * int(length.max(initial=0)) * self.n_docs >= 1 << 63:
            length = length.astype(object)
        m = (100 - LENGTH_PERCENT + LENGTH_PERCENT * length * self.n_docs // self.n_terms).astype(np.int64)
        return 1_000_000_000 * tf // (1000 * tf + 8 * m)


def corpus(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text") -> Corpus:
    """Count documents with a term, their terms, and the documents of each vocabulary term."""
    width = len(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width + 2, dtype=np.int64)
        for batch in batches:
            for t in chunks(batch.column(0)):
                _, term, _, length = vocabulary.counts(t)
                total[:width] += np.bincount(term, minlength=width)
                total[width] += np.count_nonzero(length)
                total[width + 1] += length.sum()
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["k", "n"])

    sums = docs.select(F.col(text_col)).mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))
    total = np.zeros(width + 2, dtype=np.int64)
    for row in sums.collect():  # one row for each vocabulary term
        total[row["k"]] = row["n"]
    return Corpus(int(total[width]), int(total[width + 1]), total[:width])


@dataclass
class Items:
    """A block of items as rows of (term, weight) pairs."""

    ids: list
    terms: list[np.ndarray]
    weights: list[np.ndarray]


@dataclass
class Best:
    """The best documents of one item so far, highest first, ties by id (nulls first)."""

    top: int
    scores: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    named: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))

    def least(self) -> int:
        """A score that a document must reach."""
        return max(int(self.scores[-1]) if len(self.scores) == self.top else 1, 1)

    def add(self, scores: np.ndarray, ids: np.ndarray, named: np.ndarray) -> None:
        keep = scores >= self.least()
        if not keep.any():
            return
        s, i, d = (np.concatenate(p) for p in ((self.scores, scores[keep]), (self.ids, ids[keep]), (self.named, named[keep])))
        order = np.lexsort((i, d, -s))[: self.top]
        self.scores, self.ids, self.named = s[order], i[order], d[order]


class Shard:
    """Blocked posting lists of some documents: ``impact`` has a row for each document, a column for each term."""

    def __init__(self, ids: np.ndarray, named: np.ndarray, impact: np.ndarray, weights: np.ndarray, block: int = BLOCK):
        self.ids, self.named, self.impact, self.block = ids, named, impact, block
        shape = (impact * weights).astype(np.float32)
        self.alike = shape @ shape.T
        self.blocks: dict[int, list[np.ndarray]] = {}
        self.summaries: dict[int, np.ndarray] = {}
        self.visited = self.passed = 0

    def block_list(self, term: int) -> tuple[list[np.ndarray], np.ndarray]:
        """The blocks of a term's posting list and their summaries, clustered when the term is first asked for."""
        if term not in self.blocks:
            rows = np.flatnonzero(self.impact[:, term])
            parts = [rows] if len(rows) else []
            if len(rows) > self.block:
                k = -(-len(rows) // self.block)
                chosen = rows[np.arange(k) * len(rows) // k]
                cluster = self.alike[np.ix_(rows, chosen)].argmax(axis=1)
                order = np.argsort(cluster, kind="stable")
                cuts = np.flatnonzero(np.diff(cluster[order])) + 1
                parts = np.split(rows[order], cuts)
            self.blocks[term] = parts
            width = self.impact.shape[1]
            self.summaries[term] = np.array([self.impact[p].max(axis=0) for p in parts], dtype=np.int32).reshape(-1, width)
        return self.blocks[term], self.summaries[term]

    def search(self, terms: np.ndarray, weights: np.ndarray, best: Best) -> None:
        """Bring ``best`` up to date with the documents of this shard."""
        blocks: list[np.ndarray] = []
        bounds: list[np.ndarray] = []
        for t in terms:
            members, summary = self.block_list(int(t))
            blocks += members
            bounds.append(summary[:, terms].astype(np.int64) @ weights)
        if not blocks:
            return
        bound = np.concatenate(bounds)
        order = np.argsort(-bound, kind="stable")
        seen = np.zeros(len(self.ids), dtype=bool)
        for k in range(0, len(order), VISIT):
            near = [b for b in order[k : k + VISIT] if bound[b] >= best.least()]
            if not near:
                self.passed += len(order) - k
                return
            self.visited += len(near)
            rows = np.unique(np.concatenate([blocks[b] for b in near]))
            rows = rows[~seen[rows]]
            seen[rows] = True
            scores = self.impact[np.ix_(rows, terms)].astype(np.int64) @ weights
            best.add(scores, self.ids[rows], self.named[rows])


def shards(
    batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, stats: Corpus, cells: int = CELLS, block: int = BLOCK
) -> Iterator[Shard]:
    """Cut documents (id, text) into shards; those without a vocabulary term are left out."""
    width = len(vocabulary)
    most = max(cells // width, 1)
    weights = np.maximum(stats.weights(), 0)
    ids, named, rows = [], [], []
    held = 0

    def flush() -> Shard:
        return Shard(np.concatenate(ids), np.concatenate(named), np.concatenate(rows), weights, block)

    for batch in batches:
        batch_ids = batch.column(0)
        known = np.asarray(batch_ids.is_valid())
        values = batch_ids.fill_null(0).to_numpy(zero_copy_only=False)
        for t in chunks(batch.column(1)):
            doc, term, tf, length = vocabulary.counts(t)
            impact = stats.impacts(tf, length[doc])
            cuts = np.arange(0, len(t), most)
            for a in cuts:
                lo, hi = np.searchsorted(doc, [a, a + most])
                found, at = np.unique(doc[lo:hi], return_inverse=True)
                if not len(found):
                    continue
                dense = np.zeros((len(found), width), dtype=np.int32)
                dense[at, term[lo:hi]] = impact[lo:hi]
                if held + len(found) > most and held:
                    yield flush()
                    ids, named, rows, held = [], [], [], 0
                ids.append(values[t.first + found])
                named.append(known[t.first + found])
                rows.append(dense)
                held += len(found)
    if held:
        yield flush()


def _blocks(terms: DataFrame) -> Iterator[Column]:
    """Conditions that cut the item terms into blocks of whole items, about ``PAIRS`` rows each."""
    n = -(-terms.count() // PAIRS)
    for k in range(n):
        yield F.pmod(F.xxhash64("item_id"), F.lit(n)) == k


def _load(rows: list, stats: Corpus, place: np.ndarray) -> Items:
    of_item: dict = {}
    weights = stats.weights()
    for row, p in zip(rows, place, strict=True):
        of_item.setdefault(row["item_id"], []).append((int(p), int(row["repeats"]) * int(weights[p])))
    items = Items([], [], [])
    for item, pairs in of_item.items():
        pairs = [(p, w) for p, w in sorted(pairs) if w > 0 and stats.df[p]]
        items.ids.append(item)
        items.terms.append(np.array([p for p, _ in pairs], dtype=np.int64))
        items.weights.append(np.array([w for _, w in pairs], dtype=np.int64))
    return items


def _search_block(docs: DataFrame, terms: DataFrame, top: int, cells: int, block: int) -> DataFrame | None:
    rows = terms.collect()  # about PAIRS rows
    if not rows:
        return None
    vocabulary, place = Vocabulary.of([r["term"] for r in rows])
    stats = corpus(docs, vocabulary)
    items = _load(rows, stats, place)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(top) for _ in items.ids]
        for shard in shards(batches, vocabulary, stats, cells, block):
            for k, found in enumerate(best):
                shard.search(items.terms[k], items.weights[k], found)
        for k, found in enumerate(best):
            if len(found.ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k] * len(found.ids), pa.int32()), pa.array(found.ids, pa.int64(), mask=~found.named), pa.array(found.scores)],
                    names=["item", "doc_id", "score"],
                )

    found = docs.mapInArrow(run, "item int, doc_id long, score long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    names = docs.sparkSession.createDataFrame(list(enumerate(items.ids)), f"item int, item_id {terms.schema['item_id'].dataType.simpleString()}")
    return ranked.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def search(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    cells: int = CELLS,
    block: int = BLOCK,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` best documents of every item with a score above 0."""
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    terms = item_terms(items, item_id_col, item_text_col)
    found = [b for b in (_search_block(named, terms.where(part), top, cells, block) for part in _blocks(terms)) if b is not None]
    if not found:
        ident = terms.schema["item_id"].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"item_id {ident}, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, found)
