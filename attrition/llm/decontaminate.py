"""Benchmark decontamination: short test items found inside long documents.

Size-partitioned MinHash containment search.  An item is the set of its
``N``-word shingles (ASCII letters lower-cased; an item of fewer words is one
shingle, its whole word sequence, looked for as that many words in a row).
Items fall into partitions by shingle length and set size (powers of two), each with an index of its
own: the sketches of its items, that is their bottom-k MinHash values, all under one 64-bit hash, with one k
for the partition, ``missing + SPARE``, where ``missing`` is the most shingles that a match may lack
at its largest size.  A document that holds at
least ``t`` of an item's shingles lacks at most ``size - ceil(t * size)`` of its sketch, so it holds at
least the rest of it, ``SPARE`` values or more (all but the lacking ones of a smaller set): that is
the item's threshold.  The candidate search loses nothing, however long the
document is, and a document is never sketched itself.  Each candidate is then
verified on the words themselves: the exact share of the item's distinct
shingles that the document holds must reach ``t``.

The test items are the stated query set.  They are taken in blocks of about
``BLOCK_BYTES`` of text; one block is broadcast at a time and the documents are
scanned once for each block, without any shuffle.

Defined results: null and empty texts, and items without a word, match nothing;
repeated rows repeat their matches, repeated items match once; texts of any length are taken whole; a
share equal to the threshold matches; null ids are kept; empty tables give no
matches; other columns are not read by :func:`matches` and pass unchanged
through :func:`drop_contaminated`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm.docstats import Parsed, parse
from attrition.llm.textbatch import LOWER, Texts, chunks, shingles

N = 5
CONTAINMENT = 0.8
BLOCK_BYTES = 4 << 20  # about 26 times that in a worker
SPARE = 3  # sketch values that a match holds at least

SCHEMA = "doc_id long, item_id long, n_shared long, n_shingles long, containment double"

_LOWER_TABLE = LOWER.tobytes()


def word_shingles(text: bytes, n: int) -> set[tuple[bytes, ...]]:
    """Distinct n-word shingles of a text; fewer words than n give none."""
    w = text.translate(_LOWER_TABLE).split()
    return set(zip(*(w[k:] for k in range(n)), strict=False))


def needed(size: int, t: float) -> int:
    """Fewest shared shingles that reach containment ``t``."""
    return max(1, int(np.ceil(t * size - 1e-9)))


@dataclass
class Partition:
    """Sketches of the items of one shingle length and size class."""

    length: int
    values: np.ndarray  # sorted sketch values
    items: np.ndarray  # the item of each value
    least: np.ndarray  # sketch values that a match of each item holds (by item of the block)

    def candidates(self, h: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """(document, item) rows whose document holds enough of the item's sketch; ``h``: its shingles' hashes."""
        lo = np.searchsorted(self.values, h, "left")
        hit = np.flatnonzero(self.values[np.minimum(lo, len(self.values) - 1)] == h)
        if not len(hit):
            return np.zeros((0, 2), np.int64)
        once = np.unique(np.stack([doc[hit], lo[hit]], axis=1), axis=0)  # a repeated shingle counts once
        doc, lo = once[:, 0], once[:, 1]
        count = np.searchsorted(self.values, self.values[lo], "right") - lo
        at = np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        pairs, shared = np.unique(np.stack([np.repeat(doc, count), self.items[at]], axis=1), axis=0, return_counts=True)
        return pairs[shared >= self.least[pairs[:, 1]]]


@dataclass
class ItemIndex:
    """The partitions of a block of items, and the items' exact shingle sets."""

    ids: list[int] = field(default_factory=list)
    sets: list[set] = field(default_factory=list)
    length: list[int] = field(default_factory=list)
    partitions: list[Partition] = field(default_factory=list)
    threshold: float = CONTAINMENT

    def match(self, p: Parsed) -> Iterator[tuple[int, int, int]]:
        """(document of the chunk, item, shared shingles) of every verified match."""
        found, hashes = [], {}
        for part in self.partitions:
            if part.length not in hashes:
                hashes[part.length] = shingles(p.wh, p.bounds, part.length)
            found.append(part.candidates(*hashes[part.length]))
        pairs = sorted({(int(d), int(i)) for part in found for d, i in part})
        last, sets = -1, {}
        for d, i in pairs:
            if d != last:
                last, sets = d, {}
            n = self.length[i]
            if n not in sets:
                sets[n] = word_shingles(p.t.doc(d), n)
            shared = len(self.sets[i] & sets[n])
            if shared >= needed(len(self.sets[i]), self.threshold):
                yield d, i, shared


def build_index(rows: list[tuple[int, str | None]], threshold: float = CONTAINMENT) -> ItemIndex:
    """Index of a bounded block of items (item_id, text)."""
    index = ItemIndex(threshold=threshold)
    groups: dict[tuple[int, int], list[tuple[int, np.ndarray]]] = {}
    for item_id, text in rows:
        data = (text or "").encode("utf-8", "replace")
        n_words = len(data.split())
        if not n_words:
            continue
        n = min(N, n_words)
        raw = np.frombuffer(data, dtype=np.uint8)
        p = parse(Texts(raw, np.array([0]), np.array([len(raw)]), 0).lower())
        h = np.unique(shingles(p.wh, p.bounds, n)[0])
        groups.setdefault((n, len(h).bit_length()), []).append((len(index.ids), h))
        index.ids.append(item_id)
        index.sets.append(word_shingles(data, n))
        index.length.append(n)
    for (n, bits), members in groups.items():
        largest = (1 << bits) - 1
        k = largest - needed(largest, threshold) + SPARE
        sketches = [h[:k] for _, h in members]
        least = np.zeros(len(index.ids), dtype=np.int64)
        for (i, h), low in zip(members, sketches, strict=True):
            least[i] = max(len(low) - (len(h) - needed(len(h), threshold)), 1)
        flat = np.concatenate(sketches)
        order = np.argsort(flat, kind="stable")
        owners = np.repeat([i for i, _ in members], [len(x) for x in sketches])[order]
        index.partitions.append(Partition(n, flat[order], owners, least))
    return index


def item_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> Iterator[list[tuple[int, str | None]]]:
    """The items in blocks of about ``BLOCK_BYTES`` of text, split by a hash of the row."""
    named = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).distinct()
    total = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // BLOCK_BYTES) or 1
    for b in range(blocks):
        part = named.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b)
        yield sorted(((r[0], r[1]) for r in part.collect()), key=str)


def matches(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = CONTAINMENT,
) -> DataFrame:
    """One row for each document row and item that it contains."""
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    spark, out = docs.sparkSession, None
    for rows in item_blocks(items):
        part = _block_matches(named, spark.sparkContext.broadcast(build_index(rows, threshold)))
        out = part if out is None else out.unionByName(part)
    return out


def _block_matches(named: DataFrame, shared) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for t in chunks(batch.column(1)):
                found = list(index.match(parse(t.lower())))
                if found:
                    d, i, n = (np.array(x, dtype=np.int64) for x in zip(*found, strict=True))
                    size = np.array([len(index.sets[k]) for k in i], dtype=np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(t.first + d)),
                            pa.array([index.ids[k] for k in i], pa.int64()),
                            pa.array(n),
                            pa.array(size),
                            pa.array(n / size),
                        ],
                        names=["doc_id", "item_id", "n_shared", "n_shingles", "containment"],
                    )

    return named.mapInArrow(run, SCHEMA)


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", threshold: float = CONTAINMENT) -> DataFrame:
    """The rows of ``docs`` that contain no item, with all their columns."""
    for rows in item_blocks(items):
        shared = docs.sparkSession.sparkContext.broadcast(build_index(rows, threshold))
        docs = _drop_block(docs, shared, docs.columns.index(text_col))
    return docs


def _drop_block(docs: DataFrame, shared, at: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            for t in chunks(batch.column(at)):
                for d, _, _ in shared.value.match(parse(t.lower())):
                    keep[t.first + d] = False
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
