"""Language-model scoring of whole texts.

A text is the sequence of its tokens: its words (ASCII letters lower-cased) and
one end.  Two scores are given for each text.

*Base score*: sum over the tokens of ``log10((c + 0.5) / (N + 0.5 (V + 1)))``
with the token's count c, all tokens N and distinct tokens V of the training
rows.  Exact for every token, in two tiers: counts of the ``TIER_WORDS``
most frequent words of all texts (by exact counts) are pre-summed by task and
broadcast, so any other word has at most 1/``TIER_WORDS`` of all words; those meet their counts in the buckets of the cells below,
or in a join (one row for each word, word before and text) where the word before is not in the tier either.

*Model score*: a hierarchical Pitman-Yor model (:mod:`pitman_yor`) in three
levels.  A word's restaurant is that of the word before it (or of the end), for
every word of the training texts; all pairs of neighbouring words are its cells,
so the model grows with the corpus.  Cells are a table in ``lm-seated``, dealt
out in buckets of about ``BUCKET_BYTES`` of text by pair, or by the word before,
else the word, where that is not in the tier; no context is in one task unless it is rare.
A row holds the cells of a bucket, sorted and as compressed columns (:func:`shut`), and so do
the rows that bring the texts' tokens to them; shuffle files go after each write.  The
probabilities come to the texts' tokens by a join of the buckets; only cells with
1/``HOT_CELLS`` of all tokens (so at most that many) are broadcast.

The parent of all of them is a model over symbols: a symbol is the end, one of
the ``MODEL_WORDS`` most frequent words of all training texts (by exact counts),
or the class of any other word (a hash of its last two bytes).  A symbol's
restaurant is that of the symbol before it, for every symbol; all share the root.
The alphabet bounds this parent alone.  Its Gibbs sampler runs over all contexts, dealt out in
``SHARDS``, and all chains at once, a Spark job for each sweep.  Sampling starts with the model of all pair counts;
the tables of word cells are drawn given it and a table for each other cell of the
restaurant (``c`` customers, ``t`` tables), then
the symbols are sampled again with those tables as their customers.  A
word's probability is linear in the tables, so their conditional mean stands for the
average over draws of that level.  A draw depends on its cell alone (a hash of the pair),
so the scores do not depend on the partitions.

Within a class a word is drawn from a Pitman-Yor restaurant of its own over all
training tokens: ``(c - d) / (theta + C)`` for a word with training count c, and
``(theta + d V) / (theta + C)`` for all unknown words together, with the class's
C tokens and V distinct words.  So the probabilities of all known words and
"unknown" sum to one after any context, as those of the base score do.

Defined results: null and empty texts have the end as their only token; null
ids and repeated rows are kept; without training rows every count is 0 and the
model is uniform; an empty table gives no rows; other columns are not read.  Texts of any
length are taken whole; words of equal frequency rank by their hash.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.llm import pitman_yor as py
from attrition.llm.common import materialize, shuffle_partitions
from attrition.llm.docstats import Parsed, parse
from attrition.llm.textbatch import chunks, doc_of, mix64, per_doc

TIER_WORDS = 131_072
MODEL_WORDS = 2_048
CLASSES = 512
SYMBOLS = 1 + CLASSES + MODEL_WORDS
OPEN = float("inf")  # a context of symbols is opened if it holds 1/OPEN of the customers: every one is
SHARDS = 64  # of the contexts of symbols, while they are sampled
HOLD = 2_000_000  # entries of a task's tables before they are handed on
BUCKET_BYTES = 1 << 22  # text for each bucket of cells
HOT_CELLS = 1 << 16
PACK = 1 << 19  # tokens that a task holds before they are handed on
PLACE_BITS = np.uint64(18)  # of a place in the tier, or the end's, inside a key
UNIT = 1 << 24  # a token's log10 probability is summed in whole 1/UNIT, so in any order alike
TOP_BITS = 18  # of a hash, by which the tier is searched
FREE_SHUFFLE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

END = 0  # symbols: the end, then CLASSES classes, then the model's words


def stored(df: DataFrame, name: str) -> DataFrame:
    """``materialize``, after which the shuffle files of ``df`` go."""
    conf = df.sparkSession.conf
    before = conf.get(FREE_SHUFFLE)
    conf.set(FREE_SHUFFLE, "true")
    try:
        return materialize(df, name)
    finally:
        conf.set(FREE_SHUFFLE, before)


def word_classes(p: Parsed) -> np.ndarray:
    """Class of each word: a hash of its last two bytes."""
    last = p.t.data[p.we - 1].astype(np.uint64)
    before = np.where(p.we - p.ws > 1, p.t.data[p.we - 2], 0).astype(np.uint64)
    return (mix64(before * np.uint64(256) + last + np.uint64(1)) % np.uint64(CLASSES)).astype(np.int64)


@dataclass
class Tier:
    """Frequent words: sorted hashes, the symbol of those that are the model's own words (else -1), classes."""

    words: np.ndarray
    symbol: np.ndarray
    classes: np.ndarray

    def __post_init__(self):
        first = np.arange(1 << TOP_BITS, dtype=np.uint64) << np.uint64(64 - TOP_BITS)
        self.starts = np.append(np.searchsorted(self.words, first), len(self.words))  # of the words by their first bits

    def place(self, h: np.ndarray) -> np.ndarray:
        """Place of each hash, -1 where it is not in the tier."""
        top = (h >> np.uint64(64 - TOP_BITS)).astype(np.int64)
        at, end, out = self.starts[top], self.starts[top + 1], np.full(len(h), -1)
        left = np.flatnonzero(at < end)
        while len(left):  # words of the same first bits, about one
            hit = self.words[at[left]] == h[left]
            out[left[hit]] = at[left[hit]]
            left = left[~hit]
            at[left] += 1
            left = left[at[left] < end[left]]
        return out

    def by_place(self) -> tuple[np.ndarray, np.ndarray]:
        """Hash and symbol at each place; the end has the last."""
        symbols = np.where(self.symbol >= 0, self.symbol, 1 + self.classes)
        return np.append(self.words, np.uint64(0)), np.append(symbols, END).astype(np.uint64)

    def symbols(self, p: Parsed, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbol of each word, and its class where it is told apart within one (else -1)."""
        own = np.where(place >= 0, self.symbol[place], -1) if len(self.words) else place
        classes = np.where(own >= 0, -1, word_classes(p))
        return np.where(own >= 0, own, 1 + classes), classes


def pairs(p: Parsed, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed (symbol before, symbol) of all tokens of a chunk, and the bounds of each document in them."""
    bounds = p.bounds + np.arange(len(p.bounds))
    stream = np.full(int(bounds[-1]), END, dtype=np.uint64)
    stream[np.arange(len(symbols)) + doc_of(p.bounds)] = symbols
    before = np.full(len(stream), END, dtype=np.uint64)
    before[1:] = stream[:-1]
    return before << np.uint64(py.BITS) | stream, bounds  # a text starts after an end


def grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the keys, each key once, and where each begins in that order."""
    order = np.argsort(keys)
    k = keys[order]
    start = np.flatnonzero(np.append(True, k[1:] != k[:-1])) if len(k) else np.zeros(0, np.int64)
    return order, k[start], start


class Tally:
    """Counts of uint64 keys, each with a tag that follows from the key, merged now and then."""

    def __init__(self):
        self.keys, self.counts, self.tags, self.held = [], [], [], 0

    def add(self, keys: np.ndarray, tags: np.ndarray | None = None) -> None:
        order, k, start = grouped(keys)
        self.keys.append(k)
        self.counts.append(np.diff(np.append(start, len(keys))))
        self.tags.append(np.zeros(len(k), np.int64) if tags is None else tags[order[start]])
        self.held += len(k)
        if self.held > HOLD:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            self.add(np.zeros(0, np.uint64))
        order, k, start = grouped(np.concatenate(self.keys))
        n = np.concatenate(self.counts)[order]
        n = np.add.reduceat(n, start) if len(n) else n
        self.keys, self.counts, self.tags, self.held = [k], [n], [np.concatenate(self.tags)[order[start]]], len(k)
        return k, n


class Sums:
    """Sums of numbers by uint64 key, handed on when there are many."""

    def __init__(self):
        self.keys, self.values, self.held = [], [], 0

    def add(self, keys: np.ndarray, values: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        order, k, start = grouped(keys)
        self.keys.append(k)
        self.values.append(np.add.reduceat(values[order], start) if len(k) else values)
        self.held += len(k)
        return self.rest() if self.held > HOLD else iter(())

    def rest(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        if self.keys:
            order, k, start = grouped(np.concatenate(self.keys))
            n = np.concatenate(self.values)[order]
            self.keys, self.values, self.held = [], [], 0
            yield k, np.add.reduceat(n, start) if len(k) else n


def _count_batch(kind: int | np.ndarray, keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
    kind = np.broadcast_to(np.int32(kind), len(keys)) if isinstance(kind, int) else kind
    for i in range(0, len(keys), 65536):
        part = slice(i, i + 65536)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind[part].copy()), pa.array(keys[part].view(np.int64)), pa.array(n[part])], names=["kind", "key", "n"]
        )


def count_words(train: DataFrame, others: DataFrame | None = None) -> DataFrame:
    """``word, class, n, total``: exact counts of all words in the training texts and in all texts, summed by task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally()
        for batch in batches:
            for t in chunks(batch.column(0)):
                p = parse(t.lower())
                tally.add(p.wh, word_classes(p))
            if tally.held > HOLD // 2:
                k, n = tally.merge()
                yield from _count_batch(tally.tags[0].astype(np.int32), k, n)
                tally = Tally()
        k, n = tally.merge()
        yield from _count_batch(tally.tags[0].astype(np.int32), k, n)

    rows = train.select("text").mapInArrow(run, "kind int, key long, n long").withColumn("total", F.col("n"))
    if others is not None:
        more = others.select("text").mapInArrow(run, "kind int, key long, total long")
        rows = rows.unionByName(more.withColumn("n", F.lit(0).cast("long")))
    words = rows.groupBy(F.col("key").alias("word")).agg(F.min("kind").alias("class"), F.sum("n").alias("n"), F.sum("total").alias("total"))
    return stored(words, "lm-words")


def frequent_words(words: DataFrame) -> Tier:
    """The most frequent words of all texts, and those of the training texts (ties by hash), which are symbols of their own."""
    own = words.where("n > 0").orderBy(F.desc("n"), "word").limit(MODEL_WORDS).toPandas()
    top = words.orderBy(F.desc("total"), "word").limit(TIER_WORDS).toPandas()
    top = top[~top["word"].isin(own["word"])]
    found = np.concatenate([x["word"].to_numpy(dtype=np.int64) for x in (own, top)]).view(np.uint64)
    classes = np.concatenate([x["class"].to_numpy(dtype=np.int64) for x in (own, top)])
    symbol = np.full(len(found), -1)
    symbol[: len(own)] = 1 + CLASSES + np.arange(len(own))
    order = np.argsort(found)
    return Tier(found[order], symbol[order], classes[order])


def count_training(train: DataFrame, tier: Tier, cells: DataFrame | None = None) -> DataFrame:
    """``kind, key, n``: symbol pairs (0), tier words by place (1), tokens (2), rows (3), cells of each tier word before (4).

    All follow from the cells of the training texts.
    """
    cells = count_cells(train, tier, shuffle_partitions(train.sparkSession)) if cells is None else cells
    end = len(tier.words)

    def found():
        words, own, tokens, symbols = np.zeros(end + 1), np.zeros(end + 1, np.int64), np.zeros(1, np.int64), Sums()
        x = yield
        while x is not None:
            words += np.bincount(x["v"][x["v"] >= 0], x["n"][x["v"] >= 0], end + 1)
            own += np.bincount(x["u"][x["u"] >= 0], minlength=end + 1)
            tokens[0] += x["n"].sum()
            x = yield [b for k, n in symbols.add(x["symbols"], x["n"]) for b in _count_batch(0, k, n)]
        out = [b for k, n in symbols.rest() for b in _count_batch(0, k, n)]
        seen, before = np.flatnonzero(words[:end]), np.flatnonzero(own)
        out += _count_batch(1, seen.astype(np.uint64), words[seen].astype(np.int64))
        out += _count_batch(2, np.zeros(1, np.uint64), tokens)
        out += _count_batch(3, np.zeros(1, np.uint64), words[end:].astype(np.int64))
        yield [*out, *_count_batch(4, before.astype(np.uint64), own[before])]

    parts = each_cells(cells, tier, found, "kind int, key long, n long")
    return stored(parts.groupBy("kind", "key").agg(F.sum("n").alias("n")), "lm-counts")


def opened_cells(counts: DataFrame) -> DataFrame:
    """``level, cell, n``: pair counts at their context; every context is opened, whatever it holds."""
    return counts.where("kind = 0").select(F.lit(py.ORDER - 1).alias("level"), F.col("key").alias("cell"), "n")


SHARD = "shard int, cell binary, n binary, t binary, sum binary, tables binary, root binary"


@dataclass
class Shard:
    """Contexts of one shard: their cells, tables by chain, tables summed over samples, restaurants' tables by sample."""

    number: int
    cells: py.Level
    t: np.ndarray
    sum: np.ndarray
    tables: np.ndarray

    def row(self) -> dict:
        lv, symbol = self.cells, (self.cells.cell & py.suffix_mask(1)).astype(np.int64)
        root = np.stack([np.bincount(symbol, t, SYMBOLS) for t in self.t])
        found = {"cell": steps(lv.cell), "n": lv.direct.astype("i8"), "t": self.t.astype("i4").ravel(), "sum": self.sum.astype("i4")}
        found |= {"tables": self.tables.astype("i4").ravel(), "root": root.astype("i4").ravel()}
        return {"shard": self.number} | {name: squeezed(x) for name, x in found.items()}

    @classmethod
    def of(cls, r: dict) -> Shard:
        cells = contexts_of(np.cumsum(spread(r["cell"], "u8"), dtype=np.uint64), spread(r["n"], "i8"))
        t, tables = spread(r["t"], "i4").reshape(py.CHAINS, -1), spread(r["tables"], "i4").reshape(-1, len(cells.context))
        return cls(r["shard"], cells, t.astype(float), spread(r["sum"], "i4"), tables)


def contexts_of(cell: np.ndarray, n: np.ndarray) -> py.Level:
    return py.build_levels(np.full(len(cell), py.ORDER - 1), cell, n)[-1]


def fit_model(counts: DataFrame) -> py.SymbolModel:
    """Sample the chains of all contexts of symbols, and average them.

    The contexts are dealt out in ``SHARDS``; a sweep is a pass over these and one over the root (``SYMBOLS`` cells, on the driver).
    """
    spark = counts.sparkSession

    def start(table: pa.Table) -> pa.Table:
        lv = contexts_of(table["cell"].to_numpy().view(np.uint64), table["n"].to_numpy())
        ones = np.ones((py.CHAINS, len(lv.cell)))
        row = Shard(table["shard"][0].as_py(), lv, ones, np.zeros(len(lv.cell)), np.zeros((0, len(lv.context)))).row()
        return pa.Table.from_pylist([row], schema=_schema(SHARD))

    def sweep(k: int, p: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for r in batch.to_pylist():
                    x = Shard.of(r)
                    x.t = py.seat_contexts(np.random.default_rng([x.number, k]), x.cells, x.t, p)
                    if k >= py.BURN:
                        x.sum, x.tables = x.sum + x.t.sum(axis=0), np.concatenate([x.tables, py.tables_of(x.cells, x.t)])
                    yield from _rows([x.row()], SHARD)

        return run

    def customers(state: DataFrame) -> np.ndarray:
        c = np.zeros(py.CHAINS * SYMBOLS)
        for r in state.select("root").collect():  # at most SHARDS rows
            c += spread(r["root"], "i4")
        return c.reshape(py.CHAINS, SYMBOLS)

    shard = F.pmod(F.xxhash64(F.shiftright("cell", py.BITS)), F.lit(SHARDS)).cast("int")
    cells = opened_cells(counts).select(shard.alias("shard"), "cell", "n").repartition(shuffle_partitions(spark), "shard")
    state = cells.groupBy("shard").applyInArrow(start, SHARD).persist()
    rng, c = np.random.default_rng(SHARDS), customers(state)
    t, kept = (c > 0).astype(float), []
    p = py.root_probabilities(c, t, SYMBOLS)
    for k in range(py.BURN + py.SAMPLES):
        before, state = state, state.mapInArrow(sweep(k, p), SHARD).persist()
        c = customers(state)
        before.unpersist()
        t = py.seat_root(rng, c, t, SYMBOLS)
        p = py.root_probabilities(c, t, SYMBOLS)
        if k >= py.BURN:
            kept.append(p)
    roots = np.concatenate(kept)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                x = Shard.of(r)
                found = py.context_rows(x.cells, x.sum / len(roots), x.tables, roots).astype(np.float32)
                yield pa.RecordBatch.from_arrays([pa.array(x.cells.context.astype("i4")), pa.array([y.tobytes() for y in found], pa.binary())], names=["context", "p"])

    found = state.mapInArrow(rows, "context int, p binary").orderBy("context").collect()  # at most SYMBOLS rows
    state.unpersist()
    matrix = np.frombuffer(b"".join(r["p"] for r in found), np.float32).reshape(-1, SYMBOLS)
    return py.symbol_model(np.array([r["context"] for r in found], np.int64), matrix, roots.mean(axis=0))


def class_tokens(counts: DataFrame) -> np.ndarray:
    """Training tokens of each class."""
    symbol = F.col("key").bitwiseAND(F.lit((1 << py.BITS) - 1))
    rows = counts.where("kind = 0").groupBy(symbol.alias("symbol")).agg(F.sum("n").alias("n")).where(f"symbol between 1 and {CLASSES}")
    out = np.zeros(CLASSES)
    for r in rows.collect():  # at most CLASSES rows
        out[r["symbol"] - 1] = r["n"]
    return out


def neighbours(p: Parsed, tier: Tier, at: np.ndarray) -> dict[str, np.ndarray]:
    """Of all tokens of a chunk: hash and place of the word and of the word before (the end: 0, last place), symbols, pair."""
    packed, bounds = pairs(p, tier.symbols(p, at)[0])
    to = np.arange(len(at)) + doc_of(p.bounds)
    word, v = np.zeros(len(packed), np.uint64), np.full(len(packed), len(tier.words), np.int32)
    word[to], v[to] = p.wh, at
    before, u = np.zeros(len(packed), np.uint64), np.full(len(packed), len(tier.words), np.int32)
    before[1:], u[1:] = word[:-1], v[:-1]
    return {"pair": mix64(mix64(before + np.uint64(1)) + word), "symbols": packed, "u": u, "v": v, "before": before, "word": word, "row": doc_of(bounds)}


def bucket_of(x: dict[str, np.ndarray], buckets: int) -> np.ndarray:
    """Cells of two frequent words are dealt out by pair, those of an infrequent word before, else of an infrequent word, stay together."""
    key, rare_u, rare_v = x["pair"].copy(), np.flatnonzero(x["u"] < 0), np.flatnonzero(x["v"] < 0)
    key[rare_v] = mix64(x["word"][rare_v])
    key[rare_u] = mix64(x["before"][rare_u])
    return (key % np.uint64(buckets)).astype(np.int32)


def squeezed(x: np.ndarray) -> bytes:
    """An array by the place of its bytes (all first bytes, all second ones, ...), compressed."""
    if not len(x):
        return b""
    planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T
    return len(x).to_bytes(4, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def spread(b: bytes, kind: str) -> np.ndarray:
    """The array that was squeezed."""
    if not b:
        return np.zeros(0, kind)
    n, size = int.from_bytes(b[:4], "little"), np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(memoryview(b)[4:], decompressed_size=n * size, codec="zstd"), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, n).T).view(kind).ravel()


def steps(x: np.ndarray) -> np.ndarray:
    """Differences that ``np.cumsum`` takes back to x."""
    return np.diff(x, prepend=x.dtype.type(0))


def key_of(x: dict[str, np.ndarray], n: int) -> np.ndarray:
    """Both places of the first n pairs as one number."""
    return x["u"][:n].astype(np.uint64) << PLACE_BITS | x["v"][:n].astype(np.uint64)


SHUT = ("size", "key", "place", "far", "class")
SHUT_TYPES = ", ".join(f"{name} binary" for name in SHUT)


def shut(x: dict[str, np.ndarray]) -> tuple[np.ndarray, dict[str, bytes]]:
    """Order of pairs by which of their words are infrequent and by key, and their words in that order.

    The key is both places, or the hash of the infrequent word (of two, the word before).
    """
    rare_u, rare_v = x["u"] < 0, x["v"] < 0
    group = rare_u + 2 * rare_v
    key = np.where(rare_u, x["before"], np.where(rare_v, x["word"], key_of(x, len(group))))
    order = np.lexsort((key, group))
    u, v, word, symbols = (x[name][order] for name in ("u", "v", "word", "symbols"))
    size = np.bincount(group, minlength=4)
    a, b, c = np.cumsum(size)[:3]
    before_class, class_ = (symbols >> np.uint64(py.BITS)).astype(np.int16), (symbols & py.suffix_mask(1)).astype(np.int16)
    return order, {
        "size": size.astype("i4").tobytes(),
        "key": squeezed(steps(key[order])),
        "place": squeezed(np.concatenate([v[a:b], u[b:c]]).astype("i4")),
        "far": squeezed(word[c:]),
        "class": squeezed(np.concatenate([before_class[a:b], before_class[c:], class_[b:]])),
    }


def unshut(r: dict[str, bytes], words: np.ndarray, symbol: np.ndarray) -> dict[str, np.ndarray]:
    """Pairs that were shut, given the hash and symbol of each place; hashes are 0 where there is a place."""
    size = np.frombuffer(r["size"], "i4").astype(np.int64)
    a, b, c, n = np.cumsum(size)
    key, place, classes = np.cumsum(spread(r["key"], "u8"), dtype=np.uint64), spread(r["place"], "i4"), spread(r["class"], "i2").astype(np.uint64)
    u, v, before, word = np.full(n, -1, np.int32), np.full(n, -1, np.int32), np.zeros(n, np.uint64), np.zeros(n, np.uint64)
    u[:a], v[:a] = key[:a] >> PLACE_BITS, key[:a] & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))
    before[a:b], v[a:b] = key[a:b], place[: size[1]]
    word[b:c], u[b:c] = key[b:c], place[size[1] :]
    before[c:], word[c:] = key[c:], spread(r["far"], "u8")
    su, sv = symbol[u], symbol[v]
    su[a:b], su[c:], sv[b:] = np.split(classes, np.cumsum([size[1], size[3]]))
    return {"symbols": su << np.uint64(py.BITS) | sv, "u": u, "v": v, "before": before, "word": word}


def pair_of(x: dict[str, np.ndarray], words: np.ndarray) -> np.ndarray:
    """Hash of each pair, as ``neighbours`` has it, given the hash of each place."""
    before, word = np.where(x["u"] >= 0, words[x["u"]], x["before"]), np.where(x["v"] >= 0, words[x["v"]], x["word"])
    return mix64(mix64(before + np.uint64(1)) + word)


def joined(parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """The parts as one; they are emptied, so that memory holds little twice."""
    return {k: np.concatenate([x.pop(k) for x in parts]) for k in list(parts[0])}


def merged(x: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """Each pair once, with the sum of its n."""
    order, _, start = grouped(x["pair"])
    n = np.add.reduceat(x["n"][order], start) if len(start) else x["n"]
    return {k: v[order[start]] for k, v in x.items()} | {"n": n}


NAMES = ("u", "v", "before", "word", "symbols", "row")


def dealt(x: dict[str, np.ndarray], buckets: int, rows: int) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
    """Of each bucket: every pair of every row (below ``rows``) once, and how many ``times`` it comes."""
    bucket = bucket_of(x, buckets)
    bits = np.uint64((rows - 1).bit_length())
    fits = buckets.bit_length() + 2 * int(PLACE_BITS) + int(bits) <= 64
    near = (x["u"] >= 0) & (x["v"] >= 0) & fits  # two places, bucket and row in one number, which is sorted alone
    key = bucket[near].astype(np.uint64)
    for k, b in (("u", PLACE_BITS), ("v", PLACE_BITS), ("row", bits)):
        key = key << b | x[k][near].astype(np.uint64)
    far = ~near
    x, bucket = {k: x[k][far] for k in ("pair", *NAMES)}, bucket[far]
    del near, far
    key.sort()
    start = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    times, key = np.diff(np.append(start, len(key))), key[start]
    a = {"row": (key & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int32), "times": times.astype(np.int32)}
    for k, b in (("v", bits), ("u", bits + PLACE_BITS)):
        a[k] = (key >> b & ((np.uint64(1) << PLACE_BITS) - np.uint64(1))).astype(np.int32)
    a |= {k: np.zeros(len(key), np.uint64) for k in ("before", "word", "symbols")}  # known by the places
    a_bucket = (key >> (bits + PLACE_BITS + PLACE_BITS)).astype(np.int32)

    order = np.lexsort((x["row"], x["pair"], bucket))
    pair, row = x["pair"][order], x["row"][order]
    start = np.flatnonzero(np.append(True, (pair[1:] != pair[:-1]) | (row[1:] != row[:-1]))) if len(order) else np.zeros(0, np.int64)
    times, order = np.diff(np.append(start, len(order))), order[start]
    b = {k: x[k][order] for k in NAMES} | {"times": times.astype(np.int32)}
    b_bucket = bucket[order]
    found = np.union1d(a_bucket, b_bucket)
    cuts = [(np.searchsorted(z, found).tolist(), np.searchsorted(z, found, "right").tolist()) for z in (a_bucket, b_bucket)]
    for i, at in enumerate(found.tolist()):
        yield at, {k: np.concatenate([a[k][cuts[0][0][i] : cuts[0][1][i]], b[k][cuts[1][0][i] : cuts[1][1][i]]]) for k in (*NAMES, "times")}


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    kinds |= {f"array<{name}>": pa.list_(kind) for name, kind in kinds.items()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def _rows(rows: Iterable[dict], ddl: str) -> Iterator[pa.RecordBatch]:
    rows, schema = list(rows), _schema(ddl)
    for i in range(0, len(rows), 256):
        yield pa.RecordBatch.from_pylist(rows[i : i + 256], schema=schema)


CELLS = f"bucket int, {SHUT_TYPES}, n binary"
SEATED = CELLS + ", t binary, m binary"


def count_cells(train: DataFrame, tier: Tier, buckets: int) -> DataFrame:
    """Cells of all pairs of neighbouring words, a row for each bucket."""
    shared = train.sparkSession.sparkContext.broadcast(tier)

    def rows_of(parts: list[dict[str, np.ndarray]]) -> Iterator[dict]:
        for bucket, x in dealt(joined(parts), buckets, 1):
            order, row = shut(x)
            yield {"bucket": bucket, "n": squeezed(x["times"][order].astype(np.int64))} | row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tier, parts, held = shared.value, [], 0
        for batch in batches:
            for t in chunks(batch.column(0)):
                p = parse(t.lower())
                x = neighbours(p, tier, tier.place(p.wh))
                parts.append(x | {"row": np.zeros(len(x["pair"]), np.int32)})
                held += len(x["pair"])
                if held > PACK:
                    yield from _rows(rows_of(parts), CELLS)
                    parts, held = [], 0
        if parts:
            yield from _rows(rows_of(parts), CELLS)

    def together(table: pa.Table) -> pa.Table:
        places = shared.value.by_place()
        x = joined([unshut(r, *places) | {"n": spread(r["n"], "i8")} for r in table.to_pylist()])
        x = merged(x | {"pair": pair_of(x, places[0])})
        order, row = shut(x)
        return pa.Table.from_pylist([{"bucket": table["bucket"][0].as_py(), "n": squeezed(x["n"][order])} | row], schema=_schema(CELLS))

    rows = train.select("text").mapInArrow(run, CELLS)
    return stored(rows.groupBy("bucket").applyInArrow(together, CELLS), "lm-cells")


def each_cells(rows: DataFrame, tier: Tier, found, ddl: str) -> DataFrame:
    """What ``found`` gives for the cells of each row (by column names), and at last for none."""
    shared = rows.sparkSession.sparkContext.broadcast(tier)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, make = shared.value.by_place(), found()
        next(make)
        for batch in batches:
            for r in batch.to_pylist():
                x = unshut(r, *places) | {"bucket": r["bucket"], "n": spread(r["n"], "i8")}
                if "t" in r:
                    x["t"], x["m"] = spread(r["t"], "i8"), np.ones(len(x["n"]))
                    x["m"][x["n"] > 1] = spread(r["m"], "f8")
                yield from make.send(x)
        yield from make.send(None)

    return rows.mapInArrow(run, ddl)


def seated_facts(seated: DataFrame, tier: Tier, least: int) -> DataFrame:
    """``kind, key, n, x``: tables of symbol pairs (0), customers and mean tables of a frequent word before by its place (1).

    Of cells of a frequent word before with at least ``least`` customers, by pair: customers and mean tables (2), place (3).
    """
    size = len(tier.words) + 1

    def batch(kind: int, key: np.ndarray, n: np.ndarray, x: np.ndarray | None = None) -> Iterator[pa.RecordBatch]:
        x = np.zeros(len(key)) if x is None else x
        for i in range(0, len(key), 65536):
            j = i + 65536
            kinds = np.full(len(key[i:j]), kind, np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(kinds), _long(key[i:j]), _long(n[i:j]), pa.array(x[i:j])], names=["kind", "key", "n", "x"])

    def found():
        n, m, symbols, words = np.zeros(size), np.zeros(size), Sums(), tier.by_place()[0]
        x = yield
        while x is not None:
            common = x["u"] >= 0
            n += np.bincount(x["u"][common], x["n"][common], size)
            m += np.bincount(x["u"][common], x["m"][common], size)
            out = [b for k, t in symbols.add(x["symbols"], x["t"]) for b in batch(0, k, t)]
            hot = np.flatnonzero(common & (x["n"] >= least))
            pair = pair_of({k: x[k][hot] for k in ("u", "v", "before", "word")}, words)
            x = yield [*out, *batch(2, pair, x["n"][hot], x["m"][hot]), *batch(3, pair, x["u"][hot])]
        seen = np.flatnonzero(n)
        yield [*(b for k, t in symbols.rest() for b in batch(0, k, t)), *batch(1, seen, n[seen].astype(np.int64), m[seen])]

    rows = each_cells(seated, tier, found, "kind int, key long, n long, x double")
    return stored(rows.groupBy("kind", "key").agg(F.sum("n").alias("n"), F.sum("x").alias("x")), "lm-tables")


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64))


def deal_words(words: DataFrame, tier: Tier, buckets: int) -> DataFrame:
    """``bucket, known, count``: words outside the tier by their hash, with their training counts."""
    shared, ddl = words.sparkSession.sparkContext.broadcast(tier), "bucket int, known binary, count binary"

    def rows_of(parts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[dict]:
        word, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        bucket = (mix64(word) % np.uint64(buckets)).astype(np.int32)
        order = np.lexsort((word, bucket))
        word, n, bucket = word[order], n[order], bucket[order]
        for i, j in zip(*_runs(bucket), strict=True):
            yield {"bucket": int(bucket[i]), "known": squeezed(steps(word[i:j])), "count": squeezed(n[i:j])}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, held = [], 0
        for batch in batches:
            word, n = batch.column(0).to_numpy().view(np.uint64), batch.column(1).to_numpy()
            far = shared.value.place(word) < 0
            parts.append((word[far], n[far]))
            held += int(far.sum())
            if held > HOLD:
                yield from _rows(rows_of(parts), ddl)
                parts, held = [], 0
        if parts:
            yield from _rows(rows_of(parts), ddl)

    return words.where("n > 0").select("word", "n").mapInArrow(run, ddl)


def class_of(symbols: np.ndarray) -> np.ndarray:
    """Class of the last symbol of each pair, -1 if it is a word of its own or the end."""
    last = (symbols.astype(np.int64) & ((1 << py.BITS) - 1)) - 1
    return np.where(last < CLASSES, last, -1)


def seat_cells(cells: DataFrame, words: DataFrame, tier: Tier, model: py.SymbolModel, c: np.ndarray, own: np.ndarray, of_class: np.ndarray) -> DataFrame:
    """Tables ``t`` of every cell: its customers leave and are seated again, with a table for each other cell of its restaurant."""
    shared = cells.sparkSession.sparkContext.broadcast((model, tier.by_place(), np.append(c, 0), of_class, own))

    def asks():  # only these need the count of an infrequent word
        words_of, x = tier.by_place()[0], (yield)
        while x is not None:
            y = {k: x[k][(x["n"] > 1) & (x["v"] < 0)] for k in ("u", "v", "before", "word")}
            bucket = pa.array(np.full(len(y["u"]), x["bucket"], np.int32))
            x = yield [pa.RecordBatch.from_arrays([bucket, _long(pair_of(y, words_of)), _long(y["word"])], names=["bucket", "pair", "word"])]
        yield ()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        model, places, c, of_class, tables = shared.value
        out = []
        far = {name: right[name].to_numpy() for name in ("pair", "c")}
        order = np.argsort(far["pair"])
        for r in left.to_pylist():  # one
            x = unshut(r, *places) | {"n": spread(r["n"], "i8")}
            own, rare = np.zeros(len(x["n"]), np.int64), x["u"] < 0
            _, at = np.unique(x["before"][rare], return_inverse=True)
            own[rare] = np.bincount(at)[at]
            t, many = np.ones(len(x["n"])), np.flatnonzero(x["n"] > 1)
            y = {k: v[many] for k, v in x.items()}
            y["pair"] = pair_of(y, places[0]).view(np.int64)
            cls, word = class_of(y["symbols"]), c[y["v"]]
            asked = y["v"] < 0
            word[asked] = far["c"][order][np.searchsorted(far["pair"][order], y["pair"][asked])]
            base = model.probability(y["symbols"])
            base = np.where(cls >= 0, base * (word - py.DISCOUNT) / of_class[cls], base)
            others = np.where(y["u"] >= 0, tables[y["u"]], own[many]) - 1
            t[many], mean = py.seat_by_key(y["pair"], y["n"].astype(float), others, base)
            out.append({k: r[k] for k in ("bucket", *SHUT, "n")} | {"t": squeezed(t.astype(np.int64)), "m": squeezed(mean)})
        return pa.Table.from_pylist(out, schema=_schema(SEATED))

    far = each_cells(cells, tier, asks, "bucket int, pair long, word long").join(words.select("word", F.col("n").alias("c")), "word")
    far = far.select("bucket", "pair", "c")
    seated = stored(cells.groupBy("bucket").cogroup(far.groupBy("bucket")).applyInArrow(run, SEATED), "lm-seated")
    shared.destroy()  # the model of pair counts is not needed any more
    return seated


PACKED = f"bucket int, pack long, head binary, {SHUT_TYPES}, row binary, times binary"


class Pack:
    """Tokens of the texts of one task that are looked up together, cut by bucket."""

    def __init__(self, number: int, buckets: int):
        self.number, self.buckets, self.texts, self.heads, self.tokens, self.held = number, buckets, 0, [], [], 0

    def add(self, head: tuple, tokens: dict[str, np.ndarray]) -> None:
        self.heads.append(head)
        tokens["row"] = (tokens["row"] + self.texts).astype(np.int32)
        self.tokens.append(tokens)
        self.texts += len(head[0])
        self.held += len(tokens["row"]) + len(head[0])

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.heads:
            return
        head = pickle.dumps([np.concatenate(h) for h in zip(*self.heads, strict=True)])
        out = [{"bucket": self.number % self.buckets, "pack": self.number, "head": head}]
        for bucket, x in dealt(joined(self.tokens), self.buckets, self.texts):
            order, row = shut(x)
            row |= {"row": squeezed(x["row"][order]), "times": x["times"][order].tobytes()}
            out.append({"bucket": bucket, "pack": self.number} | row)
        yield from _rows(out, PACKED)


def _runs(x: np.ndarray) -> tuple[list[int], list[int]]:
    cut = np.flatnonzero(np.diff(x)) + 1
    return ([0, *cut.tolist()], [*cut.tolist(), len(x)]) if len(x) else ([], [])


PARTS = "pack long, head binary, row binary, part binary, far_row binary, far_c binary, far_times binary, uid array<long>, word array<long>, class array<int>, a array<double>, b array<double>, times array<int>"


def score(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row of ``docs``.

    ``training`` is a condition on the column ``doc_id`` (null: not a training row).
    """
    spark = docs.sparkSession
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    named = named.withColumn("train", F.coalesce(training, F.lit(False)))
    train = named.where("train")
    words = count_words(train, named.where(~F.col("train")))
    tier = frequent_words(words)
    size = named.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(4 * shuffle_partitions(spark), size // BUCKET_BYTES)
    cells = count_cells(train, tier, buckets)
    counts = count_training(train, tier, cells)
    one = {r["kind"]: r["n"] for r in counts.where("kind in (2, 3)").collect()}
    tokens, ends = one.get(2, 0), one.get(3, 0)
    known = counts.where("kind = 1").select("key", "n").toPandas()  # at most TIER_WORDS + MODEL_WORDS rows
    c = np.zeros(len(tier.words))
    c[known["key"].to_numpy(dtype=np.int64)] = known["n"].to_numpy(dtype=float)
    own = np.zeros(len(c) + 1)
    got = counts.where("kind = 4").select("key", "n").toPandas()  # as many
    own[got["key"].to_numpy(dtype=np.int64)] = got["n"].to_numpy(dtype=float)

    # word-level restaurants: seated on the model of all pair counts, whose customers are then their tables
    of_class = class_tokens(counts) + py.STRENGTH
    seated = seat_cells(cells, words, tier, fit_model(counts), c, own, of_class)
    facts = seated_facts(seated, tier, max(1, -(-tokens // HOT_CELLS)))
    places = len(tier.words) + 1
    customers, new_table = np.full(places, py.STRENGTH), np.full(places, py.STRENGTH)
    got = facts.where("kind = 1").toPandas()  # at most TIER_WORDS + MODEL_WORDS + 1 rows
    customers[got["key"].to_numpy(dtype=np.int64)] += got["n"].to_numpy(dtype=float)
    new_table[got["key"].to_numpy(dtype=np.int64)] += got["x"].to_numpy(dtype=float) * py.DISCOUNT
    new_table /= customers
    in_class = np.zeros(CLASSES)
    for r in words.where("n > 0").groupBy("class").count().collect():  # at most CLASSES rows
        in_class[r["class"]] = r["count"]
    types = int(in_class.sum()) + (1 if ends else 0)
    np.subtract.at(in_class, tier.classes[tier.symbol >= 0], 1)
    each = float(np.log10(tokens + 0.5 * (types + 1)))

    hot = facts.where("kind = 2").select("key", "n", "x").toPandas().sort_values("key")  # no more than HOT_CELLS pairs have that share of all tokens
    hot_pair, hot_u = hot["key"].to_numpy(dtype=np.int64), facts.where("kind = 3").select("key", "n").toPandas().sort_values("key")["n"].to_numpy(dtype=np.int64)
    hot_share = (hot["n"].to_numpy(dtype=float) - py.DISCOUNT * hot["x"].to_numpy(dtype=float)) / customers[hot_u]
    new_word = py.STRENGTH + py.DISCOUNT * in_class
    inside = np.where(tier.symbol < 0, np.where(c > 0, c - py.DISCOUNT, new_word[tier.classes]) / of_class[tier.classes], 1.0)
    shared = spark.sparkContext.broadcast((fit_model(facts), tier, c, np.append(inside, 1.0), new_table, hot_pair, hot_share))
    log_end = float(np.log10(ends + 0.5))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, tier, c, inside, new_table, hot_pair, hot_share = shared.value
        number = TaskContext.get().partitionId() << 20
        pack = Pack(number, buckets)
        for batch in batches:
            for t in chunks(batch.column(1)):
                p = parse(t.lower())
                at = tier.place(p.wh)
                common, b = at >= 0, (p.bounds[:-1], p.bounds[1:])
                count = np.where(common, c[at], 0.0) if len(c) else np.zeros(len(at))
                x = neighbours(p, tier, at)
                found = np.zeros(len(x["pair"]), bool)
                if len(hot_pair):
                    place = np.minimum(np.searchsorted(hot_pair, x["pair"].view(np.int64)), len(hot_pair) - 1)
                    found = hot_pair[place] == x["pair"].view(np.int64)
                    found &= x["v"] >= 0  # an infrequent word still needs its count
                done, hot = np.zeros(len(found)), np.flatnonzero(found)
                if len(hot):
                    base = model.probability(x["symbols"][hot]) * inside[x["v"][hot]] * new_table[x["u"][hot]]
                    done[hot] = np.log10(hot_share[place[hot]] + base)
                ids = batch.column(0).slice(t.first, len(t))
                head = (
                    np.asarray(ids.fill_null(0)), np.asarray(ids.is_null()), np.asarray(batch.column(2).slice(t.first, len(t))), p.n_words + 1,
                    per_doc(common & (count > 0), *b), per_doc(np.where(common, np.log10(count + 0.5), 0.0), *b),
                    np.bincount(x["row"], done, len(t)),
                )
                pack.add(head, {key: v[~found] for key, v in x.items()})
                if pack.held > PACK:
                    yield from pack.rows()
                    number += 1
                    pack = Pack(number, buckets)
        yield from pack.rows()

    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        model, tier, _, inside, new_table = shared.value[:5]
        places = tier.by_place()
        sides = right.to_pylist()
        cells = [unshut(r, *places) | {"n": spread(r["n"], "i8"), "m": spread(r["m"], "f8")} for r in sides if r["n"] is not None]
        for x in cells:
            mean, x["m"] = x["m"], np.ones(len(x["n"]))
            x["m"][x["n"] > 1] = mean
        none = {k: np.zeros(0, kind) for k, kind in (("symbols", "u8"), ("u", "i4"), ("v", "i4"), ("before", "u8"), ("word", "u8"), ("n", "i8"), ("m", "f8"))}
        cell = cells[0] if cells else none  # a bucket has one row of cells
        near = int(((cell["u"] >= 0) & (cell["v"] >= 0)).sum())  # they come first, sorted by their places
        cell["pair"] = np.concatenate([key_of(cell, near), pair_of({k: cell[k][near:] for k in ("u", "v", "before", "word")}, places[0])])
        order = np.append(np.arange(near), near + np.argsort(cell["pair"][near:]))
        cell = {name: v[order] for name, v in cell.items()}
        known = np.concatenate([np.zeros(0, np.uint64), *(np.cumsum(spread(r["known"], "u8"), dtype=np.uint64) for r in sides if r["known"] is not None)])
        count = np.concatenate([np.zeros(0, np.int64), *(spread(r["count"], "i8") for r in sides if r["known"] is not None)])
        order = np.argsort(known)
        known, count = known[order], count[order]
        rare = cell["u"] < 0
        before, at = np.unique(cell["before"][rare], return_inverse=True)
        in_rare = np.bincount(at, cell["n"][rare], len(before)) + py.STRENGTH
        new_rare = (np.bincount(at, cell["m"][rare], len(before)) * py.DISCOUNT + py.STRENGTH) / in_rare
        held = np.ones(len(rare))
        held[rare], held[~rare] = in_rare[at], customers[cell["u"][~rare]]
        share = (cell["n"] - py.DISCOUNT * cell["m"]) / held

        def from_symbols(x: dict[str, np.ndarray]) -> np.ndarray:
            """Probability by the model of symbols, for an infrequent word that of its class."""
            rare = x["u"] < 0
            b = model.probability(x["symbols"]) * np.where(x["v"] < 0, 1.0, inside[x["v"]]) * np.where(rare, 1.0, new_table[x["u"]])
            if len(before):
                place = np.minimum(np.searchsorted(before, x["before"]), len(before) - 1)
                b = np.where(rare & (before[place] == x["before"]), b * new_rare[place], b)  # a new word before: only the model of symbols
            return b

        of_cell = from_symbols(cell)
        out = []
        for r in left.to_pylist():
            if r["head"] is not None:
                out.append({"pack": r["pack"], "head": r["head"]})
                continue
            x, row, times = unshut(r, *places), spread(r["row"], "i4"), np.frombuffer(r["times"], "i4")
            rare_u, rare_v = x["u"] < 0, x["v"] < 0
            k, a, b = int(np.frombuffer(r["size"], "i4")[0]), np.zeros(len(row)), np.zeros(len(row))
            new = np.ones(len(row), bool)
            far = {name: x[name][k:] for name in ("u", "v", "before", "word")}
            for sought, at, i, j in ((key_of(x, k), 0, 0, near), (pair_of(far, places[0]), k, near, len(share))):
                if i < j:
                    place = i + np.minimum(np.searchsorted(cell["pair"][i:j], sought), j - i - 1)
                    seen = np.flatnonzero(cell["pair"][place] == sought)
                    place = place[seen]
                    a[at + seen], b[at + seen], new[at + seen] = share[place], of_cell[place], False
            b[new] = from_symbols({name: v[new] for name, v in x.items()})
            cls, late, far = class_of(x["symbols"]), rare_u & rare_v, np.flatnonzero(rare_v & ~rare_u)
            c = np.zeros(len(far), np.int64)
            if len(known):
                place = np.minimum(np.searchsorted(known, x["word"][far]), len(known) - 1)
                c = np.where(known[place] == x["word"][far], count[place], 0)
            b[far] *= np.where(c > 0, c - py.DISCOUNT, new_word[cls[far]]) / of_class[cls[far]]
            rows, at = np.unique(row[~late], return_inverse=True)
            part = np.bincount(at, np.rint(-np.log10(a + b)[~late] * UNIT) * times[~late], len(rows))
            out.append(
                {"pack": r["pack"], "row": squeezed(steps(rows)), "part": squeezed(part.astype(np.int64))}
                | {"far_row": squeezed(row[far]), "far_c": squeezed(c), "far_times": squeezed(times[far])}
                | {"uid": (r["pack"] << 22) + row[late].astype("i8"), "word": x["word"][late].view(np.int64), "class": cls[late].astype("i4")}
                | {"a": a[late], "b": b[late], "times": times[late]}
            )
        return pa.Table.from_pylist(out, schema=parts_schema)

    parts_schema = _schema(PARTS)
    packed = named.select("doc_id", "text", "train").mapInArrow(run, PACKED)
    table = seated.drop("t").unionByName(deal_words(words, tier, buckets), allowMissingColumns=True)
    parts = packed.groupBy("bucket").cogroup(table.groupBy("bucket")).applyInArrow(look_up, PARTS)
    parts = stored(parts, "lm-parts")

    def whole(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        ids, null, train, n, known, logs, total = pickle.loads(next(r["head"] for r in rows if r["head"] is not None))
        units, known, logs = np.zeros(len(ids), np.int64), known.astype(np.int64), logs.astype(float)
        for r in rows:
            if r["row"] is not None:
                units[np.cumsum(spread(r["row"], "i4"))] += spread(r["part"], "i8")
                row, c, times = spread(r["far_row"], "i4"), spread(r["far_c"], "i8"), spread(r["far_times"], "i4")
                known += np.bincount(row, times * (c > 0), len(ids)).astype(np.int64)
                logs += np.bincount(row, np.log10(c + 0.5) * times, len(ids))
        uid = (rows[0]["pack"] << 22) + np.arange(len(ids))
        columns = [uid, pa.array(ids, mask=null), train, n.astype(np.int64), known, logs, total - units / UNIT]
        return pa.table(columns, names=["uid", "doc_id", "train", "n_tokens", "known", "logs", "score"])

    schema = "uid long, doc_id long, train boolean, n_tokens long, known long, logs double, score double"
    names = ("pack", "head", "row", "part", "far_row", "far_c", "far_times")
    texts = parts.select(*names).groupBy("pack").applyInArrow(whole, schema)

    # words outside the tier after another one: their counts by a join
    names = ("uid", "word", "class", "a", "b", "times")
    rare = parts.select(F.explode(F.arrays_zip(*names)).alias("z")).select(*(F.col(f"z.{name}").alias(name) for name in names))
    rare = rare.join(words.where("n > 0").select("word", F.col("n").alias("c")), "word", "left")
    unknown = F.array(*(F.lit(float(x)) for x in new_word / of_class))
    totals = F.array(*(F.lit(float(x)) for x in of_class))
    q = F.coalesce((F.col("c") - py.DISCOUNT) / F.element_at(totals, F.col("class") + 1), F.element_at(unknown, F.col("class") + 1))
    rare = rare.groupBy("uid").agg(
        F.sum(F.log10(F.coalesce("c", F.lit(0)) + 0.5) * F.col("times")).alias("rare_logs"),
        F.sum(F.when(F.col("c") > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        F.sum(F.log10(F.col("a") + F.col("b") * q) * F.col("times")).alias("rare_score"),
    )
    zero, nothing = F.lit(0.0), F.lit(0)
    return texts.join(rare, "uid", "left").select(
        "doc_id",
        (~F.col("train")).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", nothing) + F.lit(1 if ends else 0)).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("rare_logs", zero) + F.lit(log_end) - F.col("n_tokens") * F.lit(each)).alias("base_score"),
        (F.col("score") + F.coalesce("rare_score", zero)).alias("score"),
    )
