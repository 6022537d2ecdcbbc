"""N-gram Jaccard join by T-occurrence search (MergeSkip on short lists, binary probes of long ones: DivideSkip).

A document is the set of its ``n``-word shingles (ASCII letters lower-cased; fewer
words: the whole sequence as one shingle; no word: the empty set, linked with
nothing).  Two documents are linked at Jaccard similarity ``PERCENT`` / 100 or more,
that is, if they share ``min_overlap`` shingles.

1. *Classes.*  Rows with equal sets form one class, one node from here on, so that
   copies cost nothing further.
2. *Meeting places.*  Shingles have one order for all documents: by a table of
   ``1 << SLOT_BITS`` counters over the whole corpus (rare first), then by hash.  Linked
   sets share one of their first ``size - ceil(PERCENT * size / 100) + 1`` shingles,
   so a document is listed under these only.  The counters only order: a coarse
   one costs time, never a link.
3. *Hubs.*  A list in order of size is cut where no two sizes on either side can be linked; parts
   with the same first node form one hub.  Members are compared by
   counts of their shingles in ``BANDS`` or more bands of the hash range, whose smaller values add up
   to a bound of the overlap; those that may be linked with no other member are
   dropped.  (Hubs of more than ``FILTER_ROWS`` members skip this step.)
4. *Search.*  A hub is cut into cells of about ``CELL`` shingles.  In a cell, every
   shingle has an inverted list of the members that hold it, and every member is a
   query: a member linked with it must stand in T = ceil(PERCENT * size / 100) of its
   lists.  The L longest lists are set aside; the short ones go through a heap, which
   skips ahead to members that may still reach T - L occurrences; each member found is
   looked up in the long lists by binary search and kept if it reaches the required
   overlap.  Members that a chain of links already joins are not looked up again.
5. *Large hubs.*  With several cells, about ``PIVOTS`` members of the hub are in every
   cell, which joins what the cells found.  Members outside the hub's largest component
   are then queries to all cells, in blocks of bounded size, so no link between two
   components is left out.

The result of a join is a spanning set of links (:func:`links`: within a component, at most one
link for each member of a cell) or the components (:func:`join`).  Keys that many rows
share (copies of one text, a passage found everywhere) meet their group by a
broadcast of at most ``HOT_KEYS`` rows, all others by a shuffle.

Defined results: rows that share an id are one node; a null id is a row whose
component is that of the documents with the same set (null if there are none);
repeated rows are kept; a row without words is its own component; texts of any length are taken whole; an empty table gives no
rows.  Other columns are not read, so their names cannot clash.  Shingles are told apart by
64-bit hashes, sets of one class by 128 bits and their size.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.llm.common import hot_limit, materialize, meet
from attrition.llm.components import connected_components
from attrition.llm.docstats import parse
from attrition.llm.textbatch import chunks, mix64, release_memory, shingles

N = 3
PERCENT = 90
SLOT_BITS = 20
BANDS = 128  # at least; a power of two, one for 32 shingles of larger sets
CELL = 500_000
PIVOTS = 16
FILTER_ROWS = 1_000
BROADCAST_IDS = 1_000_000
MU = 0.01  # cost of a heap step against a binary probe (DivideSkip's tuning constant; no result depends on it)

_SALT = np.uint64(0x452821E638D01377)


def shingle_sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    for t in chunks(texts):
        p = parse(t.lower())
        h, doc = shingles(p.wh, p.bounds, n)
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
        h, doc = h[new], doc[new]
        yield from np.split(h, np.searchsorted(doc, np.arange(1, len(t))))


def least_shared(size: int | np.ndarray) -> int | np.ndarray:
    """Shingles that a set shares with any set it is linked with."""
    return -(-PERCENT * size // 100)


def min_overlap(a: int, b: int | np.ndarray) -> int | np.ndarray:
    """Shingles that sets of these sizes share when they are linked."""
    return -(-PERCENT * (a + b) // (100 + PERCENT))


# -- rows, classes, lists ---------------------------------------------------


def _smallest_type(counts: np.ndarray) -> np.ndarray:
    for kind in (np.uint8, np.uint16, np.uint32):
        if counts.max(initial=0) <= np.iinfo(kind).max:
            return counts.astype(kind)
    return counts


def slot_counts(docs: DataFrame, n: int) -> np.ndarray:
    """How many (document, shingle) pairs of the corpus fall into each slot of the hash range (fixed size)."""
    parts = 1 << max(SLOT_BITS - 16, 0)
    width = (1 << SLOT_BITS) // parts

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SLOT_BITS, dtype=np.int64)
        for batch in batches:
            for s in shingle_sets(batch.column(0), n):
                np.add.at(total, (s >> np.uint64(64 - SLOT_BITS)).astype(np.int64), 1)
        rows = [_smallest_type(r) for r in total.reshape(parts, width)]
        some = [k for k, r in enumerate(rows) if r.any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array([rows[k].itemsize for k in some], pa.int32()), pa.array([rows[k].tobytes() for k in some], pa.binary())],
            names=["part", "bytes", "counts"],
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, size, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                row = np.frombuffer(raw, dtype=f"u{size}")
                sums[part] = sums.get(part, np.zeros(width, np.int64)) + row
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([8] * len(sums), pa.int32()), pa.array([s.astype(np.uint64).tobytes() for s in sums.values()], pa.binary())],
            names=["part", "bytes", "counts"],
        )

    schema = "part int, bytes int, counts binary"
    sums = docs.select("text").mapInArrow(count, schema).repartition("part").mapInArrow(add, schema)
    total = np.zeros((parts, width), dtype=np.int64)
    for row in sums.collect():  # one row for each part of the table
        total[row["part"]] += np.frombuffer(row["counts"], dtype=np.uint64).astype(np.int64)
    return np.minimum(total, np.iinfo(np.int32).max).astype(np.int32).ravel()


def band_counts(s: np.ndarray) -> np.ndarray:
    """Shingles of a set in each of equal parts of a hash range; larger sets have more parts."""
    bits = max(BANDS.bit_length() - 1, int(len(s) // 32).bit_length())
    band = (s * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)
    return np.bincount(band.astype(np.int64), minlength=1 << bits).astype(np.int32)


def described_rows(docs: DataFrame, counts: np.ndarray, n: int) -> DataFrame:
    """``doc_id, size, f1, f2, prefix, cold, bands`` of every row; ``cold``: how many of the prefix are not in a hot slot."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)
    limit = hot_limit(int(counts.sum(dtype=np.int64)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            size, f1, f2, prefix, cold, bands = [], [], [], [], [], []
            for s in shingle_sets(batch.column(1), n):
                size.append(len(s))
                f1.append(int(mix64(s ^ _SALT).sum(dtype=np.uint64).astype(np.int64)))
                f2.append(int(mix64(s + _SALT).sum(dtype=np.uint64).astype(np.int64)))
                first = len(s) - least_shared(len(s)) + 1 if len(s) else 0
                slot = table[(s >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
                order = np.argsort(slot, kind="stable")[:first]
                prefix.append(s[order].view(np.int64))
                cold.append(int(np.searchsorted(slot[order], limit, "right")))
                bands.append(band_counts(s).tobytes())
            for k in range(0, len(size), 2048):
                cut = slice(k, k + 2048)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(k, 2048), pa.array(size[cut], pa.int64()), pa.array(f1[cut], pa.int64()), pa.array(f2[cut], pa.int64()),
                        pa.array(prefix[cut], pa.list_(pa.int64())), pa.array(cold[cut], pa.int32()), pa.array(bands[cut], pa.binary()),
                    ],
                    names=["doc_id", "size", "f1", "f2", "prefix", "cold", "bands"],
                )

    return docs.mapInArrow(run, "doc_id long, size long, f1 long, f2 long, prefix array<long>, cold int, bands binary")


def hub_members(classes: DataFrame) -> DataFrame:
    """``hub, member``: the members of all lists with the same smallest node; a list is cut where no two sizes across fit."""
    posts = classes.select("node", "size", F.explode(F.expr("slice(prefix, 1, cold)")).alias("value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        value, size, low = None, 0, 0  # of the row before: list, size, hub of its part
        held: int | None = None  # a node that is alone in its part so far
        for batch in batches:
            v, s, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if not len(v):
                continue
            new = np.ones(len(v), dtype=bool)
            new[1:] = (v[1:] != v[:-1]) | (100 * s[:-1] < PERCENT * s[1:])
            new[0] = value is None or v[0] != value or 100 * size < PERCENT * s[0]
            start = np.flatnonzero(new)
            part = np.cumsum(new) - 1
            alone = np.diff(np.append(start, len(v))) == 1
            hubs = n[start]
            if not new[0]:  # goes on from the last batch
                hubs = np.append(low, hubs)
                part = part + 1
                first = int(start[0]) if len(start) else len(v)
                alone = np.append(False, alone)
                if held is not None and first:
                    yield pa.RecordBatch.from_arrays([pa.array([low]), pa.array([held])], names=["hub", "member"])
            keep = ~alone[part]
            last = part[-1]
            value, size, low = v[-1], int(s[-1]), int(hubs[last])
            held = int(n[-1]) if alone[last] else None
            yield pa.RecordBatch.from_arrays([pa.array(hubs[part[keep]]), pa.array(n[keep])], names=["hub", "member"])

    cold = posts.repartition("value").sortWithinPartitions("value", "size", "node").select("value", "size", "node")
    pairs = cold.mapInArrow(run, "hub long, member long")
    # lists that many documents may share: their hubs by aggregation
    hot = classes.select("node", F.explode(F.expr("slice(prefix, cold + 1, size(prefix))")).alias("value"))
    lists = materialize(hot.groupBy("value").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1"), "overlap-lists")
    pairs = pairs.unionByName(meet(hot, lists, ["value"]).select("hub", F.col("node").alias("member")))
    return materialize(pairs.distinct(), "overlap-hubs")


# -- groups within a task ---------------------------------------------------


def groups(batches: Iterator[pa.RecordBatch], keys: int, most: int | None = None) -> Iterator[pa.Table]:
    """Groups of equal values in the first ``keys`` (integer) columns of sorted batches; cut at ``most`` rows if given."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[:keys]])
        cuts = np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1
        for a, b in zip(np.append(0, cuts), np.append(cuts, batch.num_rows), strict=True):
            key = tuple(values[:, a])
            full = most is not None and sum(h.num_rows for h in held) > most
            if held and (key != last or full):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def plausible(size: np.ndarray, bands: list[np.ndarray]) -> np.ndarray:
    """Which of some sets may be linked with another one of them, by sizes and band counts."""
    order = np.argsort(size, kind="stable")
    size, bands = size[order], [bands[k] for k in order]
    width = np.array([len(b) for b in bands])
    ok = np.zeros(len(size), dtype=bool)
    folded: dict[int, np.ndarray] = {}  # sets of w or 2 w bands as rows of w; sizes that fit differ by no more

    def rows_of(w: int) -> tuple[np.ndarray, int]:
        lo, hi = np.searchsorted(width, [w, 2 * w + 1])
        if w not in folded:
            folded[w] = np.stack([b.reshape(w, -1).sum(axis=1) for b in bands[lo:hi]])
        return folded[w], int(lo)

    for i in range(len(size) - 1):
        end = int(np.searchsorted(size, size[i] * 100 // PERCENT, "right"))
        if end > i + 1:
            rows, lo = rows_of(int(width[i]))
            bound = np.minimum(rows[i - lo], rows[i + 1 - lo : end - lo]).sum(axis=1)
            near = np.flatnonzero(bound >= min_overlap(size[i], size[i + 1 : end]))
            ok[i] |= len(near) > 0
            ok[i + 1 + near] = True
    out = np.zeros(len(size), dtype=bool)
    out[order] = ok
    return out


def candidates(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """``hub, member, size`` without members that cannot be linked with any other member of the hub."""
    hubs = pairs.groupBy("hub").agg(F.count("*").alias("n"))
    hot = F.broadcast(hubs.where(F.col("n") > hot_limit(pairs.count())).select("hub"))
    sizes = classes.select(F.col("node").alias("member"), "size", "bands")
    large = pairs.join(hot, "hub", "left_semi").join(sizes.drop("bands"), "member").select("hub", "member", "size")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in groups(batches, 1, FILTER_ROWS):
            out = table.drop_columns(["bands"]).combine_chunks()
            if table.num_rows <= FILTER_ROWS and not table.column("whole").to_pylist()[0]:
                bands = [np.frombuffer(x, dtype=np.int32) for x in table.column("bands").to_pylist()]
                out = out.filter(pa.array(plausible(out["size"].to_numpy(), bands)))
            yield from out.drop_columns(["whole"]).to_batches()

    rows = pairs.join(hot, "hub", "left_anti").join(hubs.select("hub", (F.col("n") > FILTER_ROWS).alias("whole")), "hub").join(sizes, "member")
    rows = rows.select("hub", "member", "size", "bands", "whole").repartition("hub").sortWithinPartitions("hub")
    kept = rows.mapInArrow(run, "hub long, member long, size long")
    return materialize(kept.unionByName(large), "overlap-members")


def member_sets(ids: DataFrame, docs: DataFrame, n: int) -> DataFrame:
    """``member, set``: the full set, as the bytes of a sorted int64 array, of every document in ``ids`` (doc_id)."""
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids.hint("merge")
    rows = docs.join(ids, "doc_id").withColumn("h", F.xxhash64("text")).dropDuplicates(["doc_id", "h"]).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch.column(1), n))
            for k in range(0, len(sets), 256):
                part = [np.sort(s.view(np.int64)).tobytes() for s in sets[k : k + 256]]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 256), pa.array(part, pa.binary())], names=["member", "set"])

    return materialize(rows.mapInArrow(run, "member long, set binary"), "overlap-sets")


# -- the search -------------------------------------------------------------


def merge_skip(lists: list[list[int]], need: int, first: int, last: int) -> list[tuple[int, int]]:
    """Values in [first, last) that stand in at least ``need`` of some ascending lists, and in how many."""
    at = [bisect_left(x, first) for x in lists]
    heap = [(x[a], k) for k, (x, a) in enumerate(zip(lists, at, strict=True)) if a < len(x)]
    heapq.heapify(heap)
    out = []
    while len(heap) >= need:
        value = heap[0][0]
        if value >= last:
            break
        popped = []
        while heap and heap[0][0] == value:
            popped.append(heapq.heappop(heap)[1])
        if len(popped) >= need:
            out.append((value, len(popped)))
            target = value + 1
        else:
            # need - 1 lists are set aside: no value before the next top can be in need lists
            while heap and len(popped) < need - 1:
                popped.append(heapq.heappop(heap)[1])
            if not heap:
                break
            target = heap[0][0]
        for k in popped:
            at[k] = bisect_left(lists[k], target, at[k])
            if at[k] < len(lists[k]):
                heapq.heappush(heap, (lists[k][at[k]], k))
    return out


def probe(posts: np.ndarray, start: np.ndarray, end: np.ndarray, value: int) -> int:
    """In how many of the lists ``posts[start:end]`` (ascending) a value stands, by binary search in all at once."""
    lo, hi = start.copy(), end.copy()
    while (lo < hi).any():
        mid = (lo + hi) >> 1
        open_ = lo < hi
        small = posts[np.minimum(mid, len(posts) - 1)] < value
        lo = np.where(open_ & small, mid + 1, lo)
        hi = np.where(open_ & ~small, mid, hi)
    return int(np.count_nonzero((lo < end) & (posts[np.minimum(lo, len(posts) - 1)] == value)))


class Cell:
    """Inverted lists over some sets, and a T-occurrence search of any of them in the others."""

    def __init__(self, ids: np.ndarray, components: np.ndarray, sets: list[np.ndarray], queries: np.ndarray | None = None):
        size = np.array([len(s) for s in sets], dtype=np.int64)
        order = np.lexsort((ids, size))
        self.ids, self.size = ids[order], size[order]
        self.queries = None if queries is None else queries[order]
        _, head, which = np.unique(components[order], return_index=True, return_inverse=True)
        self.parent = head[which].tolist()
        self.cuts = np.append(0, np.cumsum(self.size))
        values = np.concatenate([sets[k] for k in order])
        owner = np.repeat(np.arange(len(order)), self.size)
        by_value = np.argsort(values, kind="stable")
        self.posts = owner[by_value]
        ordered = values[by_value]
        new = np.append(True, ordered[1:] != ordered[:-1])
        starts = np.flatnonzero(new)
        # for each (set, shingle): where its list starts and ends, and where the set itself stands in it
        of_list = np.cumsum(new) - 1
        self.start, self.end, self.own = (np.empty(len(values), dtype=np.int64) for _ in range(3))
        self.start[by_value] = starts[of_list]
        self.end[by_value] = np.append(starts[1:], len(values))[of_list]
        self.own[by_value] = np.arange(len(values))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def links(self) -> list[tuple[int, int, int]]:
        """(larger id, smaller id, shared shingles) of links that join all components of the cell which links join."""
        out = []
        every = self.queries is None
        for i in range(len(self.ids)) if every else np.flatnonzero(self.queries):
            for j, shared in self.search(int(i), every):
                a, b = self.root(int(i)), self.root(j)
                if a != b:
                    self.parent[max(a, b)] = min(a, b)
                    out.append((max(int(self.ids[i]), int(self.ids[j])), min(int(self.ids[i]), int(self.ids[j])), shared))
        return out

    def search(self, i: int, earlier: bool) -> Iterator[tuple[int, int]]:
        """Sets that reach the required overlap with set i and are not joined to it yet; only those before it if ``earlier``."""
        mine = slice(self.cuts[i], self.cuts[i + 1])
        size = int(self.size[i])
        start, end = self.start[mine], (self.own if earlier else self.end)[mine]
        some = end - start > (0 if earlier else 1)
        start, end = start[some], end[some]
        least = int(least_shared(size))
        if len(start) < least:
            return
        length = end - start
        order = np.argsort(-length, kind="stable")
        long_ = min(least - 1, int(least / (MU * np.log2(length[order[0]]) + 1)))
        far, near = order[:long_], order[long_:]
        lists = [self.posts[start[k] : end[k]].tolist() for k in near]
        first = int(np.searchsorted(self.size, least_shared(size)))
        last = int(np.searchsorted(self.size, size * 100 // PERCENT, "right"))
        far_start, far_end = start[far], end[far]
        for j, count in merge_skip(lists, least - long_, first, last):
            required = int(min_overlap(size, int(self.size[j])))
            if j == i or count + long_ < required or self.root(i) == self.root(j):
                continue
            shared = count + probe(self.posts, far_start, far_end, j)
            if shared >= required:
                yield j, shared


def _cell_links(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    for table in groups(batches, keys):
        sets = [np.frombuffer(s, dtype=np.int64) for s in table.column("set").to_pylist()]
        ids = table.column("member").to_numpy()
        component = table.column("component").to_numpy() if "component" in table.column_names else ids
        queries = table.column("query").to_numpy() if "query" in table.column_names else None
        found = Cell(ids, component, sets, queries).links()
        if found:
            a, b, shared = (pa.array(c, pa.int64()) for c in zip(*found, strict=True))
            yield pa.RecordBatch.from_arrays([a, b, shared], names=["a", "b", "shared"])
    release_memory()


def _search_cells(rows: DataFrame, keys: list[str]) -> DataFrame:
    n = len(keys)
    rows = rows.repartition(*keys).sortWithinPartitions(*keys)
    return rows.mapInArrow(lambda batches: _cell_links(batches, n), "a long, b long, shared long")


def cell_links(members: DataFrame, sets: DataFrame, cell: int, pivots: int) -> DataFrame:
    """Links within the cells of all hubs, with the pivots of a hub in each of its cells."""
    hubs = members.groupBy("hub").agg(F.count("*").alias("n"), F.sum("size").alias("total"))
    hubs = hubs.select("hub", "n", F.col("n").alias("rows"), F.ceil(F.col("total") / cell).cast("int").alias("parts"))
    rows = meet(members, materialize(hubs, "overlap-cells"), ["hub"])
    own = F.pmod(F.xxhash64("member"), F.col("parts")).cast("int")
    chosen = F.pmod(F.xxhash64("member", "hub"), F.greatest(F.lit(1), F.floor(F.col("rows") / pivots))) == 0
    pivot = (F.col("parts") > 1) & (chosen | (F.col("member") == F.col("hub")))
    rows = rows.withColumn("part", F.explode(F.when(pivot, F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(F.array(own))))
    return _search_cells(rows.join(sets, "member").select("hub", "part", "member", "set"), ["hub", "part"])


def rest_links(members: DataFrame, found: DataFrame, sets: DataFrame, cell: int) -> DataFrame:
    """Links between components (``found``: node, component) of hubs that were cut into several cells."""
    large = members.groupBy("hub").agg(F.sum("size").alias("total")).where(F.col("total") > cell).select("hub")
    rows = members.join(large, "hub").join(found.withColumnRenamed("node", "member"), "member", "left")
    rows = rows.select("hub", "member", "size", F.coalesce("component", "member").alias("component"))
    per = rows.groupBy("hub", "component").agg(F.count("*").alias("n"), F.sum("size").alias("held"))
    hubs = per.groupBy("hub").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"), F.max_by("held", F.struct("n", "component")).alias("top"),
        F.sum("held").alias("held"), F.sum("n").alias("n"), F.count("*").alias("components"),
    )
    hubs = hubs.where("components > 1").select(
        "hub", "main", "n",
        F.ceil((F.col("held") - F.col("top")) / (cell / 2)).cast("int").alias("rests"), F.ceil(F.col("held") / cell).cast("int").alias("parts"),
    )
    rows = meet(rows, materialize(hubs, "overlap-rests"), ["hub"])
    key = F.xxhash64("member")
    rows = rows.withColumn("own_rest", F.when(F.col("component") != F.col("main"), F.pmod(key, F.col("rests")).cast("int")))
    rows = rows.withColumn("own_part", F.pmod(key, F.col("parts")).cast("int"))
    # as a query a row goes to all parts of its rest, as a member to all rests of its part
    query = F.expr("if(own_rest is null, array(), transform(sequence(0, parts - 1), p -> struct(own_rest as rest, p as part)))")
    member = F.expr("transform(sequence(0, rests - 1), q -> struct(q as rest, own_part as part))")
    rows = rows.withColumn("cell", F.explode(F.array_union(query, member))).join(sets, "member")
    rows = rows.select(
        "hub", "cell.rest", "cell.part", "member", "component", "set", (F.col("cell.rest") == F.coalesce("own_rest", F.lit(-1))).alias("query")
    )
    return _search_cells(rows, ["hub", "rest", "part"])


def _named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def _classes(rows: DataFrame) -> DataFrame:
    """One row for each distinct set: its smallest id, its number of rows, prefix and bands."""
    found = rows.where("size > 0").groupBy("size", "f1", "f2").agg(
        F.min("doc_id").alias("node"), F.count("*").alias("n"), F.first("prefix").alias("prefix"), F.first("cold").alias("cold"), F.first("bands").alias("bands"))
    return materialize(found, "overlap-classes")


def _class_links(classes: DataFrame, named: DataFrame, n: int, cell: int, pivots: int) -> DataFrame:
    nodes = classes.where("node IS NOT NULL")
    members = candidates(hub_members(nodes), nodes)
    sets = member_sets(members.select(F.col("member").alias("doc_id")).distinct(), named, n)
    found = materialize(cell_links(members, sets, cell, pivots), "overlap-links")
    if members.groupBy("hub").agg(F.sum("size").alias("total")).where(F.col("total") > cell).isEmpty():
        return found
    more = rest_links(members, connected_components(found), sets, cell)
    return materialize(found.unionByName(more), "overlap-links")


def links(
    docs: DataFrame, n: int = N, id_col: str = "doc_id", text_col: str = "text", cell: int = CELL, pivots: int = PIVOTS
) -> DataFrame:
    """``a, b, shared``: links between documents with different sets (each set named by its smallest id), spanning every component."""
    named = _named(docs, id_col, text_col)
    classes = _classes(described_rows(named, slot_counts(named, n), n))
    return _class_links(classes, named, n, cell, pivots).dropDuplicates(["a", "b"])


def join(
    docs: DataFrame, n: int = N, id_col: str = "doc_id", text_col: str = "text", cell: int = CELL, pivots: int = PIVOTS
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs``."""
    named = _named(docs, id_col, text_col)
    rows = materialize(described_rows(named, slot_counts(named, n), n), "overlap-rows")
    classes = _classes(rows)
    pairs = _class_links(classes, named, n, cell, pivots).select("a", "b")
    key: list[str | Column] = ["size", "f1", "f2"]
    # rows that share an id join their classes
    slim = rows.select("doc_id", *key)
    several = slim.where("size > 0 AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min(F.struct(*key)).alias("low"), F.max(F.struct(*key)).alias("high")).where("low <> high").select("doc_id")
    shared = meet(slim.join(several, "doc_id"), classes.select(*key, "node", "n"), key)
    pairs = pairs.unionByName(shared.select(F.greatest("doc_id", "node").alias("a"), F.least("doc_id", "node").alias("b")))
    found = connected_components(pairs)
    labelled = classes.select(*key, "node", "n").join(found, "node", "left")
    labelled = materialize(labelled.select(*key, "n", F.coalesce("component", "node").alias("component_id")), "overlap-labels")
    out = meet(slim.where("size > 0"), labelled, key).select("doc_id", F.col("size").alias("n_shingles"), "component_id")
    empty = slim.where("size = 0").select("doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return out.unionByName(empty)
