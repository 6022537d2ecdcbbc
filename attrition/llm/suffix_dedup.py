"""Removal of passages that an earlier document already holds.

Every byte covered by a ``LENGTH``-byte string that also starts in a document
of smaller id is removed (UTF-8 bytes; strings are judged on the input, never
across documents).  The first document of a passage keeps it.

A suffix array of the whole corpus would be one global sort, so suffixes meet
by content instead:

1. *Anchors.*  Of the ``GRAM``-byte strings inside a window of ``LENGTH`` bytes
   the one of smallest hash (leftmost of equals) is its anchor; equal windows
   have equal anchors at equal places.  Consecutive windows share anchors: a
   *run* is an anchor with its windows, its *context* the bytes they cover.
2. *Filter.*  32 bits of every anchor hash go to a bucket, which tells the
   anchors that stand alone; most do, and are done with.
3. *Contexts* of the others, each distinct one of a chunk once with its
   smallest document id, meet by anchor.  The smallest id of a context settles
   all its later copies.  For first copies, the suffixes of an anchor's
   contexts are put in suffix order, and longest-previous-factor arrays are
   taken: the previous and the next position with a smaller document id are
   the two candidates for the longest earlier match; a window whose factor
   reaches ``LENGTH`` is removed.
4. *Frequent anchors* (over ``HOT`` places) could fill one task: their windows
   meet by window hash instead, pre-aggregated to the smallest id, so a passage
   in a third of all documents is one row for each chunk.

Anchors are dealt out in buckets of about ``BUCKET_BYTES`` of text (at least ``BUCKETS_PER_PARTITION`` for each
shuffle partition), each a task's work, so a task does not grow with the input.  Windows that meet by
hash are told apart by 64 bits.

The documents are packed once into chunks of ``CHUNK_BYTES``, a table bucketed
by chunk in the shared folder; the results come back to the texts by joins on
the chunk in which only the results are shuffled.

Defined results: null texts are empty; a null id counts as the largest; rows of
one id (repeated rows, too) never remove each other's bytes; texts of any length are taken whole; an empty table gives no
rows.  :func:`repeats` reads no other column; :func:`drop_repeats` keeps them all under their names.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrition.llm.common import materialize, shared_path, shuffle_partitions
from attrition.llm.textbatch import Texts, chunks, hash_prefix, mix64, span_hashes

LENGTH = 50
GRAM = 24
HOT = 20_000
CHUNK_BYTES = 8 << 20
BUCKETS_PER_PARTITION = 2
BUCKET_BYTES = 16 << 20  # of text for each bucket of anchors
PLACE_BITS = np.uint64(31)  # low bits of an anchor's key that hold its place; the other 33 its hash
LAST = np.iinfo(np.int64).max  # stands for a null id

ALONE, SEVERAL, FREQUENT = 0, 1, 2
CONTEXTS, WINDOWS = 0, 1


def runs(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, anchor place, first and last window of every run of a chunk of texts."""
    n = len(t.data)
    empty = np.zeros(0, np.int64)
    if n < LENGTH:
        return np.zeros(0, np.uint64), empty, empty, empty
    at = np.arange(n - GRAM + 1)
    h = span_hashes(hash_prefix(t.data), at, at + GRAM)
    if n >= 1 << int(PLACE_BITS):
        raise ValueError(f"a text of {n} bytes is beyond the {1 << int(PLACE_BITS)} bytes that anchors tell apart")
    bits = PLACE_BITS  # one for all chunks: near ties are broken alike everywhere
    low = ((h >> bits) << bits) | at.astype(np.uint64)  # order by hash, then leftmost
    width, span = 1, LENGTH - GRAM + 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < span:
        low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
    anchor = (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    size = np.maximum(t.ends - t.starts - LENGTH + 1, 0)  # windows of each document
    window = np.repeat(t.starts - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    if not len(window):
        return np.zeros(0, np.uint64), empty, empty, empty
    doc = np.repeat(np.arange(len(t)), size)
    anchor = anchor[window]
    new = np.ones(len(window), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(window)) - 1
    return h[anchor[first]], anchor[first], window[first], window[last]


def buckets_of(key: np.ndarray, n: int) -> np.ndarray:
    return ((key >> np.uint64(32)) % np.uint64(n)).astype(np.int64)


def window_buckets(k: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """Places of the window hashes of each bucket."""
    b = buckets_of(k, n)
    order = np.argsort(b, kind="stable")
    cut = np.searchsorted(b[order], np.arange(n + 1))
    for j in np.flatnonzero(np.diff(cut)):
        yield int(j), order[cut[j] : cut[j + 1]]


class Chunk:
    """Runs of all texts of a packed chunk, in a fixed order."""

    def __init__(self, texts: pa.Array, ids: np.ndarray):
        self.parts: list[Texts] = list(chunks(texts))
        found = [runs(t) for t in self.parts]
        self.part = np.repeat(np.arange(len(found)), [len(f[0]) for f in found])
        self.key, self.anchor, self.first, self.last = (np.concatenate([f[k] for f in found] or [[]]) for k in range(4))
        self.key = self.key.astype(np.uint64)
        self.anchor, self.first, self.last = (x.astype(np.int64) for x in (self.anchor, self.first, self.last))
        docs = [np.searchsorted(t.ends, f[2], "right") + t.first for t, f in zip(self.parts, found, strict=True)]
        self.doc = np.concatenate(docs or [[]]).astype(np.int64)
        self.id = ids[self.doc]

    def context_hash(self) -> np.ndarray:
        """Hash of the context and of the anchor's place in it."""
        out = np.zeros(len(self.key), dtype=np.uint64)
        for k, t in enumerate(self.parts):
            mine = np.flatnonzero(self.part == k)
            out[mine] = span_hashes(hash_prefix(t.data), self.first[mine], self.last[mine] + LENGTH)
        return mix64(out ^ mix64((self.anchor - self.first).astype(np.uint64) + np.uint64(1)))

    def by_bucket(self, rows: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
        """Rows of each bucket, in the order of the chunk."""
        b = buckets_of(self.key[rows], n)
        order = np.argsort(b, kind="stable")
        cut = np.searchsorted(b[order], np.arange(n + 1))
        for k in np.flatnonzero(np.diff(cut)):
            yield int(k), rows[order[cut[k] : cut[k + 1]]]

    def distinct(self, rows: np.ndarray, xh: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct contexts among ``rows``: a row of each, the smallest id, and the context of every row."""
        _, at, back = np.unique(np.stack([self.key[rows], xh[rows]], axis=1), axis=0, return_index=True, return_inverse=True)
        low = np.full(len(at), LAST)
        np.minimum.at(low, back.ravel(), self.id[rows])
        return rows[at], low, back.ravel()

    def windows(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, id and place (row, offset packed by order) of all windows of ``rows``."""
        size = self.last[rows] - self.first[rows] + 1
        owner = np.repeat(rows, size)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + self.first[owner]
        out = np.zeros(len(owner), dtype=np.uint64)
        for k, t in enumerate(self.parts):
            mine = np.flatnonzero(self.part[owner] == k)
            out[mine] = span_hashes(hash_prefix(t.data), place[mine], place[mine] + LENGTH)
        return out, owner, place


def pack(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``cid, rows``: the rows of ``docs`` in chunks, a table bucketed by chunk in the shared folder."""
    spark = docs.sparkSession
    names = docs.columns
    at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            rows = pa.concat_arrays([x for x, _ in held])
            lists = pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows)
            return pa.RecordBatch.from_arrays([pa.array([held[0][1]], pa.int64()), lists], names=["cid", "rows"])

        for batch in batches:
            import pyarrow.compute as pc

            length = pc.fill_null(pc.binary_length(batch.column(at + 1)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            rows = pa.StructArray.from_arrays(batch.columns[1:], names=names)
            i = 0
            while i < batch.num_rows:
                room = np.cumsum(length[i:])
                k = max(1, int(np.searchsorted(room, CHUNK_BYTES - size, "right")))
                held.append((rows.slice(i, k), batch.column(0)[i].as_py()))
                size += int(room[min(k, len(room)) - 1])
                i += k
                if size >= CHUNK_BYTES or i < batch.num_rows:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    schema = T.StructType([T.StructField("cid", T.LongType()), T.StructField("rows", T.ArrayType(docs.schema))])
    packed = docs.select(F.monotonically_increasing_id().alias("__uid"), "*").mapInArrow(run, schema)
    name = f"packed_{uuid.uuid4().hex}"
    width = shuffle_partitions(spark)
    packed.write.bucketBy(width, "cid").option("path", shared_path(spark, name)).option("compression", "zstd").saveAsTable(name)
    return spark.table(name)


def _chunk_of(rows: pa.StructScalar | pa.Array, id_at: int, text_at: int) -> Chunk:
    ids = rows.field(id_at).cast(pa.int64()).fill_null(LAST).to_numpy(zero_copy_only=False)
    return Chunk(rows.field(text_at), ids)


def anchor_flags(packed: DataFrame, n: int, id_at: int, text_at: int) -> DataFrame:
    """``cid, flags``: for each chunk, by bucket, whether each anchor stands alone, several times, or is frequent."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cid, rows in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                c = _chunk_of(rows.values, id_at, text_at)
                found = list(c.by_bucket(np.arange(len(c.key)), n))
                blobs = [(c.key[r] & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes() for _, r in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b for b, _ in found], pa.int32()), pa.array([cid] * len(found), pa.int64()), pa.array(blobs, pa.binary())],
                    names=["bucket", "cid", "keys"],
                )

    def count(block: pd.DataFrame) -> pd.DataFrame:
        parts = [np.frombuffer(k, dtype=np.uint32) for k in block["keys"]]
        _, back, n = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        flag = np.where(n > HOT, FREQUENT, np.where(n > 1, SEVERAL, ALONE)).astype(np.uint8)[back]
        cut = np.cumsum([len(p) for p in parts])[:-1]
        return pd.DataFrame({"cid": block["cid"], "bucket": block["bucket"], "flags": [x.tobytes() for x in np.split(flag, cut)]})

    rows = packed.mapInArrow(keys, "bucket int, cid long, keys binary")
    flags = rows.repartition(n, "bucket").groupBy("bucket").applyInPandas(count, "cid long, bucket int, flags binary")
    return materialize(flags.groupBy("cid").agg(F.array_sort(F.collect_list(F.struct("bucket", "flags"))).alias("flags")), "anchor-flags")


def _with_flags(c: Chunk, flags: pa.Array, n: int) -> np.ndarray:
    out = np.zeros(len(c.key), dtype=np.uint8)
    by = {f["bucket"]: f["flags"] for f in flags.to_pylist()} if flags is not None else {}
    for b, rows in c.by_bucket(np.arange(len(c.key)), n):
        out[rows] = np.frombuffer(by[b], dtype=np.uint8)
    return out


def contexts(flagged: DataFrame, n: int, id_at: int, text_at: int) -> DataFrame:
    """Packed by bucket: distinct contexts of each chunk (kind 0), and its distinct windows of frequent anchors (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cid, rows, flags in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                c = _chunk_of(rows.values, id_at, text_at)
                flag = _with_flags(c, flags.values, n)
                xh = c.context_hash()
                out = []
                for b, mine in c.by_bucket(np.flatnonzero(flag == SEVERAL), n):
                    one, low, _ = c.distinct(mine, xh)
                    text = b"".join(c.parts[c.part[r]].data[c.first[r] : c.last[r] + LENGTH].tobytes() for r in one)
                    out.append((b, CONTEXTS, c.key[one].tobytes(), xh[one].tobytes(), low.tobytes(), (c.last[one] - c.first[one]).astype(np.uint8).tobytes(), text))
                hot = np.flatnonzero(flag == FREQUENT)
                if len(hot):
                    h, owner, _ = c.windows(hot)
                    k, back = np.unique(h, return_inverse=True)
                    low = np.full(len(k), LAST)
                    np.minimum.at(low, back, c.id[owner])
                    for b, mine in window_buckets(k, n):
                        out.append((b, WINDOWS, k[mine].tobytes(), b"", low[mine].tobytes(), b"", b""))
                cols = [pa.array([cid] * len(out), pa.int64())]
                cols += [pa.array([o[k] for o in out], pa.int32()) for k in range(2)]
                cols += [pa.array([o[k] for o in out], pa.binary()) for k in range(2, 7)]
                yield pa.RecordBatch.from_arrays(cols, names=["cid", "bucket", "kind", "keys", "hashes", "ids", "windows", "text"])

    return flagged.mapInArrow(run, "cid long, bucket int, kind int, keys binary, hashes binary, ids binary, windows binary, text binary")


def previous_smaller(x: np.ndarray) -> np.ndarray:
    """Place of the nearest earlier element that is smaller, -1 where there is none (by pointer jumping)."""
    out = np.arange(len(x)) - 1
    left = np.flatnonzero(out >= 0)
    while len(left):
        left = left[x[out[left]] >= x[left]]
        out[left] = out[out[left]]  # the jump target's own candidate is the next one that may be smaller
        left = left[out[left] >= 0]
    return out


def previous_factors(suffixes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Longest previous factor of each suffix: its longest common prefix with a suffix of a smaller document.

    ``suffixes`` holds the first ``LENGTH`` bytes of every suffix as a row.  In suffix order the longest
    earlier match is with the previous or the next suffix of a smaller document.
    """
    n = len(suffixes)
    wide = np.zeros((n, -(-LENGTH // 8) * 8), dtype=np.uint8)
    wide[:, :LENGTH] = suffixes
    words = wide.view(">u8")
    order = np.lexsort([words[:, k] for k in range(words.shape[1] - 1, -1, -1)])
    d = doc[order]
    before = previous_smaller(d)
    after = n - 1 - previous_smaller(d[::-1])[::-1]
    longest = np.zeros(n, dtype=np.int64)
    sorted_suffixes = suffixes[order]
    for other in (before, np.where(after >= n, -1, after)):
        has = np.flatnonzero(other >= 0)
        for k in range(0, len(has), 1 << 16):
            part = has[k : k + (1 << 16)]
            same = sorted_suffixes[part] == sorted_suffixes[other[part]]
            common = np.where(same.all(axis=1), LENGTH, same.argmin(axis=1))
            longest[part] = np.maximum(longest[part], common)
    out = np.empty(n, dtype=np.int64)
    out[order] = longest
    return out


def _answers(block: pd.DataFrame, low: np.ndarray, mask: np.ndarray) -> pd.DataFrame:
    cut = np.cumsum([len(x) // 8 for x in block["keys"]])[:-1]
    return pd.DataFrame(
        {
            "cid": block["cid"], "bucket": block["bucket"], "kind": block["kind"],
            "ids": [x.tobytes() for x in np.split(low, cut)], "masks": [x.tobytes() for x in np.split(mask, cut)],
        }
    )


def _settle(block: pd.DataFrame) -> pd.DataFrame:
    """For each distinct context of each chunk its smallest id, and the windows an earlier document
    holds; for each window of a frequent anchor its smallest id."""
    if block["kind"].iloc[0] == WINDOWS:
        keys = np.concatenate([np.frombuffer(x, dtype=np.uint64) for x in block["keys"]])
        ids = np.concatenate([np.frombuffer(x, dtype=np.int64) for x in block["ids"]])
        one, back = np.unique(keys, return_inverse=True)
        low = np.full(len(one), LAST)
        np.minimum.at(low, back, ids)
        return _answers(block, low[back], np.zeros(len(keys), np.uint32))
    keys, hashes = (np.concatenate([np.frombuffer(x, dtype=np.uint64) for x in block[c]]) for c in ("keys", "hashes"))
    ids = np.concatenate([np.frombuffer(x, dtype=np.int64) for x in block["ids"]])
    extra = np.concatenate([np.frombuffer(x, dtype=np.uint8) for x in block["windows"]]).astype(np.int64)
    data = np.frombuffer(b"".join(block["text"]), dtype=np.uint8)
    ends = np.cumsum(extra + LENGTH)
    order = np.lexsort((ids, hashes, keys))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (keys[order][1:] != keys[order][:-1]) | (hashes[order][1:] != hashes[order][:-1])
    back = np.empty(len(order), dtype=np.int64)
    back[order] = np.cumsum(new) - 1
    first = order[new]  # of each context, a copy with the smallest id
    key = keys[first]
    lone = np.ones(len(first) + 1, dtype=bool)
    lone[1:-1] = key[1:] != key[:-1]
    several = np.flatnonzero(~(lone[:-1] & lone[1:]))  # contexts that share their anchor with another one
    mask = np.zeros(len(first), dtype=np.uint32)
    if len(several):
        rows = first[several]
        count = extra[rows] + 1
        owner = np.repeat(np.arange(len(several)), count)
        offset = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
        start = (ends - extra - LENGTH)[rows][owner] + offset
        for a, b in _batches(key[several], owner):
            factor = previous_factors(data[start[a:b, None] + np.arange(LENGTH)], ids[rows][owner[a:b]])
            hit = np.flatnonzero(factor >= LENGTH) + a
            np.bitwise_or.at(mask, several[owner[hit]], np.uint32(1) << offset[hit].astype(np.uint32))
    return _answers(block, ids[first][back], mask[back])


def _batches(key: np.ndarray, owner: np.ndarray, size: int = 200_000) -> Iterator[tuple[int, int]]:
    """Ranges of suffixes of about ``size`` that keep all contexts of an anchor together."""
    new_key = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    starts = np.searchsorted(owner, new_key)
    a = 0
    while a < len(owner):
        k = np.searchsorted(starts, a + size)
        b = int(starts[k]) if k < len(starts) else len(owner)
        yield a, b
        a = b


def _removed(c: Chunk, flag: np.ndarray, answers: dict, n: int) -> list[np.ndarray]:
    """For each part of the chunk, which bytes are removed."""
    depth = [np.zeros(len(t.data) + 1, dtype=np.int32) for t in c.parts]

    def cover(part: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        for k, d in enumerate(depth):
            mine = part == k
            np.add.at(d, start[mine], 1)
            np.subtract.at(d, end[mine], 1)

    xh = c.context_hash()
    for b, mine in c.by_bucket(np.flatnonzero(flag == SEVERAL), n):
        _, _, back = c.distinct(mine, xh)
        low, mask = answers[b, CONTEXTS]
        low, mask = low[back], mask[back]
        later = mine[low < c.id[mine]]
        cover(c.part[later], c.first[later], c.last[later] + LENGTH)
        firsts = (low == c.id[mine]) & (mask != 0)
        rows, bits = mine[firsts], mask[firsts]
        for k in range(LENGTH - GRAM + 1):
            hit = rows[(bits >> np.uint32(k)) & np.uint32(1) == 1]
            cover(c.part[hit], c.first[hit] + k, c.first[hit] + k + LENGTH)
    rows = np.flatnonzero(flag == FREQUENT)
    if len(rows):
        h, owner, place = c.windows(rows)
        k, back = np.unique(h, return_inverse=True)
        low = np.full(len(k), LAST)
        for b, mine in window_buckets(k, n):
            low[mine] = answers[b, WINDOWS][0]
        hit = low[back] < c.id[owner]
        cover(c.part[owner[hit]], place[hit], place[hit] + LENGTH)
    return [np.cumsum(d[:-1]) > 0 for d in depth]


def _spans(flags: np.ndarray) -> np.ndarray:
    """Start and end of every maximal run of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return edge.reshape(-1, 2)


def _answered(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """``cid, rows, flags, answers`` of every chunk, and the number of buckets."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    n = max(BUCKETS_PER_PARTITION * shuffle_partitions(spark), -(-size // BUCKET_BYTES))
    id_at, text_at = docs.columns.index(id_col), docs.columns.index(text_col)
    packed = pack(docs, id_col, text_col)
    flags = anchor_flags(packed, n, id_at, text_at)
    flagged = packed.join(flags.hint("shuffle_hash"), "cid", "left").select("cid", "rows", "flags")
    found = contexts(flagged, n, id_at, text_at)
    schema = "cid long, bucket int, kind int, ids binary, masks binary"
    answers = found.repartition(n, "bucket").groupBy("bucket", "kind").applyInPandas(_settle, schema)
    answers = answers.groupBy("cid").agg(F.collect_list(F.struct("bucket", "kind", "ids", "masks")).alias("answers"))
    results = materialize(flags.join(answers, "cid", "left"), "answers")
    return packed.join(results.hint("shuffle_hash"), "cid", "left").select("cid", "rows", "flags", "answers"), n


def _resolved(batch: pa.RecordBatch, n: int, id_at: int, text_at: int) -> Iterator[tuple[pa.StructArray, Chunk, list[np.ndarray]]]:
    """Rows, chunk and removed bytes of every packed chunk of a batch."""
    for rows, flags, answers in zip(*(batch.column(k) for k in range(1, 4)), strict=True):
        rows = rows.values
        c = _chunk_of(rows, id_at, text_at)
        flag = _with_flags(c, flags.values, n)
        by = {}
        for a in (answers.values.to_pylist() if answers.is_valid else []):
            by[a["bucket"], a["kind"]] = (np.frombuffer(a["ids"], dtype=np.int64), np.frombuffer(a["masks"], dtype=np.uint32))
        yield rows, c, _removed(c, flag, by, n)


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans`` (byte ranges) of every row of ``docs``."""
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    packed, n = _answered(named, "doc_id", "text")
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, c, removed in _resolved(batch, n, 0, 1):
                out = []
                for t, gone in zip(c.parts, removed, strict=True):
                    for a, b in zip(t.starts, t.ends, strict=True):
                        g = gone[a:b]
                        spans = _spans(g) if g.any() else np.zeros((0, 2), np.int64)
                        kept = t.data[a:b][~g] if len(spans) else t.data[a:b]
                        where = [{"start": int(x), "end": int(y)} for x, y in spans]
                        out.append((b - a, int(g.sum()), len(spans), hashlib.sha256(kept.tobytes()).hexdigest(), where))
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), span]
                cols = [pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([rows.field(0), *cols], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>"
    return packed.mapInArrow(run, schema)


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated passages cut out of their texts (whole characters only), all columns kept.

    A null text stays null.
    """
    packed, n = _answered(docs, id_col, text_col)
    id_at, text_at, names = docs.columns.index(id_col), docs.columns.index(text_col), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, c, removed in _resolved(batch, n, id_at, text_at):
                out, null = [], np.asarray(rows.field(text_at).is_null())
                for t, gone in zip(c.parts, removed, strict=True):
                    whole = _whole_characters(t.data, gone)
                    for i, (a, b) in enumerate(zip(t.starts, t.ends, strict=True)):
                        kept = t.data[a:b][~whole[a:b]].tobytes().decode("utf-8", "replace")
                        out.append(None if null[t.first + i] else kept)
                cols = [pa.array(out, pa.string()) if k == text_at else rows.field(k) for k in range(len(names))]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return packed.mapInArrow(run, docs.schema)


def _whole_characters(data: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """Removed bytes, without those of characters of which a byte stays."""
    if not len(data):
        return gone
    head = (data & 0xC0) != 0x80
    head[0] = True
    character = np.cumsum(head) - 1
    stays = np.zeros(character[-1] + 1, dtype=bool)
    stays[character[~gone]] = True
    return ~stays[character]
