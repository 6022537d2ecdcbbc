"""MinHash near-duplicate detection with bottom-k sketches.

A document is the set of its ``n``-word shingles (ASCII letters lower-cased;
fewer words: the whole sequence as one shingle; no word: the empty set, linked
with nothing).  Two documents are linked at Jaccard similarity ``PERCENT`` / 100
or more; a component is a set of documents that links join.

1. *Sketches.*  One hash function; a sketch is the ``K`` smallest hash values of
   a set.  Equal sets fall into one class, represented by its smallest id, so a
   group of copies of any size is one node from here on.
2. *Inverted lists.*  Of two linked sets at least ``SHARE`` of either sketch is
   common to both (for sets of up to K values certainly; beyond, at similarity
   0.8 and K = 64 the chance of fewer is below 1e-12, a binomial's).  By the pigeonhole
   principle it is enough to list each document under its rarest values, all
   but ``ceil(SHARE * size) - 1`` of them: the values of a passage that many
   documents share are then not listed, unless they make up the document.
3. *Hubs.*  Each list links its members to its smallest id, the hub, so a list
   of any length gives as many pairs as members.  Pairs pass a size filter, then
   for larger sets the union sketch (the K smallest values of both) estimates their similarity: with
   fewer than ``SHARE`` of its values in common, a pair is no link (at similarity 0.8 the
   chance of that is the one stated above).  The exact Jaccard similarity of the full sets decides.
4. *Rest.*  Two members of a hub's lists may be linked though they are not
   joined through the hub.  Members outside the hub's largest component are
   compared with all its members in other components, in blocks of bounded
   size: shared sketch values first, then the lists of all shingles of the block give the exact overlap of a query
   with every member at once; what a link joins is one component from there on.  Only links leave a block.  A pair is looked at under its smallest
   common hub alone.  No pair that may be a link between different components
   is left out, and no pair within a component needs a look.

The full sets of all listed documents are made once, by one join of the texts
with their ids; as these grow with the input, no side of it is ever broadcast.

Defined results: rows that share an id are one node; a null id is a row whose
component is that of the documents with the same set (null if there are none);
repeated rows are kept; an empty table gives no rows.  Texts of any length are taken whole.  A
similarity equal to the threshold links.  Other columns are not read, so their names cannot clash;
:func:`keep_one` keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from attrition.llm.common import materialize, meet
from attrition.llm.components import connected_components
from attrition.llm.docstats import parse
from attrition.llm.textbatch import chunks, mix64, shingles

K = 64
PERCENT = 80
SHARE = 0.4
REST_BLOCK = 250_000  # shingles
MEMBER_BLOCK = 500_000

_SALT = np.uint64(0x243F6A8885A308D3)


def _sets(texts: pa.Array, n: int) -> Iterator[np.ndarray]:
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


def sketches(docs: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, size, f1, f2, sketch`` of every row: set size, set fingerprint, bottom-k values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, f1, f2, low = [], [], [], []
            for s in _sets(batch.column(1), n):
                size.append(len(s))
                f1.append(int(mix64(s ^ _SALT).sum(dtype=np.uint64).astype(np.int64)))
                f2.append(int(mix64(s + _SALT).sum(dtype=np.uint64).astype(np.int64)))
                low.append(np.sort(s.view(np.int64))[:K])
            for k in range(0, len(size), 2048):
                cut = slice(k, k + 2048)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(k, 2048), pa.array(size[cut], pa.int64()), pa.array(f1[cut], pa.int64()),
                        pa.array(f2[cut], pa.int64()), pa.array(low[cut], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "size", "f1", "f2", "sketch"],
                )

    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return named.mapInArrow(run, "doc_id long, size long, f1 long, f2 long, sketch array<long>")


def sizes_fit(a: str, b: str) -> Column:
    """Set sizes between which the similarity can reach the threshold."""
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def estimate(a: np.ndarray, b: np.ndarray) -> float:
    """Similarity of two sets (sorted arrays) as the K smallest values of their union tell it."""
    low = np.union1d(a[:K], b[:K])[:K]
    if not len(low):
        return 0.0
    both = np.intersect1d(a[:K], b[:K], assume_unique=True)
    return int(np.searchsorted(both, low[-1], "right")) / len(low)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two full sets (sorted arrays) reach the threshold; of larger sets the estimate rules most others out."""
    if min(len(a), len(b)) > 16 * K and estimate(a, b) < SHARE:
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both > 0 and 100 * both >= PERCENT * (len(a) + len(b) - both)


def listed(nodes: DataFrame) -> DataFrame:
    """``value, node, size``: each node under its rarest sketch values, in lists of two or more."""
    posts = nodes.select("node", "size", F.size("sketch").alias("k"), F.explode("sketch").alias("value"))
    common = posts.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    posts = posts.join(common, "value")
    mine = Window.partitionBy("node", "size")  # at most K rows
    posts = posts.withColumn("at", F.row_number().over(mine.orderBy("df", "value"))).withColumn("n", F.count("*").over(mine))
    # values of no other node are the rarest: they take the first k - n places
    keep = F.col("k") - F.ceil(F.col("k") * SHARE) + 1
    return posts.where(F.col("at") + F.col("k") - F.col("n") <= keep).select("value", "node", "size")


def hub_members(lists: DataFrame) -> DataFrame:
    """``hub, member``: the members of all lists with the same smallest node."""
    hubs = lists.groupBy("value").agg(F.min("node").alias("hub"), F.count("*").alias("n")).where("n > 1")
    return lists.join(hubs, "value").select("hub", F.col("node").alias("member")).distinct()


def member_sets(ids: DataFrame, docs: DataFrame, n: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, set``: the full set, as the bytes of a sorted int64 array, of every document in ``ids``."""
    named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    named = named.join(ids.hint("merge"), "doc_id")
    # rows that share an id may have several sets
    named = named.withColumn("h", F.xxhash64("text")).dropDuplicates(["doc_id", "h"]).drop("h")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(_sets(batch.column(1), n))
            for k in range(0, len(sets), 256):
                part = [np.sort(s.view(np.int64)).tobytes() for s in sets[k : k + 256]]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 256), pa.array(part, pa.binary())], names=["doc_id", "set"])

    return materialize(named.mapInArrow(run, "doc_id long, set binary"), "near-sets")


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                a, b = (np.frombuffer(v.as_buffer(), dtype=np.int64) for v in (x, y))
                ok.append(similar(a, b))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    rows = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("set").alias("set_a")).hint("merge"), "a")
    rows = rows.join(sets.select(F.col("doc_id").alias("b"), F.col("set").alias("set_b")).hint("merge"), "b")
    return rows.select("a", "b", "set_a", "set_b").mapInArrow(compare, "a long, b long")


def _rest_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between different components of a hub (members: hub, member, size, component, hubs)."""
    per = members.groupBy("hub", "component").agg(F.count("*").alias("n"), F.sum("size").alias("all"))
    hubs = per.groupBy("hub").agg(
        F.max_by("component", F.struct("n", "component")).alias("main"), F.sum("all").alias("all"), F.count("*").alias("components"),
        F.max_by("all", F.struct("n", "component")).alias("top"),
    )
    hubs = hubs.where("components > 1").select(
        "hub", "main",
        F.ceil((F.col("all") - F.col("top")) / REST_BLOCK).cast("int").alias("rests"),
        F.ceil(F.col("all") / MEMBER_BLOCK).cast("int").alias("parts"),
    )
    key = F.xxhash64("member")
    rows = members.join(hubs, "hub").join(sets.select(F.col("doc_id").alias("member"), "set").hint("merge"), "member")
    rows = rows.withColumn("own_rest", F.when(F.col("component") != F.col("main"), F.pmod(key, F.col("rests"))))
    rows = rows.withColumn("own_part", F.pmod(key, F.col("parts")))
    # as a query a row goes to all parts of its rest, as a member to all rests of its part
    query = F.expr("if(own_rest is null, array(), transform(sequence(0, parts - 1), p -> struct(cast(own_rest as int) as rest, p as part)))")
    member = F.expr("transform(sequence(0, rests - 1), q -> struct(q as rest, cast(own_part as int) as part))")
    rows = rows.withColumn("cell", F.explode(F.array_union(query, member)))
    rows = rows.select(
        "hub", "cell.rest", "cell.part", "member", "component", "hubs", "set",
        (F.col("cell.rest") == F.coalesce("own_rest", F.lit(-1))).alias("query"),
        (F.col("cell.part") == F.col("own_part")).alias("present"),
    )
    return rows.groupBy("hub", "rest", "part").applyInPandas(_compare_block, "a long, b long").distinct()


def _compare_block(block: pd.DataFrame) -> pd.DataFrame:
    """Links between the query rows of a block and its members in other components."""
    hub = block["hub"].iloc[0]
    right = block[block["present"]]
    ids, comp = right["member"].to_numpy(), right["component"].to_numpy()
    full = [np.frombuffer(s, dtype=np.int64) for s in right["set"]]
    size = np.array([len(s) for s in full], dtype=np.int64)
    low = [s[:K] for s in full]
    width = np.minimum(size, K)
    values = np.concatenate(low) if low else np.zeros(0, np.int64)
    owner = np.repeat(np.arange(len(ids)), width)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    every = np.concatenate(full) if full else np.zeros(0, np.int64)
    holder = np.repeat(np.arange(len(ids)), size)
    order = np.argsort(every, kind="stable")
    every, holder = every[order], holder[order]
    of_hub: dict[int, list[int]] = {}
    for i, hubs in enumerate(right["hubs"]):
        for h in hubs:
            if h < hub:
                of_hub.setdefault(int(h), []).append(i)
    earlier = {h: np.array(rows) for h, rows in of_hub.items()}
    # components that links of this block join are one from then on, and not compared again
    asked = block.loc[block["query"], ["member", "component", "hubs", "set"]]
    names = np.unique(np.concatenate([comp, asked["component"].to_numpy()]))
    now = np.arange(len(names))
    mine = np.searchsorted(names, comp)
    found = []
    for x, c, hubs, raw in asked.itertuples(index=False):
        a = np.frombuffer(raw, dtype=np.int64)
        lo, hi = np.searchsorted(values, a[:K], "left"), np.searchsorted(values, a[:K], "right")
        count = hi - lo
        at = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(count.sum())
        shared = np.bincount(owner[at], minlength=len(ids))
        me = int(np.searchsorted(names, c))
        near = (now[mine] != now[me]) & (shared >= SHARE * np.minimum(width, min(len(a), K))) & (shared > 0)
        near &= 100 * np.minimum(size, len(a)) >= PERCENT * np.maximum(size, len(a))
        for h in hubs:
            if int(h) in earlier:
                near[earlier[int(h)]] = False  # looked at under that hub
        if not near.any():
            continue
        lo, hi = np.searchsorted(every, a, "left"), np.searchsorted(every, a, "right")
        count = hi - lo
        at = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(count.sum())
        both = np.bincount(holder[at], minlength=len(ids))  # shingles shared with every member
        near &= 100 * both >= PERCENT * (len(a) + size - both)
        for j in np.flatnonzero(near):
            if now[mine[j]] != now[me]:
                found.append((max(x, ids[j]), min(x, ids[j])))
                now[now == now[mine[j]]] = now[me]
    return pd.DataFrame(sorted(set(found)), columns=["a", "b"], dtype="int64")


def components(docs: DataFrame, n: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs``."""
    rows = materialize(sketches(docs, n, id_col, text_col), "near-sketches")
    key = ["size", "f1", "f2"]
    classes = rows.where("size > 0").groupBy(*key).agg(F.min("doc_id").alias("node"), F.count("*").alias("n"), F.first("sketch").alias("sketch"))
    classes = materialize(classes, "near-classes")
    nodes = classes.where("node IS NOT NULL").select("node", "size", "sketch")
    members = hub_members(listed(nodes)).join(nodes.groupBy("node").agg(F.max("size").alias("size")), F.col("member") == F.col("node"))
    members = materialize(members.select("hub", "member", "size"), "near-members")
    sets = member_sets(members.select(F.col("member").alias("doc_id")).distinct(), docs, n, id_col, text_col)
    hub = members.where("hub = member").select("hub", F.col("size").alias("hub_size"))
    star = members.where("hub <> member").join(hub, "hub").where(sizes_fit("size", "hub_size"))
    links = materialize(verify(star.select(F.col("member").alias("a"), F.col("hub").alias("b")), sets), "near-links")
    # rows that share an id join their classes
    slim = rows.select("doc_id", *key)
    several = slim.where("size > 0 AND doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min(F.struct(*key)).alias("low"), F.max(F.struct(*key)).alias("high")).where("low <> high").select("doc_id")
    shared_id = meet(slim.join(several, "doc_id"), classes.select(*key, "node", "n"), key)
    shared_id = shared_id.select(F.greatest("doc_id", "node").alias("a"), F.least("doc_id", "node").alias("b"))
    found = connected_components(links)
    labelled = members.join(found, members["member"] == found["node"], "left")
    labelled = labelled.select("hub", "member", "size", F.coalesce("component", "member").alias("component"))
    all_hubs = members.groupBy("member").agg(F.collect_set("hub").alias("hubs"))  # at most one for each of its lists
    more = materialize(_rest_links(labelled.join(all_hubs, "member"), sets), "near-rest")
    found = connected_components(links.unionByName(more).unionByName(shared_id))
    labels = classes.select(*key, "node", "n").join(found, "node", "left")
    labels = materialize(labels.select(*key, "n", F.coalesce("component", "node").alias("component")), "near-labels")
    empty = slim.where("size = 0").join(found, slim["doc_id"] == found["node"], "left")
    empty = empty.select("doc_id", "size", F.coalesce("component", "doc_id").alias("component"))
    out = meet(slim.where("size > 0"), labels, key).select("doc_id", "size", "component").unionByName(empty)
    component = F.col("component")
    return out.select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"),
    )


def keep_one(docs: DataFrame, n: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component of ``docs``, that of the smallest id, with all its columns.

    Rows without an id cannot be told apart and stay; of rows that share an id one stays.
    """
    found = components(docs.where(F.col(id_col).isNotNull()), n, id_col, text_col)
    kept = found.where("kept").select(F.col("doc_id").alias(id_col)).distinct()
    one = docs.join(kept, id_col, "left_semi").dropDuplicates([id_col])
    return one.unionByName(docs.where(F.col(id_col).isNull())).select(docs.columns)
