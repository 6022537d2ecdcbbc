"""The n-gram join equals all pairs; the search equals counting; blocks, hubs and odd rows."""

import re

import numpy as np
import pytest

from attrition.llm import common, overlap_join
from attrition.llm.overlap_join import Cell, merge_skip, min_overlap, probe

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, n=3):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)])


def linked(a, b):
    both = len(a & b)
    return both > 0 and 100 * both >= 90 * (len(a) + len(b) - both)


def brute(docs):
    """Smallest id reachable for every row; rows that share an id are one node."""
    sets = [shingle_set(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            same = docs[i][0] is not None and docs[i][0] == docs[j][0]
            if same or linked(sets[i], sets[j]):
                parent[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            low[root(i)] = min(low.get(root(i), d), d)
    return sorted(((d, len(s), low.get(root(i))) for i, ((d, _), s) in enumerate(zip(docs, sets, strict=True))), key=str)


def run(spark, docs, **kw):
    df = spark.createDataFrame(docs, "doc_id long, text string")
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in overlap_join.join(df.repartition(3), **kw).collect()), key=str)


def near_copies(rng, groups, copies, words=60, edits=2):
    docs = []
    for _ in range(groups):
        base = [f"w{int(k)}" for k in rng.integers(0, 400, words)]
        for _ in range(copies):
            text = list(base)
            for _ in range(int(rng.integers(0, edits + 1))):
                text[int(rng.integers(0, words))] = f"e{int(rng.integers(0, 9))}"
            docs.append(" ".join(text))
    order = rng.permutation(len(docs))
    return [(int(i), docs[k]) for i, k in enumerate(order)]


@pytest.mark.parametrize("cell,pivots", [(500_000, 16), (300, 2), (300, 1000)])
def test_equals_all_pairs(spark, cell, pivots):
    docs = near_copies(np.random.default_rng(1), 6, 14)
    assert run(spark, docs, cell=cell, pivots=pivots) == brute(docs)


def test_chains_and_a_passage_that_all_share(spark, monkeypatch):
    monkeypatch.setattr(overlap_join, "SLOT_BITS", 4)  # hardly any order
    monkeypatch.setattr(common, "HOT_ROWS", 5)
    monkeypatch.setattr(overlap_join, "FILTER_ROWS", 8)
    rng = np.random.default_rng(2)
    passage = " ".join(f"p{k}" for k in range(90))
    docs = [f"{passage} " + " ".join(f"u{int(k)}" for k in rng.integers(0, 1000, int(rng.integers(1, 14)))) for _ in range(40)]
    chain = [f"c{k}" for k in range(200)]
    docs += [" ".join(chain[k : k + 120]) for k in range(0, 60, 5)]
    docs += [passage.upper()] * 9
    docs = list(enumerate(docs))
    assert run(spark, docs, cell=400) == brute(docs)


def test_lists_are_cut_by_size_and_go_on_over_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 2)
    try:
        rows = [(1, 10, [7, 8], 2), (2, 10, [7], 1), (3, 11, [7], 1), (4, 20, [7], 1), (5, 21, [7], 1), (6, 22, [8], 1), (7, 99, [9], 1), (8, 100, [9], 0), (9, 5, [9], 0)]
        got = overlap_join.hub_members(spark.createDataFrame(rows, "node long, size long, prefix array<long>, cold int")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert {(r.hub, r.member) for r in got} == {(1, 1), (1, 2), (1, 3), (4, 4), (4, 5), (8, 8), (8, 9)}


def test_band_counts_bound_the_overlap():
    rng = np.random.default_rng(8)
    for n in (50, 4000, 9000):
        base = rng.integers(0, 2**63, n).astype(np.uint64)
        sets = [np.unique(np.append(base[: int(n * f)], rng.integers(0, 2**63, n - int(n * f)).astype(np.uint64))) for f in (1.0, 0.97, 0.5, 0.1)]
        ok = overlap_join.plausible(np.array([len(s) for s in sets]), [overlap_join.band_counts(s) for s in sets])
        assert ok[:2].all() and not ok[3]


def test_partitions_and_slots_do_not_matter(spark, monkeypatch):
    docs = near_copies(np.random.default_rng(3), 4, 8)
    want = run(spark, docs)
    monkeypatch.setattr(overlap_join, "SLOT_BITS", 1)
    assert run(spark, docs) == want


def test_odd_rows(spark, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    rows += [(None, "a"), (11, "one two"), (12, "One TWO"), (20, "k l m n"), (20, "one two"), (21, None), (None, None), (None, "A null id keeps its row.")]
    assert run(spark, rows) == brute(rows)
    got = overlap_join.join(odd_docs)  # columns with clashing names
    assert got.columns == ["doc_id", "n_shingles", "component_id"] and got.count() == odd_docs.count()


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert overlap_join.join(df).count() == 0
    assert overlap_join.links(df).columns == ["a", "b", "shared"]


def test_links_name_their_overlap(spark):
    docs = near_copies(np.random.default_rng(5), 3, 6)
    sets = {d: shingle_set(t) for d, t in docs}
    found = overlap_join.links(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert found
    for r in found:
        assert linked(sets[r.a], sets[r.b]) and r.shared == len(sets[r.a] & sets[r.b])


def test_merge_skip_and_probe_equal_counting():
    rng = np.random.default_rng(6)
    for need in (1, 2, 4, 7):
        lists = [sorted(rng.choice(40, int(rng.integers(0, 25)), replace=False).tolist()) for _ in range(9)]
        count = {v: sum(v in x for x in lists) for v in range(5, 33)}
        assert merge_skip(lists, need, 5, 33) == [(v, c) for v, c in count.items() if c >= need]
    cuts = np.cumsum([0] + [len(x) for x in lists])
    posts = np.array(sum(lists, []))
    for v in range(40):
        assert probe(posts, cuts[:-1], cuts[1:], v) == sum(v in x for x in lists)


def test_cell_finds_every_link():
    rng = np.random.default_rng(7)
    for _ in range(20):
        base = rng.choice(10_000, 50, replace=False)
        sets = []
        for _ in range(12):
            s = base.copy()
            s[rng.integers(0, 50, int(rng.integers(0, 5)))] = rng.integers(10_000, 20_000)
            sets.append(np.unique(s).astype(np.int64))
        ids = np.arange(12)
        cell = Cell(ids, ids, sets)
        got = {(max(int(cell.ids[i]), int(cell.ids[j])), min(int(cell.ids[i]), int(cell.ids[j])), n) for i in range(12) for j, n in cell.search(i, True)}
        want = set()
        for a in range(12):
            for b in range(a):
                n = len(np.intersect1d(sets[a], sets[b]))
                if n >= min_overlap(len(sets[a]), len(sets[b])):
                    want.add((a, b, n))
        assert got == want
