import math
import random

import numpy as np
import pandas as pd
import pytest

from attrition.llm import near_duplicates as nd
from attrition.llm.components import connected_components


def brute(docs, n):
    """(doc_id, set size, component, kept) of rows with distinct ids, by comparing all pairs."""
    sets = {}
    for i, text in docs:
        w = (text or "").lower().split()
        k = min(n, len(w))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if k else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            both = len(sets[x] & sets[y])
            if y < x and both and 100 * both >= 80 * (len(sets[x]) + len(sets[y]) - both):
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
    return [(i, len(sets[i]), find(i), find(i) == i) for i in ids]


@pytest.fixture(scope="module")
def case():
    rng = random.Random(11)
    vocab = [f"w{i}" for i in range(3000)]
    passage = rng.choices(vocab, k=40)
    docs, i = [], 0
    for size, copies in [(60, 40), (200, 30), (400, 12), (25, 25), (5, 6), (3, 5), (120, 1), (90, 1)]:
        base = rng.choices(vocab, k=size)
        for c in range(copies):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8, 16]) * size // 200 + rng.choice([0, 1])):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            if rng.random() < 0.3:
                w += passage
            docs.append((i, " ".join(w).title() if c % 3 == 0 else " ".join(w)))
            i += 1
    chain = rng.choices(vocab, k=150)  # neighbours are linked, the ends are far apart
    for k in range(12):
        docs.append((i, " ".join(chain[: 150 - 3 * k] + [f"c{k}x{j}" for j in range(3 * k)])))
        i += 1
    for k in range(40):
        docs.append((i, " ".join(rng.choices(vocab, k=rng.choice([1, 2, 30, 80])) + (passage if k % 2 else []))))
        i += 1
    docs += [(i, None), (i + 1, ""), (i + 2, " \n"), (i + 3, "word " * 20000), (i + 4, "word " * 500)]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("n", [4, 5])
def test_equals_all_pairs(spark, case, n, monkeypatch):
    if n == 5:
        monkeypatch.setattr(nd, "REST_BLOCK", 500)
        monkeypatch.setattr(nd, "MEMBER_BLOCK", 900)
    df = spark.createDataFrame([(a, b, "clash") for a, b in case], "doc_id long, text string, sketch string").repartition(5)
    got = sorted(tuple(r) for r in nd.components(df, n=n).collect())
    want = brute(case, n)
    assert sum(not r[3] for r in want) > 50
    assert got == want


def test_odd_rows(spark, odd_docs):
    rows = sorted((tuple(r) for r in nd.components(odd_docs, n=4).collect()), key=str)
    assert len(rows) == odd_docs.count()
    by = {r[0]: r for r in rows}
    assert by[5] == (5, 6, 1, False) and by[1] == (1, 6, 1, True) and sum(r[0] == 5 for r in rows) == 2
    assert all(by[i] == (i, 0, i, True) for i in (2, 3, 4))
    assert by[None][2] is None and by[None][3]
    assert nd.components(odd_docs.limit(0), n=4).collect() == []


def test_rows_that_share_an_id_are_one_node(spark):
    a, b, c = ("one two three four five", "six seven eight nine ten", "eleven twelve thirteen fourteen")
    df = spark.createDataFrame([(2, a), (3, b), (5, a), (5, b), (7, c), (None, c)], "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id) for r in nd.components(df, n=4).collect()), key=str)
    assert got == [(2, 2), (3, 2), (5, 2), (5, 2), (7, 7), (None, 7)]


def test_components_of_long_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(100, 164)] + [(7, k) for k in range(200, 260)] + [(3, 3), (9, 8)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[k] == 100 for k in range(100, 165)) and all(got[k] == 7 for k in range(200, 260))
    assert got[9] == 8 and got[8] == 8 and 3 not in got


def test_full_sets_decide_where_a_sketch_misleads(spark):
    """Alike at 0.95, but a third of the 256 smallest values of the union are in one set only."""
    a = np.arange(2000, dtype=np.int64)
    b = np.delete(a, np.arange(64, 64 + 180, 2))
    raw = [a.tobytes(), b.tobytes()]
    block = pd.DataFrame({"hub": 0, "member": [10, 20], "component": [10, 20], "hubs": [[0], [0]], "set": raw, "query": True, "present": True})
    assert nd._compare_block(block).values.tolist() == [[20, 10]]
    sets = spark.createDataFrame([(10, raw[0]), (20, raw[1])], "doc_id long, set binary")
    assert [tuple(r) for r in nd.verify(spark.createDataFrame([(20, 10)], "a long, b long"), sets).collect()] == [(20, 10)]


def test_shares_of_sketches_lose_no_link():
    """Chance that a nested pair at the threshold shares fewer sketch values than the lists need."""
    least = math.ceil(nd.SHARE * nd.K)
    t = nd.PERCENT / 100
    assert sum(math.comb(nd.K, i) * t**i * (1 - t) ** (nd.K - i) for i in range(least)) < 1e-12


def test_union_sketch_estimates_and_keeps_links():
    rng = np.random.default_rng(9)
    for n in (30, 64, 400, 3000):
        base = np.sort(rng.choice(2**62, n, replace=False)).astype(np.int64)
        errors = []
        for _ in range(60):
            keep = int(n * rng.uniform(0.3, 1.0))
            other = np.unique(np.append(rng.choice(base, keep, replace=False), rng.integers(0, 2**62, n - keep)))
            both = len(np.intersect1d(base, other))
            true = both / (len(base) + len(other) - both)
            errors.append(nd.estimate(base, other) - true)
            if len(np.union1d(base, other)) <= nd.K:
                assert errors[-1] == 0
            assert nd.similar(base, other) == (100 * both >= 80 * (len(base) + len(other) - both))
        assert abs(np.mean(errors)) < 0.03
    none = np.zeros(0, np.int64)
    assert nd.estimate(none, none) == 0.0


def test_a_linked_pair_is_lost_with_a_chance_below_1e_12():
    from math import comb

    few = int(np.ceil(nd.SHARE * nd.K)) - 1
    assert sum(comb(64, i) * 0.8**i * 0.2 ** (64 - i) for i in range(few + 1)) < 1e-12
