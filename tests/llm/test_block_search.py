"""Ranked search equals a row-at-a-time ranking; bounds, blocks and odd rows."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from attrition.llm import block_search

TERM = re.compile(block_search.TERM_PATTERN)


def terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lower)


def brute(docs, items, top=10):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    lengths = [sum(b.values()) for _, b in bags]
    n_docs, n_terms = sum(v > 0 for v in lengths), sum(lengths)
    df = Counter(t for _, b in bags for t in b)
    out = []
    by_item = {}
    for item, text in dict.fromkeys(items):
        by_item.setdefault(item, Counter()).update(terms(text))
    for item, bag in by_item.items():
        scored = []
        for (doc, b), n in zip(bags, lengths, strict=True):
            s = 0
            for t, r in bag.items():
                if t in b:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 25 + (75 * n * n_docs) // n_terms
                    s += r * w * ((10**9 * b[t]) // (1000 * b[t] + 8 * m))
            if s > 0:
                scored.append((-s, doc is not None, doc or 0, doc))
        for rank, (s, _, _, doc) in enumerate(sorted(scored)[:top], 1):
            out.append((item, rank, doc, -s))
    return sorted(out, key=lambda r: (r[0] is None, r[0] or "", r[1]))


def run(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id string, text string")
    got = [(r.item_id, r.rank, r.doc_id, r.score) for r in block_search.search(d.repartition(3), i, **kw).collect()]
    return sorted(got, key=lambda r: (r[0] is None, r[0] or "", r[1]))


def prose(rng, n, words, most=60):
    return " ".join(f"w{int(k)}" for k in rng.zipf(1.3, rng.integers(1, most)) % words) + f" n{n}"


@pytest.mark.parametrize("cells,block", [(2_000_000, 64), (600, 4), (3_000, 2)])
def test_equals_row_at_a_time_ranking(spark, cells, block):
    rng = np.random.default_rng(3)
    docs = [(int(i), prose(rng, i, 80)) for i in rng.permutation(300)]
    docs += [(1000 + i, docs[5][1]) for i in range(15)]  # ties
    items = [(f"q{k}", prose(rng, k, 80, 12)) for k in range(25)]
    assert run(spark, docs, items, cells=cells, block=block) == brute(docs, items)


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(block_search, "PAIRS", 20)
    rng = np.random.default_rng(4)
    docs = [(i, prose(rng, i, 30)) for i in range(60)]
    items = [(f"q{k}", prose(rng, k, 30, 15)) for k in range(12)]
    assert run(spark, docs, items, top=3) == brute(docs, items, top=3)


def test_odd_rows(spark):
    docs = [
        (1, None), (2, ""), (3, "... !!"), (4, "Ünïcode ÜNÏCODE straße 日本語 x_y"), (4, "Ünïcode ÜNÏCODE straße 日本語 x_y"),
        (None, "alpha beta"), (5, "Alpha BETA"), (6, "alpha " * 30_000), (7, "gamma"), (8, "delta epsilon"), (9, "zeta"), (10, "eta theta"),
    ]
    items = [
        ("a", "alpha beta"), ("a", "alpha beta"), ("a", "gamma!"), ("b", "Ünïcode y"), ("c", None), ("d", ""), ("e", "unseen"), (None, "gamma gamma"),
    ]
    assert run(spark, docs, items) == brute(docs, items)


def test_empty_tables_and_clashing_names(spark):
    none_d = spark.createDataFrame([], "doc_id long, text string")
    none_i = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "alpha", "x", 2)], "doc_id long, text string, item_id string, score int")
    items = spark.createDataFrame([(1, "alpha", 3)], "item_id long, text string, doc_id int")
    for d, i in ((none_d, items), (docs, none_i), (none_d, none_i)):
        got = block_search.search(d, i)
        assert got.columns == ["item_id", "rank", "doc_id", "score"] and got.count() == 0
    assert [tuple(r) for r in block_search.search(docs, items).collect()] == [(1, 1, 1, block_search.search(docs, items).first().score)]


def test_blocks_are_skipped_by_their_bounds():
    rng = np.random.default_rng(5)
    topic = np.arange(400) % 8  # documents of a topic share three terms
    impact = np.zeros((400, 30), dtype=np.int32)
    impact[:, 3] = rng.integers(1, 5, 400)
    for k in range(3):
        impact[np.arange(400), 6 + 3 * topic + k] = rng.integers(20, 40, 400)
    impact[topic == 0, 3] *= 50
    weights = rng.integers(1, 100, 30)
    shard = block_search.Shard(np.arange(400), np.ones(400, bool), impact, weights)
    blocks, summary = shard.block_list(3)
    assert sorted(np.concatenate(blocks)) == list(np.flatnonzero(impact[:, 3])) and len(blocks) > 1
    for rows, s in zip(blocks, summary, strict=True):
        assert (s == impact[rows].max(axis=0)).all()
    best = block_search.Best(10)
    query = np.array([3, 7, 11])
    shard.search(query, weights[query], best)
    score = impact[:, query].astype(np.int64) @ weights[query]
    want = np.lexsort((np.arange(400), -score))[:10]
    assert best.ids.tolist() == want.tolist() and best.scores.tolist() == score[want].tolist()
    assert shard.passed > 0


def test_terms_of_bytes():
    texts = ["A-b_c  é\x00Ω9", "", None, "x"]
    t = next(block_search.chunks(pa.array(texts, pa.string())))
    _, doc, count = block_search.term_spans(t.lower())
    assert count.tolist() == [len(terms(x)) for x in texts]
    assert doc.tolist() == [0] * 5 + [3]
