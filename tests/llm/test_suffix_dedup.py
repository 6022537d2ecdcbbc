import hashlib
import random

import numpy as np
import pytest

from attrition.llm import suffix_dedup as s
from attrition.llm.queries import op5_suffix_dedup

SF = "/root/testdata/sf0.001"


def brute(rows):
    """(doc_id, n_bytes, n_removed, n_spans, sha256) by a table of all 50-byte strings."""
    first = {}
    order = lambda i: s.LAST if i is None else i
    for i, text in rows:
        data = (text or "").encode()
        for p in range(len(data) - 49):
            w = data[p : p + 50]
            first[w] = min(first.get(w, s.LAST), order(i))
    out = []
    for i, text in rows:
        data = (text or "").encode()
        gone = [False] * len(data)
        for p in range(len(data) - 49):
            if first[data[p : p + 50]] < order(i):
                gone[p : p + 50] = [True] * 50
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out.append((i, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def case():
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdé ", k=rng.randrange(1, 9)))
    passages = [" ".join(word() for _ in range(k)) for k in (8, 11, 12, 14, 20, 60)]
    rows = []
    for i in range(120):
        parts = [" ".join(word() for _ in range(rng.choice([0, 1, 2, 5, 40]))) for _ in range(3)]
        for _ in range(rng.choice([0, 1, 1, 2])):
            p = rng.choice(passages)
            cut = rng.randrange(0, 10)
            parts.insert(rng.randrange(4), p[cut:] if rng.random() < 0.5 else p[: len(p) - cut])
        rows.append((i, "".join(parts)))
    rows += [(200, rows[7][1]), (201, rows[7][1]), (7, rows[7][1]), (None, rows[8][1]), (202, None), (203, ""), (204, "x" * 49)]
    rows += [(205, "x" * 200), (206, "x" * 120), (207, "ab" * 60), (208, "ab" * 100), (3, "q" + passages[5] + "q"), (209, "long " * 9000)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("hot", [20_000, 3])
def test_equals_brute_force(spark, case, monkeypatch, hot):
    monkeypatch.setattr(s, "CHUNK_BYTES", 1500)  # many chunks
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(s)  # the changed constants reach the workers
    monkeypatch.setattr(s, "HOT", hot)
    try:
        df = spark.createDataFrame(case, "doc_id long, text string").repartition(3)
        got = sorted((tuple(r)[:5] for r in s.repeats(df).collect()), key=str)
    finally:
        cloudpickle.unregister_pickle_by_value(s)
    want = brute(case)
    assert sum(w[2] > 0 for w in want) > 40
    assert got == want


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in op5_suffix_dedup(spark, SF).collect()), key=str) == brute(rows)


def test_drop_repeats_keeps_columns_and_whole_characters(spark):
    p = "é" * 40
    rows = [(1, "x", p + "first", 1), (2, "y", "a" + p + "second", 2), (3, None, None, None), (4, "z", "", 3)]
    df = spark.createDataFrame(rows, "doc_id long, cid string, text string, flags int")
    out = s.drop_repeats(df)
    assert out.schema == df.schema
    assert sorted(map(tuple, out.collect())) == [rows[0], (2, "y", "asecond", 2), rows[2], rows[3]]
    assert s.drop_repeats(df.limit(0)).collect() == [] and s.repeats(df.limit(0)).collect() == []


def test_odd_rows(spark, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert sorted((tuple(r)[:5] for r in s.repeats(odd_docs).collect()), key=str) == brute(rows)


def test_previous_smaller_and_factors():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 50, 400):
        x = rng.integers(0, 20, n)
        want = [max((j for j in range(i) if x[j] < x[i]), default=-1) for i in range(n)]
        assert s.previous_smaller(x).tolist() == want
    assert s.previous_smaller(np.arange(1000)[::-1]).max() == -1
    texts = rng.integers(97, 99, (60, s.LENGTH)).astype(np.uint8)
    texts[10:40, :] = texts[0]
    texts[20:30, 30:] += 1
    doc = rng.integers(0, 30, 60)
    got = s.previous_factors(texts, doc)
    for i in range(60):
        best = 0
        for j in range(60):
            if doc[j] < doc[i]:
                same = texts[i] == texts[j]
                best = max(best, s.LENGTH if same.all() else int(same.argmin()))
        assert got[i] == best


def test_equal_windows_have_equal_anchors_in_chunks_of_any_length():
    """A passage has the same anchors whether it stands in a short or a very long chunk."""
    import pyarrow as pa

    from attrition.llm import suffix_dedup as sd
    from attrition.llm.textbatch import chunks

    rng = np.random.default_rng(4)
    passage = bytes(rng.integers(97, 100, 400, dtype=np.uint8)).decode()
    short, long_ = passage, "z" * 300_000 + passage
    found = []
    for text in (short, long_):
        t = next(iter(chunks(pa.array([text]), size=1 << 20)))
        key, anchor, first, last = sd.runs(t)
        at = len(text) - len(passage)
        windows = {}
        for k, a, f, e in zip(key, anchor, first, last, strict=True):
            for w in range(int(f), int(e) + 1):
                if w >= at:
                    windows[w - at] = (int(k), int(a) - at)
        found.append(windows)
    assert found[0] == found[1]
