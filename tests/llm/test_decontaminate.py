import random
from collections import Counter

import pyarrow as pa
import pytest

from attrition.llm import decontaminate as d
from attrition.llm.docstats import parse
from attrition.llm.textbatch import chunks

SF = "/root/testdata/sf0.001"


def brute(docs, items, t=0.8):
    out = []
    for doc_id, text in docs:
        w = (text or "").lower().split()
        for item_id, item in set(items):
            v = (item or "").lower().split()
            n = min(5, len(v))
            if not n:
                continue
            want = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)}
            have = {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}
            shared = len(want & have)
            if shared >= t * len(want) - 1e-9:
                out.append((doc_id, item_id, shared, len(want), shared / len(want)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def case():
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(300)]
    items = [(i, " ".join(rng.choices(vocab, k=rng.choice([1, 2, 3, 4, 5, 6, 9, 14, 30, 60])))) for i in range(60)]
    items += [(100, None), (101, ""), (102, items[5][1]), (5, items[5][1])]
    docs = []
    for i in range(150):
        w = rng.choices(vocab, k=rng.choice([0, 3, 50, 400]))
        for _, item in rng.sample(items[:60], 3):
            v = item.split()
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                v[rng.randrange(len(v))] = "changed"
            at = rng.randrange(len(w) + 1)
            w[at:at] = [x.upper() for x in v] if rng.random() < 0.3 else v
        docs.append((i, " ".join(w)))
    docs += [(200, None), (201, ""), (3, docs[3][1]), (None, docs[4][1])]
    return docs, items


def test_equals_brute_force(spark, case, monkeypatch):
    docs, items = case
    df = spark.createDataFrame([(a, b, "x") for a, b in docs], "doc_id long, text string, item_id string")
    it = spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs, items)
    assert len(want) > 100
    assert sorted((tuple(r) for r in d.matches(df, it).collect()), key=str) == want
    monkeypatch.setattr(d, "BLOCK_BYTES", 1000)  # several blocks
    assert sorted((tuple(r) for r in d.matches(df, it).collect()), key=str) == want
    clean = d.drop_contaminated(df, it)
    assert clean.columns == df.columns
    dirty = {r[0] for r in want}
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(a) for a, _ in docs if a not in dirty)


def test_empty_tables(spark, odd_docs):
    items = spark.createDataFrame([(1, "quick brown fox")], "item_id long, text string")
    assert d.matches(odd_docs.limit(0), items).collect() == []
    assert d.matches(odd_docs, items.limit(0)).collect() == []
    assert len(d.matches(odd_docs, items).collect()) == 3
    assert d.drop_contaminated(odd_docs, items).count() == odd_docs.count() - 3


def test_partitions_have_their_own_sketch_and_threshold():
    rng = random.Random(7)
    items = [(k, " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))) for k, n in enumerate([1, 3, 5, 6, 9, 20, 40, 90, 300])]
    index = d.build_index(items)
    size = {i: len(s) for i, s in enumerate(index.sets)}
    seen = set()
    for part in index.partitions:
        held = Counter(part.items.tolist())
        for i, k in held.items():
            seen.add(i)
            lacking = size[i] - d.needed(size[i], index.threshold)
            assert part.length == index.length[i] and part.least[i] == max(k - lacking, 1)
            assert k == size[i] or part.least[i] >= d.SPARE  # a match holds several sketch values
    assert seen == set(size) and len(index.partitions) > 3


def test_a_match_that_lacks_as_many_shingles_as_it_may_is_found():
    rng = random.Random(8)
    for n in (9, 17, 33, 64, 100, 250):
        words = [f"v{rng.randrange(10**6)}" for _ in range(n)]
        index = d.build_index([(1, " ".join(words))])
        total = n - d.N + 1
        lacking = total - d.needed(total, index.threshold)
        for cut in (lacking, lacking + 1):  # the first words are missing
            text = " ".join(words[cut:]) + " end"
            t = next(iter(chunks(pa.array([text]))))
            assert bool(list(index.match(parse(t.lower())))) == (cut == lacking)
