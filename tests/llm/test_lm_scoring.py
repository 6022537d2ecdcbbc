import os
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from attrition.llm import lm_scoring as lm
from attrition.llm import pitman_yor as py
from attrition.llm.docstats import parse
from attrition.llm.queries import op7_lm_scoring
from attrition.llm.textbatch import chunks

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    text = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    return [*WORD.findall(text), None]


def brute_base(rows, trains):
    c = Counter(t for (_, text), train in zip(rows, trains, strict=True) if train for t in tokens(text))
    n, v = sum(c.values()), len(c)
    out = []
    for _, text in rows:
        ts = tokens(text)
        out.append((len(ts), sum(c[t] > 0 for t in ts), n, sum(np.log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts)))
    return out


def check_base(got, rows, trains):
    want = brute_base(rows, trains)
    for r, w in zip(got, want, strict=True):
        assert (r.n_tokens, r.n_known, r.train_tokens) == w[:3]
        assert r.base_score == pytest.approx(w[3], rel=1e-9)


@pytest.fixture(scope="module")
def result(spark):
    return {r.doc_id: r for r in op7_lm_scoring(spark, SF).collect()}


@pytest.fixture(scope="module")
def documents(spark):
    return sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect())


def test_base_score_equals_brute_force(result, documents):
    trains = [zlib.crc32(str(i).encode()) % 5 != 1 for i, _ in documents]
    check_base([result[i] for i, _ in documents], documents, trains)
    assert all(result[i].held_out != t for (i, _), t in zip(documents, trains, strict=True))


def test_held_out_perplexity_beats_base(result):
    held = [r for r in result.values() if r.held_out]
    n = sum(r.n_tokens for r in held)
    assert sum(r.score for r in held) / n > sum(r.base_score for r in held) / n + 0.3
    assert all(r.score < 0 for r in result.values())


def test_rare_words_without_tier(spark, documents, monkeypatch):
    monkeypatch.setattr(lm, "TIER_WORDS", 20)  # nearly all words go through the shuffle
    rows = documents[:60]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in lm.score(df, training=F.col("doc_id") % 3 != 0).collect()}
    check_base([got[i] for i, _ in rows], rows, [i % 3 != 0 for i, _ in rows])


def test_odd_rows(spark, odd_docs):
    got = lm.score(odd_docs, training=F.col("doc_id") < 6).collect()
    assert len(got) == odd_docs.count()
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    want = {(i, w) for (i, _), w in zip(rows, (x[:3] for x in brute_base(rows, [i is not None and i < 6 for i, _ in rows])), strict=True)}
    assert {(r.doc_id, (r.n_tokens, r.n_known, r.train_tokens)) for r in got} == want
    assert lm.score(odd_docs.limit(0), training=F.col("doc_id") < 6).collect() == []
    none = lm.score(odd_docs, training=F.col("doc_id") < -1).collect()
    assert {(r.n_known, r.train_tokens) for r in none} == {(0, 0)}
    empty = next(r for r in none if r.doc_id == 3)
    assert empty.score == pytest.approx(-np.log10(lm.SYMBOLS), rel=1e-5)


def no_tier():
    return lm.Tier(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))


def test_pairs_are_those_of_the_tokens():
    import pyarrow as pa

    t = next(iter(chunks(pa.array(["ab  Cd ab\n", "", None, "cd"]))))
    p = parse(t.lower())
    tier = lm.Tier(np.sort(p.wh[:1]), np.array([2000]), np.array([0]))
    symbols, classes = tier.symbols(p, tier.place(p.wh))
    cd = int(1 + lm.word_classes(p)[1])
    assert symbols.tolist() == [2000, cd, 2000, cd] and classes.tolist() == [-1, cd - 1, -1, cd - 1]
    key, bounds = lm.pairs(p, symbols)
    stream = [[2000, cd, 2000, 0], [0], [0], [cd, 0]]
    want = [(a << 16) + b for s in stream for a, b in zip([0, *s], s, strict=False)]
    assert key.tolist() == want and bounds.tolist() == [0, 4, 5, 6, 8]


def model_of(texts, share):
    import pyarrow as pa

    counts = Counter()
    for t in chunks(pa.array(texts)):
        p = parse(t.lower())
        counts.update(lm.pairs(p, 1 + lm.word_classes(p))[0].tolist())
    total = sum(counts.values())
    held = Counter()
    for g, n in counts.items():
        held[g >> 16] += n
    cells = Counter()
    for g, n in counts.items():
        k = int(held[g >> 16] >= total / share)
        cells[k, g if k else g & 0xFFFF] += n
    level, cell = (np.array(x) for x in zip(*cells, strict=True))
    return py.build_levels(level, cell, np.array(list(cells.values())))


def test_probabilities_sum_to_one_after_any_context():
    levels = model_of(["the cat sat on the mat and the dog sat on the log"] * 5 + ["a bat"], 12)
    assert 0 < len(levels[1].context) < len(levels[0].cell)
    model = py.build_model(levels, lm.SYMBOLS, py.run_chain(levels, lm.SYMBOLS, 1))
    for context in {*levels[1].context.tolist(), 0, 5, 77, 2500}:
        g = (np.uint64(context) << np.uint64(16)) + np.arange(lm.SYMBOLS, dtype=np.uint64)
        assert (10 ** model.log10(g)).sum() == pytest.approx(1, abs=1e-3)


def partitions(items):
    """All ways to seat customers at tables."""
    if not items:
        yield []
        return
    for rest in partitions(items[1:]):
        for k in range(len(rest)):
            yield rest[:k] + [[items[0], *rest[k]]] + rest[k + 1 :]
        yield [[items[0]], *rest]


@pytest.mark.parametrize("c,others,base", [(2, 0, 0.3), (5, 3, 0.01), (7, 40, 0.2)])
def test_exact_tables_equal_all_seatings(c, others, base):
    weight = np.zeros(c + 1)
    for tables in partitions(list(range(c))):
        w = np.prod([np.prod([i - py.DISCOUNT for i in range(1, len(t))]) for t in tables])
        w *= np.prod([(py.STRENGTH + py.DISCOUNT * (others + j)) * base for j in range(len(tables))])
        weight[len(tables)] += w
    weight /= weight.sum()
    u = (np.arange(20_000) + 0.5) / 20_000
    drawn, mean = py.exact_tables(u, np.full(len(u), c), np.full(len(u), others, float), np.full(len(u), base))
    assert np.allclose(np.bincount(drawn.astype(int), minlength=c + 1) / len(u), weight, atol=2e-4)
    assert np.allclose(mean, weight @ np.arange(c + 1))


def test_seating_in_blocks_matches_one_customer_at_a_time():
    rng = np.random.default_rng(5)
    c, a = 200, 2.0
    one = []
    for _ in range(2000):
        t = 1
        for i in range(1, c):
            t += rng.random() < a / (a + i - py.DISCOUNT * t)
        one.append(t)
    many = py.block_tables(rng, np.full(4000, c, dtype=float), np.full(4000, a))
    assert many.mean() == pytest.approx(np.mean(one), rel=0.05)
    assert many.std() == pytest.approx(np.std(one), rel=0.12)
    assert py.seat(rng, np.array([0.0, 1.0]), np.ones(2), np.full(2, 0.1)).tolist() == [0, 1]


def test_a_cell_is_drawn_by_its_key_alone():
    rng = np.random.default_rng(6)
    n = 3000
    keys = rng.integers(-(2**62), 2**62, n)
    c = np.minimum(rng.zipf(1.4, n), 1000).astype(float)
    others, base = rng.integers(0, 50, n).astype(float), rng.random(n) * 0.1 + 1e-6
    t, m = py.seat_by_key(keys, c, others, base)
    assert (t >= 1).all() and (t <= c).all() and (m >= 1).all() and (m <= c).all()
    order = rng.permutation(n)
    for part in np.array_split(order, 7):
        a, b = py.seat_by_key(keys[part], c[part], others[part], base[part])
        assert (a == t[part]).all() and np.allclose(b, m[part])


def test_scores_do_not_depend_on_partitions(spark, result):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in (4, 12):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            for r in op7_lm_scoring(spark, SF).collect():
                assert r.score == pytest.approx(result[r.doc_id].score, rel=1e-9)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_opened_cells_equal_brute_force(spark):
    texts = [("the cat sat on the mat " * 3,), ("a dog",)]
    df = spark.createDataFrame(texts, "text string")
    counts = lm.count_training(df, no_tier())
    got = sorted(tuple(r) for r in lm.opened_cells(counts).collect())
    levels = model_of([t for (t,) in texts], lm.OPEN)
    want = sorted((k, int(c), int(n)) for k, lv in enumerate(levels) for c, n in zip(lv.cell, lv.direct, strict=True) if n)
    assert got == want


def test_known_words_and_unknown_sum_to_one(spark):
    """All one-word texts: known words and one unknown word of each class."""
    text = "aa bb cc aa aa xaa yaa bb zb the the of"
    known = sorted(set(text.split()))
    df = spark.createDataFrame([(k, text) for k in range(20)], "doc_id long, text string")
    probes = [(100 + i, w) for i, w in enumerate(known)] + [(200, "zzaa"), (201, "qbb"), (202, "ucc")]
    docs = df.unionByName(spark.createDataFrame(probes, df.schema))
    monkey = lm.MODEL_WORDS
    lm.MODEL_WORDS = 2
    try:
        got = {r.doc_id: r.score for r in lm.score(docs, training=F.col("doc_id") < 20).collect()}
    finally:
        lm.MODEL_WORDS = monkey
    # a text of one known word, then the end: each is likelier than a text of an unknown word of its class
    assert got[100] > got[200] and got[101] > got[201] and got[102] > got[202]
    assert all(s < 0 for s in got.values())


def test_symbols_are_the_most_frequent_words_of_all_training_rows(spark, monkeypatch):
    """Held-out rows have no say, and a word of one long training row counts in full."""
    monkeypatch.setattr(lm, "MODEL_WORDS", 1)
    rows = [(k, "held " * 50) for k in range(20)] + [(100, "long " * 400)] + [(200 + k, f"w{k} some") for k in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    words = lm.count_words(df.where("doc_id >= 100"))
    assert sorted(r.n for r in words.collect()) == [1] * 30 + [30, 400]
    seen = []
    real = lm.frequent_words
    monkeypatch.setattr(lm, "frequent_words", lambda w: seen.append(real(w)) or seen[0])
    lm.score(df, training=F.col("doc_id") >= 100).collect()
    import pyarrow as pa

    p = parse(next(iter(chunks(pa.array(["long held"])))))
    places = seen[0].place(p.wh)
    assert seen[0].symbol[places[0]] == 1 + lm.CLASSES and (places[1] < 0 or seen[0].symbol[places[1]] == -1)


def word_model(spark, texts, probes):
    rows = [(k, x) for k, x in enumerate(texts)] + [(1000 + k, x) for k, x in enumerate(probes)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.score for r in lm.score(df, training=F.col("doc_id") < 1000).collect()}
    return [got[1000 + k] for k in range(len(probes))]


@pytest.mark.parametrize("tier", [1 << 17, 3])
def test_history_of_rare_words_is_kept(spark, monkeypatch, tier):
    """Two words of one class (last two bytes), each with its own follower, in a small share of the tokens."""
    monkeypatch.setattr(lm, "MODEL_WORDS", 2)
    monkeypatch.setattr(lm, "TIER_WORDS", tier)  # 3: through the buckets and the join
    texts = ["the of " * 200] * 30 + ["bxyz oneqq", "cxyz twoqq"] * 6
    a, b, c, d = word_model(spark, texts, ["bxyz oneqq", "bxyz twoqq", "cxyz twoqq", "cxyz oneqq"])
    assert a > b + 0.5 and c > d + 0.5


def test_broadcast_buckets_and_join_give_the_same_scores(spark, monkeypatch):
    """No pair is repeated, so every cell has one table and nothing is left to the draw."""
    monkeypatch.setattr(lm, "MODEL_WORDS", 2)
    texts = ["aa bb cc aa dd bb aa cc ee", "zz aa aa ee xaa yaa", "ee zz bb bb"]
    probes = ["aa bb", "new bb cc", "cc new", "yaa new aa aa", "", "ee zz ee zz ee zz"]
    want = word_model(spark, texts, probes)
    for hot, tier in [(1, 1 << 17), (1, 3)]:
        monkeypatch.setattr(lm, "HOT_CELLS", hot)
        monkeypatch.setattr(lm, "TIER_WORDS", tier)
        assert word_model(spark, texts, probes) == pytest.approx(want, rel=1e-5)


def test_a_word_of_one_long_held_out_text_is_in_the_tier(spark, monkeypatch):
    """However often it comes, it is not dealt out by its hash; texts hand on each pair once."""
    import pyarrow as pa

    monkeypatch.setattr(lm, "TIER_WORDS", 2)
    monkeypatch.setattr(lm, "MODEL_WORDS", 1)
    rows = [(k, f"the w{k} of the") for k in range(30)] + [(100, "hot " * 400 + "the hot"), (101, "w3 hot cold")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    seen, real = [], lm.frequent_words
    monkeypatch.setattr(lm, "frequent_words", lambda w: seen.append(real(w)) or seen[0])
    got = {r.doc_id: r for r in lm.score(df, training=F.col("doc_id") < 100).collect()}
    check_base([got[i] for i, _ in rows], rows, [i < 100 for i, _ in rows])
    p = parse(next(iter(chunks(pa.array(["hot the"])))))
    place = seen[0].place(p.wh)
    assert (place >= 0).all() and seen[0].symbol[place].tolist() == [-1, 1 + lm.CLASSES]
    tokens = lm.neighbours(p2 := parse(next(iter(chunks(pa.array(["hot " * 400]))))), seen[0], seen[0].place(p2.wh))
    pack = lm.Pack(0, 1)
    pack.add((np.zeros(1),), tokens | {"base": np.ones(401, np.float32)})
    times = [np.frombuffer(x, "i4").tolist() for b in pack.rows() for x in b.column("times").to_pylist() if x is not None]
    assert sorted(times[0]) == [1, 1, 399]


def test_pairs_shut_and_unshut_are_the_same():
    rng = np.random.default_rng(8)
    hashes = np.sort(rng.integers(1, 2**63, 60, dtype=np.uint64))
    tier = lm.Tier(hashes[::2], np.where(np.arange(30) < 5, 1000 + np.arange(30), -1), rng.integers(0, lm.CLASSES, 30))
    words, symbol = tier.by_place()
    for n in (0, 1, 4000):
        x = {}
        for name, place in (("before", "u"), ("word", "v")):
            x[name] = np.append(hashes, np.uint64(0))[rng.integers(0, 61, n)]
            x[place] = np.where(x[name] == 0, len(words) - 1, tier.place(x[name])).astype(np.int32)
        of = [np.where(x[k] >= 0, symbol[x[k]], 1 + x[w] % np.uint64(lm.CLASSES)) for k, w in (("u", "before"), ("v", "word"))]
        x["symbols"] = of[0] << np.uint64(py.BITS) | of[1]
        order, row = lm.shut(x)
        got = lm.unshut(row, words, symbol)
        assert (lm.pair_of(got, words) == lm.mix64(lm.mix64(x["before"] + np.uint64(1)) + x["word"])[order]).all()
        for k in ("u", "v", "symbols"):
            assert (got[k] == x[k][order]).all()
        assert (got["before"] == np.where(x["u"] < 0, x["before"], np.uint64(0))[order]).all()
        assert (got["word"] == np.where(x["v"] < 0, x["word"], np.uint64(0))[order]).all()


def test_a_cell_takes_few_bytes(spark, monkeypatch):
    """What a run keeps of its cells in the shared folder."""
    rng = np.random.default_rng(9)
    texts = [(k, " ".join(f"w{int(i)}" for i in rng.integers(0, 3000, 200))) for k in range(1000)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(4)
    kept, written = {}, lm.materialize

    def materialize(frame, name):
        out = written(frame, name)
        kept[name] = kept.get(name, 0) + sum(os.path.getsize(f.removeprefix("file://")) for f in out.inputFiles())
        return out

    monkeypatch.setattr(lm, "materialize", materialize)
    assert lm.score(df, training=F.col("doc_id") >= 0).count() == 1000
    cells = len({p for _, text in texts for p in zip(["", *text.split()], [*text.split(), ""], strict=True)})
    assert cells > 150_000
    assert kept["lm-cells"] < 8 * cells and kept["lm-seated"] < 8 * cells


def test_contexts_of_any_share_are_opened_and_sampled(spark):
    """Of 12,000 tokens, a context of two: it is in the model of symbols, with the symbol that follows it."""
    texts = [("the of " * 200,)] * 30 + [("cxyz oneqq",)] * 2 + [("of onews",)] * 2
    counts = lm.count_training(spark.createDataFrame(texts, "text string"), no_tier())
    cells = lm.opened_cells(counts).collect()
    want = Counter()
    import pyarrow as pa

    for t in chunks(pa.array([t for (t,) in texts])):
        p = parse(t.lower())
        want.update(lm.pairs(p, 1 + lm.word_classes(p))[0].tolist())
    assert sorted(tuple(r) for r in cells) == sorted((1, g, n) for g, n in want.items())
    model = lm.fit_model(counts)
    yz, qq, ws = (int(1 + lm.word_classes(parse(next(iter(chunks(pa.array([w]))))))[0]) for w in ("yz", "qq", "ws"))
    after, other = model.probability(np.array([yz << 16 | qq, yz << 16 | ws], np.uint64))
    assert after > 0.3 > 0.05 > other


def test_chains_split_by_context_agree_with_one_process(spark):
    rng = np.random.default_rng(3)
    texts = [(" ".join(f"w{int(i)}" for i in np.minimum(rng.zipf(1.3, 60), 400)),) for _ in range(60)]
    counts = lm.count_training(spark.createDataFrame(texts, "text string"), no_tier())
    rows = lm.opened_cells(counts).toPandas()
    levels = py.build_levels(*(rows[c].to_numpy() for c in ("level", "cell", "n")))
    mean = [np.mean(x, axis=0) for x in zip(*(py.run_chain(levels, lm.SYMBOLS, seed) for seed in range(40)), strict=True)]
    want, got = py.build_model(levels, lm.SYMBOLS, mean), lm.fit_model(counts)
    cell = levels[1].cell
    assert np.allclose(got.probability(cell), want.probability(cell), rtol=0.1, atol=0.01)
    for context in {*levels[1].context.tolist(), 5, 2500}:
        g = (np.uint64(context) << np.uint64(16)) + np.arange(lm.SYMBOLS, dtype=np.uint64)
        assert got.probability(g).sum() == pytest.approx(1, abs=1e-5)
        assert np.abs(got.probability(g) - want.probability(g)).sum() < 0.1
