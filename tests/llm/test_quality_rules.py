import re
from collections import Counter

import numpy as np
import pytest

from attrition.llm import quality_rules as q
from attrition.llm.queries import op2_quality_rules

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(5)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)


def check(rows, texts):
    for r in rows:
        n_words, chars, symbols, dup, rep = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n_words, chars, symbols, dup, rep)
        failed = n_words < 10 or 100 * rep > 20 * n_words
        assert r.base_failed == failed
        assert r.kept == (not failed and r.good_prob >= q.KEEP_AT)


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_query_equals_brute_force(spark, tables):
    texts = {r.doc_id: r.text for r in tables[0].collect()}
    rows = op2_quality_rules(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    check(rows, texts)


def test_odd_rows_and_keep_good_agree(spark, tables, odd_docs):
    model = q.fit(*tables)
    rows = q.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    check(rows, {r.doc_id: r.text for r in odd_docs.collect()})
    kept = q.keep_good(odd_docs, model)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r.doc_id) for r in rows if r.kept)
    assert q.score(odd_docs.limit(0), model).collect() == []


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    fold = labels.withColumn("f", labels.doc_id % 3)
    model = q.fit(docs, fold.where("f > 0"))
    rows = q.score(docs, model).join(fold.where("f = 0").select("doc_id", "quality"), "doc_id").collect()
    hit = np.mean([(r.good_prob >= q.KEEP_AT) == bool(r.quality) for r in rows])
    assert hit > 0.93


def test_one_class_or_no_labels(spark, tables):
    docs, labels = tables
    none = q.fit(docs, labels.limit(0))
    assert none.probability(np.array([none.intercept]))[0] > 0.99
    bad = q.fit(docs, labels.where("quality = 0"))
    assert bad.probability(np.array([bad.intercept]))[0] < 0.01


def test_platt_is_calibrated():
    rng = np.random.default_rng(1)
    m = rng.normal(size=4000) * 3
    y = (rng.random(4000) < 1 / (1 + np.exp(-(0.5 * m - 1)))).astype(float)
    slope, offset = q.platt(m, y)
    assert abs(slope - 0.5) < 0.06 and abs(offset + 1) < 0.15
