import itertools
import zlib

import numpy as np
import pytest

from attrition.llm import crf_language as c
from attrition.llm.queries import op10_language_id

SF = "/root/testdata/sf0.01"


def brute_marginals(model, emit):
    """Enumerate all label paths of one sequence."""
    n, k = emit.shape
    out, total = np.zeros((n, k)), 0.0
    for path in itertools.product(range(k), repeat=n):
        s = model.start[path[0]] + sum(emit[i, y] for i, y in enumerate(path))
        s += sum(model.trans[a, b] for a, b in itertools.pairwise(path))
        p = np.exp(s)
        total += p
        for i, y in enumerate(path):
            out[i, y] += p
    return out / total


def test_marginals_equal_enumeration(monkeypatch):
    monkeypatch.setattr(c, "BLOCK", 3)
    rng = np.random.default_rng(3)
    model = c.Crf(["a", "b", "c"], np.zeros((c.DIM, 3), np.float32), rng.normal(size=3), rng.normal(size=(3, 3)))
    lengths = [1, 0, 3, 7, 4, 8, 0, 2]
    emit = rng.normal(size=(sum(lengths), 3)) * 2
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    got = model.marginals(emit, bounds)
    for a, b in itertools.pairwise(bounds):
        if b > a:
            assert np.allclose(got[a:b], brute_marginals(model, emit[a:b]))


@pytest.fixture(scope="module")
def model():
    en = ["the house is on the hill and the river", "they were walking to the old town with the dog"] * 20
    de = ["das haus ist auf dem berg und der fluss", "sie gingen mit dem hund in die alte stadt"] * 20
    return c.train(en + de, ["en"] * 40 + ["de"] * 40)


def test_code_switched_text(spark, model):
    docs = spark.createDataFrame([(1, "the old house is on the hill der hund ist in der stadt und dem fluss")], "doc_id long, text string")
    spans = sorted(c.label_spans(docs, model).collect(), key=lambda r: r.start_byte)
    assert [s.lang for s in spans] == ["en", "de"] and [s.n_words for s in spans] == [7, 9]


def test_odd_rows(spark, odd_docs, model):
    rows = c.predict(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    by = {r.doc_id: r for r in rows}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (2, 3, 4))
    assert by[1].lang_pred == "en" and 0.5 < by[6].score <= 1
    assert c.predict(odd_docs.limit(0), model).collect() == []
    none = c.fit(odd_docs.withColumn("lang", odd_docs.score.substr(9, 1)).where("false"))
    assert {r.lang_pred for r in c.predict(odd_docs, none).collect()} == {"und"}


def test_query_held_out(spark):
    rows = op10_language_id(spark, SF).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(lang)
    hits = []
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
        if r.held_out:
            hits.append(r.lang_pred == lang[r.doc_id])
    assert np.mean(hits) > 0.97


def test_sample_is_bounded_and_rare_languages_are_learned(spark, monkeypatch):
    import attrition.llm.crf_language as crf

    taken = {}

    def train(texts, labels):
        taken["rows"] = list(zip(texts, labels, strict=True))
        return None

    monkeypatch.setattr(crf, "train", train)
    rows = [(i, f"common text {i}", "aa") for i in range(400)] + [(1000 + i, f"seltener Text {i}", "bb") for i in range(3)]
    rows += [(7, "x" * (crf.FIT_BYTES + 1), "cc"), (8, "same id", "aa"), (8, "same id", "aa"), (9, None, "aa"), (None, "no id", "dd")]
    crf.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows=60)
    assert len(taken["rows"]) == 60
    assert sum(lang == "bb" for _, lang in taken["rows"]) == 3
    assert all(len(t) <= crf.FIT_BYTES for t, _ in taken["rows"]) and {lang for _, lang in taken["rows"]} == {"aa", "bb"}
