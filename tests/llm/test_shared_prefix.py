import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2

from attrition.llm import shared_prefix as m
from attrition.llm.queries import op1_sentencepiece

PATH = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"
ODD = [
    "hello world", "  two  spaces   here", "\n\nnew\tline ", "日本語 naïve", "a", "", None, " ", "aaaa aaaaa ''''' ----- ======",
    "    def f(x):\n        return x\n", "\x00\x01", "ĂĂ 🤗🤗 ﷽", "x" * 500, "ab" * 300, "word " * 2000,
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def same(enc, library, texts):
    flat, bounds = enc.encode(texts)
    for t, a, b in zip(texts, bounds[:-1], bounds[1:], strict=True):
        assert flat[a:b].tolist() == library.encode(t or ""), t


def test_bpe_equals_library(library):
    enc = m.Encoder(m.load(PATH)[1])
    same(enc, library, ODD)
    rng = random.Random(3)
    texts = ["".join(rng.choices("etaoin shrd\nE.é日", k=rng.randrange(60))) for _ in range(3000)]
    same(enc, library, texts)
    for t in ODD + texts:
        flat, bounds = enc.encode([t])
        assert enc.decode(flat[: bounds[1]]) == (t or "")


def test_cache_reset(library, monkeypatch):
    monkeypatch.setattr(m, "CACHE_WORDS", 5)
    monkeypatch.setattr(m, "PAIR_CACHE", 3)
    enc = m.Encoder(m.load(PATH)[1])
    for k in range(0, len(ODD), 3):
        same(enc, library, ODD[k : k + 3])


def test_unigram_equals_library():
    """The same pieces taken as a unigram model."""
    proto = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = m.UNIGRAM
    for i, p in enumerate(proto.pieces):  # multiples of 1/4096, whose float sums are exact
        p.score = -8 - ((i * 2654435761) % 16381) / 4096
    model = proto.SerializeToString()
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    rng = random.Random(4)
    texts = ["".join(rng.choices("etaoin shrd\nE.é日", k=rng.randrange(60))) for _ in range(1500)]
    same(m.Encoder(m.Pieces(model)), library, [*(t for t in ODD if t and len(t) < 400), *texts])


def test_query_restores_every_text(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op1_sentencepiece(spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        assert r.restored and r.n_pieces == len(r.pieces) and r.pieces == library.encode(docs[r.doc_id])


def test_odd_rows(spark, odd_docs, library):
    rows = m.encode(odd_docs, PATH).collect()
    assert len(rows) == odd_docs.count() and all(r.restored for r in rows)
    back = m.decode(m.encode(odd_docs, PATH), PATH).collect()
    texts = {(r.doc_id, r.text or "") for r in odd_docs.collect()}
    assert {tuple(r) for r in back} == texts
    wide = m.with_pieces(odd_docs.withColumn("pieces", F.lit("clash")), PATH)
    assert wide.columns == [*odd_docs.columns, "pieces", "restored"]
    assert all(r.pieces == library.encode(r.text or "") for r in wide.collect())
    assert m.encode(odd_docs.limit(0), PATH).collect() == []
    assert np.array(m.with_pieces(odd_docs.limit(0), PATH).collect()).size == 0


def test_long_runs_of_spaces(library):
    enc = m.Encoder(m.load(PATH)[1])
    texts = [" " * 20_000 + "word", "a" + " " * 20_001 + "b c", " " * 9_999, "\t" + " " * 5_000 + "x" * 5_000 + " " * 3]
    same(enc, library, texts)
