import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from attrition.llm.queries import op8_token_counts
from attrition.llm.token_counts import PreTokenCounter, count_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library(text):
    return len(Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids)


def test_equals_library_on_odd_rows(spark, odd_docs):
    got = count_tokens(odd_docs, PATH).collect()
    assert len(got) == odd_docs.count()
    texts = {(r.doc_id, r.text) for r in odd_docs.collect()}
    want = sorted(((i, len((t or "").encode()), library(t)) for i, t in texts), key=str)
    assert sorted({tuple(r) for r in got}, key=str) == want


def test_empty_table(spark, odd_docs):
    assert count_tokens(odd_docs.limit(0), PATH).collect() == []


def test_query_equals_library_on_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in op8_token_counts(spark, sf).collect()}
    tok = Tokenizer.from_file(PATH)
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        n = len(tok.encode(r.text, add_special_tokens=False).ids)
        assert got.pop(r.doc_id) == (len(r.text.encode()), n, n > 1024)
    assert not got


def test_cache_reset_keeps_counts(monkeypatch):
    import attrition.llm.token_counts as tc

    monkeypatch.setattr(tc, "CACHE_SIZE", 3)
    c = PreTokenCounter(PATH, {" the": 1})
    texts = ["one two three four", " the the five six", "seven <|endoftext|><|endoftext|> eight"]
    for _ in range(2):
        assert c.counts(texts) == [library(t) for t in texts]
