import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline as cp
from attrition.llm import quality_rules
from tests.llm.test_decontaminate import brute as brute_leaks
from tests.llm.test_near_duplicates import brute as brute_near

SF = "/root/testdata/sf0.001"


def brute_cut(rows):
    """Texts without the characters whose bytes all lie in a 50-byte string of an earlier document."""
    first = {}
    for i, text in rows:
        data = text.encode()
        for p in range(len(data) - 49):
            w = data[p : p + 50]
            first[w] = min(first.get(w, i), i)
    out = []
    for i, text in rows:
        data, gone = text.encode(), set()
        for p in range(len(data) - 49):
            if first[data[p : p + 50]] < i:
                gone.update(range(p, p + 50))
        kept, at = [], 0
        for c in text:
            n = len(c.encode())
            if not gone.issuperset(range(at, at + n)):
                kept.append(c)
            at += n
        out.append((i, "".join(kept)))
    return out


def test_pipeline_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    good = {r.doc_id for r in quality_rules.score(docs, quality_rules.fit(docs, labels)).collect() if r.kept}
    rows = sorted((r.doc_id, r.text) for r in docs.collect() if r.doc_id in good)
    kept = {i for i, _, _, first in brute_near(rows, 5) if first}
    rows = brute_cut([r for r in rows if r[0] in kept])
    dirty = {r[0] for r in brute_leaks(rows, items)}
    rows = [r for r in rows if r[0] not in dirty]
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    got = cp.run(spark, SF)
    assert got.columns == [*docs.columns, "pieces", "restored"]
    found = sorted((r.doc_id, r.text, r.pieces, r.n_chars, r.restored) for r in got.collect())
    assert found == [(i, t, library.encode(t), len(t), True) for i, t in rows]
    assert 0 < len(found) < docs.count()


def test_stages_keep_columns_and_odd_rows(spark):
    rows = [
        (1, "Clean words of a fine text that says a thing or two about nothing much at all.", "en", "s", 78, "x"),
        (2, None, None, None, None, None),
        (3, "", "en", "s", 0, "x"),
        (None, "Another fine text without an id that has enough words to pass the first rules.", "en", "s", 79, "x"),
        (5, "Clean words of a fine text that says a thing or two about nothing much at all.", "en", "s", 78, "x"),
        (6, "tok " * 3000, "en", "s", 12000, "x"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, component_id string")
    for table in (df, df.limit(0), df.union(df)):
        docs = table
        for name, stage in cp.STAGES[1:]:
            docs = cp.materialize(stage(spark, docs, SF), name)
            assert docs.columns[: len(df.columns)] == df.columns
        ids = sorted(str(r.doc_id) for r in docs.collect())
        if table is df:
            assert ids == ["1", "2", "3", "6", "None"]
        assert name == "sentencepiece" and docs.where(~F.col("restored")).count() == 0
    kept = cp.quality(spark, df, SF)
    assert kept.schema == df.schema and cp.quality(spark, df.limit(0), SF).collect() == []
