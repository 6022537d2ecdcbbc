"""The sample of labelled rows: one row of each id, the same for any partitioning."""

from attrition.llm.labelled import labelled_sample


def test_one_row_of_each_id(spark):
    docs = spark.createDataFrame(
        [(1, "long text", 0), (1, "short", 0), (1, "short", 0), (2, None, 0), (2, "two", 0), (3, None, 0), (4, "four", 0), (None, "x", 0)],
        "doc_id long, text string, label int")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (3, 1), (None, 1), (9, 1), (4, None)], "doc_id long, quality int")
    want = {(1, "short", 1), (2, "two", 0), (3, None, 1)}
    for parts in (1, 5):
        got = labelled_sample(docs.repartition(parts), labels, 10)
        assert got.columns == ["doc_id", "text", "label"]
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert labelled_sample(docs, labels, 2).count() <= 2
