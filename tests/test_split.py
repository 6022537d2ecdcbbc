import pytest
from pyspark.sql import functions as F

from attrition.operators import split as sp
from attrition.sources import samples


def test_split_is_partition_and_partitioning_free(spark):
    df = spark.range(1, 5001).select(F.col("id").alias("customer_id"), (F.col("id") % 4 == 0).cast("long").alias("churned"))
    a = sp.split_hash(df).select("customer_id", "split")
    b = sp.split_hash(df.repartition(7)).select("customer_id", "split")
    assert a.exceptAll(b).count() == 0
    assert a.count() == 5000
    share = a.where("split = 'test'").count() / 5000
    assert 0.17 < share < 0.23


def test_stratified_window_equals_cuts(spark):
    df = spark.range(1, 3001).select(F.col("id").alias("customer_id"), (F.col("id") % 3 == 0).cast("long").alias("churned"))
    a = sp.split_stratified(df, method="window")
    b = sp.split_stratified(df, method="cuts")
    assert a.exceptAll(b).count() == 0
    counts = {(r["churned"], r["split"]): r["count"] for r in a.groupBy("churned", "split").count().collect()}
    assert counts[(1, "test")] == 200 and counts[(0, "test")] == 400


@pytest.mark.parametrize("classes", [2, 7, 200])
def test_same_split_and_folds_on_both_paths(spark, classes):
    """Any number of classes, one of them null."""
    label = F.when(F.col("id") % classes > 0, F.col("id") % classes)
    df = spark.range(1, 2001).select(F.col("id").alias("customer_id"), label.alias("churned"))
    for f in (lambda m: sp.split_stratified(df, method=m), lambda m: sp.add_fold(df, 5, label="churned", method=m)):
        a, b = f("window"), f("cuts")
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.columns == df.columns + a.columns[-1:]


@pytest.mark.parametrize("method", ["window", "cuts"])
def test_folds_balanced(spark, method):
    df = spark.range(1, 1001).select(F.col("id").alias("customer_id"), (F.col("id") % 5 == 0).cast("long").alias("churned"))
    f = sp.add_fold(df, 5, label="churned", method=method)
    rows = f.groupBy("fold", "churned").count().collect()
    for label in (0, 1):
        sizes = [r["count"] for r in rows if r["churned"] == label]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_many_states_are_kept_in_the_shared_folder(spark, monkeypatch):
    from attrition.operators import selection

    df = spark.range(1, 501).select(F.col("id").alias("customer_id"), (F.col("id") % 7).alias("churned"))
    want = sp.add_fold(df, 3, label="churned", method="window")
    monkeypatch.setattr(selection, "LOCAL_ROWS", 2)
    got = sp.add_fold(df, 3, label="churned", method="cuts")
    assert want.exceptAll(got).count() == 0


def test_empty_and_tiny_tables(spark):
    df = spark.range(1, 4).select(F.col("id").alias("customer_id"), F.lit(1).alias("churned"))
    for m in ("window", "cuts"):
        assert sp.split_stratified(df.limit(0), method=m).count() == 0
        assert sp.add_fold(df.limit(0), 5, label="churned", method=m).count() == 0
        assert sp.split_stratified(df, method=m).where("split = 'test'").count() == 1
        assert sp.add_fold(df, 5, label="churned", method=m).select("fold").distinct().count() == 3


def test_sample_frames(spark):
    a = samples.sample_customers(spark, 3000)
    b = samples.sample_customers(spark, 3000).repartition(5)
    assert a.exceptAll(b).count() == 0
    pdf = a.toPandas()
    assert pdf.customer_id.is_unique and (pdf.recency_days <= pdf.days_since_signup).all() and (pdf.total_orders >= 1).all()
    assert 0.2 < pdf.churned.mean() < 0.8 and pdf.corr().loc["recency_days", "churned"] > 0.15
    assert "churned" not in samples.sample_customers(spark, 10, kind="unlabelled").columns
    assert samples.sample_customers(spark, 10, kind="narrow").columns == samples.NARROW
    with pytest.raises(ValueError):
        samples.sample_customers(spark, 1, kind="other")
    assert samples.inline_five(spark).count() == 5
