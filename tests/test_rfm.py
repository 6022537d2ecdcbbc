import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from attrition.operators import rfm


def frame(spark, values, ids=None):
    ids = ids or list(range(1, len(values) + 1))
    return spark.createDataFrame([(int(i), float(v)) for i, v in zip(ids, values)], "customer_id long, x double")


def ranks_bins(spark, values, method, ids=None):
    df = rfm.qcut_by_rank(frame(spark, values, ids), "x", 5, out="b", method=method)
    return [r["b"] for r in df.orderBy("customer_id").collect()]


def pandas_rank_qcut(values):
    s = pd.Series(values, dtype=float)
    return pd.qcut(s.rank(method="first"), q=5, labels=[1, 2, 3, 4, 5]).astype(int).tolist()


@pytest.mark.parametrize("method", ["window", "cuts"])
def test_seven_values(spark, method):
    assert ranks_bins(spark, [1, 2, 3, 4, 5, 6, 7], method) == [1, 1, 2, 3, 4, 5, 5]


@pytest.mark.parametrize("method", ["window", "cuts"])
def test_equal_values_ties_by_id(spark, method):
    vals = [3.0] * 10
    assert ranks_bins(spark, vals, method) == pandas_rank_qcut(vals)


@pytest.mark.parametrize("n", [2, 4, 5, 6, 13, 100, 257])
def test_rank_matches_pandas(spark, n):
    rng = np.random.default_rng(n)
    vals = rng.integers(0, 6, n).astype(float).tolist()
    expected = pandas_rank_qcut(vals)
    assert ranks_bins(spark, vals, "window") == expected
    assert ranks_bins(spark, vals, "cuts") == expected


def test_single_row_raises(spark):
    with pytest.raises(Exception, match="duplicate quantile edges"):
        ranks_bins(spark, [1.0], "window")
    with pytest.raises(rfm.DuplicateEdgesError):
        ranks_bins(spark, [1.0], "cuts")


def test_empty_input(spark):
    df = rfm.qcut_by_rank(frame(spark, []).where("false"), "x", 5, out="b", method="window")
    assert df.count() == 0


@pytest.mark.parametrize("n", [5, 50, 333])
def test_value_qcut_matches_pandas(spark, n):
    rng = np.random.default_rng(7 + n)
    vals = rng.integers(0, 1000, n).astype(float).tolist()
    expected = pd.qcut(pd.Series(vals), q=5, labels=[5, 4, 3, 2, 1]).astype(int).tolist()
    df = rfm.qcut_by_value(frame(spark, vals), "x", 5, out="b", reverse=True)
    assert [r["b"] for r in df.orderBy("customer_id").collect()] == expected


def test_duplicate_value_edges_raise(spark):
    vals = [0.0] * 10 + [1.0, 2.0, 3.0]
    with pytest.raises(ValueError):
        pd.qcut(pd.Series(vals), q=5)
    with pytest.raises(Exception, match="duplicate quantile edges"):
        rfm.qcut_by_value(frame(spark, vals), "x", 5, out="b").collect()


def test_hot_key_window_equals_cuts(spark):
    """A value holding a third of the rows is split across range partitions by id."""
    n = 3000
    df = spark.range(1, n + 1).select(
        F.col("id").alias("customer_id"),
        F.when(F.col("id") % 3 == 0, F.lit(7.0)).otherwise((F.col("id") * 7919 % 1000).cast("double")).alias("x"),
    )
    a = rfm.qcut_by_rank(df, "x", 5, out="b", method="window").select("customer_id", "b")
    b = rfm.qcut_by_rank(df, "x", 5, out="b", method="cuts").select("customer_id", "b")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    sizes = [r["count"] for r in a.groupBy("b").count().collect()]
    assert max(sizes) - min(sizes) <= 1


def test_exact_quantiles_match_percentile(spark):
    df = spark.range(1, 2001).select(F.col("id").alias("customer_id"), (F.col("id") * 37 % 101).cast("double").alias("x"),
                                     F.when(F.col("id") % 4 > 0, F.col("id") % 4).alias("g"), (F.col("id") * 7919 % 1009).alias("y"))
    levels = [0.0, 0.25, 0.5, 0.75, 1.0]
    p = F.array(*[F.lit(v) for v in levels])
    got = rfm.exact_quantiles(df, ["x", "y"], levels)
    ref = df.select(F.percentile("x", p), F.percentile("y", p)).first()
    assert got[None, "x"] == pytest.approx(ref[0], abs=1e-12) and got[None, "y"] == pytest.approx(ref[1], abs=1e-12)
    got = rfm.exact_quantiles(df, ["x", "y"], levels, by="g")
    for r in df.groupBy("g").agg(F.percentile("x", p).alias("x"), F.percentile("y", p).alias("y")).collect():
        assert got[r["g"], "x"] == pytest.approx(r["x"], abs=1e-12) and got[r["g"], "y"] == pytest.approx(r["y"], abs=1e-12)
    assert len(got) == 8 and rfm.exact_quantiles(df.limit(0), ["x"], levels) == {}


@pytest.mark.parametrize("method", ["window", "cuts"])
def test_nulls_have_no_rank(spark, method):
    vals = [None] * 4 + [float(v) for v in range(1, 11)]
    df = spark.createDataFrame(list(enumerate(vals)), "customer_id long, x double")
    got = [r["b"] for r in rfm.qcut_by_rank(df, "x", 5, out="b", method=method).orderBy("customer_id").collect()]
    assert got == [None] * 4 + pandas_rank_qcut(vals[4:])


def test_frozen_bins_keep_their_shares_on_ties(spark):
    n = 5000
    df = spark.range(n).select(F.col("id").alias("customer_id"), F.col("id").alias("recency_days"),
                               F.when(F.col("id") % 10 < 7, F.col("id") % 3).otherwise(F.col("id") % 9).alias("frequency"),
                               (F.col("id") * 7919 % 1009).cast("double").alias("monetary_value"))
    for method in ("window", "cuts"):
        frozen = rfm.apply_rfm(df, rfm.fit_rfm(df, method=method))
        for c in ("f_score", "m_score"):
            sizes = {r[c]: r["count"] for r in frozen.groupBy(c).count().collect()}
            assert all(abs(sizes[b] / n - 0.2) < 0.02 for b in range(1, 6)), (c, sizes)


def test_frozen_rfm_on_same_batch(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({
        "customer_id": np.arange(1, 501),
        "recency_days": rng.integers(0, 400, 500),
        "frequency": rng.integers(0, 30, 500),
        "monetary_value": rng.gamma(2, 300, 500).round(2),
    })
    df = spark.createDataFrame(pdf)
    model = rfm.fit_rfm(df)
    a = rfm.apply_rfm(df, model).select("customer_id", "r_score").orderBy("customer_id").toPandas()
    b = rfm.rfm_features(df, method="window").select("customer_id", "r_score").orderBy("customer_id").toPandas()
    assert a["r_score"].tolist() == b["r_score"].tolist()
    assert set(model.to_dict()) == {"q", "recency_edges", "frequency_keys", "frequency_shares", "monetary_keys", "monetary_shares"}


@pytest.mark.parametrize("n", [7, 120])
def test_value_qcut_cuts_path(spark, n):
    rng = np.random.default_rng(11 + n)
    vals = rng.normal(100, 30, n).round(2).tolist()
    a = rfm.qcut_by_value(frame(spark, vals), "x", 5, out="b", method="percentile")
    b = rfm.qcut_by_value(frame(spark, vals), "x", 5, out="b", method="cuts")
    assert a.orderBy("customer_id").collect() == b.orderBy("customer_id").collect()


@pytest.mark.parametrize("n", [2, 7, 1000])
def test_fit_rank_cuts_window_equals_cuts(spark, n):
    # a third of the rows share one value, the rest have few distinct values
    df = spark.range(n).select(F.col("id").alias("customer_id"),
                               F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id") % 11).alias("frequency"))
    w = rfm.fit_rank_cuts(df, "frequency", method="window")
    c = rfm.fit_rank_cuts(df, "frequency", method="cuts")
    assert (w.n, w.keys, w.shares) == (c.n, c.keys, c.shares)
