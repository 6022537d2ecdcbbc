"""Infinities, NaN, far values, constant columns: one answer on every path."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from attrition.functions.exprs import clip, r6, truncate
from attrition.operators import models as ml
from attrition.operators import profile, rfm, scoring, selection
from attrition.sources import samples

NAN, INF = float("nan"), float("inf")


def _frame(spark, values, kind="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"customer_id long, x {kind}")


def _bins(df):
    return [r["b"] for r in df.orderBy("customer_id").collect()]


DOUBLES = {
    "nan": [*map(float, range(20)), NAN],
    "infinities": [*map(float, range(20)), INF, -INF, INF],
    "mostly odd": [NAN] * 9 + [INF] * 8 + [-INF] * 7 + [1.0],
    "zeros": [0.0, -0.0] * 9 + [1.0, -1.0],
    "far": [1.7e308, -1.7e308, 1e-308, -1e-308, 0.0, 5e-324, 1.0, 2.0, 3.0],
    "ties": [5.0] * 30 + [6.0] * 2 + [None, None],
}


@pytest.mark.parametrize("name", DOUBLES)
@pytest.mark.parametrize("band,local", [(5_000_000, 10_000), (1, 2)])
def test_ranks_of_odd_doubles(spark, name, band, local, monkeypatch):
    monkeypatch.setattr(selection, "BAND_ROWS", band)
    monkeypatch.setattr(selection, "LOCAL_ROWS", local)
    df = _frame(spark, DOUBLES[name])
    window = rfm.qcut_by_rank(df, "x", 4, out="b", method="window")
    cuts = rfm.qcut_by_rank(df, "x", 4, out="b", method="cuts")
    assert _bins(window) == _bins(cuts)


def test_ranks_of_far_longs(spark):
    values = [-(2**63), 2**63 - 1, 2**62, 2**62 + 1, 2**62 + 2, -5, 0, 7, 2**53 + 1, 2**53]
    df = _frame(spark, values, "long")
    assert _bins(rfm.qcut_by_rank(df, "x", 5, out="b", method="window")) == _bins(rfm.qcut_by_rank(df, "x", 5, out="b", method="cuts"))
    found = selection.select_ranks(df, ["x"], lambda n: F.sequence(F.lit(1).cast("long"), n)).orderBy("rank").collect()
    assert [r["value"] for r in found] == sorted(values)


@pytest.mark.parametrize("band", [5_000_000, 50])
def test_selection_equals_sorting(spark, band, monkeypatch):
    monkeypatch.setattr(selection, "BAND_ROWS", band)
    rng = np.random.default_rng(1)
    n = 20_000
    pdf = pd.DataFrame({
        "customer_id": rng.permutation(n), "g": rng.choice(["a", "b", None], n, p=[0.6, 0.3, 0.1]),
        "x": np.round(rng.normal(size=n) ** 3, 2), "y": rng.integers(0, 5, n).astype(float)})
    df = spark.createDataFrame(pdf)
    found = selection.select_ranks(df, ["x", "y"], lambda m: selection.cut_ranks_expr(m, 7), by="g", id_col="customer_id").collect()
    assert len(found) == 3 * 2 * 6
    for r in found:
        rows = pdf[pdf["g"].isna()] if r["g"] is None else pdf[pdf["g"] == r["g"]]
        col = ["x", "y"][r["c"]]
        s = rows.sort_values([col, "customer_id"])
        at = s.iloc[r["rank"] - 1]
        tied = s[s[col] == at[col]]
        assert (r["n"], r["value"], r["id"], r["m"]) == (len(s), at[col], at["customer_id"], len(tied))
        assert tied.iloc[r["r"] - 1]["customer_id"] == r["id"]


def test_ids_of_a_value_that_holds_most_rows(spark, monkeypatch):
    monkeypatch.setattr(selection, "BAND_ROWS", 10)  # the ids are searched by sketch, too
    df = spark.range(3000).select((F.col("id") * 7 % 3001).alias("customer_id"), F.when(F.col("id") < 2900, 1.0).otherwise(2.0).alias("x"))
    assert _bins(rfm.qcut_by_rank(df, "x", 5, out="b", method="cuts")) == _bins(rfm.qcut_by_rank(df, "x", 5, out="b", method="window"))


def test_ids_of_many_tied_rows_are_searched_for(spark, monkeypatch):
    monkeypatch.setattr(selection, "TIED_ROWS", 10)
    df = spark.range(3000).select((F.col("id") * 7 % 3001).alias("customer_id"), (F.col("id") % 3).cast("double").alias("x"))
    assert _bins(rfm.qcut_by_rank(df, "x", 5, out="b", method="cuts")) == _bins(rfm.qcut_by_rank(df, "x", 5, out="b", method="window"))


@pytest.mark.parametrize("band", [1_000_000, 50])
def test_selection_sorts_no_rows_to_count_them(spark, band, monkeypatch):
    monkeypatch.setattr(selection, "BAND_ROWS", band)
    plans, kept = [], selection._kept

    def seen(state):
        plans.append(state._jdf.queryExecution().executedPlan().toString())
        return kept(state)

    monkeypatch.setattr(selection, "_kept", seen)
    df = spark.range(20_000).select(F.col("id").alias("customer_id"), F.pmod(F.col("id") * 7919, F.lit(5000)).cast("double").alias("x"))
    found = selection.select_ranks(df, ["x"], lambda n: selection.cut_ranks_expr(n, 5), id_col="customer_id").orderBy("k").collect()
    assert [r["value"] for r in found] == [999.0, 1999.0, 2999.0, 3999.0]
    assert len(plans) >= 4 and not any("SortAggregate" in p for p in plans)


def test_a_missed_bracket_is_searched_again(spark, monkeypatch):
    monkeypatch.setattr(selection, "MARGIN", 1e-9)
    monkeypatch.setattr(selection, "SKETCH_K", 8)  # far too coarse
    df = spark.range(5000).select(F.col("id").alias("customer_id"), F.pmod(F.col("id") * 7919, F.lit(5000)).cast("double").alias("x"))
    assert _bins(rfm.qcut_by_rank(df, "x", 5, out="b", method="cuts")) == _bins(rfm.qcut_by_rank(df, "x", 5, out="b", method="window"))


@pytest.mark.parametrize("method", ["percentile", "cuts"])
def test_describe_keeps_large_and_odd_values(spark, method):
    values = [2e13 + 0.5 * k for k in range(9)]
    r = profile.describe(_frame(spark, values), ["x"], method).first()
    s = pd.Series(values)
    assert (r["mean"], r["p25"], r["p50"], r["p75"]) == tuple([s.mean(), *s.quantile([0.25, 0.5, 0.75])])
    assert math.isclose(r["std"], s.std(), rel_tol=1e-9)
    r = profile.describe(_frame(spark, [1.0, 2.0, 3.0, INF, NAN]), ["x"], method).first()
    assert math.isnan(r["mean"]) and math.isnan(r["max"]) and r["min"] == 1.0 and r["p25"] == 2.0 and r["p50"] == 3.0


def test_histogram_of_odd_values(spark):
    rows = profile.histogram(_frame(spark, [0.0, 10.0, NAN, INF, -INF, None, 2e13]), ["x"], 2).collect()
    assert [(r["bin_lo"], r["bin_hi"], r["count"]) for r in rows] == [(0.0, 1e13, 2), (1e13, 2e13, 1)]
    rows = profile.histogram(_frame(spark, [NAN, INF]), ["x"], 2).collect()
    assert [(r["bin_lo"], r["count"]) for r in rows] == [(None, 0), (None, 0)]


def test_constant_column(spark):
    df = samples.sample_customers(spark, 50).withColumn("support_tickets", F.lit(0).cast("long"))
    scored = scoring.rule_score(df)
    assert scored.where("churn_probability IS NULL OR isnan(churn_probability)").count() == 0
    weights = {k: v for k, v in scoring.RULE_WEIGHTS.items() if k != "support_tickets"}
    want = scoring.rule_score(df, weights).orderBy("customer_id").collect()
    assert [r["churn_probability"] for r in scored.orderBy("customer_id").collect()] == pytest.approx([r["churn_probability"] for r in want])
    frozen = scoring.rule_score_frozen(df, scoring.fit_rule_stats(df)).orderBy("customer_id").collect()
    assert [r["churn_probability"] for r in frozen] == pytest.approx([r["churn_probability"] for r in want])
    one = df.limit(1)
    assert scoring.rule_score(one).first()["churn_probability"] == 0.5
    assert scoring.rule_score_frozen(one, scoring.fit_rule_stats(one)).first()["churn_probability"] == 0.5
    with pytest.raises(ValueError, match="no values"):
        scoring.fit_rule_stats(df.limit(0))
    for method in ("pairs", "gram"):
        got = {(r["col_a"], r["col_b"]): r["corr"] for r in profile.corr_long(df, ["age", "support_tickets"], method).collect()}
        assert got == {("age", "age"): 1.0, ("support_tickets", "support_tickets"): 1.0,
                       ("age", "support_tickets"): None, ("support_tickets", "age"): None}


def test_correlations_of_a_wide_table_with_nulls(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 200)) * np.logspace(0, 6, 200) + 1e6
    x[:, 1:] += x[:, :1]
    x[rng.random(x.shape) < 0.05] = np.nan
    pdf = pd.DataFrame(x, columns=[f"c {k}" for k in range(200)])
    df = spark.createDataFrame([tuple(None if math.isnan(v) else float(v) for v in r) for r in x], [f"`c {k}`".strip("`") for k in range(200)])
    got = profile.corr_long(df, df.columns).toPandas()
    assert len(got) == 200 * 200
    wide = got.pivot(index="col_a", columns="col_b", values="corr").loc[pdf.columns, pdf.columns].to_numpy()
    assert np.allclose(wide, pdf.corr().to_numpy(), atol=1e-9)
    # one value in common: no correlation
    few = spark.createDataFrame([(1.0, None), (2.0, 3.0), (None, 4.0)], "a double, b double")
    for method in ("pairs", "gram"):
        assert {r["corr"] for r in profile.corr_long(few, ["a", "b"], method).collect()} == {1.0, None}
    some = df.columns[:6]
    pairs, gram = (profile.corr_long(df.select(some), some, m).orderBy("col_a", "col_b").toPandas()["corr"] for m in ("pairs", "gram"))
    assert np.allclose(pairs, gram, atol=1e-9)


def test_expressions(spark):
    df = spark.createDataFrame([(v,) for v in (1.23456789, -2.5, 3e13, NAN, INF, -INF, None)], "x double")
    got = df.select(r6("x").alias("r"), clip(F.col("x"), -1, 2).alias("c"), truncate(F.col("x")).alias("t")).collect()
    r = [g["r"] for g in got]
    assert r[:3] == [1.234568, -2.5, 3e13] and math.isnan(r[3]) and r[4:] == [INF, -INF, None]
    assert [g["c"] for g in got] == [1.23456789, -1.0, 2.0, 2.0, 2.0, -1.0, None]
    assert [g["t"] for g in got] == [1, -2, 30_000_000_000_000, None, None, None, None]


def test_out_of_fold_predictions(spark, scratch):
    df = samples.sample_customers(spark, 400)
    cols = ["recency_days", "frequency", "age"]
    specs = ml.grid_specs("rf", {"n_estimators": [3, 5], "max_depth": [2]})
    assert [s.name for s in specs] == ["maxDepth=2,numTrees=3", "maxDepth=2,numTrees=5"]
    rows = ml.out_of_fold(df, specs, cols, 3, path=f"{scratch}/oof")
    assert rows.count() == 800 and rows.groupBy("setting_id", "customer_id").count().where("count > 1").count() == 0
    best, table = ml.grid_search(df, "rf", {"n_estimators": [3, 5], "max_depth": [2]}, cols, 3)
    pdf = rows.toPandas()
    for r in table.collect():
        f1 = []
        for _, g in pdf[pdf["setting_id"] == r["setting_id"]].groupby("fold"):
            tp = int(((g["actual"] == 1) & (g["predicted"] == 1)).sum())
            f1.append(2 * tp / max(int((g["actual"] == 1).sum() + (g["predicted"] == 1).sum()), 1))
        assert (r["mean_f1"], r["std_f1"]) == pytest.approx((np.mean(f1), np.std(f1)))
    top = table.orderBy(F.desc("mean_f1"), "setting_id").first()
    assert best.stages[-1].getNumTrees == int(top["setting"].split("numTrees=")[1])
