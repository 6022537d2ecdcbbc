import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from attrition.operators import metrics as me
from attrition.operators import profile as pr
from attrition.operators import scaling as sc
from attrition.operators import scoring


def test_constant_column_zscore_and_scaler(spark):
    df = spark.createDataFrame([(i, 5.0) for i in range(1, 6)], "customer_id long, x double")
    z = sc.zscore(df, ["x"]).select("x").collect()
    assert all(r["x"] == 0.0 for r in z)
    s = sc.standard_scale(df, ["x"]).select("x").collect()
    assert all(r["x"] == 0.0 for r in s)
    model = sc.fit_scaler(df, ["x"])
    assert model.scales == [1.0]


def test_histogram_constant_and_sum(spark):
    df = spark.createDataFrame([(i, 5.0, float(i)) for i in range(1, 101)], "customer_id long, c double, x double")
    h = pr.histogram(df, ["c", "x"], 30).toPandas()
    assert len(h) == 60
    assert h.groupby("column")["count"].sum().tolist() == [100, 100]
    assert h[(h.column == "c") & (h["count"] > 0)]["bin"].tolist() == [15]
    counts, _ = np.histogram(np.arange(1, 101), bins=30)
    assert h[h.column == "x"].sort_values("bin")["count"].tolist() == counts.tolist()


def test_describe_matches_pandas(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"customer_id": np.arange(1, 201), "a": rng.normal(10, 3, 200), "b": rng.integers(0, 9, 200)})
    d = pr.describe(spark.createDataFrame(pdf), ["a", "b"]).toPandas().set_index("column")
    ref = pdf[["a", "b"]].describe()
    for c in ["a", "b"]:
        assert d.loc[c, "mean"] == pytest.approx(ref.loc["mean", c], abs=1e-6)
        assert d.loc[c, "std"] == pytest.approx(ref.loc["std", c], abs=1e-6)
        assert d.loc[c, "p25"] == pytest.approx(ref.loc["25%", c], abs=1e-6)
        assert d.loc[c, "p75"] == pytest.approx(ref.loc["75%", c], abs=1e-6)


def test_null_counts_and_fill(spark):
    df = spark.createDataFrame([(1, None), (2, 3.0)], "customer_id long, x double")
    n = {r["column"]: r["null_count"] for r in pr.null_counts(df).collect()}
    assert n == {"customer_id": 0, "x": 1}
    from attrition.operators.features import drop_nulls, fill_zero
    assert [r["x"] for r in fill_zero(df).orderBy("customer_id").collect()] == [0.0, 3.0]
    assert drop_nulls(df).count() == 1


def test_only_negative_class(spark):
    df = spark.createDataFrame([(0, 0)] * 5, "actual long, predicted long")
    m = me.class_metrics(df).first()
    assert (m["precision"], m["recall"], m["f1"], m["accuracy"]) == (0.0, 0.0, 0.0, 1.0)
    cells = {(r["actual"], r["predicted"]): r["count"] for r in me.confusion(df).collect()}
    assert cells == {(0, 0): 5, (0, 1): 0, (1, 0): 0, (1, 1): 0}
    rep = {r["label"]: r for r in me.class_report(df).collect()}
    assert rep["1"]["support"] == 0 and rep["0"]["f1"] == 1.0


def test_thresholds_are_strict(spark):
    df = spark.createDataFrame([(1, 0.5), (2, 0.7), (3, 0.70001)], "customer_id long, churn_probability double")
    d = scoring.decide(df).orderBy("customer_id").collect()
    assert [r["churn_predicted"] for r in d] == [0, 1, 1]
    assert [r["customer_id"] for r in scoring.high_risk(df).collect()] == [3]


def test_best_run_tie_by_name(spark):
    t = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", 0.4)], "run_name string, f1 double")
    assert me.best_run(t).first()["run_name"] == "a"


def test_leaderboard_fallback(spark):
    per_split = spark.createDataFrame(
        [("r1", "test", 0.8, 0.0, 0.0, 0.0), ("r1", "train", 0.9, 0.5, 0.5, 0.5),
         ("r2", "test", 0.7, 0.6, 0.6, 0.6), ("r2", "train", 0.9, 0.9, 0.9, 0.9)],
        "run_name string, split string, accuracy double, precision double, recall double, f1 double")
    lb = {r["run_name"]: r for r in me.leaderboard(me.runs_table(per_split)).collect()}
    assert lb["r1"]["metric_type"] == me.TRAIN_FLAG and lb["r1"]["f1"] == 0.5
    assert lb["r2"]["metric_type"] == "test" and lb["r2"]["f1"] == 0.6


def test_metrics_by_run_one_scan(spark):
    df = spark.createDataFrame([(1, 0.9, 1), (2, 0.2, 0), (3, 0.6, 0)], "customer_id long, p double, churned long")
    long = me.long_predictions(df, [("t5", F.col("p") > 0.5), ("t8", F.col("p") > 0.8)], "churned", [])
    m = {r["run_name"]: r for r in me.metrics_by_run(long).collect()}
    assert m["t5"]["fp"] == 1 and m["t8"]["fp"] == 0 and m["t8"]["tp"] == 1
