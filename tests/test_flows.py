from pyspark.sql import functions as F

from attrition.operators import features as fe
from attrition.operators import metrics as me
from attrition.operators import models as ml
from attrition.operators import scaling as sc
from attrition.plans import flows
from attrition.schema import preset
from attrition.sources import samples


def test_inline_five_exercise_flow(spark):
    """Five literal rows -> z-score of every numeric column -> preset F2 -> forest."""
    raw = samples.inline_five(spark)
    prep = sc.zscore_all_numeric(raw)
    assert {"age_normalized", "monetary_normalized", "churn_normalized"} <= set(prep.columns)
    cols = fe.pick_columns(prep, preset("F2"))
    assert cols == ["age_normalized", "monetary_normalized"]
    assert fe.pick_columns(raw, ["nope"], exclude=("customer_id", "churn")) == ["age", "monetary", "frequency"]
    x = fe.fill_zero(prep, cols)
    pm = ml.fit(x, "rf", {"n_estimators": 100, "max_depth": 5}, cols, label="churn")
    assert ml.predict(pm, x).count() == 5
    z = {r["customer_id"]: r["age_normalized"] for r in prep.collect()}
    ages = [25, 30, 45, 22, 50]
    mean = sum(ages) / 5
    std = (sum((a - mean) ** 2 for a in ages) / 4) ** 0.5
    assert abs(z[3] - (45 - mean) / (std + 1e-8)) < 1e-12


def test_missing_label_becomes_zeros(spark):
    df = samples.sample_customers(spark, 50, kind="unlabelled", first_id=10001)
    assert fe.with_label(df).agg(F.sum("churned")).first()[0] == 0


def test_profile_flow_tables(spark):
    tables = flows.profile(samples.sample_customers(spark, 800))
    assert set(tables) == {"shape", "column_info", "describe", "churn_counts", "churn_share", "null_counts",
                           "histogram", "boxplot", "corr", "churn_rate"}
    assert tables["shape"].first()["n_rows"] == 800
    assert tables["histogram"].agg(F.sum("count")).first()[0] == 800 * 8
    assert tables["corr"].count() == 9 * 9


def test_compare_runs_flow(spark):
    df = samples.sample_customers(spark, 600)
    scored = df.withColumn("split", F.when(F.col("customer_id") % 5 == 0, "test").otherwise("train"))
    long = me.long_predictions(scored, [("recency_gt_60", F.col("recency_days") > 60),
                                        ("never", F.lit(False))], "churned", ["split"])
    board, best = flows.compare_runs(me.metrics_by_run(long, by=["split"]))
    rows = {r["run_name"]: r for r in board.collect()}
    assert rows["never"]["metric_type"] == me.TRAIN_FLAG
    assert best.first()["run_name"] == "recency_gt_60"


def test_cv_summary_band(spark):
    folds = spark.createDataFrame([(0, 0.7), (1, 0.8), (2, 0.9)], "fold long, accuracy double")
    r = ml.cv_summary(folds).first()
    assert abs(r["mean"] - 0.8) < 1e-12
    sd = (((0.1 ** 2) * 2) / 3) ** 0.5
    assert abs(r["std"] - sd) < 1e-12 and abs(r["high"] - (0.8 + 2 * sd)) < 1e-12


def test_predicted_at_is_one_stamp_per_batch(spark):
    import datetime as dt

    from attrition.operators import scoring
    df = samples.sample_customers(spark, 300)
    stamp = dt.datetime(2024, 1, 2, 3, 4, 5)
    out = scoring.score(scoring.rule_score(df), version="v7", predicted_at=stamp)
    assert out.columns == ["customer_id", "churn_probability", "churn_predicted", "model_version", "predicted_at"]
    assert out.select("predicted_at").distinct().count() == 1
    assert out.select("model_version").distinct().first()[0] == "v7"


def test_prepare_materialised_and_frozen(spark, scratch):
    from attrition.operators import rfm
    df = samples.sample_customers(spark, 400)
    a = flows.prepare(df, store_base=scratch)
    b = flows.prepare(df, store_base=scratch)
    assert a.count() == 400 and sorted(a.collect()) == sorted(b.collect())
    model = rfm.fit_rfm(df)
    frozen = flows.prepare(samples.sample_customers(spark, 200, seed=7), rfm_model=model)
    assert frozen.where("rfm_score < 3 OR rfm_score > 15").count() == 0
