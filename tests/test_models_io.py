import os

import pytest
from pyspark.sql import functions as F

from attrition.operators import features as fe
from attrition.operators import models as ml
from attrition.operators import rfm
from attrition.operators import scoring
from attrition.operators import split as sp
from attrition.plans import flows
from attrition.schema import preset
from attrition.sources import files, samples, store
from attrition.streaming.scoring_stream import score_stream


def _prepared(spark, n=3000):
    return rfm.rfm_features(fe.ratio_features(samples.sample_customers(spark, n)))


def test_model_skill_and_roundtrip(spark, scratch):
    df = _prepared(spark)
    s = sp.split_stratified(df)
    tr, te = s.where("split = 'train'"), s.where("split = 'test'")
    cols = preset("F13")
    pm = ml.fit(tr, "lr", {}, cols)
    m = ml.evaluate(pm, te).first()
    majority = max(te.agg(F.avg("churned")).first()[0], 1 - te.agg(F.avg("churned")).first()[0])
    assert m["accuracy"] > majority + 0.1
    v1 = store.save_model(pm, scratch, "churn")
    v2 = store.save_model(pm, scratch, "churn")
    assert (v1, v2) == (1, 2)
    loaded = store.load_model(scratch, "churn")
    a = ml.score_frame(pm, te).orderBy("customer_id").collect()
    b = ml.score_frame(loaded, te).orderBy("customer_id").collect()
    assert a == b


def test_train_flow_gate(spark, scratch):
    res = flows.train(samples.sample_customers(spark, 2000), "rf", {"n_estimators": 20, "max_depth": 5},
                      model_base=scratch, name="m", gate_min=0.99)
    assert not res.passed and res.version is None
    res = flows.train(samples.sample_customers(spark, 2000), "rf", {"n_estimators": 20, "max_depth": 5},
                      model_base=scratch, name="m", gate_min=0.0)
    assert res.passed and res.version == 1
    out = flows.infer(samples.sample_customers(spark, 300, kind="unlabelled", first_id=10001), res.model, "v1")
    assert out.count() == 300 and set(out.columns) == {"customer_id", "churn_probability", "churn_predicted",
                                                       "model_version"}


def test_csv_roundtrip_and_receipt(spark, scratch):
    df = samples.sample_customers(spark, 500)
    path = os.path.join(scratch, "c.csv")
    files.write_table(df, path, "csv")
    back = files.read_customers(spark, path, "csv")
    assert back.dtypes == df.dtypes
    assert back.exceptAll(df).count() == 0
    scored = scoring.rule_score(df)
    receipt = files.write_predictions(scoring.score(scored), os.path.join(scratch, "pred"))
    assert receipt["record_count"] == 500
    assert receipt["high_risk_count"] == scored.where("churn_probability > 0.7").count()
    g = files.load_or_sample(spark, os.path.join(scratch, "missing.csv"), "narrow", 500)
    assert g.count() == 500


def test_materialize_hit_miss_expiry(spark, scratch):
    src = samples.sample_customers(spark, 200)
    derived = fe.spend_frequency_product(src)
    t1, hit1 = store.materialize(derived, scratch, {"v": 1}, ttl_s=3600, source=src)
    t2, hit2 = store.materialize(derived, scratch, {"v": 1}, ttl_s=3600, source=src)
    t3, hit3 = store.materialize(derived, scratch, {"v": 2}, ttl_s=3600, source=src)
    t4, hit4 = store.materialize(derived, scratch, {"v": 1}, ttl_s=-1, source=src)
    assert (hit1, hit2, hit3, hit4) == (False, True, False, False)
    assert t2.count() == 200


def test_stream_exactly_once(spark, scratch):
    base = samples.sample_customers(spark, 1000)
    fit_rows = base.where("customer_id <= 600")
    model = rfm.fit_rfm(fit_rows)
    stats = scoring.fit_rule_stats(fit_rows)
    inp, out, ck = (os.path.join(scratch, x) for x in ("in", "out", "ck"))
    base.where("customer_id <= 600").write.parquet(os.path.join(inp, "a"))
    # the source reads files directly under the folder
    import glob
    import shutil
    os.makedirs(os.path.join(scratch, "feed"))
    for i, f in enumerate(glob.glob(os.path.join(inp, "a", "*.parquet"))):
        shutil.copy(f, os.path.join(scratch, "feed", f"a{i}.parquet"))
    feed = os.path.join(scratch, "feed")
    score_stream(spark, feed, out, ck, rfm_model=model, rule_stats=stats, version="v1")
    assert spark.read.parquet(out).count() == 600
    score_stream(spark, feed, out, ck, rfm_model=model, rule_stats=stats, version="v1")
    assert spark.read.parquet(out).count() == 600
    base.where("customer_id > 600").write.parquet(os.path.join(inp, "b"))
    for i, f in enumerate(glob.glob(os.path.join(inp, "b", "*.parquet"))):
        shutil.copy(f, os.path.join(feed, f"b{i}.parquet"))
    score_stream(spark, feed, out, ck, rfm_model=model, rule_stats=stats, version="v1")
    res = spark.read.parquet(out)
    assert res.count() == 1000 and res.select("customer_id").distinct().count() == 1000


def test_csv_with_text_columns_and_any_column_order(spark, scratch):
    a = spark.createDataFrame([(1, 5, 2, "v1"), (2, 6, 3, "v1")], "customer_id long, total_orders long, frequency long, model_version string")
    a.coalesce(1).write.option("header", True).csv(os.path.join(scratch, "c"))
    a.select("model_version", "frequency", "customer_id", "total_orders").coalesce(1).write.mode("append").option("header", True).csv(
        os.path.join(scratch, "c"))
    back = files.read_customers(spark, os.path.join(scratch, "c"))
    assert back.columns == a.columns or set(back.columns) == set(a.columns)
    rows = back.select(a.columns)
    assert rows.schema == a.schema and sorted(map(tuple, rows.collect())) == sorted(map(tuple, a.union(a).collect()))
    bad = spark.createDataFrame([("x",)], "total_orders string")
    bad.coalesce(1).write.option("header", True).csv(os.path.join(scratch, "bad"))
    with pytest.raises(Exception):
        files.read_customers(spark, os.path.join(scratch, "bad")).collect()
    with pytest.raises(FileNotFoundError):
        os.makedirs(os.path.join(scratch, "none"))
        files.read_customers(spark, os.path.join(scratch, "none"))


def test_two_savers_get_two_versions(spark, scratch):
    from concurrent.futures import ThreadPoolExecutor

    pm = ml.fit(samples.sample_customers(spark, 200), "lr", {}, ["age", "frequency"])
    with ThreadPoolExecutor(4) as pool:
        got = sorted(pool.map(lambda _: store.save_model(pm, scratch, "m"), range(4)))
    assert len(set(got)) == 4
    assert store.load_model(scratch, "m", with_version=True)[1] == got[-1]


def test_no_cached_rows_are_left(spark):
    df = samples.sample_customers(spark, 400)
    s = sp.split_stratified(df)
    tr, te = s.where("split = 'train'"), s.where("split = 'test'")
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    cols = ["age", "frequency", "recency_days"]
    ml.compare(tr, te, [ml.Spec("lr"), ml.Spec("rf", {"n_estimators": 3, "max_depth": 2})], cols).collect()
    ml.cv_score(df, "lr", {}, cols, k=3)
    ml.grid_search(df, "rf", {"n_estimators": [2], "max_depth": [2]}, cols, k=2)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_forest_does_not_depend_on_the_partitions(spark):
    df = samples.sample_customers(spark, 12_000)
    cols = ["age", "frequency", "recency_days", "monetary_value"]
    a, b = (ml.fit(x, "rf", {"n_estimators": 5, "max_depth": 4}, cols) for x in (df.coalesce(1), df.repartition(7)))
    assert a.stages[-1].toDebugString.split("\n", 1)[1] == b.stages[-1].toDebugString.split("\n", 1)[1]


def test_checkpoint_folder_is_required_on_a_cluster(monkeypatch):
    from attrition.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_models_score_after_an_observed_write(spark, scratch):
    """A fitted model does not carry its training session to the tasks."""
    df = samples.sample_customers(spark, 200)
    files.write_predictions(scoring.score(scoring.rule_score(df)), os.path.join(scratch, "p"), fmt="parquet")
    for kind, params in (("lr", {}), ("rf", {"n_estimators": 2}), ("gbt", {"n_estimators": 2})):
        assert ml.score_frame(ml.fit(df, kind, params, ["age", "frequency"]), df).count() == 200


def test_large_training_frames_have_few_large_partitions(spark):
    rows = spark.range(250_000).withColumnRenamed("id", "customer_id")
    assert ml.spread(rows).rdd.getNumPartitions() == ml.TRAIN_FEW_PARTS
    assert ml.spread(rows, few=ml.SIDE_PARTS).rdd.getNumPartitions() == 3  # 100,000 rows each
    assert ml.spread(rows.limit(12_000)).rdd.getNumPartitions() == 3
    assert ml.spread(rows.limit(12_000), few=ml.SIDE_PARTS).rdd.getNumPartitions() == 2


def test_large_folds_are_fitted_one_after_another(spark, monkeypatch):
    asked = []
    pool = ml.cf.ThreadPoolExecutor
    monkeypatch.setattr(ml.cf, "ThreadPoolExecutor", lambda max_workers: asked.append(max_workers) or pool(max_workers=max_workers))
    df = samples.sample_customers(spark, 200)
    cols = ["recency_days", "frequency"]
    for most in (4_000_000, 200):
        monkeypatch.setattr(ml, "SIDE_ROWS", most)
        rows = ml.out_of_fold(df, [ml.Spec("rf", {"n_estimators": 2, "max_depth": 2})], cols, 2, parallelism=2)
        assert rows.count() == 200 and rows.select("fold").distinct().count() == 2
    assert asked == [2, 1]
