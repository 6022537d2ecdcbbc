"""Derived tables with dependencies, kept runs, published model versions, receipts."""

import datetime as dt
import os
import threading

import pytest
from pyspark.sql import functions as F

from attrition.operators import scoring
from attrition.sources import files, runs, samples, store
from attrition.sources.assets import Asset, AssetGraph, Source, listing_identity, newest_table
from attrition.streaming.scoring_stream import score_stream


def _graph(spark, root, over=1, version="1", ttl=None):
    return AssetGraph(
        spark, f"{root}/tables",
        [Source("a", f"{root}/a"), Source("b", f"{root}/b")],
        [
            Asset("both", ("left", "right"), lambda t, p: t["left"].join(t["right"], "id")),
            Asset("left", ("a",), lambda t, p: t["a"].where(F.col("id") > p["over"]), {"over": over}, version),
            Asset("right", ("b",), lambda t, p: t["b"]),
            Asset("count", ("right",), lambda t, p: t["right"].groupBy().count()),
        ])


def _write(spark, path, n):
    spark.range(n).write.mode("overwrite").parquet(path)


def _rebuilt(outcomes):
    return [o.name for o in outcomes if o.rebuilt]


def test_only_what_changed_is_rebuilt(spark, scratch):
    _write(spark, f"{scratch}/a", 10)
    _write(spark, f"{scratch}/b", 6)
    assert _graph(spark, scratch).stale() == ["left", "right", "both", "count"]
    assert _rebuilt(_graph(spark, scratch).materialize()) == ["left", "right", "both", "count"]
    assert _rebuilt(_graph(spark, scratch).materialize()) == []
    _write(spark, f"{scratch}/a", 20)
    assert _rebuilt(_graph(spark, scratch).materialize()) == ["left", "both"]
    assert _rebuilt(_graph(spark, scratch, over=3).materialize()) == ["left", "both"]
    assert _graph(spark, scratch, over=3).table("both").count() == 2
    # the tables of the earlier parameter are still there
    assert _rebuilt(_graph(spark, scratch).materialize()) == []
    assert _rebuilt(_graph(spark, scratch, version="2").materialize()) == ["left", "both"]
    _write(spark, f"{scratch}/b", 7)
    assert _rebuilt(_graph(spark, scratch).materialize(only=["count"])) == ["right", "count"]
    assert _graph(spark, scratch).stale() == ["both"]
    with pytest.raises(FileNotFoundError):
        _graph(spark, scratch).table("both")
    assert _rebuilt(_graph(spark, scratch).materialize(ttl_s=-1)) == ["left", "right", "both", "count"]


def test_half_written_tables_do_not_count(spark, scratch):
    _write(spark, f"{scratch}/a", 10)
    _write(spark, f"{scratch}/b", 6)
    out = {o.name: o for o in _graph(spark, scratch).materialize()}
    os.remove(f"{out['right'].path}/_SUCCESS")
    assert newest_table(spark, os.path.dirname(out["right"].path)) is None
    assert _rebuilt(_graph(spark, scratch).materialize()) == ["right"]


def test_graph_errors(spark, scratch):
    def bad(*assets):
        return AssetGraph(spark, scratch, [Source("s", scratch)], assets)

    with pytest.raises(ValueError, match="depend on each other"):
        bad(Asset("x", ("y",), None), Asset("y", ("x",), None))
    with pytest.raises(ValueError, match="unknown input"):
        bad(Asset("x", ("nowhere",), None))
    with pytest.raises(ValueError, match="same name"):
        bad(Asset("s", (), None))


def _jobs(spark, call):
    """Number of jobs that a call runs."""
    group = f"probe-{id(call)}"
    spark.sparkContext.setJobGroup(group, "probe")
    try:
        out = call()
    finally:
        spark.sparkContext.setJobGroup("", "")
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_identity_and_hit_run_no_job_over_the_source(spark, scratch):
    _write(spark, f"{scratch}/src", 100)
    first, jobs = _jobs(spark, lambda: listing_identity(spark, f"{scratch}/src"))
    assert jobs == 0 and first == listing_identity(spark, f"{scratch}/src")
    derived = spark.read.parquet(f"{scratch}/src").withColumn("x", F.col("id") * 2)
    _, hit = store.materialize(derived, f"{scratch}/kept", {"v": 1}, source_path=f"{scratch}/src")
    assert not hit
    (table, hit), jobs = _jobs(spark, lambda: store.materialize(derived, f"{scratch}/kept", {"v": 1}, source_path=f"{scratch}/src"))
    # reading the kept table's schema may run one job on its own footer
    assert hit and jobs <= 1 and table.count() == 100
    _write(spark, f"{scratch}/src", 101)
    assert listing_identity(spark, f"{scratch}/src") != first
    _, hit = store.materialize(spark.read.parquet(f"{scratch}/src"), f"{scratch}/kept", {"v": 1}, source_path=f"{scratch}/src")
    assert not hit


def _rows(spark, names, f1, start, tags=None):
    table = spark.createDataFrame([(n, f, None if n == "none" else 0.5) for n, f in zip(names, f1, strict=True)],
                                  "run_name string, f1 double, accuracy double")
    return runs.run_rows(table, ["f1", "accuracy"], "e", start, tags=tags)


def test_runs_are_appended_and_pruned(spark, scratch):
    day = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    start = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    assert runs.read_runs(spark, f"{scratch}/none").count() == 0
    runs.log_runs(_rows(spark, ["a", "b"], [0.5, None], start[0], {"who": "x"}), scratch, day[0])
    runs.log_runs(_rows(spark, ["c", "none"], [0.7, 0.1], start[1]), scratch, day[1])
    runs.log_runs(_rows(spark, ["a"], [0.9], start[0], {"who": "x"}), scratch, day[2])  # the first run logged again
    got = {r.run_name: r for r in runs.read_runs(spark, scratch).collect()}
    assert set(got) == {"a", "b", "c", "none"} and got["a"].metrics == {"f1": 0.9, "accuracy": 0.5}
    assert got["b"].metrics == {"accuracy": 0.5} and got["none"].metrics == {"f1": 0.1} and got["c"].tags is None
    assert got["a"].run_date == day[2] and got["a"].tags == {"who": "x"}
    assert {r.run_name for r in runs.read_runs(spark, scratch, since=day[1], until=day[1]).collect()} == {"c", "none"}
    only = runs.read_runs(spark, scratch, until=day[0])
    assert all("run_date=2024-01-01" in f for f in only.inputFiles())
    best = {r.who: r for r in runs.best_by_tag(runs.read_runs(spark, scratch), "who", default="?").collect()}
    assert (best["x"].runs, best["x"].best_f1, best["x"].best_run) == (2, 0.9, "a")
    assert (best["?"].runs, best["?"].best_run) == (2, "c")


def test_half_written_batches_and_two_writers(spark, scratch):
    day, start = dt.date(2024, 1, 1), dt.datetime(2024, 1, 1)
    path = runs.log_runs(_rows(spark, ["lost"], [0.1], start), scratch, day)
    os.remove(f"{path}/_SUCCESS")
    writers = [threading.Thread(target=lambda k=k: runs.log_runs(_rows(spark, [f"w{k}"], [0.2], start), scratch, day)) for k in range(4)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert {r.run_name for r in runs.read_runs(spark, scratch).collect()} == {f"w{k}" for k in range(4)}


def test_unpublished_model_versions_are_not_loaded(spark, scratch):
    from attrition.operators import models as ml

    df = samples.sample_customers(spark, 300)
    pm = ml.fit(df, "lr", {"max_iter": 5}, ["age", "frequency"])
    assert [store.save_model(pm, scratch, "m") for _ in range(2)] == [1, 2]
    os.remove(f"{scratch}/m/version=2/{store.COMMITTED}")
    _, version = store.load_model(scratch, "m", with_version=True)
    assert version == 1
    os.makedirs(f"{scratch}/m/version=7/metadata")  # a saver that died early
    assert store.load_model(scratch, "m", with_version=True)[1] == 1
    with pytest.raises(FileNotFoundError, match="not published"):
        store.load_model(scratch, "m", 2)
    assert store.save_model(pm, scratch, "m") == 8
    assert store.load_model(scratch, "m", with_version=True)[1] == 8


def test_receipt_counts_in_one_pass(spark, scratch):
    df = scoring.score(scoring.rule_score(samples.sample_customers(spark, 500)))
    receipt = files.write_predictions(df, f"{scratch}/p", fmt="parquet")
    back = spark.read.parquet(f"{scratch}/p")
    assert receipt["record_count"] == back.count() == 500
    assert receipt["high_risk_count"] == back.where("churn_probability > 0.7").count()
    empty = files.write_predictions(df.limit(0), f"{scratch}/e", fmt="parquet")
    assert (empty["record_count"], empty["high_risk_count"]) == (0, 0)


def test_headers_are_read_without_a_job(spark, scratch):
    big = "customer_id,age\n" + "".join(f"{k},{k % 50}\n" for k in range(200_000))
    for name, text in (("a.csv", big), ("b.csv", "age,customer_id\n7,900001\n"), ("empty.csv", "")):
        with open(f"{scratch}/{name}", "w", encoding="utf-8") as f:
            f.write(text)
    found, jobs = _jobs(spark, lambda: files._headers(spark, scratch))
    assert jobs == 0 and set(found) == {("customer_id", "age"), ("age", "customer_id")}
    rows = files.read_customers(spark, scratch)
    assert rows.count() == 200_001
    assert rows.where("customer_id = 900001").first()["age"] == 7


def test_stream_scores_new_customers_only(spark, scratch):
    base = samples.sample_customers(spark, 60).cache()
    stats = scoring.fit_rule_stats(base)
    args = dict(rule_stats=stats, new_only=True)

    def deliver(rows):
        rows.write.mode("append").parquet(f"{scratch}/in")
        score_stream(spark, f"{scratch}/in", f"{scratch}/out", f"{scratch}/state", **args)
        return [r.customer_id for r in spark.read.parquet(f"{scratch}/out").collect()]

    first = deliver(base.where("customer_id <= 20"))
    assert sorted(first) == list(range(1, 21))
    assert sorted(deliver(base.where("customer_id <= 20"))) == sorted(first)  # delivered again: nothing new
    assert sorted(deliver(base.union(base))) == list(range(1, 61))
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) != "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
