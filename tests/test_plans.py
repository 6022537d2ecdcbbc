"""Physical-plan properties the scale design relies on (checked with explain)."""

import io
from contextlib import redirect_stdout

from attrition.operators import features as fe
from attrition.operators import rfm, scoring
from attrition.plans.catalog import QUERIES
from attrition.sources.testdata import customer_base

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_orders_scan_is_pruned_and_filtered(spark):
    p = plan(customer_base(spark, SF))
    orders = p[p.index("orders.parquet") - 400:p.index("orders.parquet") + 400]
    assert "LessThan(o_orderdate" in orders
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in orders
    # partial aggregation before the shuffle on the customer key
    assert p.count("HashAggregate") >= 4


def test_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["top10_risk"](spark, SF))


def test_scalar_statistics_are_subqueries_not_joins(spark):
    base = customer_base(spark, SF, materialize=True)
    p = plan(scoring.rule_score(base))
    assert "Subquery" in p and "Join" not in p


def test_boxplot_has_no_join(spark):
    assert "Join" not in plan(QUERIES["boxplot_by_churn"](spark, SF))


def test_cut_key_path_has_no_single_partition_window(spark):
    base = customer_base(spark, SF, materialize=True)
    p = plan(rfm.rfm_features(fe.ratio_features(base), method="cuts"))
    main = p.split("===== Subqueries =====")[0]
    # one-row statistics subqueries end in a single-partition merge of partial
    # aggregates; the rows themselves are never gathered in one partition
    assert "Window" not in main and "SinglePartition" not in main
    w = plan(rfm.rfm_features(fe.ratio_features(base), method="window"))
    assert "Window" in w


def test_split_is_row_local(spark):
    from attrition.operators import split as sp
    p = plan(sp.split_hash(customer_base(spark, SF, materialize=True)))
    assert "Exchange" not in p


def test_histogram_is_one_pass_without_join(spark):
    from attrition.operators import profile as pr
    from attrition.schema import BASE_FEATURES

    p = plan(pr.histogram(customer_base(spark, SF, materialize=True), BASE_FEATURES, 30))
    assert "Join" not in p
    # one pass of conditional counts: no shuffle on a bin key
    assert "hashpartitioning" not in p


def test_spread_layout_follows_the_rows(spark):
    from attrition.operators import models as ml

    small = spark.range(12_000).withColumnRenamed("id", "customer_id").coalesce(1)
    out = ml.spread(small, rows_per_part=5_000)
    assert out.rdd.getNumPartitions() == 3
    assert sorted(r[0] for r in out.collect()) == list(range(12_000))


def test_single_reader_queries_run_no_job_when_built(spark):
    tracker = spark.sparkContext.statusTracker()
    names = ["ratio_features", "spend_frequency_product", "column_info", "corr_matrix", "churn_rate", "split_hash", "first_100",
             "logistic_fixed", "shape", "churn_counts"]
    for name in names:
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        df = QUERIES[name](spark, SF)
        # schema inference reads a Parquet footer: no job of the query itself may run
        jobs = [j for j in tracker.getJobIdsForGroup(f"build-{name}") if (i := tracker.getJobInfo(j)) and len(i.stageIds) > 1]
        assert not jobs, name
    spark.sparkContext.setJobGroup("tests", "tests")
    p = plan(QUERIES["churn_rate"](spark, SF))
    assert "o_totalprice" not in p


def test_minimal_score_has_no_ranks(spark):
    p = plan(QUERIES["score_minimal"](spark, SF))
    assert "Window" not in p and "rangepartitioning" not in p


def test_selection_shuffles_counts_only(spark):
    """The selected paths never range-partition or gather the rows."""
    from attrition.operators import selection

    base = customer_base(spark, SF, materialize=True)
    found = selection.select_ranks(base, ["monetary_value", "total_orders"], lambda n: selection.cut_ranks_expr(n, 5), by="churned")
    assert "rangepartitioning" not in plan(found) and found.count() == 2 * 2 * 4
