"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query starts from the tables of ``sf_dir`` (through the customer base)
and runs over all of their rows.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrition.functions.exprs import clip, r6, truncate
from attrition.operators import features as fe
from attrition.operators import metrics as me
from attrition.operators import models as ml
from attrition.operators import profile as pr
from attrition.operators import rfm, scoring
from attrition.operators import scaling as sc
from attrition.operators import split as sp
from attrition.plans import flows
from attrition.schema import BASE_FEATURES, ID, LABEL, preset
from attrition.session import ensure_checkpoint_dir
from attrition.sources import assets, files, store
from attrition.sources import runs as kept
from attrition.sources.testdata import all_customers, customer_base
from attrition.streaming.scoring_stream import score_stream


def base_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base written once as Parquet, for queries that read it several times."""
    return customer_base(spark, sf_dir, materialize=True)


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn

    return deco


# -- shared stages ----------------------------------------------------------


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """L1 prepare: base -> ratio features -> RFM scores (batch-relative)."""
    return rfm.rfm_features(fe.ratio_features(base_table(spark, sf_dir)))


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    """Columns whose last bits depend on the order of aggregation, rounded for the comparison."""
    return df.withColumns({c: r6(c) for c in cols})


def decided(spark: SparkSession, sf_dir: str, with_rfm: bool = False) -> DataFrame:
    """The base scored by the churn rule (statistics fitted on it) and decided;
    with ratio features and RFM scores only for queries that return them."""
    base = base_table(spark, sf_dir)
    rows = rfm.rfm_features(fe.ratio_features(base)) if with_rfm else base
    return scoring.decide(scoring.rule_score(rows, fit_on=base))


# -- queries ----------------------------------------------------------------


@query("customer_base")
def qcustomer_base(spark, sf_dir):
    return customer_base(spark, sf_dir)


@query("ratio_features")
def q_ratio_features(spark, sf_dir):
    return fe.ratio_features(customer_base(spark, sf_dir)).select(
        ID, "recency_frequency_ratio", "monetary_per_order", "order_frequency", "support_per_order"
    )


@query("spend_frequency_product")
def q_spend_frequency_product(spark, sf_dir):
    return fe.spend_frequency_product(customer_base(spark, sf_dir)).select(ID, "expensive_feature")


@query("r_score")
def q_r_score(spark, sf_dir):
    return rfm.qcut_by_value(base_table(spark, sf_dir), "recency_days", 5, out="r_score", reverse=True).select(
        ID, "recency_days", "r_score"
    )


@query("f_score")
def q_f_score(spark, sf_dir):
    return rfm.qcut_by_rank(base_table(spark, sf_dir), "frequency", 5, out="f_score").select(
        ID, "frequency", "f_score"
    )


@query("m_score")
def q_m_score(spark, sf_dir):
    return rfm.qcut_by_rank(base_table(spark, sf_dir), "monetary_value", 5, out="m_score").select(
        ID, "monetary_value", "m_score"
    )


@query("rfm_features")
def q_rfm_features(spark, sf_dir):
    return features(spark, sf_dir)


@query("rule_score")
def q_rule_score(spark, sf_dir):
    return decided(spark, sf_dir).select(ID, r6("churn_probability").alias("churn_probability"), "churn_predicted")


@query("top10_risk")
def q_top10_risk(spark, sf_dir):
    """Flagship: the ten customers most at risk."""
    top = scoring.top_k(decided(spark, sf_dir, with_rfm=True), "churn_probability", 10)
    return top.select(ID, r6("churn_probability").alias("churn_probability"), "churn_predicted", "rfm_score")


# -- profile (A1-A10) ---------------------------------------------------------


DESCRIBED = ("mean", "std", "p25", "p50", "p75")
QUARTILE_COLS = ("q1", "median", "q3")
NULL_COLS = ["recency_days", "frequency", "monetary_value", "total_orders", "support_tickets"]


@query("shape")
def q_shape(spark, sf_dir):
    return pr.shape(customer_base(spark, sf_dir))


@query("column_info")
def q_column_info(spark, sf_dir):
    return pr.column_info(customer_base(spark, sf_dir))


@query("describe")
def q_describe(spark, sf_dir):
    base = base_table(spark, sf_dir)
    return rounded(pr.describe(base, base.columns), *DESCRIBED)


@query("churn_counts")
def q_churn_counts(spark, sf_dir):
    return pr.value_counts(customer_base(spark, sf_dir), LABEL)


@query("churn_share")
def q_churn_share(spark, sf_dir):
    return pr.value_counts(base_table(spark, sf_dir), LABEL, normalize=True)


@query("null_counts")
def q_null_counts(spark, sf_dir):
    return pr.null_counts(all_customers(spark, sf_dir))


@query("histogram_30")
def q_histogram_30(spark, sf_dir):
    return rounded(pr.histogram(base_table(spark, sf_dir), BASE_FEATURES, 30), "bin_lo", "bin_hi")


@query("boxplot_by_churn")
def q_boxplot_by_churn(spark, sf_dir):
    return rounded(pr.boxplot_stats(base_table(spark, sf_dir), BASE_FEATURES, LABEL), *QUARTILE_COLS)


@query("corr_matrix")
def q_corr_matrix(spark, sf_dir):
    base = customer_base(spark, sf_dir)
    return rounded(pr.corr_long(base, [c for c in base.columns if c != ID]), "corr")


@query("churn_rate")
def q_churn_rate(spark, sf_dir):
    return pr.churn_rate(customer_base(spark, sf_dir))


# -- nulls (P10, P11) ---------------------------------------------------------


@query("null_fill")
def q_null_fill(spark, sf_dir):
    return fe.fill_zero(all_customers(spark, sf_dir).select(ID, *NULL_COLS), NULL_COLS)


@query("drop_nulls")
def q_drop_nulls(spark, sf_dir):
    return fe.drop_nulls(all_customers(spark, sf_dir).select(ID, *NULL_COLS))


# -- normalisation (N1-N3) ----------------------------------------------------


@query("zscore_features")
def q_zscore_features(spark, sf_dir):
    cols = preset("F4")
    z = sc.zscore(base_table(spark, sf_dir), cols)
    return z.select(ID, *[r6(c).alias(c) for c in cols])


@query("zscore_all_numeric")
def q_zscore_all_numeric(spark, sf_dir):
    z = sc.zscore_all_numeric(base_table(spark, sf_dir))
    return z.select(*[r6(c).alias(c) if c.endswith("_normalized") else F.col(c) for c in z.columns])


@query("standard_scale_train")
def q_standard_scale_train(spark, sf_dir):
    split = sp.split_hash(base_table(spark, sf_dir))
    train, test = split.where("split = 'train'"), split.where("split = 'test'")
    scaled = sc.standard_scale(test, BASE_FEATURES, fit_on=train)
    return scaled.select(ID, *[r6(c).alias(c) for c in BASE_FEATURES])


# -- splits (T1-T4) -------------------------------------------------------------


@query("split_hash")
def q_split_hash(spark, sf_dir):
    return sp.split_hash(customer_base(spark, sf_dir)).select(ID, "split")


@query("split_stratified")
def q_split_stratified(spark, sf_dir):
    return sp.split_stratified(base_table(spark, sf_dir)).select(ID, LABEL, "split")


@query("fold_sizes")
def q_fold_sizes(spark, sf_dir):
    folds = sp.add_fold(base_table(spark, sf_dir), 5, label=LABEL)
    return folds.groupBy("fold", LABEL).agg(F.count(F.lit(1)).alias("n"))


@query("first_100")
def q_first_100(spark, sf_dir):
    return scoring.first_n(customer_base(spark, sf_dir), 100)


# -- scoring tables (P12-P17, R1-R5) --------------------------------------------


MODEL_VERSION = "rule-v1"
P = "churn_probability"


def scored_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decided rule scores + the fixed logistic score + the hash split."""
    return sp.split_hash(scoring.logistic_score(decided(spark, sf_dir, with_rfm=True), out="p_logistic"))


# Model comparison without MLlib: runs that the SQL oracle can rebuild.
RUNS = [
    ("rule_t30", lambda: F.col(P) > 0.3),
    ("rule_t50", lambda: F.col(P) > 0.5),
    ("rule_t70", lambda: F.col(P) > 0.7),
    ("rfm_low", lambda: F.col("rfm_score") <= 7),
    ("logistic_fixed", lambda: F.col("p_logistic") > 0.5),
    ("never", lambda: F.lit(False)),
]
RUN_PARAMS = {
    "rule_t30": {"model": "rule", "threshold": "0.3"},
    "rule_t50": {"model": "rule", "threshold": "0.5"},
    "rule_t70": {"model": "rule", "threshold": "0.7"},
    "rfm_low": {"model": "rfm", "max_score": "7"},
    "logistic_fixed": {"model": "logistic", "threshold": "0.5"},
    "never": {"model": "constant", "value": "0"},
}


def per_split_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    long = me.long_predictions(scored_runs(spark, sf_dir), [(n, f()) for n, f in RUNS], LABEL, ["split"])
    return me.metrics_by_run(long, by=["split"])


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return me.runs_table(per_split_metrics(spark, sf_dir), RUN_PARAMS)


def test_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    test = sp.split_hash(decided(spark, sf_dir)).where(F.col("split") == "test")
    return scoring.eval_table(test)


@query("logistic_fixed")
def q_logistic_fixed(spark, sf_dir):
    s = scoring.decide(scoring.logistic_score(customer_base(spark, sf_dir)))
    return s.select(ID, r6(P).alias(P), "churn_predicted")


@query("high_risk")
def q_high_risk(spark, sf_dir):
    return scoring.high_risk(decided(spark, sf_dir)).select(ID, r6(P).alias(P))


@query("high_risk_receipt")
def q_high_risk_receipt(spark, sf_dir):
    """The receipt of a real write of the predictions."""
    receipt = files.write_predictions(scoring.score(decided(spark, sf_dir)), _scratch(spark, "receipt"), fmt="parquet")
    return spark.createDataFrame([(receipt["record_count"], receipt["high_risk_count"])], "record_count long, high_risk_count long")


@query("score_with_actual")
def q_score_with_actual(spark, sf_dir):
    s = scoring.score(decided(spark, sf_dir), keep_actual=True)
    return s.withColumn(P, r6(P))


@query("score_versioned")
def q_score_versioned(spark, sf_dir):
    return scoring.score(decided(spark, sf_dir), version=MODEL_VERSION).withColumn(P, r6(P))


@query("score_minimal")
def q_score_minimal(spark, sf_dir):
    return scoring.minimal_predictions(decided(spark, sf_dir))


@query("status_labels")
def q_status_labels(spark, sf_dir):
    return scoring.status_label(decided(spark, sf_dir)).select(ID, "status")


@query("eval_table")
def q_eval_table(spark, sf_dir):
    return test_eval(spark, sf_dir).withColumn("probability", r6("probability"))


# -- metrics (A11-A15) and runs (K2-K6, M9) ---------------------------------------


@query("class_metrics")
def q_class_metrics(spark, sf_dir):
    return me.class_metrics(test_eval(spark, sf_dir))


@query("confusion")
def q_confusion(spark, sf_dir):
    return me.confusion(test_eval(spark, sf_dir))


@query("class_report")
def q_class_report(spark, sf_dir):
    return me.class_report(test_eval(spark, sf_dir))


@query("score_summary")
def q_score_summary(spark, sf_dir):
    return me.score_summary(scoring.score(decided(spark, sf_dir), keep_actual=True))


@query("metrics_by_run")
def q_metrics_by_run(spark, sf_dir):
    return per_split_metrics(spark, sf_dir)


@query("leaderboard")
def q_leaderboard(spark, sf_dir):
    return me.leaderboard(runs(spark, sf_dir))


@query("runs_query")
def q_runs_query(spark, sf_dir):
    r = me.runs_query(runs(spark, sf_dir), F.col("accuracy") > 0.5,
                      [F.col("f1").desc(), F.col("run_name").asc()], 5)
    return r.select("run_name", "accuracy", "f1")


@query("best_run")
def q_best_run(spark, sf_dir):
    return me.best_run(me.leaderboard(runs(spark, sf_dir)))


@query("quality_gate")
def q_quality_gate(spark, sf_dir):
    return me.quality_gate(runs(spark, sf_dir), "f1", 0.3).select("run_name", "f1", "passed")


# -- RFM on the distributed paths (W4, W5) ----------------------------------------


@query("rfm_cutkeys")
def q_rfm_cutkeys(spark, sf_dir):
    """Same scores as rfm_features, through selected cut keys."""
    return rfm.rfm_features(fe.ratio_features(base_table(spark, sf_dir)), method="cuts")


@query("rfm_frozen")
def q_rfm_frozen(spark, sf_dir):
    """Edges fitted on the training split, applied to the test split."""
    split = sp.split_hash(base_table(spark, sf_dir))
    model = rfm.fit_rfm(split.where(F.col("split") == "train"))
    test = split.where(F.col("split") == "test")
    return rfm.apply_rfm(test, model).select(ID, "r_score", "f_score", "m_score", "rfm_score")


@query("split_stratified_cuts")
def q_split_stratified_cuts(spark, sf_dir):
    """Stratified split through per-label cut keys (no per-label window)."""
    return sp.split_stratified(base_table(spark, sf_dir), method="cuts").select(ID, LABEL, "split")


@query("describe_cuts")
def q_describe_cuts(spark, sf_dir):
    """describe() with exact quartiles by selection."""
    base = base_table(spark, sf_dir)
    return rounded(pr.describe(base, base.columns, method="cuts"), *DESCRIBED)


# -- MLlib models and the stream; what SQL can recompute of them is in the *_checked queries -----------------


F13 = preset("F13")
# fixed values: model settings and the number of features kept
RF_DEFAULT = {"n_estimators": 100, "max_depth": 10}
GBT_DEFAULT = {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 3}
TOP_FEATURES = 8
# fixed values: the reference's search grid (2 x 3 x 3 settings, 5 folds, F1 of class 1)
GRID = {"n_estimators": [100, 200], "max_depth": [5, 10, 15], "min_samples_split": [2, 10, 20]}


CANDIDATES = [ml.Spec("lr", {}, "logistic_regression"), ml.Spec("rf", {"n_estimators": 50}, "random_forest"),
              ml.Spec("gbt", {"n_estimators": 50}, "gradient_boosting")]


def model_split(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Stratified train/test split of the features, checkpointed because every
    fit makes several passes over it."""
    s = sp.split_stratified(features(spark, sf_dir)).checkpoint(eager=True)
    return s.where(F.col("split") == "train"), s.where(F.col("split") == "test")


def _scores(spark, sf_dir, kind, params):
    train, test = model_split(spark, sf_dir)
    return ml.score_frame(ml.fit(train, kind, params, F13), test)


@query("lr_scores")
def q_lr_scores(spark, sf_dir):
    return _scores(spark, sf_dir, "lr", {"C": 1.0, "max_iter": 1000})


@query("rf_scores")
def q_rf_scores(spark, sf_dir):
    return _scores(spark, sf_dir, "rf", RF_DEFAULT)


@query("gbt_scores")
def q_gbt_scores(spark, sf_dir):
    return _scores(spark, sf_dir, "gbt", GBT_DEFAULT)


@query("candidate_compare")
def q_candidate_compare(spark, sf_dir):
    """Candidates trained concurrently, compared on the same test rows (best = first row)."""
    train, test = model_split(spark, sf_dir)
    table_ = ml.compare(train, test, CANDIDATES, F13, parallelism=3)
    return table_.orderBy(F.col("accuracy").desc(), F.col("order").asc())


@query("cv_accuracy")
def q_cv_accuracy(spark, sf_dir):
    return ml.cv_score(features(spark, sf_dir), "rf", RF_DEFAULT, F13, k=5)


@query("grid_search")
def q_grid_search(spark, sf_dir):
    train, _ = model_split(spark, sf_dir)
    _, table_ = ml.grid_search(train, "rf", GRID, F13, k=5, parallelism=8)
    return table_


@query("feature_importance")
def q_feature_importance(spark, sf_dir):
    train, _ = model_split(spark, sf_dir)
    return ml.importance_frame(spark, ml.fit(train, "rf", RF_DEFAULT, F13), F13)


@query("top8_retrain")
def q_top8_retrain(spark, sf_dir):
    """Retrain on the 8 most important features and compare with all features."""
    train, test = model_split(spark, sf_dir)
    full = ml.fit(train, "rf", RF_DEFAULT, F13)
    top8 = [f for f, _ in ml.feature_importance(full, F13)[:TOP_FEATURES]]
    small = ml.fit(train, "rf", RF_DEFAULT, top8)
    a = ml.evaluate(full, test).withColumn("run_name", F.lit("all_features"))
    b = ml.evaluate(small, test).withColumn("run_name", F.lit("top8:" + ",".join(top8)))
    return a.unionByName(b)


@query("stream_scores")
def q_stream_scores(spark, sf_dir):
    """The customer base as a folder of files, scored by an available-now stream
    with RFM edges and rule statistics frozen beforehand (without the time stamp)."""
    root = f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    customer_base(spark, sf_dir).write.parquet(f"{root}/in")
    frozen = spark.read.parquet(f"{root}/in")
    model = rfm.fit_rfm(frozen)
    stats = scoring.fit_rule_stats(frozen)
    score_stream(spark, f"{root}/in", f"{root}/out", f"{root}/ckpt", rfm_model=model, rule_stats=stats,
                 version=MODEL_VERSION)
    return spark.read.parquet(f"{root}/out").drop("predicted_at").withColumn(P, r6(P))


@query("boxplot_by_churn_cuts")
def q_boxplot_by_churn_cuts(spark, sf_dir):
    """Box-plot statistics with exact per-group quartiles from the cut-key path."""
    return rounded(pr.boxplot_stats(base_table(spark, sf_dir), BASE_FEATURES, LABEL, method="cuts"), *QUARTILE_COLS)


@query("r_score_cuts")
def q_r_score_cuts(spark, sf_dir):
    """r_score with edges by selection (for high-cardinality columns)."""
    return rfm.qcut_by_value(base_table(spark, sf_dir), "recency_days", 5, out="r_score", reverse=True,
                             method="cuts").select(ID, "recency_days", "r_score")


# -- one answer at every size: nulls, many groups ----------------------------------


@query("rfm_ranks_nulls")
def q_rfm_ranks_nulls(spark, sf_dir):
    """f and m bins over all customers: those without orders have null values and no bin."""
    rows = all_customers(spark, sf_dir).select(ID, "frequency", "monetary_value")
    f = rfm.qcut_by_rank(rows, "frequency", 5, out="f_score")
    return rfm.qcut_by_rank(f, "monetary_value", 5, out="m_score").select(ID, "f_score", "m_score")


MANY_GROUPS = 97


@query("boxplot_many_groups")
def q_boxplot_many_groups(spark, sf_dir):
    """Box-plot statistics of spend by more groups than are inlined, one of them null."""
    g = F.col(ID) % MANY_GROUPS
    rows = base_table(spark, sf_dir).withColumn("grp", F.when(g > 0, g))
    return rounded(pr.boxplot_stats(rows, ["monetary_value", "total_orders"], "grp"), *QUARTILE_COLS)


# -- flows and files ----------------------------------------------------------------


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query("csv_roundtrip")
def q_csv_roundtrip(spark, sf_dir):
    """The scored base with a text column, written as CSV and read back with its types."""
    path = _scratch(spark, "csv")
    rows = scoring.score(decided(spark, sf_dir), version=MODEL_VERSION, keep_actual=True)
    files.write_table(rows, path, "csv")
    kinds = {"churn_probability": T.DoubleType(), "churn_predicted": T.LongType(), "churn_actual": T.LongType()}
    return files.read_customers(spark, path, "csv", kinds).withColumn(P, r6(P))


@query("materialize_reuse")
def q_materialize_reuse(spark, sf_dir):
    """Ratio features kept under the identity of their input files; the second call reads the first's table."""
    store_dir, path = _scratch(spark, "store"), _scratch(spark, "base")
    customer_base(spark, sf_dir).write.parquet(path)
    feats = fe.ratio_features(spark.read.parquet(path))
    _, first = store.materialize(feats, store_dir, {"step": "ratios"}, source_path=path)
    again, second = store.materialize(feats, store_dir, {"step": "ratios"}, source_path=path)
    return again.select(ID, "monetary_per_order", F.lit(first).alias("first_hit"), F.lit(second).alias("second_hit"))


@query("flow_infer")
def q_flow_infer(spark, sf_dir):
    """Train, save, load the latest version, score, write with stamp and version, read back and check."""
    models_dir, out = _scratch(spark, "models"), _scratch(spark, "predictions")
    base = base_table(spark, sf_dir)
    flows.train(base, "lr", {}, model_base=models_dir, name="churn")
    receipt = flows.infer_saved(base, models_dir, "churn", out)
    rows = spark.read.parquet(out)
    stamps = rows.select(F.count_distinct("predicted_at")).scalar()
    return rows.select(
        ID,
        "model_version",
        (F.col(P).between(0, 1) & (F.col("churn_predicted") == (F.col(P) > 0.5).cast("long"))).alias("decision_ok"),
        stamps.alias("stamps"),
        F.lit(receipt["record_count"]).cast("long").alias("record_count"),
    )


@query("flow_train_gate")
def q_flow_train_gate(spark, sf_dir):
    """A gate that no model passes saves nothing; one that all pass saves version 1, then 2."""
    models_dir, base = _scratch(spark, "models"), base_table(spark, sf_dir)
    closed = flows.train(base, "lr", {}, model_base=models_dir, name="m", gate_min=1.1)
    opened = [flows.train(base, "lr", {}, model_base=models_dir, name="m", gate_min=0.0) for _ in range(2)]
    rows = [("closed", closed.passed, closed.version), *((f"open{i}", r.passed, r.version) for i, r in enumerate(opened))]
    return spark.createDataFrame(rows, "gate string, passed boolean, version long")


def _checked(scores: DataFrame, rows: DataFrame) -> DataFrame:
    """Scores against the rows they were made for: id, label, and whether probability and decision agree."""
    ok = F.col(P).between(0, 1) & (F.col("churn_predicted") == (F.col(P) > 0.5).cast("long"))
    return scores.select(ID, ok.alias("decision_ok")).join(rows.select(ID, LABEL), ID).select(ID, LABEL, "decision_ok")


@query("model_scores_checked")
def q_model_scores_checked(spark, sf_dir):
    """Each kind of model scores exactly the stratified test rows, and decides by its probability."""
    train, test = model_split(spark, sf_dir)
    out = None
    for kind, params in (("lr", {"C": 1.0, "max_iter": 1000}), ("rf", RF_DEFAULT), ("gbt", GBT_DEFAULT)):
        part = _checked(ml.score_frame(ml.fit(train, kind, params, F13), test), test).withColumn("kind", F.lit(kind))
        out = part if out is None else out.unionByName(part)
    return out


@query("lr_gradient_checked")
def q_lr_gradient_checked(spark, sf_dir):
    """At the fitted coefficients the gradient of the penalised log-loss vanishes (one row for each feature)."""
    train, _ = model_split(spark, sf_dir)
    pm = ml.fit(train, "lr", {"tol": 1e-9}, F13)
    return ml.lr_gradient(pm, train, F13).select("feature", (F.abs("gradient") < 1e-4).alias("vanishes"))


@query("importance_checked")
def q_importance_checked(spark, sf_dir):
    """Importances: one for each feature, none negative, summing to one."""
    train, _ = model_split(spark, sf_dir)
    imp = ml.importance_frame(spark, ml.fit(train, "rf", RF_DEFAULT, F13), F13)
    total = imp.select(F.sum("importance")).scalar()
    return imp.select("feature", (F.col("importance") >= 0).alias("not_negative"), (F.abs(total - 1) < 1e-9).alias("sums_to_one"))


def _recomputed(rows: DataFrame, base: DataFrame) -> DataFrame:
    """Accuracy and F1 of every (setting_id, fold) of an out-of-fold table, counted anew with the labels of ``base``."""
    joined = rows.drop("actual").join(base.select(ID, F.col(LABEL).alias("truth")), ID)
    both = F.count_if((F.col("truth") == 1) & (F.col("predicted") == 1))
    either = F.count_if(F.col("truth") == 1) + F.count_if(F.col("predicted") == 1)
    return joined.groupBy("setting_id", "fold").agg(
        F.count_distinct(ID).alias("n"), F.count_if(F.col("truth") == 1).alias("positives"),
        F.avg((F.col("truth") == F.col("predicted")).cast("double")).alias("accuracy_again"),
        F.coalesce(F.try_divide(2 * both, either), F.lit(0.0)).alias("f1_again"),
        F.min((F.col("predicted") == (F.col(P) > 0.5).cast("long")).cast("int")).alias("decided"))


@query("cv_checked")
def q_cv_checked(spark, sf_dir):
    """The folds of ``cv_accuracy`` at its own settings: sizes, and whether the metric is that of the stored predictions."""
    feats = features(spark, sf_dir)
    rows = ml.out_of_fold(feats, [ml.Spec("rf", RF_DEFAULT)], F13, 5)
    again = _recomputed(rows, feats)
    both = ml.fold_metrics(rows).select("setting_id", "fold", "accuracy").join(again, ["setting_id", "fold"])
    return both.select("fold", "n", "positives", (F.abs(F.col("accuracy") - F.col("accuracy_again")) < 1e-12).alias("accuracy_ok"))


@query("cv_band")
def q_cv_band(spark, sf_dir):
    """Mean accuracy over the stratified folds and its band of two standard deviations, for the churn rule's decisions."""
    folds = sp.add_fold(decided(spark, sf_dir), 5, label=LABEL)
    per = me.class_metrics(folds, LABEL, "churn_predicted", by=["fold"])
    return rounded(ml.cv_summary(per), "mean", "std", "low", "high")


@query("grid_checked")
def q_grid_checked(spark, sf_dir):
    """All 18 settings x 5 folds of the search: each metric recomputed from the stored predictions, and the table's means."""
    train, _ = model_split(spark, sf_dir)
    path = _scratch(spark, "grid")
    _, table_ = ml.grid_search(train, "rf", GRID, F13, k=5, parallelism=8, path=path)
    rows = spark.read.parquet(path)
    again = _recomputed(rows, train)
    means = again.groupBy("setting_id").agg(F.avg("f1_again").alias("mean_again"), F.stddev_pop("f1_again").alias("std_again"))
    out = again.join(table_, "setting_id").join(means, "setting_id")
    return out.select(
        F.col("setting_id").cast("long").alias("setting_id"), "setting", F.col("fold").cast("long").alias("fold"), "n", "positives",
        (F.abs(F.col("mean_f1") - F.col("mean_again")) < 1e-12).alias("mean_ok"),
        (F.abs(F.col("std_f1") - F.col("std_again")) < 1e-12).alias("std_ok"), (F.col("decided") == 1).alias("decided_ok"))


@query("compare_checked")
def q_compare_checked(spark, sf_dir):
    """The candidates of ``candidate_compare``: the cells of each confusion matrix add up to the test rows and labels."""
    train, test = model_split(spark, sf_dir)
    table_ = ml.compare(train, test, CANDIDATES, F13, parallelism=3)
    exact = (F.abs(F.col("accuracy") - (F.col("tp") + F.col("tn")) / F.col("n")) < 1e-12).alias("accuracy_ok")
    return table_.select("run_name", F.col("order").cast("long").alias("order"), "n", (F.col("tp") + F.col("fn")).alias("positives"), exact)


# -- kept runs, rebuilds, new customers, odd values -------------------------------------


RUN_METRICS = ["accuracy", "precision", "recall", "f1", "training_accuracy_score", "training_precision_score", "training_recall_score", "training_f1_score"]


def _logged(spark: SparkSession, sf_dir: str) -> str:
    """The runs logged in two batches, a day apart, the first of them twice; tags say how and whether the model needs scaling."""
    base, rows = _scratch(spark, "runs"), runs(spark, sf_dir).checkpoint()
    rule = F.col("run_name").startswith("rule_")
    tags = F.create_map(
        F.lit("logging_method"), F.when(rule, "auto").otherwise("manual"),
        F.lit("requires_scaling"), (F.col("run_name") == "logistic_fixed").cast("string"))
    for day, part in ((1, rows.where(rule)), (2, rows.where(~rule)), (3, rows.where(rule))):
        start = dt.datetime(2000, 8, 2 if day == 2 else 1)
        batch = kept.run_rows(part, RUN_METRICS, "churn", start, tags=tags)
        kept.log_runs(batch, base, dt.date(2000, 8, day))
    return base


@query("runs_history")
def q_runs_history(spark, sf_dir):
    """All kept runs with a test F1 above 0, best first: from three appended batches, one of which logs runs again."""
    r = kept.read_runs(spark, _logged(spark, sf_dir)).where(kept.metric("f1") > 0)
    r = me.runs_query(r, None, [kept.metric("f1").desc(), F.col("run_name").asc()], 10)
    return r.select(
        "run_name", kept.metric("f1").alias("f1"), kept.metric("accuracy").alias("accuracy"), kept.param("model").alias("model"),
        kept.tag("logging_method", "manual").alias("logging_method"), F.date_format("run_date", "yyyy-MM-dd").alias("run_date"))


@query("runs_by_tag")
def q_runs_by_tag(spark, sf_dir):
    """Runs of the first two days by a tag: how many, the best F1 and its run."""
    r = kept.read_runs(spark, _logged(spark, sf_dir), until=dt.date(2000, 8, 2))
    return kept.best_by_tag(r, "logging_method")


@query("rebuild_changed")
def q_rebuild_changed(spark, sf_dir):
    """Four runs over a graph of derived tables: all new, nothing changed, one input changed, one parameter changed."""
    root = _scratch(spark, "assets")
    base = base_table(spark, sf_dir)
    base.drop("support_tickets").write.parquet(f"{root}/in/customers")
    base.select(ID, "support_tickets").write.parquet(f"{root}/in/tickets")

    def graph(threshold: float) -> assets.AssetGraph:
        return assets.AssetGraph(
            spark, f"{root}/tables",
            [assets.Source("customers", f"{root}/in/customers"), assets.Source("tickets", f"{root}/in/tickets")],
            [
                assets.Asset("spend", ("customers",), lambda t, p: t["customers"].select(ID, "monetary_value", "total_orders")),
                assets.Asset("busy", ("tickets",), lambda t, p: t["tickets"].where("support_tickets > 0")),
                assets.Asset("large", ("spend",), lambda t, p: t["spend"].where(F.col("monetary_value") > p["over"]), {"over": threshold}),
                assets.Asset("watch", ("large", "busy"), lambda t, p: t["large"].join(t["busy"], ID)),
            ])

    def run(number: int, threshold: float) -> list[tuple]:
        return [(number, o.name, o.rebuilt, spark.read.parquet(o.path).count()) for o in graph(threshold).materialize()]

    rows = run(1, 1e5) + run(2, 1e5)
    base.select(ID, "support_tickets").where("support_tickets > 1").write.mode("overwrite").parquet(f"{root}/in/tickets")
    rows += run(3, 1e5) + run(4, 2e5)
    return spark.createDataFrame(rows, "run long, asset string, rebuilt boolean, n_rows long")


@query("stream_new_customers")
def q_stream_new_customers(spark, sf_dir):
    """Two deliveries scored by a saved model: the training rows, then all customers; each is scored when it is new."""
    root = _scratch(spark, "stream")
    base = sp.split_hash(base_table(spark, sf_dir))
    train = base.where("split = 'train'").drop("split")
    flows.train(train, "lr", {}, model_base=f"{root}/models", name="churn")
    edges = rfm.fit_rfm(train)
    for delivery, rows in ((1, train), (2, base.drop("split"))):
        rows.write.mode("append").parquet(f"{root}/in")
        pm, version = store.load_model(f"{root}/models", "churn", with_version=True)
        score_stream(spark, f"{root}/in", f"{root}/out", f"{root}/state", edges, pm, version=f"churn-v{version}", new_only=True)
        spark.read.parquet(f"{root}/out").select(ID).write.parquet(f"{root}/seen/delivery={delivery}")
    rows = spark.read.parquet(f"{root}/out")
    first = spark.read.parquet(f"{root}/seen").groupBy(ID).agg(F.min("delivery").cast("long").alias("first_delivery"))
    per = rows.groupBy(ID, "model_version").agg(
        F.count(F.lit(1)).alias("times"), F.min((F.col(P).between(0, 1) & (F.col("churn_predicted") == (F.col(P) > 0.5).cast("long"))).cast("int")).alias("ok"))
    return per.join(first, ID).select(ID, "model_version", "times", (F.col("ok") == 1).alias("decision_ok"), "first_delivery")


def odd_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base with a column that holds infinities and NaN."""
    inf, nan = F.lit(float("inf")), F.lit(float("nan"))
    x = F.when(F.col("frequency") == 0, inf).when(F.col("support_tickets") >= 2, nan).when(F.col("total_orders") <= 8, -inf)
    return base_table(spark, sf_dir).withColumn("odd", x.otherwise(F.col("monetary_value")))


@query("describe_nonfinite")
def q_describe_nonfinite(spark, sf_dir):
    """describe() of a column with infinities and NaN, by selection; what is not finite is told by flags."""
    d = rounded(pr.describe(odd_values(spark, sf_dir), ["odd"], method="cuts"), *DESCRIBED)
    return d.select("column", "count", F.isnan("mean").alias("mean_nan"), F.isnan("max").alias("max_nan"),
                    (F.col("min") == float("-inf")).alias("min_infinite"), *[F.col(c).cast("string").alias(c) for c in ("p25", "p50")])


@query("rfm_ranks_nonfinite")
def q_rfm_ranks_nonfinite(spark, sf_dir):
    """Bins by rank of a column with infinities and NaN, through selected cut keys."""
    return rfm.qcut_by_rank(odd_values(spark, sf_dir), "odd", 5, out="bin", method="cuts").select(ID, "bin")


@query("rule_score_constant")
def q_rule_score_constant(spark, sf_dir):
    """The churn rule where one of its columns does not vary: that column adds nothing."""
    rows = base_table(spark, sf_dir).withColumn("support_tickets", F.lit(0).cast("long"))
    frozen = scoring.rule_score_frozen(scoring.rule_score(rows), scoring.fit_rule_stats(rows), out="frozen")
    return frozen.select(ID, r6(P).alias(P), (F.abs(F.col(P) - F.col("frozen")) < 1e-9).alias("frozen_agrees"))


@query("corr_gram")
def q_corr_gram(spark, sf_dir):
    """The correlation matrix from one matrix of moments, with nulls (all customers) and a constant column."""
    rows = all_customers(spark, sf_dir).withColumn("flat", F.lit(1.0))
    return rounded(pr.corr_long(rows, [*BASE_FEATURES, "flat"], "gram"), "corr")


@query("clip_truncate")
def q_clip_truncate(spark, sf_dir):
    """Values kept within bounds, whole parts towards zero."""
    return customer_base(spark, sf_dir).select(
        ID, clip(F.col("age"), 25, 60).cast("long").alias("age_clipped"), truncate(F.col("monetary_value") / -7).alias("whole"))


@query("wanted_columns")
def q_wanted_columns(spark, sf_dir):
    """The wanted columns that exist, or all when none does."""
    base = customer_base(spark, sf_dir)
    some = fe.pick_columns(base, ["age", "no_such_column", "frequency"])
    every = fe.pick_columns(base, ["no_such_column"])
    return base.select(ID, *some, F.lit(len(every)).cast("long").alias("n_all"))


@query("read_or_sample")
def q_read_or_sample(spark, sf_dir):
    """The file is there, so its rows are read and none are made up."""
    path = _scratch(spark, "there")
    files.write_table(customer_base(spark, sf_dir), path, "csv")
    return files.load_or_sample(spark, path).select(ID, "recency_days", "monetary_value", LABEL)


@query("flow_prepare")
def q_flow_prepare(spark, sf_dir):
    """L1 with its result kept: features and scores of the kept table."""
    return flows.prepare(base_table(spark, sf_dir), store_base=_scratch(spark, "prepared"))


@query("flow_profile")
def q_flow_profile(spark, sf_dir):
    """L4: count, nulls, smallest and largest value of every column, from the profile's tables, with the churn rate."""
    t = flows.profile(base_table(spark, sf_dir))
    rows = t["describe"].join(t["null_counts"], "column").join(t["column_info"], "column")
    return rows.select("column", "position", "dtype", "count", "null_count", "min", "max", t["churn_rate"].select("churn_rate").scalar().alias("churn_rate"))


@query("flow_compare")
def q_flow_compare(spark, sf_dir):
    """The leaderboard with its best run marked."""
    board, best = flows.compare_runs(per_split_metrics(spark, sf_dir))
    return board.select("run_name", "metric_type", "f1", (F.col("run_name") == best.select("run_name").scalar()).alias("best"))
