"""Model fitting and selection on MLlib (M1-M8).

Every model is a ``PipelineModel``: assembler -> (scaler) -> classifier, so
the scaler travels with the model and scoring is one ``transform``.  The
probability of class 1 is read with ``vector_to_array`` (JVM-side), never a
Python UDF.  Differences from the reference's library:

* logistic regression: C=1 with an L2 penalty becomes ``regParam = 1/n``
  (MLlib averages the loss over rows); ``standardization=False`` because the
  pipeline scales first;
* random forest: 32 histogram bins instead of exact splits, ``maxDepth``
  at most 30 (None -> 30), ``minInstancesPerNode`` instead of
  ``min_samples_split``;
* MLlib's ``StandardScaler`` divides by the sample std (the exact population
  scaler is :func:`attrition.operators.scaling.standard_scale`).
"""

from __future__ import annotations

import concurrent.futures as cf
import datetime as dt
import itertools
import uuid
import warnings
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.operators import metrics as me
from attrition.operators.rfm import WINDOW_MAX_BYTES, estimated_bytes
from attrition.operators.split import add_fold
from attrition.schema import ID, LABEL
from attrition.session import ensure_checkpoint_dir

SEED = 42
MAX_DEPTH_NONE = 30  # MLlib's ceiling stands in for "no depth limit"


@dataclass
class Spec:
    """A candidate model: kind ('lr', 'rf', 'gbt'), parameters, a run name."""

    kind: str
    params: dict = field(default_factory=dict)
    name: str = ""

    def run_name(self) -> str:
        return self.name or self.kind + "".join(f"_{k}{v}" for k, v in sorted(self.params.items()))


# Rows per partition of a training frame: while it has few partitions, and beyond; the most partitions.
TRAIN_ROWS_PER_PART = 5_000
TRAIN_LARGE_PART = 100_000
TRAIN_FEW_PARTS = 8
TRAIN_MAX_PARTS = 2_000
# Models fitted side by side: partitions of their common frame while it is small, and most rows in all.
SIDE_PARTS = 2
SIDE_ROWS = 4_000_000


def spread(df: DataFrame, id_col: str = ID, rows_per_part: int = TRAIN_ROWS_PER_PART, few: int = TRAIN_FEW_PARTS) -> DataFrame:
    """Rows to train on, in a layout that depends on the rows alone.

    MLlib bags rows by partition, so a forest depends on the partitions and on
    the order of the rows in them.  The rows go by a hash of the id to
    ``ceil(rows / rows_per_part)`` partitions, at most ``few`` of them or as many as
    hold ``TRAIN_LARGE_PART`` rows each, and are sorted by id there: the same rows give
    the same model on any number of cores and after a retry.  Without an id column the frame is left as it is.

    Every task of a tree's level fills, sends and merges the statistics of all nodes of that level, whatever rows it has:
    that work grows with the partitions, so they are few, and large.
    """
    if id_col not in df.columns:
        return df
    n = df.count()
    parts = max(min(few, -(-n // rows_per_part)), -(-n // max(rows_per_part, TRAIN_LARGE_PART)))
    return df.repartition(max(1, min(TRAIN_MAX_PARTS, parts)), F.col(id_col)).sortWithinPartitions(id_col)


def with_label(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.withColumn("label", F.col(label).cast("double"))


def classifier(kind: str, params: dict | None = None, n_rows: int | None = None, small: bool = False):
    """An MLlib estimator for ``kind``.  Trees cache node ids; on large inputs
    that cache is checkpointed every 10 levels (lineage cut, survives a lost
    executor), on small ones (``small``) the checkpoint writes are skipped."""
    p = dict(params or {})
    ckpt = -1 if small else 10
    if kind == "lr":
        c = float(p.pop("C", 1.0))
        reg = 1.0 / (c * n_rows) if n_rows else 0.0
        # tol 1e-4 is the reference library's lbfgs default (MLlib's is 1e-6)
        return LogisticRegression(maxIter=int(p.pop("max_iter", 1000)), regParam=reg, elasticNetParam=0.0,
                                  tol=float(p.pop("tol", 1e-4)), standardization=False, featuresCol="features",
                                  labelCol="label")
    if kind == "rf":
        depth = p.pop("max_depth", 10)
        if depth is None:
            warnings.warn(f"no depth limit: MLlib's ceiling of {MAX_DEPTH_NONE} levels is used", stacklevel=2)
        return RandomForestClassifier(
            numTrees=int(p.pop("n_estimators", 100)),
            maxDepth=MAX_DEPTH_NONE if depth is None else int(depth),
            minInstancesPerNode=max(1, int(p.pop("min_samples_split", 2)) // 2),
            featureSubsetStrategy="sqrt", seed=SEED, featuresCol="features", labelCol="label",
            cacheNodeIds=True, checkpointInterval=ckpt, maxMemoryInMB=512)
    if kind == "gbt":
        return GBTClassifier(maxIter=int(p.pop("n_estimators", 100)), stepSize=float(p.pop("learning_rate", 0.1)),
                             maxDepth=int(p.pop("max_depth", 3)), seed=SEED, featuresCol="features",
                             labelCol="label", cacheNodeIds=True, checkpointInterval=ckpt, maxMemoryInMB=512)
    raise ValueError(f"unknown model kind {kind!r}")


def make_pipeline(clf, cols: list[str], scale: bool = True) -> Pipeline:
    stages = [VectorAssembler(inputCols=list(cols), outputCol="raw_features" if scale else "features",
                              handleInvalid="keep")]
    if scale:
        stages.append(StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True))
    return Pipeline(stages=[*stages, clf])


def without_summary(pm: PipelineModel) -> PipelineModel:
    """Let go of a fitted classifier's training summary.

    It holds the training frame and the session, which Spark would send along with the model to
    every task that scores (and cannot send any more once the session has observed a write).
    """
    model = pm.stages[-1]._java_obj
    if getattr(pm.stages[-1], "hasSummary", False):
        model.setSummary(SparkSession.active().sparkContext._jvm.scala.Option.empty())
    return pm


def fit(df: DataFrame, kind: str, params: dict | None, cols: list[str], label: str = LABEL,
        scale: bool | None = None, spread_rows: bool = True) -> PipelineModel:
    """Fit one candidate.  Linear models are scaled; trees are not (scale-free).

    ``spread_rows`` gives the rows the layout of :func:`spread`; callers that
    fit several models on rows that have it already turn it off.
    """
    train = with_label(df, label)
    if spread_rows:
        train = spread(train)
    n = train.count() if kind == "lr" else None
    scale = (kind == "lr") if scale is None else scale
    small = estimated_bytes(train) <= WINDOW_MAX_BYTES
    return without_summary(make_pipeline(classifier(kind, params, n, small), cols, scale).fit(train))


def predict(pm: PipelineModel, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Input columns + churn_probability + churn_predicted (P(1) > threshold)."""
    out = pm.transform(df)
    p = vector_to_array(F.col("probability"))[1]
    keep = [c for c in df.columns]
    return out.select(*keep, p.alias("churn_probability")).withColumn(
        "churn_predicted", (F.col("churn_probability") > F.lit(threshold)).cast("long"))


def evaluate(pm: PipelineModel, test: DataFrame, label: str = LABEL) -> DataFrame:
    """A11 metrics of one model on labelled rows."""
    pred = predict(pm, test)
    return me.class_metrics(pred.select(F.col(label).alias("actual"), F.col("churn_predicted").alias("predicted")))


PIPELINE_OUTPUTS = ("raw_features", "features", "rawPrediction", "probability", "prediction")


def score_many(models_: list[tuple[str, PipelineModel]], df: DataFrame) -> DataFrame:
    """Apply several fitted pipelines to one frame: each adds ``p_<name>`` and
    drops its scratch columns, so all candidates are scored in a single scan."""
    out = df
    for name, pm in models_:
        out = pm.transform(out).withColumn(f"p_{name}", vector_to_array(F.col("probability"))[1])
        out = out.drop(*[c for c in PIPELINE_OUTPUTS if c in out.columns])
    return out


def compare(train: DataFrame, test: DataFrame, specs: list[Spec], cols: list[str], label: str = LABEL,
            parallelism: int = 4, threshold: float = 0.5) -> DataFrame:
    """Train the candidates concurrently (one Spark job stream per driver
    thread, sharing the cached training rows), score all of them on the test
    rows in one scan, and compute every candidate's metrics in one aggregate:
    run_name, order, metrics."""
    train = spread(with_label(train, label)).persist()
    try:
        with cf.ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            fitted = list(pool.map(lambda s: fit(train, s.kind, s.params, cols, "label", spread_rows=False),
                                  specs))
    finally:
        train.unpersist()
    names = [f"m{i}" for i in range(len(specs))]
    scored = score_many(list(zip(names, fitted, strict=True)), test.select(ID, label, *cols))
    runs = [(f"{i:04d}|{s.run_name()}", F.col(f"p_{n}") > F.lit(threshold))
            for i, (n, s) in enumerate(zip(names, specs, strict=True))]
    out = me.class_metrics(me.long_predictions(scored, runs, label, []), by=["run_name"])
    key = F.split(F.col("run_name"), r"\|", 2)
    return out.withColumn("order", key[0].cast("int")).withColumn("run_name", key[1])


def best_by(table: DataFrame, metric: str = "accuracy") -> DataFrame:
    """Highest metric; on ties the first candidate (by submission order) wins."""
    return table.orderBy(F.col(metric).desc(), F.col("order").asc()).limit(1)


# -- cross-validation (M6, M7) --------------------------------------------------


def out_of_fold(df: DataFrame, specs: list[Spec], cols: list[str], k: int = 5, label: str = LABEL,
                parallelism: int = 4, path: str | None = None) -> DataFrame:
    """Every row's prediction by every setting's model of the folds it is not in:
    setting_id, fold, customer_id, actual, churn_probability, predicted.

    Stratified hash folds; the ``len(specs) * k`` models are fitted concurrently from driver
    threads, each writes its fold's predictions to the table at ``path`` (default: a fresh folder of
    ``spark.checkpoint.dir``) and is then let go, so the driver holds ``parallelism`` models at a time
    (fewer on large frames: a fit fills the cluster then, and its trees' state is as large as the rows).
    Metrics are aggregates of this table (:func:`fold_metrics`).
    """
    spark = df.sparkSession
    path = path or f"{ensure_checkpoint_dir(spark)}/folds-{uuid.uuid4().hex}"
    data = spread(with_label(add_fold(df, k, label=label), label), few=SIDE_PARTS).persist()
    n = data.count()
    side = max(1, min(parallelism, SIDE_ROWS // max(n, 1)))

    def one(job: tuple[int, int]) -> None:
        i, f = job
        tr, te = data.where(F.col("fold") != f), data.where(F.col("fold") == f)
        kind = specs[i].kind
        clf = classifier(kind, specs[i].params, n - te.count() if kind == "lr" else None, estimated_bytes(tr) <= WINDOW_MAX_BYTES)
        scored = without_summary(make_pipeline(clf, cols, kind == "lr").fit(tr)).transform(te)
        scored.select(
            F.col(ID), F.col("label").cast("long").alias("actual"), vector_to_array(F.col("probability"))[1].alias("churn_probability"),
            F.col("prediction").cast("long").alias("predicted"),
        ).write.parquet(f"{path}/setting_id={i}/fold={f}")

    try:
        with cf.ThreadPoolExecutor(max_workers=side) as pool:
            list(pool.map(one, [(i, f) for i in range(len(specs)) for f in range(k)]))
    finally:
        data.unpersist()
    schema = f"{ID} long, actual long, churn_probability double, predicted long, setting_id long, fold long"
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def fold_metrics(predictions: DataFrame) -> DataFrame:
    """A11 metrics of every (setting_id, fold) of an out-of-fold table: one grouped aggregate."""
    return me.class_metrics(predictions, by=["setting_id", "fold"])


def cv_score(df: DataFrame, kind: str, params: dict | None, cols: list[str], k: int = 5,
             label: str = LABEL, metric: str = "accuracy", parallelism: int = 4) -> DataFrame:
    """k-fold cross-validated metric per fold; ``cv_summary`` gives mean +- 2 std."""
    rows = out_of_fold(df, [Spec(kind, params or {})], cols, k, label, parallelism)
    return fold_metrics(rows).select("fold", metric)


def cv_summary(folds: DataFrame, metric: str = "accuracy") -> DataFrame:
    """mean, population std and the mean +- 2 std band of a per-fold metric."""
    m, sd = F.avg(metric), F.stddev_pop(metric)
    return folds.agg(m.alias("mean"), sd.alias("std"), (m - 2 * sd).alias("low"), (m + 2 * sd).alias("high"))


def grid_specs(kind: str, grid: dict[str, list]) -> list[Spec]:
    """All settings of a grid, in the order of its values; named by MLlib's parameters."""
    names = {"n_estimators": "numTrees" if kind == "rf" else "maxIter", "max_depth": "maxDepth",
             "min_samples_split": "minInstancesPerNode", "learning_rate": "stepSize"}
    out = []
    for values in itertools.product(*grid.values()):
        params = dict(zip(grid, values, strict=True))
        clf = classifier(kind, params)
        shown = {names.get(key, key): clf.getOrDefault(names[key]) if key in names else params[key] for key in params}
        out.append(Spec(kind, params, ",".join(f"{a}={b}" for a, b in sorted(shown.items()))))
    return out


def grid_search(df: DataFrame, kind: str, grid: dict[str, list], cols: list[str], k: int = 5,
                label: str = LABEL, parallelism: int = 4, path: str | None = None):
    """Exhaustive search with k-fold CV scored by the F1 of class 1, best refit (ties: the first setting).

    Returns (best PipelineModel, DataFrame of settings with mean/std metric); the out-of-fold
    predictions behind the metrics stay at ``path`` (see :func:`out_of_fold`).
    """
    specs = grid_specs(kind, grid)
    rows = out_of_fold(df, specs, cols, k, label, parallelism, path)
    per = fold_metrics(rows).groupBy("setting_id").agg(F.avg("f1").alias("mean_f1"), F.stddev_pop("f1").alias("std_f1"))
    found = {r["setting_id"]: (r["mean_f1"], r["std_f1"]) for r in per.collect()}  # one row for each setting
    table = [(i, spec.run_name(), *found[i]) for i, spec in enumerate(specs)]
    best = max(table, key=lambda r: (r[2], -r[0]))[0]
    out = df.sparkSession.createDataFrame(table, "setting_id long, setting string, mean_f1 double, std_f1 double")
    return fit(df, kind, specs[best].params, cols, label), out


def feature_importance(pm: PipelineModel, cols: list[str]) -> list[tuple[str, float]]:
    """(feature, importance) of the tree stage, most important first."""
    imp = pm.stages[-1].featureImportances.toArray()
    return sorted(zip(cols, (float(v) for v in imp), strict=True), key=lambda t: (-t[1], t[0]))


def importance_frame(spark, pm: PipelineModel, cols: list[str]) -> DataFrame:
    return spark.createDataFrame(feature_importance(pm, cols), "feature string, importance double")


def lr_gradient(pm: PipelineModel, df: DataFrame, cols: list[str], label: str = LABEL) -> DataFrame:
    """``feature, gradient`` of the penalised mean log-loss at the model's coefficients (scaled features)."""
    model = pm.stages[-1]
    reg, coef = model.getRegParam(), model.coefficients.toArray()
    rows = pm.transform(df)
    error = vector_to_array(F.col("probability"))[1] - F.col(label).cast("double")
    x = vector_to_array("features")
    grads = [F.struct(F.lit(c).alias("feature"), (F.avg(error * x[i]) + F.lit(float(reg * coef[i]))).alias("gradient"))
             for i, c in enumerate(cols)]
    return rows.select(F.inline(F.array(*grads)))


def score_frame(pm: PipelineModel, df: DataFrame, threshold: float = 0.5, version: str | None = None,
                predicted_at: dt.datetime | None = None) -> DataFrame:
    """customer_id, churn_probability, churn_predicted, [model_version], [predicted_at].

    ``predicted_at`` is one stamp for the whole batch.
    """
    out = predict(pm, df, threshold).select(ID, "churn_probability", "churn_predicted")
    if version is not None:
        out = out.withColumn("model_version", F.lit(version))
    if predicted_at is not None:
        out = out.withColumn("predicted_at", F.lit(predicted_at).cast("timestamp"))
    return out
