"""Classification metrics, reports and run comparison.

All metrics of a prediction set come from one aggregate of four conditional
counts (TP, FP, FN, TN), grouped by run when there are several; the ratios are
computed from those integers, with an undefined ratio reported as 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.functions.exprs import safe_ratio

TRAIN_FLAG = "TRAIN (non comparable !)"  # fixed value: leaderboard label of train-only metrics
TEST_FLAG = "test"  # fixed value


def _cells(actual: str, predicted: str) -> list[Column]:
    a, p = F.col(actual), F.col(predicted)
    return [
        F.count_if((a == 1) & (p == 1)).alias("tp"),
        F.count_if((a == 0) & (p == 1)).alias("fp"),
        F.count_if((a == 1) & (p == 0)).alias("fn"),
        F.count_if((a == 0) & (p == 0)).alias("tn"),
    ]


def _ratios(prefix: str = "") -> dict[str, Column]:
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return {
        f"{prefix}accuracy": safe_ratio(tp + tn, tp + fp + fn + tn),
        f"{prefix}precision": safe_ratio(tp, tp + fp),
        f"{prefix}recall": safe_ratio(tp, tp + fn),
        # same value as 2PR/(P+R), from integers: 2TP / (2TP + FP + FN)
        f"{prefix}f1": safe_ratio(2 * tp, 2 * tp + fp + fn),
    }


def class_metrics(df: DataFrame, actual: str = "actual", predicted: str = "predicted",
                  by: list[str] | None = None) -> DataFrame:
    """n, tp, fp, fn, tn, accuracy, precision, recall, f1 of the positive class."""
    cells = _cells(actual, predicted)
    agg = df.groupBy(*by).agg(*cells) if by else df.agg(*cells)
    agg = agg.withColumn("n", F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn"))
    return agg.withColumns(_ratios())


def confusion(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """2x2 confusion matrix in long form; all four cells, zero counts kept."""
    a, p = F.col(actual), F.col(predicted)
    cells = [
        F.struct(F.lit(i).cast("long").alias("actual"), F.lit(j).cast("long").alias("predicted"),
                 F.count_if((a == i) & (p == j)).alias("count"))
        for i in (0, 1) for j in (0, 1)
    ]
    return df.select(F.inline(F.array(*cells)))


def class_report(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Per-class precision, recall, f1, support; accuracy; macro and weighted averages."""
    c = df.agg(*_cells(actual, predicted))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    n = tp + fp + fn + tn
    # class 1 is the positive class; for class 0 the roles swap (tn is its tp)
    p1, r1, f1 = safe_ratio(tp, tp + fp), safe_ratio(tp, tp + fn), safe_ratio(2 * tp, 2 * tp + fp + fn)
    p0, r0, f0 = safe_ratio(tn, tn + fn), safe_ratio(tn, tn + fp), safe_ratio(2 * tn, 2 * tn + fn + fp)
    s1, s0 = tp + fn, tn + fp
    acc = safe_ratio(tp + tn, n)

    def row(label, p, r, f, s):
        return F.struct(F.lit(label).alias("label"), p.alias("precision"), r.alias("recall"), f.alias("f1"),
                        s.cast("long").alias("support"))

    none = F.lit(None).cast("double")
    rows = [
        row("0", p0, r0, f0, s0),
        row("1", p1, r1, f1, s1),
        row("accuracy", none, none, acc, n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        row("weighted avg", safe_ratio(p0 * s0 + p1 * s1, n), safe_ratio(r0 * s0 + r1 * s1, n),
            safe_ratio(f0 * s0 + f1 * s1, n), n),
    ]
    return c.select(F.inline(F.array(*rows)))


def score_summary(df: DataFrame, actual: str = "churn_actual", predicted: str = "churn_predicted") -> DataFrame:
    """Batch summary: counts and shares of predicted and actual churners, accuracy."""
    n = F.count(F.lit(1))
    pc, ac = F.count_if(F.col(predicted) == 1), F.count_if(F.col(actual) == 1)
    return df.agg(
        n.alias("n"),
        pc.alias("n_predicted_churn"),
        ac.alias("n_actual_churn"),
        safe_ratio(pc, n).alias("predicted_share"),
        safe_ratio(ac, n).alias("actual_share"),
        safe_ratio(F.count_if(F.col(predicted) == F.col(actual)), n).alias("accuracy"),
    )


def long_predictions(df: DataFrame, runs: list[tuple[str, Column]], actual: str, keep: list[str]) -> DataFrame:
    """One row per (input row, run): run_name, actual, predicted, plus ``keep``.

    Built with one ``inline`` per row, so R runs cost one scan of the input.
    """
    structs = [F.struct(F.lit(name).alias("run_name"), pred.cast("long").alias("predicted")) for name, pred in runs]
    return df.select(*keep, F.col(actual).cast("long").alias("actual"), F.inline(F.array(*structs)))


def metrics_by_run(long_df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """A11 per run (and any extra keys, e.g. the split)."""
    return class_metrics(long_df, "actual", "predicted", ["run_name", *(by or [])])


def runs_table(per_split: DataFrame, params: dict[str, dict[str, str]] | None = None) -> DataFrame:
    """One row per run: test metrics, training metrics (``training_*_score``),
    a deterministic run_id and a params map.  Input: metrics_by_run(by=['split']).

    A conditional aggregate per run (no self-join of the metrics table)."""

    def pick(split: str, col: str):
        return F.max(F.when(F.col("split") == split, F.col(col)))

    out = per_split.groupBy("run_name").agg(
        pick("test", "accuracy").alias("accuracy"),
        pick("test", "precision").alias("precision"),
        pick("test", "recall").alias("recall"),
        pick("test", "f1").alias("f1"),
        pick("train", "accuracy").alias("training_accuracy_score"),
        pick("train", "precision").alias("training_precision_score"),
        pick("train", "recall").alias("training_recall_score"),
        pick("train", "f1").alias("training_f1_score"),
    ).withColumn("run_id", F.substring(F.md5(F.col("run_name")), 1, 8))
    if params:
        entries = []
        for name, p in params.items():
            entries.append(F.when(F.col("run_name") == name,
                                  F.create_map(*[x for k, v in p.items() for x in (F.lit(k), F.lit(str(v)))])))
        out = out.withColumn("params", F.coalesce(*entries))
    return out


def leaderboard(runs: DataFrame) -> DataFrame:
    """Test metrics per run, or training metrics flagged when the test F1 is 0
    and training metrics exist; sorted by F1 (ties by run name)."""
    use_train = (F.coalesce(F.col("f1"), F.lit(0.0)) == 0) & F.col("training_f1_score").isNotNull()

    def pick(test_col, train_col):
        return F.when(use_train, F.col(train_col)).otherwise(F.coalesce(F.col(test_col), F.lit(0.0)))

    return runs.select(
        "run_name",
        "run_id",
        F.when(use_train, F.lit(TRAIN_FLAG)).otherwise(F.lit(TEST_FLAG)).alias("metric_type"),
        pick("accuracy", "training_accuracy_score").alias("accuracy"),
        pick("precision", "training_precision_score").alias("precision"),
        pick("recall", "training_recall_score").alias("recall"),
        pick("f1", "training_f1_score").alias("f1"),
    ).orderBy(F.col("f1").desc(), F.col("run_name").asc())


def runs_query(runs: DataFrame, predicate: Column | str | None = None, order_by: list[Column] | None = None,
               limit: int | None = None) -> DataFrame:
    """Search runs: filter, order, limit (``search_runs``)."""
    out = runs if predicate is None else runs.where(predicate)
    if order_by:
        out = out.orderBy(*order_by)
    return out.limit(limit) if limit else out


def best_run(table: DataFrame, metric: str = "f1", name: str = "run_name") -> DataFrame:
    """Row with the highest metric; ties go to the smallest run name."""
    return table.orderBy(F.col(metric).desc(), F.col(name).asc()).limit(1)


def quality_gate(table: DataFrame, metric: str = "f1", minimum: float = 0.5) -> DataFrame:
    """Flag runs whose metric reaches the threshold (models to keep)."""
    return table.withColumn("passed", (F.coalesce(F.col(metric), F.lit(0.0)) >= F.lit(minimum)).cast("long"))
