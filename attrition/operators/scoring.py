"""Scoring expressions and prediction tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.functions.exprs import sigmoid, standardized
from attrition.schema import ID, LABEL

# Weights of the churn score on the z-scored columns, and the
# coefficients of the fixed logistic model (intercept last).
RULE_WEIGHTS = {"recency_days": 1.8, "frequency": -1.5, "monetary_value": -1.0, "support_tickets": 0.8}
LOGISTIC_COEFS = {"recency_days": 0.02, "frequency": -0.1, "monetary_value": -0.001, "support_tickets": 0.2}
LOGISTIC_INTERCEPT = -2.0
DECISION_THRESHOLD = 0.5
HIGH_RISK_THRESHOLD = 0.7


def zscore_stats(df: DataFrame, cols: list[str]) -> Column:
    """One scalar subquery: struct of mean and sample std per column."""
    fields = []
    for c in cols:
        fields += [F.avg(c).alias(f"{c}__mean"), F.stddev_samp(c).alias(f"{c}__std")]
    return df.select(F.struct(*fields).alias("s")).scalar()


def rule_score(
    df: DataFrame,
    weights: dict[str, float] | None = None,
    out: str = "churn_probability",
    fit_on: DataFrame | None = None,
) -> DataFrame:
    """Noise-free churn rule: sigmoid(sum w_c * (c - mean_c) / std_c), sample std.

    A column that does not vary (or a table of one row) adds 0 to the score.
    The statistics come from ``fit_on`` (default: this frame) as one aggregate,
    computed once and inlined as a scalar; the score is a row-local expression.
    Pass the undecorated input (or a training split) as ``fit_on`` to keep the
    statistics plan small and independent of later columns.
    """
    weights = weights or RULE_WEIGHTS
    st = zscore_stats(df if fit_on is None else fit_on, list(weights))
    score = sum(
        (F.lit(w) * standardized(F.col(c), F.col(f"_zst.{c}__mean"), F.col(f"_zst.{c}__std")) for c, w in weights.items()),
        F.lit(0.0),
    )
    return df.withColumn("_zst", st).withColumn(out, sigmoid(score).cast("double")).drop("_zst")


def logistic_score(
    df: DataFrame,
    coefs: dict[str, float] | None = None,
    intercept: float = LOGISTIC_INTERCEPT,
    out: str = "churn_probability",
) -> DataFrame:
    """Fixed-coefficient logistic model: sigmoid(b0 + sum b_c * c)."""
    coefs = coefs or LOGISTIC_COEFS
    lin = sum((F.lit(b) * F.col(c) for c, b in coefs.items()), F.lit(intercept))
    return df.withColumn(out, sigmoid(lin).cast("double"))


def decide(df: DataFrame, threshold: float = DECISION_THRESHOLD, p: str = "churn_probability",
           out: str = "churn_predicted") -> DataFrame:
    """Predicted class 1 iff P(1) > threshold (a tie at the threshold is class 0)."""
    return df.withColumn(out, (F.col(p) > F.lit(threshold)).cast("long"))


def high_risk(df: DataFrame, threshold: float = HIGH_RISK_THRESHOLD, p: str = "churn_probability") -> DataFrame:
    """Rows with probability strictly above the threshold."""
    return df.where(F.col(p) > F.lit(threshold))


def status_label(df: DataFrame, pred: str = "churn_predicted", out: str = "status") -> DataFrame:
    return df.withColumn(out, F.when(F.col(pred) == 1, F.lit("Churn")).otherwise(F.lit("Retain")))


def eval_table(df: DataFrame, label: str = LABEL, pred: str = "churn_predicted",
               p: str = "churn_probability") -> DataFrame:
    """actual, predicted, probability, correct (0/1), keyed by customer_id."""
    return df.select(
        F.col(ID),
        F.col(label).cast("long").alias("actual"),
        F.col(pred).cast("long").alias("predicted"),
        F.col(p).alias("probability"),
        (F.col(label) == F.col(pred)).cast("long").alias("correct"),
    )


def score(
    df: DataFrame,
    p: str = "churn_probability",
    threshold: float = DECISION_THRESHOLD,
    version: str | None = None,
    predicted_at: dt.datetime | None = None,
    keep_actual: bool = False,
    label: str = LABEL,
) -> DataFrame:
    """Prediction table: customer_id, churn_probability, churn_predicted,
    [model_version], [predicted_at], [churn_actual].

    ``predicted_at`` is one literal fixed for the whole batch (not a per-row
    clock), so every row of a run carries the same stamp.
    """
    cols = [F.col(ID), F.col(p).alias("churn_probability"),
            (F.col(p) > F.lit(threshold)).cast("long").alias("churn_predicted")]
    if version is not None:
        cols.append(F.lit(version).alias("model_version"))
    if predicted_at is not None:
        cols.append(F.lit(predicted_at).cast("timestamp").alias("predicted_at"))
    if keep_actual:
        cols.append(F.col(label).cast("long").alias("churn_actual"))
    return df.select(*cols)


def minimal_predictions(df: DataFrame, threshold: float = DECISION_THRESHOLD,
                        p: str = "churn_probability") -> DataFrame:
    """customer_id, predicted_churn."""
    return df.select(F.col(ID), (F.col(p) > F.lit(threshold)).cast("long").alias("predicted_churn"))


def top_k(df: DataFrame, col: str = "churn_probability", k: int = 10, tie: str = ID) -> DataFrame:
    """The k largest rows of ``col`` (ties by ascending id): TakeOrderedAndProject,
    a per-partition top-k merged on the driver side of one task, never a full sort."""
    return df.orderBy(F.col(col).desc(), F.col(tie).asc()).limit(k)


def first_n(df: DataFrame, n: int, order: str = ID) -> DataFrame:
    """First n rows in id order (the reference's ``head(n)``)."""
    return df.orderBy(F.col(order).asc()).limit(n)


def fit_rule_stats(df: DataFrame, weights: dict[str, float] | None = None) -> dict[str, tuple[float, float]]:
    """Freeze the rule's statistics: {column: (mean, sample std)} from one aggregate row.

    The std of one row is 0 (it adds nothing to a score); a column without values is an error.
    """
    weights = weights or RULE_WEIGHTS
    row = df.select(*[F.avg(c).alias(f"{c}__m") for c in weights],
                    *[F.stddev_samp(c).alias(f"{c}__s") for c in weights]).first()
    empty = [c for c in weights if row[f"{c}__m"] is None]
    if empty:
        raise ValueError(f"cannot fit the rule: no values in {empty}")
    return {c: (float(row[f"{c}__m"]), float(row[f"{c}__s"] or 0.0)) for c in weights}


def rule_score_frozen(df: DataFrame, stats: dict[str, tuple[float, float]],
                      weights: dict[str, float] | None = None, out: str = "churn_probability") -> DataFrame:
    """The churn rule with frozen statistics (literals only: works on streams)."""
    weights = weights or RULE_WEIGHTS
    score = sum((F.lit(w) * standardized(F.col(c), F.lit(stats[c][0]), F.lit(stats[c][1])) for c, w in weights.items()),
                F.lit(0.0))
    return df.withColumn(out, sigmoid(score).cast("double"))
