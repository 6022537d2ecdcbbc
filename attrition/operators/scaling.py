"""Normalisation (N1-N4): z-scores and a fit/apply standard scaler.

Statistics are one aggregate row (a scalar subquery), applied by row-local
expressions: no join, no shuffle of the rows themselves.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.operators.features import numeric_columns

EPS = 1e-8


def zscore(df: DataFrame, cols: list[str], eps: float = EPS, suffix: str = "", fit_on: DataFrame | None = None) -> DataFrame:
    """(x - mean) / (sample std + eps) for each column.

    ``suffix=''`` replaces the columns in place; ``'_normalized'`` adds new ones.
    Statistics come from ``fit_on`` (default: this frame, as in the reference).
    """
    src = df if fit_on is None else fit_on
    st = src.select(
        F.struct(*[F.struct(F.avg(c).alias("m"), F.stddev_samp(c).alias("s")).alias(f"c{i}")
                   for i, c in enumerate(cols)]).alias("s")
    ).scalar()
    out = df.withColumn("_zs", st)
    new = {
        f"{c}{suffix}": ((F.col(c) - F.col(f"_zs.c{i}.m")) / (F.col(f"_zs.c{i}.s") + F.lit(eps))).cast("double")
        for i, c in enumerate(cols)
    }
    return out.withColumns(new).drop("_zs")


def zscore_all_numeric(df: DataFrame, eps: float = EPS) -> DataFrame:
    """Every numeric column (id and label too) into ``<col>_normalized``."""
    return zscore(df, numeric_columns(df), eps, suffix="_normalized")


@dataclass
class ScalerModel:
    """Fitted standard scaler: mean and population std per column (zero std -> 1)."""

    cols: list[str]
    means: list[float]
    scales: list[float]

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        return df.withColumns(
            {
                f"{c}{suffix}": ((F.col(c) - F.lit(m)) / F.lit(s)).cast("double")
                for c, m, s in zip(self.cols, self.means, self.scales, strict=True)
            }
        )


def fit_scaler(df: DataFrame, cols: list[str]) -> ScalerModel:
    """Fit on (say) the training rows: one aggregate row reaches the driver."""
    row = df.select(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                    *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    means = [float(row[f"m{i}"]) for i in range(len(cols))]
    scales = [float(row[f"s{i}"]) or 1.0 for i in range(len(cols))]
    return ScalerModel(list(cols), means, scales)


def standard_scale(df: DataFrame, cols: list[str], fit_on: DataFrame | None = None, suffix: str = "") -> DataFrame:
    """Lazy form of fit + apply: population std, zero variance -> scale 1."""
    src = df if fit_on is None else fit_on
    st = src.select(
        F.struct(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(f"c{i}")
                   for i, c in enumerate(cols)]).alias("s")
    ).scalar()
    out = df.withColumn("_ss", st)
    new = {}
    for i, c in enumerate(cols):
        s = F.col(f"_ss.c{i}.s")
        new[f"{c}{suffix}"] = ((F.col(c) - F.col(f"_ss.c{i}.m")) / F.when(s == 0, F.lit(1.0)).otherwise(s)).cast("double")
    return out.withColumns(new).drop("_ss")
