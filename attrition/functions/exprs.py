"""Column expressions shared by the operators (all JVM-side, codegen friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


R6_MAX = 1e9  # larger values are left as they are: a double holds fewer than 7 decimals of them


def r6(c: str | Column) -> Column:
    """Round half up to 6 decimals with plain IEEE steps.

    ``floor(x*1e6 + 0.5) / 1e6`` gives the same double in any engine that
    follows IEEE-754, unlike ``round`` whose half-way handling differs between
    engines; used by queries on values whose last bits depend on aggregation order.
    NaN, infinities and values beyond ``R6_MAX`` pass through.
    """
    x = col(c).cast("double")
    return F.when(F.abs(x) < R6_MAX, F.floor(x * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)).otherwise(x).cast("double")


def q(name: str) -> str:
    """Back-quoted column name for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def cents(c: str | Column) -> Column:
    """Money as an exact integer number of cents (sums are then order-free)."""
    return F.round(col(c) * F.lit(100)).cast("long")


def safe_ratio(num: Column, den: Column) -> Column:
    """num/den as double, 0 when the denominator is 0 or null (undefined metric -> 0)."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def standardized(x: Column, mean: Column, std: Column) -> Column:
    """``(x - mean) / std``; 0 where the column does not vary (std 0) or has one row (std null), null for a null x."""
    return F.when(x.isNull(), F.lit(None)).otherwise(F.coalesce(F.try_divide(x - mean, std), F.lit(0.0))).cast("double")


def clip(c: Column, low: float, high: float) -> Column:
    """``c`` kept within [low, high]; null stays null, NaN becomes ``high`` (it is the largest value)."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def truncate(c: Column) -> Column:
    """The whole part towards zero, as a long; null for NaN and for what no long holds."""
    x = c.cast("double")
    return F.when(F.abs(x) < F.lit(float(1 << 63)), x.cast("long"))


def sigmoid(c: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-c))
