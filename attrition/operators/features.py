"""Row-local feature expressions and column selection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrition.schema import ID, LABEL


def ratio_features(df: DataFrame, which: tuple[str, ...] | None = None) -> DataFrame:
    """Add the four ratio features (longs divided by longs give doubles).

    recency_frequency_ratio = recency_days / (frequency + 1)
    monetary_per_order      = monetary_value / (total_orders + 1)
    order_frequency         = total_orders / (days_since_signup + 1)
    support_per_order       = support_tickets / (total_orders + 1)
    """
    exprs = {
        "recency_frequency_ratio": F.col("recency_days") / (F.col("frequency") + 1),
        "monetary_per_order": F.col("monetary_value") / (F.col("total_orders") + 1),
        "order_frequency": F.col("total_orders") / (F.col("days_since_signup") + 1),
        "support_per_order": F.col("support_tickets") / (F.col("total_orders") + 1),
    }
    if which is not None:
        exprs = {k: v for k, v in exprs.items() if k in which}
    return df.withColumns({k: v.cast("double") for k, v in exprs.items()})


def spend_frequency_product(df: DataFrame) -> DataFrame:
    """``expensive_feature = monetary_value * frequency``."""
    return df.withColumn("expensive_feature", (F.col("monetary_value") * F.col("frequency")).cast("double"))


def pick_columns(df: DataFrame, wanted: list[str], exclude: tuple[str, ...] = (ID, LABEL)) -> list[str]:
    """The wanted columns that exist; if none does, every column but id and label.

    Driver-side over the schema only (no pass over the data).
    """
    present = [c for c in wanted if c in df.columns]
    return present or [c for c in df.columns if c not in exclude]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def fill_zero(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Nulls of numeric columns -> 0 (``fillna(0)``)."""
    return df.fillna(0, subset=cols) if cols else df.fillna(0)


def drop_nulls(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    return df.dropna(subset=cols) if cols else df.dropna()


def with_label(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Missing label column -> a column of zeros (the reference's fallback)."""
    return df if label in df.columns else df.withColumn(label, F.lit(0).cast("long"))
