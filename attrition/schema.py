"""Table schemas and the named feature presets."""

from __future__ import annotations

from pyspark.sql import types as T

ID = "customer_id"
LABEL = "churned"

CUSTOMER = T.StructType(
    [
        T.StructField("customer_id", T.LongType(), False),
        T.StructField("recency_days", T.LongType(), True),
        T.StructField("frequency", T.LongType(), True),
        T.StructField("monetary_value", T.DoubleType(), True),
        T.StructField("avg_order_value", T.DoubleType(), True),
        T.StructField("days_since_signup", T.LongType(), True),
        T.StructField("total_orders", T.LongType(), True),
        T.StructField("support_tickets", T.LongType(), True),
        T.StructField("age", T.LongType(), True),
        T.StructField("churned", T.LongType(), True),
    ]
)

UNLABELLED = T.StructType([f for f in CUSTOMER.fields if f.name != LABEL])

PREDICTIONS = T.StructType(
    [
        T.StructField("customer_id", T.LongType(), False),
        T.StructField("churn_probability", T.DoubleType(), True),
        T.StructField("churn_predicted", T.LongType(), True),
        T.StructField("predicted_at", T.TimestampType(), True),
    ]
)

BASE_FEATURES = [
    "recency_days",
    "frequency",
    "monetary_value",
    "avg_order_value",
    "days_since_signup",
    "total_orders",
    "support_tickets",
    "age",
]
RATIO_FEATURES = ["recency_frequency_ratio", "monetary_per_order", "order_frequency", "support_per_order"]

# Named feature lists; the reference's entry points each use one of them.
PRESETS = {
    "F13": BASE_FEATURES + RATIO_FEATURES + ["rfm_score"],
    "F11": BASE_FEATURES + ["recency_frequency_ratio", "monetary_per_order", "rfm_score"],
    "F9": BASE_FEATURES + ["rfm_score"],
    "F4": ["recency_days", "frequency", "monetary_value", "age"],
    "F3": ["age", "monetary", "frequency"],
    "F2": ["age_normalized", "monetary_normalized"],
}


def preset(name: str) -> list[str]:
    return list(PRESETS[name])
