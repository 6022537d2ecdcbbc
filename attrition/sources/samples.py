"""Small customer frames for tests, examples and the read-or-sample source.

Every column is a Spark expression of the row id: uniform numbers come from a
hash of (seed, column name, id), so a frame is the same for any partitioning.
One hidden number for each customer, its liveliness in (0, 1), ties the columns
together: lively customers order more, came back lately, ask for help less
often and churn less.  No registered query reads these frames.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from attrition.schema import CUSTOMER, LABEL

NARROW = ["customer_id", "age", "recency_days", "frequency", "monetary_value", LABEL]


def uniform(seed: int, name: str, id_col: str = "customer_id") -> Column:
    """A number in [0, 1) from a hash of (seed, name, id)."""
    return F.pmod(F.xxhash64(F.lit(f"{seed}/{name}"), F.col(id_col)), F.lit(1 << 40)) / F.lit(float(1 << 40))


def sample_customers(spark: SparkSession, n: int = 1000, seed: int = 1, first_id: int = 1, kind: str = "labelled") -> DataFrame:
    """``n`` customers in the columns of :data:`attrition.schema.CUSTOMER`.

    ``kind``: ``labelled``, ``unlabelled`` (no label), ``narrow`` (a few columns).
    """
    if kind not in ("labelled", "unlabelled", "narrow"):
        raise ValueError(f"unknown kind {kind!r}")

    def u(name: str) -> Column:
        return uniform(seed, name)

    def whole(x: Column) -> Column:
        return F.floor(x).cast("long")

    live = F.col("_live")
    df = spark.range(first_id, first_id + n).withColumnRenamed("id", "customer_id").withColumn("_live", u("live"))
    df = df.withColumn("days_since_signup", whole(u("signup") * 1400) + 40)
    df = df.withColumn("total_orders", whole(live * live * F.col("days_since_signup") / 25 + u("orders") * 4) + 1)
    year = F.least(F.lit(1.0), F.lit(365) / F.col("days_since_signup"))
    df = df.withColumn("frequency", whole(F.col("total_orders") * year * (0.4 + 0.6 * live)))
    df = df.withColumn("recency_days", whole(F.least(F.col("days_since_signup"), (1.1 - live) * 330 * u("recency"))))
    df = df.withColumn("avg_order_value", F.round(15 + 85 * u("price"), 2))
    df = df.withColumn("monetary_value", F.round(F.col("avg_order_value") * F.col("total_orders"), 2))
    df = df.withColumn("support_tickets", whole(5 * u("tickets") * (1.2 - live)))
    df = df.withColumn("age", whole(u("age") * 60) + 18)
    df = df.withColumn(LABEL, (u("label") < 1 / (1 + F.exp(9 * (live - 0.45)))).cast("long"))
    names = NARROW if kind == "narrow" else [f.name for f in CUSTOMER.fields if kind == "labelled" or f.name != LABEL]
    return df.select(*names)


def inline_five(spark: SparkSession) -> DataFrame:
    """The five-row literal table of the exercises."""
    # fixed values: the table's rows
    rows = [(1, 25, 100, 2, 0), (2, 30, 200, 5, 1), (3, 45, 500, 10, 0), (4, 22, 50, 1, 0), (5, 50, 1000, 20, 1)]
    names = ("customer_id", "age", "monetary", "frequency", "churn")
    return spark.createDataFrame(rows, T.StructType([T.StructField(c, T.LongType(), False) for c in names]))
