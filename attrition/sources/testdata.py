"""Customer base derived from the TPC-H-like tables (orders, customer, events).

One row per customer with at least one order before the cut-off date, in the
columns of :data:`attrition.schema.CUSTOMER`:

* ``recency_days`` = days from the last order before the cut-off to the cut-off
* ``days_since_signup`` = days from the first order to the cut-off
* ``total_orders`` = orders before the cut-off; ``frequency`` = of those, the
  ones in the last 365 days
* ``monetary_value`` = their total price (summed as integer cents, so the sum
  does not depend on the order rows arrive in); ``avg_order_value`` = that per
  order, rounded half up to the cent with integer arithmetic
* ``support_tickets`` = ``error`` events of the customer (0 if none); an undated
  stand-in: the events lie after the label window, so it must not be read as a
  feature known at the cut-off
* ``age`` = ``18 + (c_custkey * 37) % 58``: no table holds an age, so this is
  a made-up deterministic stand-in
* ``churned`` = 1 when the customer places no order in the 365 days from the
  cut-off

Plan shape: orders are read once (date filter and three columns pushed into
the scan) and folded into one hash aggregate on the customer key with partial
aggregation before the shuffle, so a customer holding a third of all orders is
pre-summed map-side.  The error events are aggregated the same way; both
joins then meet on the same key.  Adaptive execution turns a join side into a
broadcast only when its measured size is under the broadcast threshold.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.functions.exprs import cents
from attrition.session import ensure_checkpoint_dir

# Fixed values of the derived base (the same in the SQL oracle).
CUTOFF = dt.date(2000, 8, 1)
HORIZON_DAYS = 365
AGE_MIN, AGE_MULT, AGE_SPAN = 18, 37, 58

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def customer_base(spark: SparkSession, sf_dir: str, cutoff: dt.date = CUTOFF, materialize: bool = False) -> DataFrame:
    """The customer base (see the module docstring).

    The base is lazy: a query that reads it once runs as one plan, with the
    columns it does not need pruned.  ``materialize=True`` writes it once as
    Parquet to the shared folder (``spark.checkpoint.dir``) and reads it back,
    for queries with several passes (quantile edges, z-score moments, ranks):
    each pass then reads its own columns of one row per customer instead of
    re-aggregating ``orders``, and the lineage is cut.
    """
    if materialize:
        path = f"{ensure_checkpoint_dir(spark)}/base-{uuid.uuid4().hex}"
        base = customer_base(spark, sf_dir, cutoff)
        base.write.parquet(path)
        return spark.read.schema(base.schema).parquet(path)
    start = cutoff - dt.timedelta(days=HORIZON_DAYS)
    end = cutoff + dt.timedelta(days=HORIZON_DAYS)
    c_lit, s_lit, e_lit = F.lit(cutoff), F.lit(start), F.lit(end)

    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    # date literal: compared with the timestamp_ntz column without any time-zone shift
    orders = orders.where(F.col("o_orderdate") < e_lit)
    d = F.to_date("o_orderdate")
    past = d < c_lit
    per_cust = (
        orders.groupBy(F.col("o_custkey").alias("customer_id"))
        .agg(
            F.count_if(past).alias("total_orders"),
            F.count_if(past & (d >= s_lit)).alias("frequency"),
            F.max(F.when(past, d)).alias("last_order"),
            F.min(F.when(past, d)).alias("first_order"),
            F.sum(F.when(past, cents("o_totalprice"))).alias("spend_cents"),
            F.count_if((d >= c_lit) & (d < e_lit)).alias("next_orders"),
        )
        .where(F.col("total_orders") > 0)
    )

    errors = (
        table(spark, sf_dir, "events")
        .where(F.col("event_type") == "error")
        .groupBy(F.col("user_id").alias("customer_id"))
        .agg(F.count(F.lit(1)).alias("support_tickets"))
    )

    custs = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("customer_id"))

    spend = F.col("spend_cents")
    n = F.col("total_orders")
    return (
        custs.join(per_cust, "customer_id", "inner")
        .join(errors, "customer_id", "left")
        .select(
            F.col("customer_id").cast("long").alias("customer_id"),
            F.datediff(c_lit, "last_order").cast("long").alias("recency_days"),
            F.col("frequency").cast("long").alias("frequency"),
            (spend / F.lit(100)).cast("double").alias("monetary_value"),
            # round half up to the cent: (2*cents + n) div (2*n), exact in integers
            (F.expr("(spend_cents * 2 + total_orders) div (total_orders * 2)") / F.lit(100))
            .cast("double")
            .alias("avg_order_value"),
            F.datediff(c_lit, "first_order").cast("long").alias("days_since_signup"),
            n.cast("long").alias("total_orders"),
            F.coalesce(F.col("support_tickets"), F.lit(0)).cast("long").alias("support_tickets"),
            (F.lit(AGE_MIN) + (F.col("customer_id") * AGE_MULT) % AGE_SPAN).cast("long").alias("age"),
            (F.col("next_orders") == 0).cast("long").alias("churned"),
        )
    )


def all_customers(spark: SparkSession, sf_dir: str, cutoff: dt.date = CUTOFF) -> DataFrame:
    """Every row of ``customer`` left-joined to its base row (nulls when it
    has no order before the cut-off): the input of the null-handling queries."""
    custs = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long").alias("customer_id"))
    return custs.join(customer_base(spark, sf_dir, cutoff), "customer_id", "left")
