"""One row per customer, joining orders and application activity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def customer_view(customers: DataFrame, orders: DataFrame, gold: DataFrame) -> DataFrame:
    """Customer attributes with order and activity totals; every customer is kept.

    Both fact tables are summed to one row per customer first, so no join
    multiplies rows and a busy customer is merged before the shuffle.
    """
    order_totals = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count("*").alias("orders_count"),
        F.sum("o_totalprice").alias("orders_total"),
        F.max(F.col("o_orderdate").cast("date")).alias("last_order_date"),
    )
    activity = gold.groupBy(F.col("user_id").alias("c_custkey")).agg(
        F.sum("events_count").alias("events_count"),
        F.count("*").alias("active_days"),
        F.sum("page_view_count").alias("page_views"),
        F.sum("checkout_count").alias("checkouts"),
        F.sum("error_count").alias("errors"),
        F.sum("total_amount").alias("activity_amount"),
        F.min("first_event_ts").alias("first_event_ts"),
        F.max("last_event_ts").alias("last_event_ts"),
    )
    zero = lambda name: F.coalesce(F.col(name), F.lit(0)).alias(name)
    return (
        customers.join(order_totals, "c_custkey", "left")
        .join(activity, "c_custkey", "left")
        .select(
            "c_custkey",
            "c_name",
            "c_nationkey",
            "c_mktsegment",
            "c_acctbal",
            zero("orders_count"),
            "orders_total",
            "last_order_date",
            zero("events_count"),
            zero("active_days"),
            zero("page_views"),
            zero("checkouts"),
            zero("errors"),
            "activity_amount",
            "first_event_ts",
            "last_event_ts",
        )
    )
