"""Daily metrics per user."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.functions.events import count_where
from daymark.operators.contracts import require_columns
from daymark.schemas import GOLD, GOLD_INPUT, GOLD_KEY


def daily_user_metrics(silver: DataFrame) -> DataFrame:
    """One row per (event_date, user_id).

    All buffers have a fixed width, so this is a hash aggregate with a partial
    step before its one shuffle: a busy user or date sends one row per task.
    """
    require_columns(silver, GOLD_INPUT)
    of_type = {
        "page_view_count": "page_view",
        "login_count": "login",
        "add_to_cart_count": "add_to_cart",
        "checkout_count": "checkout",
        "error_count": "error",
    }
    return silver.groupBy(*GOLD_KEY).agg(
        F.count("*").alias("events_count"),
        *[count_where(F.col("event_type") == kind).alias(name) for name, kind in of_type.items()],
        F.sum("is_purchase_event").alias("purchase_events"),
        F.sum("is_error_event").alias("error_events"),
        F.sum("amount").alias("total_amount"),
        F.min("event_timestamp_ts").alias("first_event_ts"),
        F.max("event_timestamp_ts").alias("last_event_ts"),
    ).select(*GOLD.fieldNames())
