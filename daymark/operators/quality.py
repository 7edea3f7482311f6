"""Data-quality report over raw events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daymark.functions.events import count_where, one_of, utc_timestamp, whole_number
from daymark.schemas import AMOUNT_RANGE, ERROR_CODES, EVENT_TYPES, PAGES, PRODUCT_ID_RANGE
from daymark.session import require_utc


def row_rules() -> dict[str, Column]:
    """Rule name -> condition under which a row fails it. Null counts as no failure."""
    c = F.col
    has_item = c("event_type").isin("add_to_cart", "checkout")
    user_id, product_id = whole_number(c("user_id")), whole_number(c("product_id"))
    amount = c("amount").try_cast("double")
    is_finite = ~F.isnan(amount) & (F.abs(amount) < float("inf"))
    return {
        "event_id_not_null": c("event_id").isNull(),
        "user_id_not_null": c("user_id").isNull(),
        "user_id_is_integer": c("user_id").isNotNull() & user_id.isNull(),
        "event_type_accepted": ~one_of(c("event_type"), EVENT_TYPES),
        "page_accepted": ~one_of(c("page"), PAGES),
        "event_timestamp_not_null": c("event_timestamp").isNull(),
        "event_timestamp_readable": c("event_timestamp").isNotNull()
        & utc_timestamp(c("event_timestamp")).isNull(),
        "product_id_in_range": c("product_id").isNotNull()
        & ~F.coalesce(product_id.between(*PRODUCT_ID_RANGE), F.lit(False)),
        "product_id_only_with_item_events": c("product_id").isNotNull() != has_item,
        "amount_is_number": c("amount").isNotNull() & amount.isNull(),
        "amount_is_finite": amount.isNotNull() & ~is_finite,
        "amount_in_range": amount.isNotNull() & is_finite & ~amount.between(*AMOUNT_RANGE),
        "error_code_accepted": c("error_code").isNotNull() & ~one_of(c("error_code"), ERROR_CODES),
        "error_code_only_with_errors": c("error_code").isNotNull() != (c("event_type") == "error"),
    }


def row_report(events: DataFrame) -> DataFrame:
    """Failing and total rows per rule on single rows, all in one pass."""
    require_utc(events.sparkSession)
    rules = row_rules()
    return (
        events.agg(
            F.count("*").alias("total"),
            *[count_where(failing).alias(name) for name, failing in rules.items()],
        )
        .unpivot(["total"], list(rules), "rule", "failing")
        .select("rule", "failing", "total")
    )


def identity_report(copies: DataFrame) -> DataFrame:
    """Failing and total rows of the identity rules, from (event_id, event_date, copies).

    One aggregate by event_id, whose buffers are fixed-width, so copies are merged in
    each task before the shuffle. Rows without an id are left out at the end, not by a
    filter, which Spark would move into the plan of `copies` and so keep it from being shared.
    """
    known = F.col("event_id").isNotNull()
    return (
        copies.groupBy("event_id")
        .agg(
            F.sum("copies").alias("copies"),
            F.min("event_date").alias("first_date"),
            F.max("event_date").alias("last_date"),
        )
        .agg(
            F.coalesce(F.sum(F.when(known, F.col("copies"))), F.lit(0)).alias("total"),
            F.coalesce(F.sum(F.when(known, F.col("copies") - 1)), F.lit(0)).alias("event_id_unique"),
            count_where(known & (F.col("first_date") < F.col("last_date"))).alias("event_id_on_one_date"),
        )
        .unpivot(["total"], ["event_id_unique", "event_id_on_one_date"], "rule", "failing")
        .select("rule", "failing", "total")
    )


def dq_report(events: DataFrame) -> DataFrame:
    """Failing and total rows per rule, on single rows and on identities."""
    copies = events.select("event_id", "event_date", F.lit(1).cast("bigint").alias("copies"))
    return row_report(events).unionByName(identity_report(copies))
