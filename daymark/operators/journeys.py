"""What a user did one after the other: sessions, and the cart a checkout came from.

Both cut time into slices as long as the gap, so that no user's rows meet in one place: a user
with a large share of all rows has a group per slice, and one slice is what a task must see at once.
Times are compared in microseconds. A row without a time takes part in no sequence.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daymark.functions.events import count_where
from daymark.session import require_utc

GAP = dt.timedelta(minutes=30)


def checkout_carts(silver: DataFrame, gap: dt.timedelta = GAP) -> DataFrame:
    """One row per checkout, with the user's last cart at or before it and at most `gap` earlier.

    Of carts at one time the largest event_id counts. `cart_event_id`, `cart_ts` and
    `seconds_since_cart` (whole seconds) are null if there was no such cart or the checkout has no time.

    A checkout finds its cart in its own slice or in the one before, so each cart is sent to two
    slices and all else follows from one shuffle by (user, slice). Checkouts without a time are spread evenly.
    """
    require_utc(silver.sparkSession)
    width, at = _micros(gap), _at("event_timestamp_ts")
    is_cart, slice_ = F.col("event_type") == "add_to_cart", at - F.pmod(at, F.lit(width))
    rows = silver.where(is_cart & at.isNotNull() | (F.col("event_type") == "checkout")).select(
        "event_id",
        "event_date",
        "user_id",
        "event_timestamp_ts",
        "amount",
        F.when(is_cart, F.struct(F.col("event_timestamp_ts").alias("ts"), "event_id")).alias("_cart"),
        F.when(is_cart, F.array(slice_, slice_ + width))
        .otherwise(F.array(F.coalesce(slice_, F.monotonically_increasing_id())))
        .alias("_slices"),
    )
    in_slices = rows.withColumn("_slice", F.explode("_slices"))
    # Carts first among rows of one time. A row without a time comes before them all.
    order = [F.col("event_timestamp_ts").asc_nulls_first(), F.col("_cart").isNull(), F.col("event_id").asc_nulls_first()]
    so_far = Window.partitionBy("user_id", "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    matched = in_slices.withColumn("_last", F.last("_cart", ignorenulls=True).over(so_far)).where("_cart IS NULL")
    since = at - _at("_last.ts")
    near = since <= width
    return matched.select(
        "event_id",
        "event_date",
        "user_id",
        "event_timestamp_ts",
        "amount",
        F.when(near, F.col("_last.event_id")).alias("cart_event_id"),
        F.when(near, F.col("_last.ts")).alias("cart_ts"),
        F.when(near, F.floor(since / 1_000_000)).cast("bigint").alias("seconds_since_cart"),
    )


def sessions(silver: DataFrame, gap: dt.timedelta = GAP) -> DataFrame:
    """One row per session: a user's events without a pause longer than `gap`; events without a time are left out.

    Events of one slice are less than a gap apart, so they are one session whatever lies between. They are
    summed up per (user, slice) with a partial step before the shuffle; what is ordered per user is then a row
    per slice the user was active in, whose number follows the calendar and not the events.
    """
    require_utc(silver.sparkSession)
    width, at = _micros(gap), _at("event_timestamp_ts")
    of = lambda kind: F.col("event_type") == kind
    slices = (
        silver.where(at.isNotNull())
        .groupBy("user_id", (at - F.pmod(at, F.lit(width))).alias("_slice"))
        .agg(
            F.min("event_timestamp_ts").alias("session_start"),
            F.max("event_timestamp_ts").alias("session_end"),
            F.count("*").alias("events_count"),
            count_where(of("add_to_cart")).alias("carts"),
            count_where(of("checkout")).alias("checkouts"),
            F.coalesce(F.sum(F.when(of("checkout"), F.col("amount"))), F.lit(0.0)).alias("revenue"),
        )
    )
    in_order = Window.partitionBy("user_id").orderBy("_slice")
    pause = _at("session_start") - F.lag(_at("session_end")).over(in_order)
    opens = F.when(pause <= width, 0).otherwise(1)
    numbered = slices.withColumn("_opens", opens).withColumn(
        "_session", F.sum("_opens").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    )
    sums = [F.sum(c).alias(c) for c in ("events_count", "carts", "checkouts", "revenue")]
    return (
        numbered.groupBy("user_id", "_session")
        .agg(F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"), *sums)
        .drop("_session")
    )


def conversion_daily(sessions: DataFrame) -> DataFrame:
    """Per day on which sessions began (UTC): how many, how many with a cart, and how many of these with a checkout."""
    carted: Column = F.col("carts") > 0
    return sessions.groupBy(F.to_date("session_start").alias("event_date")).agg(
        F.count("*").alias("sessions"),
        count_where(carted).alias("with_cart"),
        count_where(carted & (F.col("checkouts") > 0)).alias("converted"),
        F.sum("revenue").alias("revenue"),
    )


def _at(column: str) -> Column:
    """Microseconds of a wall-clock time in UTC, which the session's zone must be."""
    return F.unix_micros(F.col(column).cast("timestamp"))


def _micros(gap: dt.timedelta) -> int:
    micros = gap // dt.timedelta(microseconds=1)
    if micros <= 0:
        raise ValueError(f"the gap must be positive, not {gap}")
    return micros
