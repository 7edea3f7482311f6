"""Typing, validation and enrichment of bronze events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.functions.events import flag, row_fault, utc_timestamp, whole_number
from daymark.schemas import EVENT_COLUMNS, SILVER
from daymark.session import require_utc

ACCEPTED, REJECTED = "accepted", "rejected"


def enforce_types(events: DataFrame) -> DataFrame:
    """Typed columns beside the text they come from, under a `typed_` prefix."""
    require_utc(events.sparkSession)
    return events.withColumns(
        {
            "typed_user_id": whole_number(F.col("user_id")),
            "typed_product_id": whole_number(F.col("product_id")),
            "typed_amount": F.col("amount").try_cast("double"),
            "event_timestamp_ts": utc_timestamp(F.col("event_timestamp")),
        }
    )


def with_reason(typed: DataFrame) -> DataFrame:
    """Add `reason`: why the row is set aside, or null if it is sound."""
    reason = row_fault(
        F.col("typed_user_id"),
        F.col("event_type"),
        F.col("page"),
        F.col("event_timestamp"),
        F.col("event_timestamp_ts"),
    )
    if "ingest_fault" in typed.columns:
        reason = F.coalesce(F.col("ingest_fault"), reason)
    return typed.withColumn("reason", reason)


def enrich(sound: DataFrame) -> DataFrame:
    """The silver columns, in contract order."""
    return sound.select(*_silver_columns())


def _silver_columns() -> list:
    made = {
        "user_id": F.col("typed_user_id"),
        "product_id": F.col("typed_product_id"),
        "amount": F.col("typed_amount"),
        "is_purchase_event": flag(F.col("event_type") == "checkout"),
        "is_error_event": flag(F.col("event_type") == "error"),
        "event_hour": F.hour("event_timestamp_ts"),
        "event_day_of_week": F.date_format("event_timestamp_ts", "E"),
    }
    return [made.get(name, F.col(name)).alias(name) for name in SILVER.fieldNames()]


def clean(events: DataFrame) -> DataFrame:
    """Silver rows of already deduplicated events: narrow, no shuffle."""
    return enrich(with_reason(enforce_types(events)).filter(F.col("reason").isNull()))


def quarantine(events: DataFrame) -> DataFrame:
    """The rows `clean` leaves out, as text, with the reason."""
    rejected = with_reason(enforce_types(events)).filter(F.col("reason").isNotNull())
    envelope = F.col("envelope") if "envelope" in events.columns else F.lit(None).cast("string")
    return rejected.select(*EVENT_COLUMNS, "event_date", "reason", envelope.alias("envelope"))


def screen(events: DataFrame) -> DataFrame:
    """Silver and quarantine in one frame, told apart by `verdict`.

    One frame means one pass over the deduplicated events and one write for
    both. Rejected rows carry their original text in `rejected_event`.
    """
    judged = with_reason(enforce_types(events))
    is_rejected = F.col("reason").isNotNull()
    text = F.to_json(F.struct(*EVENT_COLUMNS))
    return judged.select(
        *_silver_columns(),
        "reason",
        F.when(is_rejected, text).alias("rejected_event"),
        F.when(is_rejected, F.col("envelope")).alias("envelope"),
        F.when(is_rejected, REJECTED).otherwise(ACCEPTED).alias("verdict"),
    )


def quarantine_summary(rejected: DataFrame) -> DataFrame:
    """Rows set aside per reason."""
    return rejected.groupBy("reason").agg(F.count("*").alias("rejected_rows"))
