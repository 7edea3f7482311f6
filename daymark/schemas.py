"""Table contracts: column names, types and value domains of every stage."""

from __future__ import annotations

from pyspark.sql import types as T

# The event contract.
EVENT_TYPES = ("login", "page_view", "add_to_cart", "checkout", "error")
PAGES = ("/", "/home", "/products", "/cart", "/checkout", "/support")
ERROR_CODES = ("500_INTERNAL", "TIMEOUT", "VALIDATION_ERROR")
PRODUCT_ID_RANGE = (1000, 1100)
AMOUNT_RANGE = (5.0, 300.0)

# Reasons a row is set aside, in the order they are tested.
INGEST_FAULTS = ("bad_envelope", "empty_message", "bad_message")
ROW_FAULTS = ("bad_user_id", "bad_event_type", "bad_page", "bad_event_timestamp")


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, null) for name, dtype, null in fields])


_text, _long, _double = T.StringType(), T.LongType(), T.DoubleType()
_int, _date, _ts = T.IntegerType(), T.DateType(), T.TimestampNTZType()

# The message body. Everything is read as text, so one odd value never fails
# or re-types a whole batch; screening does the typing.
EVENT_TEXT = _struct(
    ("event_id", _text, True),
    ("user_id", _text, True),
    ("event_type", _text, True),
    ("event_timestamp", _text, True),
    ("page", _text, True),
    ("product_id", _text, True),
    ("amount", _text, True),
    ("error_code", _text, True),
    ("source", _text, True),
)
EVENT_COLUMNS = tuple(EVENT_TEXT.fieldNames())

# Every message that arrived. `ingest_fault` is set, and `envelope` keeps the
# text, only where the message could not be opened.
BRONZE = T.StructType(
    EVENT_TEXT.fields
    + [
        T.StructField("ingest_fault", _text, True),
        T.StructField("envelope", _text, True),
        T.StructField("event_date", _date, True),
        T.StructField("load_id", _text, True),
    ]
)

# As stored: where small loads have been merged, a row keeps the name of its own.
BRONZE_STORED = T.StructType([*BRONZE.fields, T.StructField("of_load", _text, True)])

# The silver contract.
SILVER = _struct(
    ("event_id", _text, True),
    ("user_id", _long, True),
    ("event_type", _text, True),
    ("event_timestamp", _text, True),
    ("event_timestamp_ts", _ts, True),
    ("event_date", _date, True),
    ("page", _text, True),
    ("product_id", _long, True),
    ("amount", _double, True),
    ("error_code", _text, True),
    ("source", _text, True),
    ("is_purchase_event", _int, True),
    ("is_error_event", _int, True),
    ("event_hour", _int, True),
    ("event_day_of_week", _text, True),
)

QUARANTINE = T.StructType(
    EVENT_TEXT.fields
    + [
        T.StructField("event_date", _date, True),
        T.StructField("reason", _text, True),
        T.StructField("envelope", _text, True),
    ]
)

# The gold contract.
GOLD = _struct(
    ("event_date", _date, False),
    ("user_id", _long, False),
    ("events_count", _long, False),
    ("page_view_count", _long, False),
    ("login_count", _long, False),
    ("add_to_cart_count", _long, False),
    ("checkout_count", _long, False),
    ("error_count", _long, False),
    ("purchase_events", _long, False),
    ("error_events", _long, False),
    ("total_amount", _double, True),
    ("first_event_ts", _ts, True),
    ("last_event_ts", _ts, True),
)
GOLD_KEY = ("event_date", "user_id")
GOLD_NOT_NULL = tuple(f.name for f in GOLD.fields if not f.nullable)

# What the daily metrics need from silver.
GOLD_INPUT = T.StructType(
    [
        SILVER[name]
        for name in (
            "event_date",
            "user_id",
            "event_type",
            "event_timestamp_ts",
            "amount",
            "is_error_event",
            "is_purchase_event",
        )
    ]
)
