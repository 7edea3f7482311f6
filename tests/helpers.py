"""Builders for hand-made events and envelopes."""

import json

from pyspark.sql import functions as F

from daymark.functions.events import event_date
from daymark.schemas import EVENT_TEXT

GOOD = {
    "event_id": "e1",
    "user_id": "7",
    "event_type": "checkout",
    "event_timestamp": "2024-01-05T10:11:12.123456+00:00",
    "page": "/cart",
    "product_id": "1001",
    "amount": "12.5",
    "error_code": None,
    "source": "web_app",
}
INGEST_DATE = "2024-02-01"


def event(**changes):
    return {**GOOD, **changes}


def events_df(spark, *rows):
    """Bronze-like events: text columns and the partition date."""
    data = [tuple(r[f.name] for f in EVENT_TEXT.fields) for r in rows]
    none = F.lit(None).cast("string")
    return spark.createDataFrame(data, EVENT_TEXT).withColumns(
        {
            "event_date": event_date(F.col("event_timestamp"), INGEST_DATE),
            "ingest_fault": none,
            "envelope": none,
        }
    )


def envelope(message, **outer):
    """An envelope line; a dict message is encoded first."""
    if isinstance(message, dict):
        message = json.dumps(message)
    return json.dumps({"Type": "Notification", "Message": message, **outer})


def lines_df(spark, *lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def write_lines(directory, name, *lines):
    directory.mkdir(parents=True, exist_ok=True)
    (directory / name).write_text("\n".join(lines) + "\n")


def rows(df):
    """Rows as a sorted list of tuples, for comparison as sets with counts."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
