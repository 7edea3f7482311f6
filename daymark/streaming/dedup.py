"""Deduplication within a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.operators.dedup import IDENTITY


def dedup_stream(
    events: DataFrame, horizon: str, spread: str | None = None
) -> DataFrame:
    """First copy of each event among those processed within `horizon` of each other.

    For consumers that need events at once; the tables come from the date
    rebuild, which has no horizon. `horizon` is processing time: an event arrives
    with the micro-batch that reads it, so no row is ever late, however old its file
    or the time it states, and only how long a copy is recognised is limited.
    Rows without an id all pass.

    All copies of one identity meet in one state partition. `spread` names a
    column, such as the landing file, by which copies are thinned out first, so
    that at most one per identity and value of `spread` goes on to it.
    """
    # Rows without an id must not count as copies of each other.
    key = F.coalesce(F.col("event_id"), F.concat(F.lit("\u0000"), F.expr("uuid()")))
    keyed = events.withColumn("_key", key).withColumn("_arrival", F.current_timestamp())
    keyed = keyed.withWatermark("_arrival", horizon)
    identity = ["_key", *(c for c in IDENTITY if c != "event_id")]
    if spread is not None:
        keyed = keyed.dropDuplicatesWithinWatermark([*identity, spread])
    return keyed.dropDuplicatesWithinWatermark(identity).drop("_key", "_arrival")
