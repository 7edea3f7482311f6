"""Typing, validation and enrichment expressions for one event row.

All parsing is of the `try_` kind: a bad value becomes null under ANSI and
non-ANSI settings alike, and a rule then names it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from daymark.schemas import EVENT_TYPES, PAGES


def stated_date(timestamp_text: Column) -> Column:
    """Calendar date written at the start of an ISO-8601 text, else null.

    The shape test keeps out short forms and years beyond four digits, which a
    plain cast takes and a date partition directory cannot hold.
    """
    prefix = F.substring(timestamp_text, 1, 10)
    is_shaped = (F.substring(prefix, 5, 1) == "-") & (F.substring(prefix, 8, 1) == "-")
    return F.when(is_shaped, storable(prefix.try_cast("date")))


def storable(day: Column) -> Column:
    """The date if its year is 1 to 9999, else null: others cannot be read back from a directory's name."""
    return F.when(F.year(day).between(1, 9999), day)


def event_date(timestamp_text: Column, *fallbacks: Column | dt.date | str) -> Column:
    """Partition date: as stated in the timestamp text, in the sender's own zone.

    Where the text is absent or unreadable the first fallback that has a value
    counts, so that no row falls into an ever-growing null partition.
    """
    others = [f if isinstance(f, Column) else _date_literal(f) for f in fallbacks]
    return F.coalesce(stated_date(timestamp_text), *others)


def _date_literal(day: dt.date | str) -> Column:
    return F.lit(day if isinstance(day, dt.date) else dt.date.fromisoformat(day))


def utc_timestamp(timestamp_text: Column) -> Column:
    """UTC wall-clock time of an ISO-8601 text, else null.

    Needs a stated date: Spark reads a bare time of day as today's.
    """
    instant = F.try_to_timestamp(timestamp_text).cast("timestamp_ntz")
    return F.when(stated_date(timestamp_text).isNotNull(), instant)


def whole_number(text: Column) -> Column:
    """The bigint a text holds, else null; `7.0` counts, as senders whose column
    has gaps write whole numbers that way."""
    decimal = text.try_cast("decimal(38,18)")
    return F.coalesce(
        text.try_cast("bigint"), F.when(decimal == F.floor(decimal), decimal.try_cast("bigint"))
    )


def one_of(value: Column, allowed: tuple[str, ...]) -> Column:
    """Exact membership; null is not a member."""
    return F.coalesce(value.isin(*allowed), F.lit(False))


def row_fault(
    user_id: Column, event_type: Column, page: Column, timestamp_text: Column, timestamp: Column
) -> Column:
    """First rule the row breaks, or null.

    An absent timestamp is allowed; one that is present must be readable.
    """
    return (
        F.when(user_id.isNull(), "bad_user_id")
        .when(~one_of(event_type, EVENT_TYPES), "bad_event_type")
        .when(~one_of(page, PAGES), "bad_page")
        .when(timestamp_text.isNotNull() & timestamp.isNull(), "bad_event_timestamp")
    )


def flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def count_where(condition: Column) -> Column:
    """Rows for which the condition holds; 0, never null, for a group without any."""
    return F.count(F.when(condition, 1))
