"""One row per event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

IDENTITY = ("event_id", "event_date")


def dedup_events(events: DataFrame, identity: Sequence[str] = IDENTITY) -> DataFrame:
    """Keep one copy of each `identity`; keep every row without an event_id.

    Rows that differ under one identity are ordered by timestamp text, absent
    ones last, then by all other columns, so the choice does not depend on the
    order of arrival. `row_number() = 1` lets Spark drop all but one copy per
    identity in each task before the shuffle: an id that holds a large share of
    the rows sends one row per task. The id leads the sort because its first
    bytes tell rows apart, which the date's do not. A row without an id gets a
    number of its own as part of the key, which spreads such rows evenly; the
    numbers follow the order of reading, which for files a re-run repeats.

    The date is part of the identity, so a date can be rebuilt from its own
    rows alone. `quality.dq_report` counts ids that occur on several dates; over
    a whole history, `identity=("event_id",)` keeps the earliest of those too.
    """
    rest = [c for c in events.columns if c not in identity and c != "event_timestamp"]
    order = [F.col(c).asc_nulls_last() for c in ("event_timestamp", *rest)]
    copies = Window.partitionBy(*identity, "_own").orderBy(*order)
    own = F.when(F.col("event_id").isNull(), F.monotonically_increasing_id())
    return (
        events.withColumn("_own", own)
        .withColumn("_copy", F.row_number().over(copies))
        .filter(F.col("_copy") == 1)
        .drop("_own", "_copy")
    )
