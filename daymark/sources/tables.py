"""Reading the lake's Parquet tables by contract, never by inference."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daymark import filesystem as files
from daymark.functions.events import event_date, storable
from daymark.schemas import EVENT_COLUMNS
from daymark.session import listings_shared


def read_table(
    spark: SparkSession,
    path: str,
    contract: StructType,
    dates: Iterable[dt.date] | None = None,
) -> DataFrame:
    """A table partitioned by event_date, with exactly the contract's columns.

    With `dates`, only those date directories are listed and read; without,
    all are. Partition values are typed by the contract, so one odd directory
    name cannot turn the whole date column into text.
    """
    if dates is None:
        paths = [path] if files.matching(spark, f"{path}/event_date=*") else []
    else:
        wanted = {f"event_date={d.isoformat()}" for d in dates}
        found = files.matching(spark, f"{path}/event_date=*")
        paths = [p for p in found if p.rsplit("/", 1)[-1] in wanted]
    if not paths:
        return spark.createDataFrame([], contract)
    with listings_shared(spark):
        rows = spark.read.schema(contract).option("basePath", path).parquet(*paths)
    return rows.select(*contract.fieldNames())


def as_text_events(events: DataFrame, ingest_date: dt.date | str) -> DataFrame:
    """Events of any column types, with or without all columns, as unwrapped ones.

    For tables that were loaded elsewhere, with inferred types. A date they
    carry themselves stands in where the event states none.
    """
    none = F.lit(None).cast("string")
    text = {c: F.col(c).cast("string") if c in events.columns else none for c in EVENT_COLUMNS}
    text["event_timestamp"] = F.nullif(text["event_timestamp"], F.lit(""))
    carried = [storable(F.col("event_date").try_cast("date"))] if "event_date" in events.columns else []
    return events.select(
        *[text[c].alias(c) for c in EVENT_COLUMNS],
        none.alias("ingest_fault"),
        none.alias("envelope"),
        event_date(text["event_timestamp"], *carried, ingest_date).alias("event_date"),
    )


def table_dates(spark: SparkSession, path: str) -> list[dt.date]:
    """Dates a table has a directory for, in order; no data is read."""
    names = [p.rsplit("event_date=", 1)[-1] for p in files.matching(spark, f"{path}/event_date=*")]
    return sorted(dt.date.fromisoformat(n) for n in names)
