"""All checks of a lake in one report."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.operators import contracts, quality
from daymark.operators.dedup import IDENTITY
from daymark.plans import lake as tables, load_checks
from daymark.plans.lake import Lake
from daymark.session import use_utc


def audit(spark: SparkSession, lake: Lake, dates: Iterable[dt.date] | None = None) -> DataFrame:
    """Rows (scope, check, failing), over the given dates or all.

    Scope `raw` reports on what senders sent; there a failure is news, not a
    fault of the lake. Over all dates the rules on single rows come from the records that the loads
    left when they were written, so bronze is read once, for its keys; they count undated copies
    too. Over given dates bronze is read twice, and undated copies that count on another day are left
    out. Any failure in scope `table` means a table is wrong. Gold is read twice (whole rows, and its keys
    alone), the others once.
    """
    use_utc(spark)
    dates = None if dates is None else sorted(set(dates))
    bronze, silver, rejected, gold = (
        read(spark, lake, dates)
        for read in (tables.read_events, tables.read_silver, tables.read_quarantine, tables.read_gold)
    )
    # Bronze rows that could not be opened have no event_id.
    copies = bronze.groupBy(*IDENTITY).agg(F.count("*").alias("copies"))
    if dates is None:
        raw = load_checks.totals(tables.load_report(spark, lake))
    else:
        raw = quality.row_report(bronze.filter("ingest_fault IS NULL"))
    raw = raw.unionByName(quality.identity_report(copies)).select(F.lit("raw"), "rule", "failing")
    table = contracts.table_checks(copies, silver, rejected, gold)
    return raw.unionAll(table.select(F.lit("table"), "*")).toDF("scope", "check", "failing")
