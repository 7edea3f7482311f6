"""What the rules of the quality report say of each bronze load, counted by the write of that load.

A load's record is a small file with its number of rows and how many of them break each rule. It is
removed before the load's rows change and written after, so a record never speaks of other rows
than the load has; loads without one are counted later (`lake.record_missing`).
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daymark import filesystem as files
from daymark.operators.quality import row_rules

OPENED = "message_opened"
_RECORD = "load_id string, opened long, unopened long, failing map<string, long>"
_FILE = "load-"


def conditions() -> dict[str, Column]:
    """What is counted in bronze rows for a record. As everywhere, the rules are for rows that could be opened."""
    opened = F.col("ingest_fault").isNull()
    return {"opened": opened, "unopened": ~opened, **{rule: opened & failing for rule, failing in row_rules().items()}}


class LoadChecks:
    """The records of a lake's loads."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.home = spark, f"{root}/load_checks"

    def loads(self) -> frozenset[str]:
        return frozenset(name.removeprefix(_FILE) for name in files.file_names(self.spark, self.home))

    def remove(self, load_id: str) -> None:
        files.delete(self.spark, f"{self.home}/{_FILE}{load_id}")

    def note(self, load_id: str, counts: Mapping[str, int]) -> None:
        """Write a load's record: how many rows meet each of `conditions`; no counts stand for no rows."""
        failing = {name: counts.get(name, 0) for name in conditions()}
        record = {"load_id": load_id, "opened": failing.pop("opened"), "unopened": failing.pop("unopened")}
        files.write_text(self.spark, f"{self.home}/{_FILE}{load_id}", json.dumps({**record, "failing": failing}))

    def report(self) -> DataFrame:
        """One row per load and rule: load_id, recorded_at, rule, failing, total.

        `total` is what the rule was put to: rows that could be opened; all rows for `message_opened`.
        """
        if not files.exists(self.spark, self.home):
            files.touch(self.spark, f"{self.home}/_made")
        records = self.spark.read.schema(_RECORD).json(self.home).select("*", "_metadata.file_modification_time")
        every = F.map_concat("failing", F.create_map(F.lit(OPENED), F.col("unopened")))
        return records.select(
            "load_id", F.col("file_modification_time").alias("recorded_at"), "opened", "unopened", F.explode(every).alias("rule", "failing")
        ).select(
            "load_id",
            "recorded_at",
            "rule",
            "failing",
            (F.col("opened") + F.when(F.col("rule") == OPENED, F.col("unopened")).otherwise(0)).alias("total"),
        )


def totals(report: DataFrame) -> DataFrame:
    """Failing and total rows per rule on single rows over all loads, as `quality.row_report` counts them in the rows."""
    sums = [F.sum(c).alias(c) for c in ("failing", "total")]
    return report.where(F.col("rule") != OPENED).groupBy("rule").agg(*sums)


def drift(report: DataFrame, deviations: float = 4.0, least: float = 0.01) -> DataFrame:
    """Each load and rule beside all loads recorded earlier, with `drifted`.

    A rule has drifted if the share of failing rows differs from the share in all earlier loads
    together by more than `deviations` standard errors of two proportions, and by more than
    `least`, so that very large loads do not report what is too small to matter. The first load,
    and one without rows, has not. Written again, a load counts as recorded then. The window holds
    one row per load and rule.
    """
    earlier = Window.partitionBy("rule").orderBy("recorded_at", "load_id").rowsBetween(Window.unboundedPreceding, -1)
    beside = report.withColumns({f"earlier_{c}": F.coalesce(F.sum(c).over(earlier), F.lit(0)) for c in ("failing", "total")})
    f, n, f0, n0 = (F.col(c).cast("double") for c in ("failing", "total", "earlier_failing", "earlier_total"))
    gap = F.abs(F.try_divide(f, n) - F.try_divide(f0, n0))
    pooled = F.try_divide(f + f0, n + n0)
    error = F.sqrt(pooled * (1 - pooled) * (F.try_divide(F.lit(1.0), n) + F.try_divide(F.lit(1.0), n0)))
    drifted = (gap > least) & (gap > deviations * error)
    return beside.withColumn("drifted", F.coalesce(drifted, F.lit(False)))
