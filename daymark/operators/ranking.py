"""Exact ranks over a whole table without bringing it into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daymark.session import stage

# monotonically_increasing_id() puts the task's number above this bit.
_TASK_BITS = 33


def ntile_within(
    df: DataFrame, group: str, order: Sequence[str], buckets: int, name: str
) -> DataFrame:
    """`ntile(buckets) OVER (PARTITION BY group ORDER BY order)` for groups of any size.

    A window would pull each group into one task. Here the rows are range-sorted
    over all tasks, a row's rank is the number of rows in earlier tasks plus its
    place in its own; what is joined to them is one count per task and group. `order` should be unique within a group, which also lets the range
    sort cut through a value that very many rows share.

    The sorted rows are written out once, so that counts and places come from
    the same sort whatever is recomputed.
    """
    placed = stage(
        df.orderBy(group, *order).withColumn("_place", F.monotonically_increasing_id()), "ntile"
    )
    task = F.shiftright("_place", _TASK_BITS)
    earlier = Window.partitionBy(group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (
        placed.groupBy(group, task.alias("_task"))
        .agg(F.count("*").alias("_rows"), F.min("_place").alias("_first"))
        .select(
            group,
            "_task",
            "_first",
            F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
            F.sum("_rows").over(Window.partitionBy(group)).alias("_all"),
        )
    )
    # As in SQL: the first `_all % buckets` buckets hold one row more than the others.
    bucket = F.expr(
        f"""CASE WHEN _rank < (_all % {buckets}) * (_all div {buckets} + 1)
                 THEN _rank div (_all div {buckets} + 1)
                 ELSE (_rank - _all % {buckets}) div (_all div {buckets}) END"""
    )
    return (
        placed.withColumn("_task", task)
        .join(sizes, [group, "_task"])
        .withColumn("_rank", F.col("_before") + F.col("_place") - F.col("_first"))
        .select(*df.columns, (bucket + 1).cast("int").alias(name))
    )
