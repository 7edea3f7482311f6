"""Replacing whole partitions of a Parquet table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from daymark import filesystem as files
from daymark.functions.events import count_where

_MET = "_conditions_met"


def replace_partitions(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    owned: Iterable[str],
    gather: bool = True,
) -> list[str]:
    """Write `df`, replacing each partition it has rows for, and drop the rest of `owned`.

    `owned` names the partition directories (below `path`) this write stands
    for. Dynamic overwrite leaves a partition alone if the new data has no row
    for it, so those of `owned` that the rows themselves did not name are
    deleted. Running the same write twice leaves the same table. Returns the
    directories written.

    With `gather` the rows of a partition are brought together, so that the number of
    files follows the data and not tasks x partitions; adaptive execution
    splits a partition that is too large for one task. Without it the caller
    has brought them together already.
    """
    return replace_and_count(df, path, keys, owned, {}, gather)[0]


def replace_and_count(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    owned: Iterable[str],
    conditions: Mapping[str, Column],
    gather: bool = True,
) -> tuple[list[str], dict[str, int]]:
    """As `replace_partitions`, and how many of the rows written meet each condition (63 at most); nothing if there are no rows.

    The counts come from the write itself. They are collected behind the shuffle that gathers the
    rows, in the last stage, where every task counts once, however many executors are lost. In an
    earlier stage the rows of a task that is run again would count again. Metrics are not compiled, so the conditions are tested in a
    projection before, which is, and only their bits are counted.
    """
    spark, owned = df.sparkSession, list(owned)
    seen, bits = Observation(), [F.when(c, 1 << i).otherwise(0).cast("long") for i, c in enumerate(conditions.values())]
    rows = df.hint("rebalance", *keys) if gather else df
    if bits:
        rows = rows.withColumn(_MET, reduce(Column.bitwiseOR, bits))
    counts = [count_where(F.col(_MET).bitwiseAND(F.lit(1 << i)) != 0).alias(name) for i, name in enumerate(conditions)]
    (
        rows.observe(seen, F.collect_set(F.struct(*keys)).alias("partitions"), *counts)
        .drop(_MET)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*keys)
        .parquet(path)
    )
    found = _observed(seen, df)
    written = sorted("/".join(f"{k}={_text(r[k])}" for k in keys) for r in found.pop("partitions", []))
    stale = sorted(set(owned) - set(written))
    files.each(lambda p: files.delete(spark, f"{path}/{p}"), stale)
    return written, found


def _observed(seen: Observation, df: DataFrame) -> dict:
    """What was observed while writing; nothing if Spark found out that there are no rows at all."""
    try:
        return dict(seen.get)
    except Py4JJavaError:
        # The observation goes with the plan's empty branch. Anything else must not delete data.
        if not df.isEmpty():
            raise
        return {}


def _text(value: str | dt.date) -> str:
    return value.isoformat() if isinstance(value, dt.date) else value
