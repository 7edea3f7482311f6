"""Schema contracts, table constraints and metric invariants."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daymark.functions.events import count_where
from daymark.operators.dedup import IDENTITY
from daymark.schemas import GOLD_KEY, GOLD_NOT_NULL


def require_columns(df: DataFrame, contract: StructType) -> DataFrame:
    """Return `df`, or raise ValueError naming missing and wrongly typed columns."""
    present = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in contract.fields if f.name not in present]
    if missing:
        raise ValueError(f"Missing required columns: {missing}")
    wrong = [
        f"{f.name}: {present[f.name].simpleString()} instead of {f.dataType.simpleString()}"
        for f in contract.fields
        if present[f.name] != f.dataType
    ]
    if wrong:
        raise ValueError(f"Columns of the wrong type: {wrong}")
    return df


def column_profile(df: DataFrame, contract: StructType) -> DataFrame:
    """Per contract column: its type, and how many rows have a value. One pass."""
    require_columns(df, contract)
    counts = df.agg(
        F.count("*").alias("total_rows"),
        *[F.count(f.name).alias(f.name) for f in contract.fields],
    )
    names = [f.name for f in contract.fields]
    types = F.create_map(*[F.lit(x) for f in contract.fields for x in (f.name, f.dataType.simpleString())])
    return counts.unpivot(["total_rows"], names, "column_name", "non_null_rows").select(
        "column_name",
        types[F.col("column_name")].alias("data_type"),
        "non_null_rows",
        "total_rows",
    )


def null_violations(df: DataFrame, columns: Sequence[str] = GOLD_NOT_NULL) -> DataFrame:
    """Null rows per NOT NULL column: all zero in a sound table. One pass."""
    counts = df.agg(*[count_where(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "null_rows")


def duplicate_keys(df: DataFrame, key: Sequence[str] = GOLD_KEY) -> DataFrame:
    """Keys that occur more than once: no rows in a sound table."""
    return df.groupBy(*key).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def key_summary(df: DataFrame, key: Sequence[str] = GOLD_KEY) -> DataFrame:
    """One row: how many keys there are, and how many occur more than once."""
    return (
        df.groupBy(*key)
        .agg(F.count("*").alias("copies"))
        .agg(
            F.count("*").alias("distinct_keys"),
            count_where(F.col("copies") > 1).alias("duplicate_keys"),
        )
    )


def _broken_rules() -> dict[str, Column]:
    """Rule between the metrics -> condition under which a gold row breaks it."""
    c = F.col
    kinds = c("page_view_count") + c("login_count") + c("add_to_cart_count") + c("checkout_count") + c("error_count")
    return {
        "events_count_is_sum_of_types": c("events_count") != kinds,
        "purchase_events_is_checkout_count": c("purchase_events") != c("checkout_count"),
        "error_events_is_error_count": c("error_events") != c("error_count"),
        "first_event_not_after_last": c("first_event_ts") > c("last_event_ts"),
        "first_and_last_event_both_or_neither": c("first_event_ts").isNull()
        != c("last_event_ts").isNull(),
        "at_least_one_event": c("events_count") < 1,
    }


def metric_invariants(gold: DataFrame) -> DataFrame:
    """Gold rows that break each rule between the metrics: all zero if sound."""
    broken = _broken_rules()
    counts = gold.agg(
        F.count("*").alias("gold_rows"),
        *[count_where(rule).alias(name) for name, rule in broken.items()],
    )
    return counts.unpivot(["gold_rows"], list(broken), "invariant", "violations")


def events_once(copies: DataFrame) -> DataFrame:
    """One row: how many events are left of each identity's `copies`; those without an id all stay."""
    once = F.when(F.col("event_id").isNull(), F.col("copies")).otherwise(1)
    return copies.agg(F.coalesce(F.sum(once), F.lit(0)).alias("rows"))


def reconciliation(
    bronze: DataFrame, silver: DataFrame, rejected: DataFrame, gold: DataFrame
) -> DataFrame:
    """Row counts that must agree between the stages: expected equals actual if sound."""
    events = events_once(bronze.groupBy(*IDENTITY).agg(F.count("*").alias("copies")))
    judged = silver.select("event_date").unionAll(rejected.select("event_date"))
    in_gold = gold.agg(F.coalesce(F.sum("events_count"), F.lit(0)).alias("rows"))

    def check(name: str, expected: DataFrame, actual: DataFrame) -> DataFrame:
        # One row each.
        pair = expected.select(F.col("rows").alias("expected"), F.lit(None).cast("bigint").alias("actual"))
        pair = pair.unionAll(actual.select(F.lit(None).cast("bigint"), F.col("rows")))
        return pair.agg(F.max("expected").alias("expected"), F.max("actual").alias("actual")).select(
            F.lit(name).alias("check"), "expected", "actual"
        )

    def rows(df: DataFrame) -> DataFrame:
        return df.agg(F.count("*").alias("rows"))

    return check("silver_and_quarantine_hold_every_event", events, rows(judged)).unionAll(
        check("gold_counts_every_silver_row", rows(silver), in_gold)
    )


def table_checks(
    copies: DataFrame, silver: DataFrame, rejected: DataFrame, gold: DataFrame
) -> DataFrame:
    """All of the above as rows (check, failing), from one row of totals.

    `copies` has the bronze rows of each identity. Silver and quarantine are counted
    once. Gold is read twice: all of it for the rules, and its key alone for the one
    check that needs a shuffle, which stays as narrow as the key.
    """
    rules = {f"{c}_not_null": F.col(c).isNull() for c in GOLD_NOT_NULL} | _broken_rules()
    in_gold = F.coalesce(F.sum("events_count"), F.lit(0)).alias("in_gold")
    totals = gold.agg(*[count_where(rule).alias(name) for name, rule in rules.items()], in_gold)
    for other in (
        key_summary(gold).select(F.col("duplicate_keys").alias("gold_key_unique")),
        silver.agg(F.count("*").alias("in_silver")),
        rejected.agg(F.count("*").alias("in_quarantine")),
        events_once(copies).withColumnRenamed("rows", "events"),
    ):
        totals = totals.unionByName(other, allowMissingColumns=True)
    # One row each, so that the greatest is the only one.
    row = totals.agg(*[F.max(c).alias(c) for c in totals.columns])
    found = row.select(
        *rules,
        "gold_key_unique",
        F.abs(F.expr("events - in_silver - in_quarantine")).alias("silver_and_quarantine_hold_every_event"),
        F.abs(F.expr("in_silver - in_gold")).alias("gold_counts_every_silver_row"),
    )
    return found.unpivot([], found.columns, "check", "failing")


def require_sound(gold: DataFrame) -> None:
    """Raise ValueError if the table breaks its NOT NULL or key constraints.

    One pass: each key carries its copies and a bit for every column that is null somewhere.
    """
    bits = [F.when(F.col(c).isNull(), 1 << i).otherwise(0) for i, c in enumerate(GOLD_NOT_NULL)]
    keys = gold.groupBy(*GOLD_KEY).agg(F.count("*").alias("copies"), F.bit_or(sum(bits, F.lit(0))).alias("nulls"))
    found = keys.agg(
        count_where(F.col("copies") > 1).alias("duplicate_keys"),
        F.coalesce(F.bit_or("nulls"), F.lit(0)).alias("nulls"),
    ).first()
    nulls = [c for i, c in enumerate(GOLD_NOT_NULL) if found.nulls >> i & 1]
    if nulls:
        raise ValueError(f"NOT NULL columns hold nulls: {nulls}")
    if found.duplicate_keys:
        raise ValueError(f"Primary key {GOLD_KEY} is not unique")
