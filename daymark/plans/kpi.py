"""KPI queries over the silver, gold and order tables."""

from __future__ import annotations

import datetime as dt
import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daymark.functions.events import count_where, flag
from daymark.operators.ranking import ntile_within

SKETCH_PRECISION = 12  # 4096 registers of a few bits


def event_revenue_daily(silver: DataFrame) -> DataFrame:
    """Revenue per day: checkouts only, unlike gold's total_amount."""
    return (
        silver.filter(F.col("event_type") == "checkout")
        .groupBy("event_date")
        .agg(
            F.sum("amount").alias("revenue"),
            F.count("*").alias("checkouts"),
            F.countDistinct("user_id").alias("buyers"),
        )
    )


def order_revenue_daily(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Gross and net revenue per order date.

    Lines are summed per order before the join, so the join is one row to at
    most one row however many lines an order has.
    """
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    lines = lineitem.groupBy("l_orderkey").agg(F.sum(net).alias("net"))
    return (
        orders.select("o_orderkey", "o_totalprice", F.col("o_orderdate").cast("date").alias("order_date"))
        .join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .groupBy("order_date")
        .agg(
            F.count("*").alias("orders_count"),
            F.sum("o_totalprice").alias("gross_revenue"),
            F.coalesce(F.sum("net"), F.lit(0.0)).alias("net_revenue"),
        )
    )


def retention(gold: DataFrame) -> DataFrame:
    """Users of each cohort (first active date) active n days later.

    Gold has one row per user and date, so the window over a user holds at most
    one row per calendar day, and no self join is needed.
    """
    first = F.min("event_date").over(Window.partitionBy("user_id"))
    active = (
        gold.select("user_id", "event_date", first.alias("cohort_date"))
        .groupBy("cohort_date", F.date_diff("event_date", "cohort_date").alias("day_offset"))
        .agg(F.count("*").alias("active_users"))
    )
    # One row per pair of calendar days by now; offset 0 is the whole cohort.
    size = F.max("active_users").over(Window.partitionBy("cohort_date"))
    return active.select(
        "cohort_date",
        "day_offset",
        "active_users",
        size.alias("cohort_size"),
        (F.col("active_users") / size).alias("retention_rate"),
    )


def churn_proxy(
    gold: DataFrame, customers: DataFrame, as_of: dt.date | str, idle_days: int = 14
) -> DataFrame:
    """Activity state of each user on `as_of`: active, churned or never_active.

    Users are the customers and whoever has events up to that day. Churned means the
    last event is more than `idle_days` days before; later events do not count.
    """
    day = F.lit(str(as_of)).cast("date")
    last = gold.where(F.col("event_date") <= day).groupBy("user_id").agg(F.max("event_date").alias("last_event_date"))
    idle = F.date_diff(day, "last_event_date")
    state = (
        F.when(F.col("last_event_date").isNull(), "never_active")
        .when(idle > idle_days, "churned")
        .otherwise("active")
    )
    return customers.join(last, F.col("c_custkey") == F.col("user_id"), "full").select(
        F.coalesce("c_custkey", "user_id").alias("user_id"),
        "c_mktsegment",
        "last_event_date",
        idle.alias("days_inactive"),
        state.alias("activity_state"),
    )


def rfm_measures(orders: DataFrame) -> DataFrame:
    """Recency, frequency and monetary value of each customer, as rows (o_custkey, measure, value)."""
    customers = orders.groupBy("o_custkey").agg(
        F.max(F.col("o_orderdate").cast("date")).alias("last_order_date"),
        F.count("*").alias("orders_count"),
        F.round(F.sum("o_totalprice"), 2).alias("monetary"),
    )
    return customers.select(
        "o_custkey",
        F.unix_date("last_order_date").cast("double").alias("recency"),
        F.col("orders_count").cast("double").alias("frequency"),
        "monetary",
    ).unpivot(["o_custkey"], ["recency", "frequency", "monetary"], "measure", "value")


def quantile_cuts(measures: DataFrame, shares: Sequence[float] = (0.2, 0.4, 0.6, 0.8), error: float = 0.001) -> DataFrame:
    """One row per measure: the values (`cuts`) below or at which the given shares of its rows lie, from a sketch.

    No row is sorted across tasks or sent whole: each task sends a sketch per measure, whose size follows
    1 / `error`, not the rows. The rank of a cut is off by at most `error` times the rows of the measure.
    Nulls are left out; a measure of nulls only has null cuts.
    """
    sketch = F.percentile_approx("value", [float(s) for s in shares], math.ceil(1 / error))
    return measures.groupBy("measure").agg(sketch.alias("cuts"))


def scored_by_cuts(measures: DataFrame, cuts: DataFrame, name: str = "score") -> DataFrame:
    """Each row with its place between the cuts of its measure, from 1; null values have none.

    Equal values get one score, which `ntile` does not promise. `cuts` has one row per measure.
    """
    above = F.size(F.filter("cuts", lambda cut: cut < F.col("value")))
    score = F.when(F.col("value").isNotNull(), above + 1).cast("int")
    return measures.join(cuts, "measure", "left").select(*measures.columns, score.alias(name))


def rfm_segments(orders: DataFrame) -> DataFrame:
    """Recency, frequency and monetary quintile (5 is best) and segment per customer.

    The three measures are ranked in one sort of a long table, one row per
    customer and measure.
    """
    scored = ntile_within(rfm_measures(orders), "measure", ["value", "o_custkey"], 5, "quintile")

    def of(measure: str, column: str):
        return F.max(F.when(F.col("measure") == measure, F.col(column)))

    wide = scored.groupBy("o_custkey").agg(
        F.date_from_unix_date(of("recency", "value").cast("int")).alias("last_order_date"),
        of("frequency", "value").cast("bigint").alias("orders_count"),
        of("monetary", "value").alias("monetary"),
        of("recency", "quintile").alias("r_score"),
        of("frequency", "quintile").alias("f_score"),
        of("monetary", "quintile").alias("m_score"),
    )
    r, f, m = F.col("r_score"), F.col("f_score"), F.col("m_score")
    segment = (
        F.when((r >= 4) & (f >= 4) & (m >= 4), "champion")
        .when((r >= 3) & (f >= 3), "loyal")
        .when(r >= 4, "recent")
        .when((r <= 2) & (f >= 3), "at_risk")
        .when((r <= 2) & (f <= 2), "dormant")
        .otherwise("regular")
    )
    return wide.withColumn("segment", segment)


def daily_summary(silver: DataFrame) -> DataFrame:
    """KPI feed per day: activity, revenue, error rate and cart-to-checkout ratio."""
    of = lambda kind: F.col("event_type") == kind
    days = silver.groupBy("event_date").agg(
        F.countDistinct("user_id").alias("active_users"),
        F.count("*").alias("events_count"),
        count_where(of("add_to_cart")).alias("carts"),
        count_where(of("checkout")).alias("checkouts"),
        count_where(of("error")).alias("errors"),
        F.coalesce(F.sum(F.when(of("checkout"), F.col("amount"))), F.lit(0.0)).alias("revenue"),
    )
    return days.select(
        "*",
        (F.col("errors") / F.col("events_count")).alias("error_rate"),
        F.try_divide(F.col("checkouts"), F.col("carts")).alias("cart_to_checkout"),
    )


def user_sketches(silver: DataFrame, precision: int = SKETCH_PRECISION) -> DataFrame:
    """One row per day: the day's users as a sketch of bounded size, and their exact number.

    Worth storing: sketches of any days can be merged later, exact numbers cannot.
    """
    return silver.groupBy("event_date").agg(
        F.hll_sketch_agg("user_id", F.lit(precision)).alias("users"),
        F.countDistinct("user_id").alias("active_users"),
    )


def active_users(sketches: DataFrame, days: Sequence[int] = (7, 28)) -> DataFrame:
    """Users active in the `days` days up to each day that has a sketch, estimated by merging sketches.

    No event is read again: every daily sketch goes to the days it counts for, at most the longest
    span per day. The standard error is about 1.04 / sqrt(2 ** precision), 1.6 per cent at 12.
    """
    ends = sketches.select(F.col("event_date").alias("as_of"))
    spans = F.explode(F.array(*[F.lit(n) for n in days])).alias("days")
    reach = sketches.select("event_date", "users", spans)
    last = F.date_add("event_date", F.col("days") - 1)
    counted = reach.select("days", "users", F.explode(F.sequence("event_date", last)).alias("as_of"))
    merged = counted.groupBy("as_of", "days").agg(F.hll_union_agg("users").alias("users"))
    return merged.join(ends, "as_of", "left_semi").select(
        "as_of", "days", F.hll_sketch_estimate("users").alias("active_users")
    )


def totals_by_grain(silver: DataFrame) -> DataFrame:
    """Totals of everything, per day, per day and event type, and per day and page, from one scan and one shuffle.

    `grain` names the set; columns that it does not group by are null. Other nulls cannot occur:
    accepted rows have all three.
    """
    of = lambda kind: F.col("event_type") == kind
    sets = [[], ["event_date"], ["event_date", "event_type"], ["event_date", "page"]]
    # What is left out of a set, as bits: date 4, type 2, page 1.
    grain = (
        F.when(F.grouping_id() == 7, "total")
        .when(F.grouping_id() == 3, "day")
        .when(F.grouping_id() == 1, "day and type")
        .otherwise("day and page")
    )
    measures = silver.select("*", *[flag(of(k)).alias(f"_{k}") for k in ("checkout", "error")])
    return measures.groupingSets([[F.col(c) for c in s] for s in sets], "event_date", "event_type", "page").agg(
        grain.alias("grain"),
        F.count("*").alias("events_count"),
        F.sum("_checkout").alias("checkouts"),
        F.sum("_error").alias("errors"),
        F.coalesce(F.sum(F.when(F.col("_checkout") == 1, F.col("amount"))), F.lit(0.0)).alias("revenue"),
    )


def support_metrics(tickets: DataFrame) -> DataFrame:
    """Tickets and mean satisfaction per user, from (user_id, csat) rows; csat may be null."""
    return tickets.groupBy("user_id").agg(
        F.count("*").alias("ticket_count"), F.avg("csat").alias("mean_csat")
    )
