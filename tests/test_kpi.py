"""KPI definitions on hand-made rows, and the distributed ntile against a window."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from daymark.operators import screening
from daymark.operators.daily_metrics import daily_user_metrics
from daymark.operators.ranking import ntile_within
from daymark.plans import kpi
from daymark.plans.customer_view import customer_view
from helpers import event, events_df, rows


def on(day, event_id, user="7", kind="checkout", amount="10.0"):
    return event(event_id=event_id, user_id=user, event_type=kind, amount=amount, event_timestamp=f"2024-01-{day:02d}T01:00:00Z")


@pytest.fixture(scope="module")
def silver(spark):
    events = [
        on(1, "a"), on(1, "b", kind="add_to_cart", amount="99.0"), on(1, "c", user="8", kind="login", amount=None),
        on(2, "d"), on(3, "e", user="8", kind="error", amount=None), on(3, "f", user="9"),
    ]
    return screening.clean(events_df(spark, *events)).cache()


def d(day):
    return dt.date(2024, 1, day)


def test_event_revenue_counts_checkouts_only(silver):
    assert rows(kpi.event_revenue_daily(silver)) == [(d(1), 10.0, 1, 1), (d(2), 10.0, 1, 1), (d(3), 10.0, 1, 1)]


def test_retention(silver):
    assert rows(kpi.retention(daily_user_metrics(silver))) == [
        (d(1), 0, 2, 2, 1.0),
        (d(1), 1, 1, 2, 0.5),
        (d(1), 2, 1, 2, 0.5),
        (d(3), 0, 1, 1, 1.0),
    ]


def test_churn_proxy_does_not_look_past_the_day(spark, silver):
    customers = spark.createDataFrame([(8, "B")], "c_custkey bigint, c_mktsegment string")
    got = rows(kpi.churn_proxy(daily_user_metrics(silver), customers, "2024-01-02"))
    assert all(r[2] is None or r[2] <= d(2) for r in got)
    assert all(r[3] is None or r[3] >= 0 for r in got)


def test_churn_proxy_boundary(spark, silver):
    customers = spark.createDataFrame([(7, "A"), (8, "B"), (1, "C")], "c_custkey bigint, c_mktsegment string")
    got = rows(kpi.churn_proxy(daily_user_metrics(silver), customers, "2024-01-17"))
    assert got == [(1, "C", None, None, "never_active"), (7, "A", d(2), 15, "churned"), (8, "B", d(3), 14, "active"), (9, None, d(3), 14, "active")]


def test_daily_summary(silver):
    first, second, third = kpi.daily_summary(silver).orderBy("event_date").collect()
    assert tuple(first) == (d(1), 2, 3, 1, 1, 0, 10.0, 0.0, 1.0)
    assert second.cart_to_checkout is None
    assert (third.error_rate, third.revenue) == (0.5, 10.0)


def test_order_revenue_keeps_orders_without_lines(spark):
    day = dt.datetime(2024, 1, 1)
    orders = spark.createDataFrame([(1, 10.0, day), (2, 5.0, day)], "o_orderkey bigint, o_totalprice double, o_orderdate timestamp_ntz")
    lines = spark.createDataFrame([(1, 8.0, 0.25), (1, 4.0, 0.0)], "l_orderkey bigint, l_extendedprice double, l_discount double")
    assert rows(kpi.order_revenue_daily(orders, lines)) == [(d(1), 2, 15.0, 10.0)]


def test_customer_view_keeps_every_customer_once(spark, silver):
    customers = spark.createDataFrame(
        [(7, "x", 1, 0.0, "A"), (99, "y", 2, 1.0, "B")],
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    )
    orders = spark.createDataFrame(
        [(1, 7, 3.0, dt.datetime(2024, 1, 1)), (2, 7, 4.0, dt.datetime(2024, 1, 2))],
        "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz",
    )
    active, idle = customer_view(customers, orders, daily_user_metrics(silver)).orderBy("c_custkey").collect()
    assert (active.orders_count, active.orders_total, active.events_count, active.active_days) == (2, 7.0, 3, 2)
    assert (idle.orders_count, idle.orders_total, idle.events_count, idle.last_event_ts) == (0, None, 0, None)


def test_support_metrics(spark):
    tickets = spark.createDataFrame([(1, 4.0), (1, None), (1, 5.0), (2, None)], "user_id bigint, csat double")
    assert rows(kpi.support_metrics(tickets)) == [(1, 3, 4.5), (2, 1, None)]


@pytest.mark.parametrize("n, buckets", [(1, 5), (3, 5), (5, 5), (101, 5), (1000, 7)])
def test_ntile_equals_the_window_function(spark, n, buckets):
    """A third of the rows share one value; groups differ in size."""
    df = spark.range(n).select(
        "id",
        F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("g"),
        F.when(F.col("id") % 3 == 0, 5.0).otherwise((F.col("id") * 7919 % 101).cast("double")).alias("v"),
    )
    window = Window.partitionBy("g").orderBy("v", "id")
    expected = df.select("id", F.ntile(buckets).over(window).alias("q"))
    got = ntile_within(df.repartition(5), "g", ["v", "id"], buckets, "q").select("id", "q")
    assert rows(got) == rows(expected)


def test_merged_sketches_count_each_user_once(spark):
    """Against exact numbers, on days that share most of their users, with a gap between them."""
    days = [d(n) for n in (1, 2, 3, 4, 12, 13, 20)]
    rows_of = [(day, u * 7 + k * 900) for k, day in enumerate(days) for u in range(3000)]
    silver = spark.createDataFrame(rows_of, "event_date date, user_id long")
    sketches = kpi.user_sketches(silver)
    assert {r.active_users for r in sketches.collect()} == {3000}
    got = {(r.as_of, r.days): r.active_users for r in kpi.active_users(sketches).collect()}
    assert set(got) == {(day, n) for day in days for n in (7, 28)}
    for (as_of, n), estimate in got.items():
        exact = len({u for day, u in rows_of if as_of - dt.timedelta(days=n) < day <= as_of})
        assert abs(estimate - exact) <= 0.05 * exact
    assert kpi.active_users(sketches.where("false")).count() == 0


def test_totals_at_several_grains_take_one_scan_and_one_shuffle(spark, silver, tmp_path):
    got = {(r.grain, r.event_date, r.event_type, r.page): (r.events_count, r.checkouts, r.errors, r.revenue) for r in kpi.totals_by_grain(silver).collect()}
    assert got["total", None, None, None] == (6, 3, 1, 30.0)
    assert got["day", d(1), None, None] == (3, 1, 0, 10.0)
    assert got["day and type", d(3), "error", None] == (1, 0, 1, 0.0)
    assert got["day and page", d(2), None, "/cart"] == (1, 1, 0, 10.0)
    assert sum(n for (grain, *_), (n, *_) in got.items() if grain == "day and type") == 6
    silver.write.parquet(str(tmp_path / "silver"))
    plan = kpi.totals_by_grain(spark.read.parquet(str(tmp_path / "silver")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_cuts_from_a_sketch_stay_within_the_rank_error(spark):
    """Skewed values, a third of them equal, over many tasks; the sketch is far smaller than the rows."""
    n, error = 200_000, 0.005
    value = F.when(F.col("id") % 3 == 0, 500.0).otherwise(F.exp(F.rand(3) * 12))
    values = spark.range(0, n, 1, 16).select(F.lit("m").alias("measure"), F.round(value, 3).alias("value")).toPandas()
    measures = spark.createDataFrame(values).repartition(16)
    shares = [0.05, 0.2, 0.4, 0.6, 0.8, 0.99]
    cuts = kpi.quantile_cuts(measures, shares, error)
    for share, cut in zip(shares, cuts.first().cuts):
        below, up_to = (values.value < cut).mean(), (values.value <= cut).mean()
        assert below <= share + error and up_to >= share - error
    plan = cuts._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "partial_percentile_approx" in plan


def test_scores_by_cuts(spark):
    rows = [("a", "m", float(v)) for v in range(1, 11)] + [("a", "m", None), ("a", "nulls", None)]
    measures = spark.createDataFrame(rows, "key string, measure string, value double")
    cuts = kpi.quantile_cuts(measures)
    assert {r.measure: r.cuts for r in cuts.collect()} == {"m": [2.0, 4.0, 6.0, 8.0], "nulls": None}
    scored = kpi.scored_by_cuts(measures, cuts, "quintile").where("measure = 'm'").collect()
    assert {r.value: r.quintile for r in scored} == {None: None, **{float(v): (v + 1) // 2 for v in range(1, 11)}}
    assert kpi.quantile_cuts(measures.limit(0)).collect() == []
