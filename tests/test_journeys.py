"""Sessions and the carts of checkouts, against the definitions worked out row by row."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from daymark.operators.journeys import GAP, checkout_carts, conversion_daily, sessions

SCHEMA = "event_id string, event_date date, user_id long, event_type string, event_timestamp_ts timestamp_ntz, amount double"
START = dt.datetime(2024, 1, 5)
MINUTES = dt.timedelta(minutes=1)


def silver(spark, *events):
    """(event_id, user, kind, time or minutes after START or None)"""
    data = []
    for event_id, user, kind, at in events:
        at = START + at * MINUTES if isinstance(at, (int, float)) else at
        data.append((event_id, (at or START).date(), user, kind, at, 1.5 if kind == "checkout" else None))
    return spark.createDataFrame(data, SCHEMA)


def some_events(n=1500, seed=7):
    """A third of the rows are one user's; times lie on few marks, slice borders among them, before 1970 too."""
    rng = random.Random(seed)
    marks = [START + dt.timedelta(minutes=15 * k, microseconds=rng.choice((-1, 0, 0, 1))) for k in range(400)]
    marks += [dt.datetime(1969, 12, 31, 23, 30) + dt.timedelta(minutes=15 * k) for k in range(6)]
    for i in range(n):
        user = 1 if i % 3 == 0 else rng.randrange(2, 40)
        kind = rng.choice(("add_to_cart", "checkout", "page_view"))
        yield (None if i % 50 == 9 else f"e{i % (n - 20)}", user, kind, None if i % 40 == 3 else rng.choice(marks))


def expected_carts(events, gap):
    for event_id, user, kind, at in events:
        if kind == "checkout":
            near = [
                (t, e or "") for e, u, k, t in events
                if k == "add_to_cart" and u == user and at and t and dt.timedelta(0) <= at - t <= gap
            ]
            best = max(near, default=None)
            yield (event_id, user, at, best and (best[1] or None), best and best[0], best and (at - best[0]) // dt.timedelta(seconds=1))


def expected_sessions(events, gap):
    users = {u for _, u, _, t in events if t}
    for user in users:
        own, runs = sorted((t, k) for _, u, k, t in events if u == user and t), []
        for t, k in own:
            if runs and t - runs[-1][-1][0] <= gap:
                runs[-1].append((t, k))
            else:
                runs.append([(t, k)])
        for run in runs:
            kinds = [k for _, k in run]
            paid = kinds.count("checkout")
            yield (user, run[0][0], run[-1][0], len(run), kinds.count("add_to_cart"), paid, 1.5 * paid)


CART_COLUMNS = ("event_id", "user_id", "event_timestamp_ts", "cart_event_id", "cart_ts", "seconds_since_cart")
SESSION_COLUMNS = ("user_id", "session_start", "session_end", "events_count", "carts", "checkouts", "revenue")


def as_rows(df, columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("gap", [GAP, 15 * MINUTES, dt.timedelta(days=2)])
def test_carts_and_sessions_follow_the_definition(spark, gap):
    events = list(some_events())
    df = silver(spark, *events)
    assert as_rows(checkout_carts(df, gap), CART_COLUMNS) == sorted(expected_carts(events, gap), key=repr)
    assert as_rows(sessions(df, gap), SESSION_COLUMNS) == sorted(expected_sessions(events, gap), key=repr)


def test_the_gap_itself_is_near_and_one_microsecond_more_is_not(spark):
    for late, found in ((30 * MINUTES, "c"), (30 * MINUTES + dt.timedelta(microseconds=1), None)):
        df = silver(spark, ("c", 1, "add_to_cart", START + 7 * MINUTES), ("p", 1, "checkout", START + 7 * MINUTES + late))
        assert checkout_carts(df).first().cart_event_id == found
        assert sessions(df).count() == (1 if found else 2)


def test_ties_other_users_and_missing_times(spark):
    df = silver(
        spark,
        ("a", 1, "add_to_cart", 5), ("b", 1, "add_to_cart", 5), ("z", 2, "add_to_cart", 5), ("n", 1, "add_to_cart", None),
        ("after", 1, "add_to_cart", 6), ("p", 1, "checkout", 5), ("p", 1, "checkout", 5), ("q", 1, "checkout", None),
    )
    found = as_rows(checkout_carts(df), ("event_id", "cart_event_id"))
    assert found == [("p", "b"), ("p", "b"), ("q", None)]


def test_nothing_gives_nothing(spark):
    none = silver(spark).withColumn("_slice", F.lit(1)).withColumn("_cart", F.lit("x"))
    assert [checkout_carts(none).count(), sessions(none).count(), conversion_daily(sessions(none)).count()] == [0, 0, 0]
    with pytest.raises(ValueError, match="positive"):
        sessions(none, dt.timedelta(0))


def test_conversion_counts_sessions_on_the_day_they_began(spark):
    df = silver(
        spark,
        ("a", 1, "add_to_cart", 23 * 60 + 50), ("b", 1, "checkout", 24 * 60 + 5),
        ("c", 2, "checkout", 10), ("d", 3, "add_to_cart", 24 * 60 + 1),
    )
    found = as_rows(conversion_daily(sessions(df)), ("event_date", "sessions", "with_cart", "converted", "revenue"))
    assert found == [(START.date(), 2, 1, 1, 3.0), (START.date() + dt.timedelta(days=1), 1, 1, 0, 0.0)]


def test_a_user_with_a_third_of_the_rows_is_spread(spark, tmp_path):
    """No group a task must see whole holds more than a small share of the rows; nothing is shuffled by user before it is summed up."""
    n = 60_000
    rows = spark.range(n).select(
        F.col("id").cast("string").alias("event_id"),
        F.lit(START.date()).alias("event_date"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") + 10).cast("long").alias("user_id"),
        F.when(F.col("id") % 2 == 0, "add_to_cart").otherwise("checkout").alias("event_type"),
        F.timestamp_micros(F.lit(1_704_412_800_000_000) + F.col("id") * 43_200_000).cast("timestamp_ntz").alias("event_timestamp_ts"),
        F.lit(1.0).alias("amount"),
    )
    rows.write.parquet(str(tmp_path / "silver"))
    df = spark.read.parquet(str(tmp_path / "silver"))
    plan = checkout_carts(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "hashpartitioning(user_id#" in plan and "_slice#" in plan.split("Exchange")[1].split("\n")[0]
    largest = df.where("user_id = 1").groupBy(F.window("event_timestamp_ts", "30 minutes")).count().agg(F.max("count")).first()[0]
    assert 2 * largest < n / 300

    plan = sessions(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and "Python" not in plan
    # The first shuffle is by user and slice, behind the partial sums; the window comes after both.
    by_user, by_slice = (part.split("\n")[0] for part in plan.split("Exchange")[1:])
    assert by_user.count("#") == 1 and by_slice.count("#") == 2
    assert "partial_count" in plan.split("Exchange")[2] and "Window" not in plan.split("Exchange")[2]
    hot = sessions(df).where("user_id = 1").collect()
    assert len(hot) == 1 and hot[0].events_count == n // 3
