"""Daily metrics, contracts, invariants, quality report."""

import datetime as dt

import pytest

from daymark.operators import contracts, quality, screening
from daymark.operators.daily_metrics import daily_user_metrics
from daymark.schemas import GOLD, GOLD_NOT_NULL
from helpers import event, events_df, rows


@pytest.fixture(scope="module")
def gold(spark):
    at = "2024-01-05T%02d:00:00+00:00"
    kinds = ["login", "page_view", "add_to_cart", "checkout", "error"]
    events = [event(event_id=f"a{i}", event_type=k, event_timestamp=at % i) for i, k in enumerate(kinds)]
    events += [event(event_id="b", user_id="8", event_type="login", amount=None, event_timestamp=None)]
    return daily_user_metrics(screening.clean(events_df(spark, *events))).cache()


def test_metrics(gold):
    row = gold.filter("user_id = 7").first()
    assert tuple(row) == (
        dt.date(2024, 1, 5), 7, 5, 1, 1, 1, 1, 1, 1, 1, 62.5,
        dt.datetime(2024, 1, 5, 0), dt.datetime(2024, 1, 5, 4),
    )


def test_no_amount_and_no_time_stay_null(gold):
    row = gold.filter("user_id = 8").first()
    assert (row.events_count, row.page_view_count) == (1, 0)
    assert (row.total_amount, row.first_event_ts, row.last_event_ts) == (None, None, None)


def test_gold_follows_its_contract(gold):
    contracts.require_columns(gold, GOLD)
    contracts.require_sound(gold)
    assert [f.name for f in gold.schema] == GOLD.fieldNames()


def test_missing_column_is_named(gold):
    with pytest.raises(ValueError, match="user_id"):
        contracts.require_columns(gold.drop("user_id"), GOLD)


def test_wrong_type_is_named(gold):
    with pytest.raises(ValueError, match="user_id: string instead of bigint"):
        contracts.require_columns(gold.withColumn("user_id", gold.user_id.cast("string")), GOLD)


def test_metrics_refuse_incomplete_input(spark):
    silver = screening.clean(events_df(spark, event()))
    with pytest.raises(ValueError, match="amount"):
        daily_user_metrics(silver.drop("amount"))


def test_invariants_hold_and_are_able_to_fail(gold):
    assert all(r.violations == 0 and r.gold_rows == 2 for r in contracts.metric_invariants(gold).collect())
    broken = gold.withColumns({"checkout_count": gold.checkout_count + 1, "first_event_ts": gold.last_event_ts + contracts.F.expr("interval 1 day")})
    failing = {r.invariant: r.violations for r in contracts.metric_invariants(broken).collect()}
    assert failing["events_count_is_sum_of_types"] == 2
    assert failing["purchase_events_is_checkout_count"] == 2
    assert failing["first_event_not_after_last"] == 1
    assert failing["error_events_is_error_count"] == 0


def test_null_and_key_violations(gold):
    assert rows(contracts.null_violations(gold)) == sorted((c, 0) for c in GOLD_NOT_NULL)
    twice = gold.union(gold)
    assert contracts.duplicate_keys(gold).isEmpty()
    assert contracts.duplicate_keys(twice).count() == 2
    with pytest.raises(ValueError, match="Primary key"):
        contracts.require_sound(twice)
    no_user = gold.withColumn("user_id", contracts.F.lit(None).cast("bigint"))
    with pytest.raises(ValueError, match="user_id"):
        contracts.require_sound(no_user)


def test_one_hash_aggregate_and_one_shuffle(spark, tmp_path):
    path = str(tmp_path / "silver")
    screening.clean(events_df(spark, event())).write.parquet(path)
    plan = daily_user_metrics(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
    assert "SortAggregate" not in plan and plan.count("HashAggregate") == 2
    schema = plan[plan.index("ReadSchema") :]
    assert "page" not in schema and "event_id" not in schema


def test_quality_report(spark):
    events = events_df(
        spark,
        event(),
        event(),
        event(event_id=None, user_id="x"),
        event(event_id="e2", user_id=None, event_type="zzz"),
        event(event_id="e3", amount="NaN"),
        event(event_id="e4", amount="1e400"),
        event(event_id="e5", amount="-1", product_id="7"),
        event(event_id="e6", amount="ten", error_code="WHY"),
        event(event_id="e7", event_timestamp="x"),
        event(event_id="e7", event_timestamp=None, page="/x"),
        event(event_id="e1", event_timestamp="2024-01-06T00:00:00Z", product_id=None),
    )
    assert {r.rule: r.failing for r in quality.dq_report(events).collect()} == {
        "event_id_not_null": 1,
        "user_id_not_null": 1,
        "user_id_is_integer": 1,
        "event_type_accepted": 1,
        "page_accepted": 1,
        "event_timestamp_not_null": 1,
        "event_timestamp_readable": 1,
        "product_id_in_range": 1,
        "product_id_only_with_item_events": 2,
        "amount_is_number": 1,
        "amount_is_finite": 2,
        "amount_in_range": 1,
        "error_code_accepted": 1,
        "error_code_only_with_errors": 1,
        "event_id_unique": 3,
        "event_id_on_one_date": 1,
    }


def test_quality_report_of_nothing(spark):
    report = quality.dq_report(events_df(spark, event()).limit(0)).collect()
    assert len(report) == 16 and all((r.failing, r.total) == (0, 0) for r in report)
