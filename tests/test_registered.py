"""Every registered query against its SQL, and the golden counts of the fixture."""

import os

import pytest

import __spark_entry__ as entry
from checks import raw_events
from checks.catalog import QUERIES
from checks.compare import compare, oracle
from checks.oracle import SQL
from daymark.operators import screening
from daymark.operators.dedup import dedup_events

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() == 364


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    equal, _, note = compare(spark, con, name, SF)
    assert equal, note


@pytest.mark.parametrize("name", ["envelope_parse", "gold_daily_user_metrics", "dq_report"])
def test_query_pins_its_zone_and_does_not_need_ansi(spark, con, name):
    other = {"spark.sql.session.timeZone": "America/New_York", "spark.sql.ansi.enabled": "false"}
    before = {k: spark.conf.get(k) for k in other}
    try:
        for k, v in other.items():
            spark.conf.set(k, v)
        equal, _, note = compare(spark, con, name, SF)
        assert equal, note
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_golden_counts(spark):
    dated = raw_events.dated_events(spark, SF)
    assert dated.count() == 1040
    once = dedup_events(dated)
    silver = screening.clean(once)
    assert silver.count() == 774
    assert {r.reason: r.rejected_rows for r in screening.quarantine_summary(screening.quarantine(once)).collect()} == {
        "bad_user_id": 20,
        "bad_event_type": 46,
        "bad_page": 138,
        "bad_event_timestamp": 22,
    }
    assert silver.filter("event_date <> date(event_timestamp_ts)").count() == 3


STORED = {
    "bronze_ingest", "bronze_backfill", "ingest_quarantine", "silver_rebuild", "silver_scan", "gold_rebuild",
    "publish_replace", "dq_reconciliation", "stream_equals_batch", "stream_dedup", "undated_redelivery", "bronze_compacted",
    "load_drift",
}
# The buffer of a sketch is an object, of bounded size and with a partial step.
SKETCHES = {"kpi_active_users", "kpi_quintile_cuts"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STORED))
def test_plan_shape(spark, name):
    """No cross or nested-loop join, no Python in the plan, no window over a whole table."""
    broadcast = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(broadcast)
    spark.conf.set(broadcast, "-1")
    try:
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(broadcast, before)
    for unwanted in ("CartesianProduct", "NestedLoop", "Python", "Pandas", "SortAggregate", "ObjectHash"):
        assert unwanted not in plan or unwanted == "ObjectHash" and name in SKETCHES
    if "SinglePartition" in plan:
        # Only for aggregates of everything, after a partial step.
        assert plan.count("SinglePartition") == plan.count("keys=[], functions=[partial") + plan.count("keys=[], functions=[merge")
