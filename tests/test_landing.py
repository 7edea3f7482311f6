"""Opening envelopes."""

import datetime as dt

import pytest

from daymark.operators import screening
from daymark.sources.landing import unwrap
from helpers import INGEST_DATE, envelope, event, lines_df


def open_one(spark, line):
    return unwrap(lines_df(spark, line), INGEST_DATE).first()


def test_good_message(spark):
    row = open_one(spark, envelope(event(user_id=7, product_id=1001, amount=12.5)))
    assert row.ingest_fault is None and row.envelope is None
    assert (row.event_id, row.user_id, row.product_id, row.amount) == ("e1", "7", "1001", "12.5")
    assert row.event_date == dt.date(2024, 1, 5)


@pytest.mark.parametrize(
    "line, fault",
    [
        ('{"Type":"Notification"}', "empty_message"),
        ('{"Message":""}', "empty_message"),
        ('{"Message":null}', "empty_message"),
        ("not json", "bad_envelope"),
        ("", "bad_envelope"),
        ("[1, 2]", "bad_envelope"),
        ('"text"', "bad_envelope"),
        ('{"Message":"{}"', "bad_envelope"),
        ('{"Message":"{}"}{"Message":"{}"}', "bad_envelope"),
        ('{"Message":"{}"},{"Message":"{}"}', "bad_envelope"),
        ('{"Message":"{}"} trailing', "bad_envelope"),
        ('{"Message":"nope"}', "bad_message"),
        ('{"Message":"{\\"user_id\\": 1"}', "bad_message"),
        ('{"Message":"null"}', "bad_message"),
        ('{"Message":"{}{}"}', "bad_message"),
        ('{"Message":"{},{}"}', "bad_message"),
        ('{"Message":"{} trailing"}', "bad_message"),
        ('{"Message":"42"}', "bad_message"),
        ('{"Message":"[]"}', "bad_message"),
        ('{"Message":"{}], [{}"}', "bad_message"),
        ('{"Message":"{}] trailing"}', "bad_message"),
        ('{"Message":"{} ]"}', "bad_message"),
        ('{"Message":"{},{}], [{}"}', "bad_message"),
        ('{"Message":"{},{\\"_end\\":\\"x\\"}], [{}"}', "bad_message"),
        ('{"Message":"{},"}', "bad_message"),
        ('{"Message":"],[{}"}', "bad_message"),
        ('{"Message":"{}"}], [{"Message":"{}"}', "bad_envelope"),
        ('{"Message":"{}"}] trailing', "bad_envelope"),
        ('{"Message":"{}"} ]', "bad_envelope"),
        ('{"Message":"{}"},{"_end":"x"}], [{"Message":"{}"}', "bad_envelope"),
    ],
)
def test_faulty_lines_are_kept_with_their_text(spark, line, fault):
    row = open_one(spark, line)
    assert (row.ingest_fault, row.envelope) == (fault, line)
    assert row.event_id is None
    assert row.event_date == dt.date(2024, 2, 1)


def test_no_line_is_lost(spark):
    lines = [envelope(event()), "x", "", '{"Message":""}', envelope("{"), envelope({})]
    assert unwrap(lines_df(spark, *lines), INGEST_DATE).count() == len(lines)


def test_columns_null_in_every_message_keep_their_type(spark):
    bare = event(product_id=None, amount=None, error_code=None)
    opened = unwrap(lines_df(spark, envelope(bare), envelope(bare)), INGEST_DATE)
    silver = screening.clean(opened)
    assert silver.schema["product_id"].dataType.simpleString() == "bigint"
    assert silver.schema["amount"].dataType.simpleString() == "double"
    assert silver.count() == 2


def test_whole_and_fractional_amounts_mix(spark):
    opened = unwrap(
        lines_df(spark, *(envelope(event(amount=a)) for a in (10, 10.5, "11"))), INGEST_DATE
    )
    assert sorted(r.amount for r in screening.clean(opened).collect()) == [10.0, 10.5, 11.0]


def test_user_id_forms(spark):
    forms = [7, "7", 7.0, "7.00", " 7 ", 9007199254740993, "abc", 7.5, {"x": 1}, True, None, 12345678901234567890, "1e30", "NaN"]
    opened = unwrap(lines_df(spark, *(envelope(event(user_id=u)) for u in forms)), INGEST_DATE)
    assert [r.user_id for r in screening.clean(opened).collect()] == [7] * 5 + [9007199254740993]
    rejected = screening.quarantine(opened).collect()
    assert [r.reason for r in rejected] == ["bad_user_id"] * 8
    assert {r.user_id for r in rejected} == {
        "abc", "7.5", '{"x":1}', "true", None, "12345678901234567890", "1e30", "NaN",
    }


def test_unknown_keys_are_ignored(spark):
    assert open_one(spark, envelope(event(extra=[1, {"a": 2}]))).ingest_fault is None


@pytest.mark.parametrize("number, value", [("NaN", "nan"), ("1e400", "inf"), ("-3.5", "-3.5")])
def test_odd_amounts_reach_silver(spark, number, value):
    line = envelope('{"user_id":1,"event_type":"login","page":"/","amount":' + number + "}")
    opened = unwrap(lines_df(spark, line), INGEST_DATE)
    assert str(screening.clean(opened).first().amount) == value


def test_empty_timestamp_is_absent(spark):
    row = open_one(spark, envelope(event(event_timestamp="")))
    assert row.event_timestamp is None
    assert row.event_date == dt.date(2024, 2, 1)


def test_undated_event_takes_the_publish_date(spark):
    """A redelivery repeats the envelope, so it falls on the same date."""
    line = envelope(event(event_timestamp=None), Timestamp="2024-01-09T00:00:01.000Z")
    assert open_one(spark, line).event_date == dt.date(2024, 1, 9)


def test_no_lines(spark):
    assert unwrap(spark.createDataFrame([], "value string"), INGEST_DATE).count() == 0


@pytest.mark.parametrize("stated", ["0000-01-05T00:00:00Z", "12000-01-05T00:00:00Z"])
def test_years_no_directory_can_hold_take_the_fallback(spark, stated):
    row = open_one(spark, envelope(event(event_timestamp=stated)))
    assert row.event_date == dt.date.fromisoformat(INGEST_DATE)
