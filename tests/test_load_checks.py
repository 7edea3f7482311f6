"""What the loads' own writes counted."""

import pytest

from daymark.__main__ import parser, run
from daymark import filesystem
from daymark.operators import quality
from daymark.plans import lake, load_checks
from daymark.sinks import tables
from daymark.sources.landing import unwrap
from helpers import INGEST_DATE, envelope, event, events_df, lines_df, rows


def load(spark, home, load_id, *events):
    lake.write_load(events_df(spark, *events), home, load_id)


def bad(n, rows):
    return [event(event_id=f"e{i}", page="/admin" if i < n else "/cart") for i in range(rows)]


def recorded(spark, home):
    return {(r.load_id, r.rule): (r.failing, r.total) for r in lake.load_report(spark, home).collect()}


def from_rows(spark, home):
    sound = lake.read_bronze(spark, home).where("ingest_fault IS NULL")
    return rows(quality.row_report(sound))


def of_records(spark, home):
    return rows(load_checks.totals(lake.load_report(spark, home)).select("rule", "failing", "total"))


def test_records_equal_the_report_on_the_rows(spark, home):
    load(spark, home, "a", *bad(2, 5), event(event_id=None, user_id="x"))
    lines = [envelope(event(event_id="z", amount="-1")), "{", envelope("")]
    lake.write_load(unwrap(lines_df(spark, *lines), INGEST_DATE), home, "b")
    assert of_records(spark, home) == from_rows(spark, home)
    found = recorded(spark, home)
    assert found["a", "page_accepted"] == (2, 6) and found["a", "message_opened"] == (0, 6)
    assert found["b", "amount_in_range"] == (1, 1) and found["b", "message_opened"] == (2, 3)


def test_a_repeated_load_replaces_its_record_in_a_pack_too(spark, home):
    load(spark, home, "a", *bad(3, 5))
    load(spark, home, "b", *bad(1, 5))
    lake.compact(spark, home)
    assert of_records(spark, home) == from_rows(spark, home)
    load(spark, home, "a", *bad(0, 2))
    assert recorded(spark, home)["a", "page_accepted"] == (0, 2)
    assert of_records(spark, home) == from_rows(spark, home)
    load(spark, home, "a")
    assert recorded(spark, home)["a", "page_accepted"] == (0, 0)
    assert of_records(spark, home) == from_rows(spark, home)


def test_loads_without_a_record_are_counted_once_asked_for(spark, home):
    load(spark, home, "a", *bad(3, 5))
    load(spark, home, ".b", *bad(1, 4))
    before = recorded(spark, home)
    assert (".b", "page_accepted") in before
    filesystem.delete(spark, f"{home.root}/load_checks")
    assert recorded(spark, home) == before


def test_a_load_cut_off_before_its_record_has_none_of_other_rows(spark, home, monkeypatch):
    load(spark, home, "a", *bad(3, 5))
    with monkeypatch.context() as patch:
        patch.setattr(load_checks.LoadChecks, "note", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            load(spark, home, "a", *bad(1, 9))
    assert recorded(spark, home) == {}  # still open
    lake.refresh(spark, home)
    assert recorded(spark, home)["a", "page_accepted"] == (1, 9)


def test_no_loads(spark, home):
    assert lake.load_report(spark, home).collect() == []
    assert lake.load_drift(spark, home).collect() == []


def test_counts_are_collected_in_the_last_stage(spark, tmp_path):
    """Behind the shuffle, so that a map task that runs again does not count again."""
    df = events_df(spark, *bad(2, 6)).withColumn("load_id", tables.F.lit("a"))
    plan = df.hint("rebalance", "event_date").observe(tables.Observation(), tables.F.count("*").alias("n"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.index("CollectMetrics") < text.index("Exchange")
    path = str(tmp_path / "t")
    written, counts = tables.replace_and_count(df, path, ("event_date",), [], load_checks.conditions())
    assert written == ["event_date=2024-01-05"] and counts["opened"] == 6 and counts["page_accepted"] == 2
    assert tables.replace_and_count(df.limit(0), path, ("event_date",), written, load_checks.conditions())[0] == []


def test_drift(spark, home, capsys):
    for name, n in (("a", 10), ("b", 12), ("c", 60), ("d", 9)):
        load(spark, home, name, *bad(n, 200))
    found = {(r.load_id, r.rule): r for r in lake.load_drift(spark, home).collect()}
    drifted = {key for key, r in found.items() if r.drifted}
    assert ("c", "page_accepted") in drifted and {rule for _, rule in drifted} == {"page_accepted"}
    assert not {("a", "page_accepted"), ("b", "page_accepted")} & drifted
    assert (found["c", "page_accepted"].earlier_failing, found["c", "page_accepted"].earlier_total) == (22, 400)
    assert run(spark, parser().parse_args(["drift", "--lake", home.root])) == []
    assert "60/200 before: 22/400" in capsys.readouterr().out
    strict = lake.load_drift(spark, home, least=0.5)
    assert strict.where("drifted").count() == 0
