"""Undated copies over the whole history, load manifests and packs."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from daymark import filesystem as files
from daymark.operators.dedup import dedup_events
from daymark.plans import identity, lake, loads
from daymark.plans.audit import audit
from helpers import event, events_df, rows

D5, D6, D7 = dt.date(2024, 1, 5), dt.date(2024, 1, 6), dt.date(2024, 1, 7)


def delivered(spark, day, *events):
    """Events without a date of their own, delivered on a day; others keep theirs."""
    own = F.when(F.col("event_timestamp").isNull(), F.lit(day)).otherwise(F.col("event_date"))
    return events_df(spark, *events).withColumn("event_date", own)


def load(spark, home, load_id, day, *events):
    return lake.write_load(delivered(spark, day, *events), home, load_id)


def gold_days(spark, home):
    return sorted((r.event_date, r.events_count) for r in lake.read_gold(spark, home).collect())


UNDATED = event(event_timestamp=None)


@pytest.mark.parametrize("order", list(itertools.permutations(range(3))))
def test_an_undated_redelivery_counts_once_in_any_order(spark, home, order):
    batches = [("dated", D5, event()), ("late", D7, UNDATED), ("next", D6, UNDATED)]
    for k in order:
        name, day, copy = batches[k]
        load(spark, home, name, day, copy)
        lake.refresh(spark, home)
    assert gold_days(spark, home) == [(D5, 1)]


def test_an_event_never_dated_counts_on_its_first_day(spark, home):
    load(spark, home, "b", D7, UNDATED)
    lake.refresh(spark, home)
    assert gold_days(spark, home) == [(D7, 1)]
    load(spark, home, "a", D6, UNDATED, UNDATED)
    assert lake.refresh(spark, home) == [D6, D7]
    assert gold_days(spark, home) == [(D6, 1)]


def test_what_was_collapsed_comes_back_when_its_event_is_withdrawn(spark, home):
    load(spark, home, "a", D5, event(), event(event_id="other"))
    load(spark, home, "b", D7, UNDATED)
    lake.refresh(spark, home)
    assert gold_days(spark, home) == [(D5, 2)]
    load(spark, home, "a", D5, event(event_id="other"))
    lake.refresh(spark, home)
    assert gold_days(spark, home) == [(D5, 1), (D7, 1)]


def test_rows_without_an_id_and_unreadable_lines_are_never_collapsed(spark, home):
    nameless = event(event_id=None, event_timestamp=None)
    load(spark, home, "a", D5, nameless, nameless)
    load(spark, home, "b", D6, nameless)
    lake.refresh(spark, home)
    assert gold_days(spark, home) == [(D5, 2), (D6, 1)]


def test_two_stated_dates_stay_two_events(spark, home):
    load(spark, home, "a", D5, event(), event(event_timestamp="2024-01-06T00:00:00Z"), UNDATED)
    lake.refresh(spark, home)
    assert gold_days(spark, home) == [(D5, 1), (D6, 1)]


def test_buckets_of_other_ids_are_not_read(spark, home, monkeypatch):
    load(spark, home, "a", D5, *[event(event_id=f"e{k}") for k in range(64)])
    load(spark, home, "b", D6, event(event_id="e3", event_timestamp=None))
    lake.record_identities(spark, home)
    read, paths = identity.Identities._read, []
    monkeypatch.setattr(identity.Identities, "_read", lambda self, p: paths.extend(p) or read(self, p))
    assert lake.read_events(spark, home, [D6]).isEmpty()
    own = {p.split("bucket=")[1].split("/")[0] for p in paths}
    assert len(own) == 1 and {p.split("kind=")[1].split("/")[0] for p in paths} == {"dated", "undated"}
    del paths[:]
    assert lake.read_events(spark, home, [D5]).count() == 64
    assert paths == []


def test_rows_with_a_date_are_not_joined_to_find_undated_copies(spark, home, monkeypatch):
    load(spark, home, "a", D5, event(), event(event_id=None), event(event_id="e2", event_timestamp=None))
    load(spark, home, "b", D6, UNDATED, event(event_id=None, event_timestamp=None))
    lake.record_identities(spark, home)
    staged, stage = [], identity.stage
    monkeypatch.setattr(identity, "stage", lambda df, label: staged.append(label) or stage(df, label))
    kept = lake.read_events(spark, home, [D5, D6])
    assert sorted((r.event_id or "", r.event_date) for r in kept.collect()) == [("", D5), ("", D6), ("e1", D5), ("e2", D5)]
    plan = kept._jdf.queryExecution().optimizedPlan()
    parts = [plan.children().apply(i).toString() for i in range(plan.children().size())]
    assert ["Join" in part for part in parts] == [False, True]
    assert staged == ["undated", "redelivered"]


def test_a_refresh_measures_the_dates_of_bronze_once(spark, home, monkeypatch):
    load(spark, home, "a", D5, event(), event(event_id="e2", event_timestamp="2024-01-06T00:00:00Z"))
    measured, total = [], files.total_bytes
    monkeypatch.setattr(files, "total_bytes", lambda s, path: measured.append(path) or total(s, path))
    lake.refresh(spark, home)
    assert len([p for p in measured if p.startswith(home.bronze)]) == 2
    assert gold_days(spark, home) == [(D5, 1), (D6, 1)]


def test_many_dates_are_listed_in_few_tasks(spark, home):
    days = [D5 + dt.timedelta(days=k) for k in range(60)]
    load(spark, home, "a", D5, *[event(event_id=str(d), event_timestamp=f"{d}T00:00:00Z") for d in days])
    spark.sparkContext.setJobGroup("listing", "listing")
    try:
        found = lake.read_bronze(spark, home, days)
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    tracker = spark.sparkContext.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(job).stageIds]
    assert stages and all(tracker.getStageInfo(s).numTasks <= 4 * spark.sparkContext.defaultParallelism for s in stages)
    assert found.count() == 60


def test_a_crash_while_identities_are_recorded_loses_nothing(spark, home, monkeypatch):
    load(spark, home, "a", D7, UNDATED)
    lake.refresh(spark, home)
    load(spark, home, "b", D5, event())
    record = identity.Identities.record

    def fail(*args):
        record(*args)
        raise RuntimeError("lost")

    monkeypatch.setattr(identity.Identities, "record", fail)
    with pytest.raises(RuntimeError):
        lake.refresh(spark, home)
    monkeypatch.undo()
    lake.refresh(spark, home)
    assert gold_days(spark, home) == [(D5, 1)]


def test_the_audit_counts_redelivered_copies_out(spark, home):
    load(spark, home, "a", D5, event(), event(event_id="e2"))
    load(spark, home, "b", D6, UNDATED)
    lake.refresh(spark, home)
    assert not any(r.failing for r in audit(spark, home).collect() if r.scope == "table")


def test_a_random_history_equals_the_definition(spark, home):
    """Every load order and repetition gives what one look at all rows gives."""
    batches = {
        f"load-{k}": [
            (D5 + dt.timedelta(days=k), event(event_id=f"e{(k * 5 + i) % 13}", event_timestamp=None if (k + i) % 3 else f"2024-01-0{1 + i % 4}T00:00:00Z"))
            for i in range(9)
        ]
        for k in range(4)
    }
    for name in ("load-2", "load-0", "load-3", "load-1", "load-0"):
        per_day = [delivered(spark, day, e) for day, e in batches[name]]
        whole = per_day[0]
        for more in per_day[1:]:
            whole = whole.unionByName(more)
        lake.write_load(whole, home, name)
        if name != "load-3":
            lake.refresh(spark, home)
    seen = [(e, day) for own in batches.values() for day, e in own]
    dated = {(e["event_id"], e["event_timestamp"][:10]) for e, _ in seen if e["event_timestamp"]}
    known = {i for i, _ in dated}
    first = {}
    for e, day in seen:
        if e["event_id"] not in known:
            first[e["event_id"]] = min(first.get(e["event_id"], day), day)
    expected = dated | {(i, day.isoformat()) for i, day in first.items()}
    found = sorted((r.event_id, r.event_date.isoformat()) for r in lake.read_silver(spark, home).collect())
    assert found == sorted(expected)


# --- manifests and packs ----------------------------------------------------


def three_loads(spark, home):
    for k in range(3):
        load(spark, home, f"{k}", D5, *[event(event_id=f"e{k}-{i}", event_timestamp=f"2024-01-0{5 + i % 2}T00:00:00Z") for i in range(4)])


def directories(spark, home, day):
    return sorted(p.rsplit("load_id=", 1)[-1] for p in files.matching(spark, f"{home.bronze}/event_date={day}/load_id=*"))


def test_compaction_changes_nothing_but_the_files(spark, home):
    three_loads(spark, home)
    before = rows(lake.read_bronze(spark, home))
    assert lake.compact(spark, home, [D5]) == [D5]
    assert len(directories(spark, home, D5)) == 1 and directories(spark, home, D6) == ["0", "1", "2"]
    assert rows(lake.read_bronze(spark, home)) == before
    assert lake.compact(spark, home) == [D6]
    assert lake.compact(spark, home) == []
    assert rows(lake.read_bronze(spark, home)) == before
    lake.refresh(spark, home)
    assert lake.read_silver(spark, home).count() == 12


def test_a_load_in_a_pack_still_replaces_itself(spark, home):
    three_loads(spark, home)
    lake.compact(spark, home)
    assert load(spark, home, "1", D5, event(event_id="new")) == [D5, D6]
    got = sorted((r.load_id, r.event_id) for r in lake.read_bronze(spark, home).collect())
    assert [x for x in got if x[0] == "1"] == [("1", "new")] and len(got) == 9
    lake.compact(spark, home)
    assert lake.write_load(events_df(spark, event()).limit(0), home, "1") == [D5]
    assert {r.load_id for r in lake.read_bronze(spark, home).collect()} == {"0", "2"}


def test_a_pack_that_loses_all_rows_goes(spark, home):
    three_loads(spark, home)
    lake.compact(spark, home)
    for k in range(3):
        load(spark, home, f"{k}", D5, event(event_id=f"{k}", event_timestamp="2024-01-07T00:00:00Z"))
    assert directories(spark, home, D5) == directories(spark, home, D6) == []
    assert lake.read_bronze(spark, home).count() == 3


def test_large_and_open_loads_stay_as_they_are(spark, home):
    three_loads(spark, home)
    files.touch(spark, f"{home.open_loads}/1")
    assert lake.compact(spark, home, [D5], small=1) == []
    assert lake.compact(spark, home, [D5]) == [D5]
    assert directories(spark, home, D5)[0] == "1" and len(directories(spark, home, D5)) == 2


@pytest.mark.parametrize("step", ["delete", "rename", "write_text"])
@pytest.mark.parametrize("call", (1, 2, 4))
def test_a_compaction_that_crashes_anywhere_is_finished_later(spark, home, monkeypatch, step, call):
    three_loads(spark, home)
    before = rows(lake.read_bronze(spark, home))
    real, calls = getattr(files, step), []

    def fail(*args):
        calls.append(args)
        if len(calls) == call:
            raise RuntimeError("lost")
        return real(*args)

    monkeypatch.setattr(files, step, fail)
    try:
        lake.compact(spark, home)
    except RuntimeError:
        pass
    monkeypatch.undo()
    lake.compact(spark, home)
    assert rows(lake.read_bronze(spark, home)) == before
    assert all(len(directories(spark, home, d)) == 1 for d in (D5, D6))
    load(spark, home, "2", D5, event(event_id="new"))
    assert lake.read_bronze(spark, home).count() == 9


def test_a_load_asks_for_its_own_directories_only(spark, home, monkeypatch):
    def asked(load_id):
        calls = []
        for name in ("exists", "matching", "file_names", "read_text", "delete", "touch", "write_text"):
            real = getattr(files, name)
            monkeypatch.setattr(files, name, lambda *a, real=real: calls.append(a) or real(*a))
        load(spark, home, load_id, D5, event(event_id=load_id))
        monkeypatch.undo()
        return len(calls)

    asked("first")
    few = asked("few")
    load(spark, home, "many", D5, *[event(event_id=f"e{k}", event_timestamp=f"2023-{1 + k // 28:02}-{1 + k % 28:02}T00:00:00Z") for k in range(60)])
    assert asked("then") == few


def test_a_lake_made_before_manifests_is_taken_over(spark, home):
    three_loads(spark, home)
    files.delete(spark, f"{home.root}/manifests")
    assert load(spark, home, "1", D5, event(event_id="new")) == [D5, D6]
    assert lake.read_bronze(spark, home).count() == 9


def test_names_of_packs_are_not_for_loads(spark, home):
    with pytest.raises(ValueError, match="pack-"):
        load(spark, home, f"{loads.PACK}x", D5, event())


def test_dedup_of_the_whole_history_agrees(spark, home):
    """Where no id has two stated dates, the lake keeps what deduplication by id alone keeps."""
    load(spark, home, "a", D5, event(), event(event_id="e2"))
    load(spark, home, "b", D6, UNDATED, event(event_id="e2", event_timestamp=None))
    lake.refresh(spark, home)
    whole = dedup_events(lake.read_bronze(spark, home).drop("load_id"), identity=("event_id",))
    assert {r.event_id for r in whole.collect()} == {r.event_id for r in lake.read_silver(spark, home).collect()}
    assert {str(r.event_date) for r in lake.read_silver(spark, home).collect()} == {str(D5)}
