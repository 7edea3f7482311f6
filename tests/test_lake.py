"""Loads, rebuilds and what they do to the other dates."""

import datetime as dt
from pathlib import Path

import pytest

from daymark.__main__ import parser, run
from daymark.operators.daily_metrics import daily_user_metrics
from daymark.operators import screening
from daymark.operators.dedup import dedup_events
from daymark.plans import lake
from daymark.plans.audit import audit
from daymark.sources.tables import read_table, table_dates
from daymark.schemas import BRONZE
from daymark.session import shuffles_for
from helpers import INGEST_DATE, envelope, event, events_df, rows, write_lines

D5, D6 = dt.date(2024, 1, 5), dt.date(2024, 1, 6)
ON_6 = "2024-01-06T08:00:00+00:00"


def load(spark, home, load_id, *events):
    return lake.write_load(events_df(spark, *events), home, load_id)


def files(path):
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def test_refresh_builds_all_tables(spark, home):
    load(spark, home, "a", event(), event(), event(event_id="e2", user_id="x"), event(event_id="e3", event_timestamp=ON_6))
    assert lake.refresh(spark, home) == [D5, D6]
    assert lake.read_bronze(spark, home).count() == 4
    assert lake.read_silver(spark, home).count() == 2
    assert [r.reason for r in lake.read_quarantine(spark, home).collect()] == ["bad_user_id"]
    assert lake.read_quarantine(spark, home).first().user_id == "x"
    assert lake.read_gold(spark, home).count() == 2


def test_running_everything_twice_changes_nothing(spark, home):
    batch = [event(event_id=f"e{i}", user_id=str(i % 3), amount=f"{i}.25") for i in range(20)]
    load(spark, home, "a", *batch)
    lake.refresh(spark, home)
    before = [rows(read(spark, home)) for read in (lake.read_silver, lake.read_gold)]
    load(spark, home, "a", *batch)
    load(spark, home, "redelivered", *batch[:7])
    lake.refresh(spark, home)
    lake.rebuild_all(spark, home)
    assert [rows(read(spark, home)) for read in (lake.read_silver, lake.read_gold)] == before


def test_a_late_event_changes_its_own_date_only(spark, home):
    load(spark, home, "a", event(), event(event_id="e2", event_timestamp=ON_6))
    lake.refresh(spark, home)
    kept = {p: t for root in (home.screened, home.gold) for p, t in files(root).items() if "2024-01-06" in p}
    load(spark, home, "b", event(event_id="late"))
    assert lake.refresh(spark, home) == [D5]
    now = {**files(home.screened), **files(home.gold)}
    assert kept and all(now[p] == t for p, t in kept.items())
    assert {(r.event_date, r.events_count) for r in lake.read_gold(spark, home).collect()} == {(D5, 2), (D6, 1)}


def test_a_date_whose_rows_all_turn_invalid_leaves_gold(spark, home):
    load(spark, home, "a", event(), event(event_id="e2", event_timestamp=ON_6))
    lake.refresh(spark, home)
    load(spark, home, "a", event(page="/admin"), event(event_id="e2", event_timestamp=ON_6))
    assert lake.refresh(spark, home) == [D5, D6]
    assert [r.event_date for r in lake.read_gold(spark, home).collect()] == [D6]
    assert [r.event_date for r in lake.read_silver(spark, home).collect()] == [D6]
    assert [r.event_date for r in lake.read_quarantine(spark, home).collect()] == [D5]


def test_a_repeated_load_may_leave_a_date(spark, home):
    load(spark, home, "a", event())
    lake.refresh(spark, home)
    assert load(spark, home, "a", event(event_timestamp=ON_6)) == [D5, D6]
    lake.refresh(spark, home)
    assert table_dates(spark, home.bronze) in ([D6], [D5, D6])
    assert [r.event_date for r in lake.read_gold(spark, home).collect()] == [D6]


def test_an_empty_load_is_no_op(spark, home):
    load(spark, home, "a", event())
    lake.refresh(spark, home)
    before = rows(lake.read_gold(spark, home))
    assert lake.write_load(events_df(spark, event()).limit(0), home, "none") == []
    assert lake.refresh(spark, home) == []
    assert rows(lake.read_gold(spark, home)) == before


def test_tables_that_do_not_exist_yet_are_empty(spark, home):
    assert lake.read_gold(spark, home).isEmpty()
    assert lake.refresh(spark, home) == []
    assert lake.rebuild_all(spark, home) == []


def test_a_load_noted_during_a_refresh_stays_pending(spark, home, monkeypatch):
    load(spark, home, "a", event())
    rebuild_gold = lake.rebuild_gold

    def load_meanwhile(*args):
        rebuild_gold(*args)
        load(spark, home, "b", event(event_id="e2"))

    monkeypatch.setattr(lake, "rebuild_gold", load_meanwhile)
    lake.refresh(spark, home)
    monkeypatch.undo()
    assert lake.refresh(spark, home) == [D5]
    assert lake.read_gold(spark, home).first().events_count == 2


def test_a_failed_refresh_stays_pending(spark, home, monkeypatch):
    load(spark, home, "a", event())

    def fail(*args):
        raise RuntimeError("lost")

    monkeypatch.setattr(lake, "rebuild_gold", fail)
    with pytest.raises(RuntimeError):
        lake.refresh(spark, home)
    monkeypatch.undo()
    assert lake.refresh(spark, home) == [D5]


def test_views_can_be_queried(spark, home):
    load(spark, home, "a", event(), event(event_id="e2", page="/x"))
    lake.refresh(spark, home)
    lake.create_views(spark, home)
    got = spark.sql(
        "SELECT (SELECT count(*) FROM app_events_bronze), (SELECT count(*) FROM app_events_quarantine), "
        "sum(events_count) FROM daily_user_metrics WHERE event_date = DATE'2024-01-05'"
    )
    assert tuple(got.first()) == (2, 1, 1)
    assert spark.table("app_events").count() == 1


def test_load_names_are_checked(spark, home):
    with pytest.raises(ValueError, match="load_id"):
        load(spark, home, "a/b", event())


def test_dates_prune_the_scan(spark, home):
    load(spark, home, "a", event(), event(event_id="e2", event_timestamp=ON_6))
    df = read_table(spark, home.bronze, BRONZE, [D6])
    assert all("event_date=2024-01-06" in f for f in df.inputFiles()) and df.count() == 1
    plan = read_table(spark, home.bronze, BRONZE).filter("event_date = DATE'2024-01-06'")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "event_date" in text[text.index("PartitionFilters") : text.index("PushedFilters")]


def test_incremental_equals_full(spark, home):
    """Loads in pieces, refreshed piece by piece, against one pass over everything."""
    events = [
        event(event_id=f"e{i % 17}", user_id=str(i % 4), amount=f"{i % 5}.5", event_timestamp=f"2024-01-0{1 + i % 17 % 5}T0{i % 17 % 9}:00:00Z")
        for i in range(60)
    ]
    for n in range(0, 60, 12):
        load(spark, home, f"part-{n}", *events[n : n + 12])
        lake.refresh(spark, home)
    whole = screening.clean(dedup_events(events_df(spark, *events)))
    assert rows(lake.read_silver(spark, home)) == rows(whole)
    assert rows(lake.read_gold(spark, home)) == rows(daily_user_metrics(whole))


def test_a_long_history_is_rebuilt_in_runs(spark, home, monkeypatch):
    days = [f"2024-01-0{n}T00:00:00Z" for n in range(1, 6)]
    load(spark, home, "a", *[event(event_id=f"e{d}", event_timestamp=d) for d in days])
    one = lake.files.total_bytes(spark, f"{home.bronze}/event_date=2024-01-01")
    dates = table_dates(spark, home.bronze)
    runs = lambda limit: [len(g) for g in lake._groups(spark, home.bronze, dates, limit)]
    assert runs(10 * one) == [5]
    assert runs(2 * one + one // 2) == [2, 2, 1]
    assert runs(1) == [1] * 5

    monkeypatch.setattr(lake._groups, "__defaults__", (2 * one + one // 2,))
    rebuild_gold, calls = lake.rebuild_gold, []

    def fail_on_second(*args):
        calls.append(args)
        if len(calls) == 2:
            raise RuntimeError("lost")
        rebuild_gold(*args)

    monkeypatch.setattr(lake, "rebuild_gold", fail_on_second)
    with pytest.raises(RuntimeError):
        lake.refresh(spark, home)
    monkeypatch.setattr(lake, "rebuild_gold", rebuild_gold)
    assert lake.refresh(spark, home) == dates[2:]
    assert lake.read_gold(spark, home).count() == 5


def test_shuffles_follow_the_input(spark):
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    for size, expected in ((0, before), (2**30, "32"), (2**40, "32768"), (2**50, "33554432")):
        with shuffles_for(spark, size):
            assert spark.conf.get(setting) == expected
        assert spark.conf.get(setting) == before


def test_one_file_per_partition_however_many_tasks(spark, home):
    events = [event(event_id=f"e{i}", event_timestamp=f"2024-01-0{1 + i % 5}T00:00:00Z") for i in range(50)]
    lake.write_load(events_df(spark, *events).repartition(8), home, "a")
    lake.refresh(spark, home)
    for table in (home.bronze, home.silver, home.gold):
        assert len(files(table)) == 5


def uneven_days():
    """Five days, the first with most of the rows: copies, a hot id, no ids, no dates, rejected rows."""
    for day, n in enumerate((400, 3, 3, 3, 3), 1):
        at = f"2024-01-0{day}T08:00:00+00:00"
        for i in range(n):
            yield event(event_id=f"{day}-{i}", event_timestamp=at, user_id=str(i % 7), amount=f"{i}.25")
            yield event(event_id="hot", event_timestamp=at, page=None if i % 2 else "/home")
        yield event(event_id=f"{day}-0", event_timestamp=at, user_id="0", amount="0.25")
        yield from [event(event_id=None, event_timestamp=at)] * 2
        yield event(event_id=f"{day}-bad", event_timestamp=at, page="/admin")
        yield event(event_id=f"{day}-1", event_timestamp=None)


@pytest.mark.parametrize("large", ["all", "first"])
def test_dates_with_a_shuffle_of_their_own_come_out_the_same(spark, tmp_path, large):
    homes = [lake.Lake(str(tmp_path / "together"))]
    load(spark, homes[0], "a", *uneven_days())
    sizes = sorted(lake._groups(spark, homes[0].bronze, table_dates(spark, homes[0].bronze))[0].values())
    homes.append(lake.Lake(str(tmp_path / "apart"), large_date_bytes=0 if large == "all" else sizes[-1]))
    load(spark, homes[1], "a", *uneven_days())
    for home in homes:
        lake.refresh(spark, home)
    for read in (lake.read_silver, lake.read_quarantine, lake.read_gold):
        one, other = (rows(read(spark, home)) for home in homes)
        assert one and one == other
    # Adaptive execution has merged the small partitions of each part.
    assert len(files(homes[1].silver)) == len(files(homes[0].silver)) == len(table_dates(spark, homes[0].silver))

    load(spark, homes[1], "a", event(event_timestamp="2024-01-03T08:00:00Z"))
    lake.refresh(spark, homes[1])
    assert [r.event_date.day for r in lake.read_gold(spark, homes[1]).collect()] == [3]


def test_rows_of_a_large_date_are_shuffled_once(spark, home):
    load(spark, home, "a", *uneven_days())
    dates = table_dates(spark, home.bronze)
    bronze = lake.read_bronze(spark, home, dates).drop("load_id")
    clean = lambda rows: screening.screen(dedup_events(rows))

    def plan(large, others):
        made = lake._by_date(bronze, large, others, clean, ("verdict", "event_date"))
        return made._jdf.queryExecution().executedPlan().toString()

    one = plan(dates[:1], False)
    assert one.count("Exchange") == 1
    # Copies go before the rows move, a hot id's too.
    assert one.index("Final") < one.index("Exchange hashpartitioning") < one.index("Partial")
    assert plan(dates[:2], False).count("Exchange") == 2
    assert plan(dates[:2], True).count("Exchange") == 4
    assert plan([], True).count("Exchange") == 2
    gold = lake._by_date(screening.clean(bronze), dates[:1], False, daily_user_metrics, ("event_date",))
    assert gold._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_audit_passes_a_sound_lake_and_finds_a_wrong_table(spark, home):
    load(spark, home, "a", event(), event(), event(event_id=None), event(event_id="e2", user_id="x"))
    lake.refresh(spark, home)
    args = parser().parse_args(["audit", "--lake", home.root])
    assert run(spark, args) == [D5]
    failing = {(r.scope, r.check): r.failing for r in audit(spark, home).collect()}
    assert failing["raw", "event_id_unique"] == 1 and failing["raw", "user_id_is_integer"] == 1
    assert not any(n for (scope, _), n in failing.items() if scope == "table")
    lake.read_gold(spark, home).drop("event_date").write.parquet(f"{home.gold}/event_date=2024-01-06")
    with pytest.raises(SystemExit, match="gold_counts_every_silver_row"):
        run(spark, args)


def test_audit_reads_gold_twice_and_the_rest_once(spark, home):
    load(spark, home, "a", event(), event(event_id="e2", user_id="x"))
    lake.refresh(spark, home)
    report = audit(spark, home)
    report.collect()
    final = report._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    scans = [line for line in final.splitlines() if "FileScan parquet" in line]
    assert len(scans) == 5
    assert sum("[event_id#" in line for line in scans) == 1  # bronze: its keys
    assert sum("[user_id#" in line for line in scans) == 2  # gold
    assert "ReusedExchange" in final


def test_command_line(spark, tmp_path):
    landing, home = tmp_path / "landing", str(tmp_path / "lake")
    write_lines(landing, "1.txt", envelope(event()), envelope(event(event_id="e2", event_timestamp=ON_6)), "x")

    def go(*args):
        return run(spark, parser().parse_args([args[0], "--lake", home, *args[1:]]))

    days = [D5, D6, dt.date(2024, 2, 1)]
    assert go("ingest", "--landing", str(landing), "--load-id", "1", "--ingest-date", INGEST_DATE) == days
    assert go("refresh") == days
    assert go("silver", "--dates", "2024-01-05") == [D5]
    assert go("gold") == [D5, D6]
    target = str(tmp_path / "serving")
    assert go("publish", "--target", target, "--dates", "2024-01-05") == [D5]
    assert table_dates(spark, target) == [D5]
    write_lines(landing, "2.txt", envelope(event(event_id="e3")))
    assert go("drain", "--landing", str(landing), "--ingest-date", INGEST_DATE, "--checkpoint", str(tmp_path / "cp")) == days
    assert {r.events_count for r in lake.read_gold(spark, lake.Lake(home)).filter("event_date = '2024-01-05'").collect()} == {2}
    assert go("compact", "--dates", "2024-01-05") == [D5]


def test_kpi_stage(spark, tmp_path, home):
    load(spark, home, "a", event(), event(event_id="e2", user_id="8"))
    lake.refresh(spark, home)
    out = str(tmp_path / "kpi")

    def go(*args):
        return run(spark, parser().parse_args(["kpi", *args, "--lake", home.root, "--out", out]))

    go("daily_summary")
    assert spark.read.parquet(out).first().active_users == 2
    go("retention")
    assert spark.read.parquet(out).first().cohort_size == 2
    with pytest.raises(SystemExit, match="--customers"):
        go("churn_proxy")


def test_a_typed_table_made_elsewhere_can_be_imported(spark, tmp_path, home):
    old = str(tmp_path / "old")
    spark.createDataFrame(
        [
            ("e1", 7, "checkout", "2024-01-05T10:00:00+00:00", "/", 1001.0, 12.5, "2024-01-05"),
            ("e1", 7, "checkout", "2024-01-05T10:00:00+00:00", "/", 1001.0, 12.5, "2024-01-05"),
            ("e2", 8, "login", None, "/", None, None, "2024-01-06"),
        ],
        "event_id string, user_id bigint, event_type string, event_timestamp string, page string, "
        "product_id double, amount double, event_date string",
    ).write.partitionBy("event_date").parquet(old)
    args = ["import", "--lake", home.root, "--table", old, "--load-id", "old", "--ingest-date", INGEST_DATE]
    assert run(spark, parser().parse_args(args)) == [D5, D6]
    lake.refresh(spark, home)
    silver = lake.read_silver(spark, home).orderBy("event_id").collect()
    assert [(r.event_id, r.user_id, r.product_id, r.amount, r.event_date) for r in silver] == [
        ("e1", 7, 1001, 12.5, D5),
        ("e2", 8, None, None, D6),
    ]


def test_a_load_that_failed_is_still_rebuilt(spark, home, monkeypatch):
    note = lake._note_pending
    monkeypatch.setattr(lake, "_note_pending", lambda s, h, dates: None if dates == [] else 1 / 0)
    with pytest.raises(ZeroDivisionError):
        lake.write_load(events_df(spark, event(event_timestamp="2024-01-05T00:00:00Z")), home, "a")
    monkeypatch.setattr(lake, "_note_pending", note)
    assert [str(d) for d in lake.refresh(spark, home)] == ["2024-01-05"]
    assert lake.read_gold(spark, home).count() == 1
