"""The stream gives what the batch gives."""

import os
import time

import pytest
from pyspark.sql import functions as F

from daymark.plans import lake
from daymark.plans.lake import Lake
from daymark.streaming.dedup import dedup_stream
from daymark.streaming.ingest import drain, start_ingest
from helpers import INGEST_DATE, envelope, event, rows, write_lines


def batch_of(n, start=0):
    return [
        envelope(event(event_id=f"e{i}", user_id=i % 5, event_timestamp=f"2024-01-0{1 + i % 4}T01:00:00Z"))
        for i in range(start, start + n)
    ]


@pytest.mark.parametrize("limit", [{"max_files": 1}, {"max_files": 2}, {"max_bytes": 10}, {}])
def test_stream_equals_batch(spark, tmp_path, limit):
    landing = tmp_path / "landing"
    for n in range(3):
        write_lines(landing, f"{n}.txt", *batch_of(10, 7 * n), "broken", '{"Message":""}')
    streamed, batched = Lake(str(tmp_path / "s")), Lake(str(tmp_path / "b"))
    dates = drain(spark, str(landing), streamed, str(tmp_path / "cp"), INGEST_DATE, **limit)
    lake.ingest_batch(spark, str(landing), batched, "all", INGEST_DATE)
    assert lake.refresh(spark, batched) == dates
    for read in (lake.read_silver, lake.read_gold):
        assert rows(read(spark, streamed)) == rows(read(spark, batched))
    faults = lambda home: rows(lake.read_quarantine(spark, home))
    assert faults(streamed) == faults(batched) and len(faults(streamed)) == 6


def test_second_drain_reads_new_files_only(spark, tmp_path, home):
    landing, cp = tmp_path / "landing", str(tmp_path / "cp")
    write_lines(landing, "1.txt", *batch_of(8))
    drain(spark, str(landing), home, cp, INGEST_DATE)
    assert drain(spark, str(landing), home, cp, INGEST_DATE) == []
    write_lines(landing, "2.txt", *batch_of(1, 4))
    assert [d.isoformat() for d in drain(spark, str(landing), home, cp, INGEST_DATE)] == ["2024-01-01"]
    assert lake.read_bronze(spark, home).count() == 9
    assert lake.read_silver(spark, home).count() == 8


def test_a_repeated_batch_replaces_itself(spark, tmp_path, home):
    """The commit of the only batch is undone, as a crash just before it would leave things."""
    landing, cp = tmp_path / "landing", tmp_path / "cp"
    write_lines(landing, "1.txt", *batch_of(8))
    drain(spark, str(landing), home, str(cp), INGEST_DATE)
    before = rows(lake.read_bronze(spark, home))
    (cp / "commits" / "0").unlink()
    (cp / "commits" / ".0.crc").unlink(missing_ok=True)
    drain(spark, str(landing), home, str(cp), INGEST_DATE)
    assert rows(lake.read_bronze(spark, home)) == before


def test_a_batch_repeated_on_another_day_leaves_no_copy(spark, tmp_path, home):
    """Undated events take the new ingest date; the first attempt's partition goes."""
    landing, cp = tmp_path / "landing", tmp_path / "cp"
    write_lines(landing, "1.txt", envelope(event(event_id="undated", event_timestamp=None)), *batch_of(2))
    drain(spark, str(landing), home, str(cp), "2024-02-01")
    (cp / "commits" / "0").unlink()
    (cp / "commits" / ".0.crc").unlink(missing_ok=True)
    drain(spark, str(landing), home, str(cp), "2024-02-02")
    dates = [str(r.event_date) for r in lake.read_gold(spark, home).orderBy("event_date").collect()]
    assert dates == ["2024-01-01", "2024-01-02", "2024-02-02"]
    assert lake.read_bronze(spark, home).count() == 3


def test_a_new_checkpoint_keeps_the_old_loads(spark, tmp_path, home):
    landing = tmp_path / "landing"
    write_lines(landing, "1.txt", *batch_of(3))
    drain(spark, str(landing), home, str(tmp_path / "cp1"), INGEST_DATE)
    write_lines(tmp_path / "other", "2.txt", *batch_of(3, 3))
    drain(spark, str(tmp_path / "other"), home, str(tmp_path / "cp2"), INGEST_DATE)
    assert lake.read_silver(spark, home).count() == 6


def test_files_in_folders_below_are_read(spark, tmp_path, home):
    landing = tmp_path / "landing"
    write_lines(landing, "1.txt", *batch_of(2))
    write_lines(landing / "2024" / "02", "2.txt", *batch_of(2, 2))
    write_lines(landing / "hour=03", "3.txt", *batch_of(2, 4))
    drain(spark, str(landing), home, str(tmp_path / "cp"), INGEST_DATE)
    assert lake.read_silver(spark, home).count() == 6
    lake.ingest_batch(spark, str(landing), home, "batch", INGEST_DATE)
    assert lake.read_bronze(spark, home).count() == 12


def test_empty_landing(spark, tmp_path, home):
    (tmp_path / "landing").mkdir()
    assert drain(spark, str(tmp_path / "landing"), home, str(tmp_path / "cp"), INGEST_DATE) == []


def test_start_ingest_leaves_the_dates_pending(spark, tmp_path, home):
    write_lines(tmp_path / "landing", "1.txt", *batch_of(4))
    start_ingest(spark, str(tmp_path / "landing"), home, str(tmp_path / "cp"), INGEST_DATE).awaitTermination()
    assert lake.read_gold(spark, home).isEmpty()
    assert len(lake.refresh(spark, home)) == 4


def test_consumed_files_are_archived_after_their_batch(spark, tmp_path, home):
    """The clean-up of a batch runs with the next one."""
    landing, archive, cp = tmp_path / "landing", tmp_path / "archive", str(tmp_path / "cp")
    for n in range(2):
        write_lines(landing, f"{n}.txt", *batch_of(4, 4 * n))
        drain(spark, str(landing), home, cp, INGEST_DATE, archive=str(archive))
    write_lines(landing, "2.txt", *batch_of(1, 8))
    drain(spark, str(landing), home, cp, INGEST_DATE, archive=str(archive))
    assert lake.read_silver(spark, home).count() == 9
    archived = {p.name for p in archive.rglob("*.txt")}
    assert archived and archived | {p.name for p in landing.glob("*.txt")} == {"0.txt", "1.txt", "2.txt"}


def test_archive_must_lie_outside_the_landing_directory(spark, tmp_path, home):
    with pytest.raises(ValueError, match="archive"):
        drain(spark, str(tmp_path / "in"), home, str(tmp_path / "cp"), INGEST_DATE, archive=str(tmp_path / "in" / "old"))


def test_interval_ingest_keeps_looking(spark, tmp_path, home):
    landing = tmp_path / "landing"
    write_lines(landing, "1.txt", *batch_of(4))
    query = start_ingest(spark, str(landing), home, str(tmp_path / "cp"), INGEST_DATE, every="0 seconds")
    try:
        query.processAllAvailable()
        write_lines(landing, "2.txt", *batch_of(4, 4))
        query.processAllAvailable()
    finally:
        query.stop()
    lake.refresh(spark, home)
    assert lake.read_silver(spark, home).count() == 8


@pytest.mark.parametrize("spread", [None, "file_name"])
def test_stream_dedup_holds_across_runs(spark, tmp_path, spread):
    source, out, cp = (str(tmp_path / n) for n in ("source", "out", "cp"))

    def send(*ids):
        rows_ = [(i, "2024-01-05") for i in ids]
        spark.createDataFrame(rows_, "event_id string, event_date string").withColumn(
            "event_date", F.col("event_date").cast("date")
        ).repartition(2).write.mode("append").parquet(source)
        stream = (
            spark.readStream.schema("event_id string, event_date date")
            .parquet(source)
            .select("*", "_metadata.file_name")
        )
        (
            dedup_stream(stream, "1 hour", spread)
            .select("event_id", "event_date")
            .writeStream.format("parquet")
            .option("path", out)
            .option("checkpointLocation", cp)
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
        return sorted((r.event_id or "-") for r in spark.read.parquet(out).collect())

    assert send("a", "a", "b", None, None) == ["-", "-", "a", "b"]
    assert send("a", "c", None) == ["-", "-", "-", "a", "b", "c"]


@pytest.mark.parametrize("days", [10, 400])
def test_a_file_of_any_age_is_read(spark, tmp_path, home, days):
    landing, checkpoint = tmp_path / "landing", str(tmp_path / "cp")
    write_lines(landing, "one", envelope(event(event_id="a")))
    drain(spark, str(landing), home, checkpoint, INGEST_DATE)
    write_lines(landing, "two", envelope(event(event_id="b")))
    write_lines(landing, "three", envelope(event(event_id="c")))
    old = time.time() - days * 86400
    os.utime(landing / "two", (old, old))
    drain(spark, str(landing), home, checkpoint, INGEST_DATE)
    assert {r.event_id for r in lake.read_bronze(spark, home).collect()} == {"a", "b", "c"}
