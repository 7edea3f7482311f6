"""The lake: ingest loads, then rebuild the dates they touched.

Each stage reads the stage before it and replaces whole dates, so any of them
can be run again, or over again after a crash, without changing the result.
One job per table is expected to run at a time.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.functions.events import count_where
from daymark.operators.daily_metrics import daily_user_metrics
from daymark.operators.dedup import dedup_events
from daymark.operators.screening import ACCEPTED, REJECTED, screen
from daymark.plans import load_checks
from daymark.plans.identity import Identities
from daymark.plans.loads import PACK, SMALL_BYTES, Loads
from daymark.schemas import BRONZE, BRONZE_STORED, EVENT_COLUMNS, EVENT_TEXT, GOLD, QUARANTINE, SILVER
from daymark.session import shuffles_for, use_utc
from daymark import filesystem as files
from daymark.sinks.tables import replace_and_count, replace_partitions
from daymark.sources.landing import read_landing, unwrap
from daymark.sources.tables import as_text_events, read_table, table_dates

# Parquet bytes rebuilt in one go.
GROUP_BYTES = 2**40
# Parquet bytes from which a date has a shuffle of its own in a rebuild: at most 32 of them are in one run.
LARGE_DATE_BYTES = GROUP_BYTES // 32


@dataclass(frozen=True)
class Lake:
    """Where the tables are.

    `identity_buckets` is for a lake that has no identity table yet: a bucket's ids should be some
    GB at most. It then stays as it is. `large_date_bytes` says from which size on a date is rebuilt
    with one shuffle; see `_replace_dates`.
    """

    root: str
    identity_buckets: int = 8
    large_date_bytes: int = LARGE_DATE_BYTES

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/app_events"

    @property
    def screened(self) -> str:
        return f"{self.root}/silver/app_events"

    @property
    def silver(self) -> str:
        return f"{self.screened}/verdict={ACCEPTED}"

    @property
    def quarantine(self) -> str:
        return f"{self.screened}/verdict={REJECTED}"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold/daily_user_metrics"

    @property
    def pending(self) -> str:
        return f"{self.root}/pending_dates"

    @property
    def open_loads(self) -> str:
        return f"{self.root}/open_loads"

    @property
    def new_loads(self) -> str:
        return f"{self.root}/new_loads"


# --- bronze -----------------------------------------------------------------


def write_load(events: DataFrame, lake: Lake, load_id: str) -> list[dt.date]:
    """Write one load of unwrapped events to bronze; return the dates it touches.

    A load has its own directory within each date. Writing the same load again
    replaces it, in packs too. The dates are noted as pending before anything is removed and
    after anything is added. Between, the load is noted as open, and `refresh`
    finishes the notes of open loads, so a rebuild cannot miss one when a load fails.
    The calls to the file system follow the load's own dates, not those of the lake. The write also
    counts the rows that break each rule of the quality report, for the load's record.
    """
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", load_id) or load_id.startswith(PACK):
        raise ValueError(f"load_id may hold letters, digits, '_', '.' and '-' only, not start with {PACK}: {load_id!r}")
    spark, loads = events.sparkSession, _loads(events.sparkSession, lake)
    loads.adopt()
    loads.recover()
    was_open = files.exists(spark, f"{lake.open_loads}/{load_id}")
    files.touch(spark, f"{lake.open_loads}/{load_id}")
    earlier = loads.found(load_id) if was_open else loads.places(load_id)
    _note_pending(spark, lake, sorted(earlier))
    checks = load_checks.LoadChecks(spark, lake.root)
    checks.remove(load_id)
    loads.withdraw(load_id, {d: place for d, place in earlier.items() if place != load_id})
    written, counts = replace_and_count(
        events.withColumn("load_id", F.lit(load_id)),
        lake.bronze,
        ("event_date", "load_id"),
        [f"event_date={d.isoformat()}/load_id={load_id}" for d, place in earlier.items() if place == load_id],
        load_checks.conditions(),
    )
    checks.note(load_id, counts)
    dates = [dt.date.fromisoformat(p.split("/")[0].split("=")[1]) for p in written]
    _close(spark, lake, load_id, dates)
    return sorted({*earlier, *dates})


def _close(spark: SparkSession, lake: Lake, load_id: str, dates: list[dt.date]) -> None:
    """Note where the rows of a load are, and what is to be done for it."""
    _loads(spark, lake).note(load_id, dict.fromkeys(dates, load_id))
    _note_pending(spark, lake, dates)
    files.touch(spark, f"{lake.new_loads}/{load_id}")
    files.delete(spark, f"{lake.open_loads}/{load_id}")


def record_identities(spark: SparkSession, lake: Lake) -> None:
    """Enter the ids of new loads into the identity table, all in one pass.

    Where other loads have undated copies of the same events, what counts may change: their dates become
    pending, for the ids a repeated load had before and for those it has now.
    """
    new = sorted(files.file_names(spark, lake.new_loads))
    if not new:
        return
    identities = _identities(spark, lake)
    _note_pending(spark, lake, identities.related_dates(new))
    dates = {d for places in files.each(_loads(spark, lake).places, new) for d in places}
    identities.record(read_bronze(spark, lake, dates).where(F.col("load_id").isin(new)), new)
    _note_pending(spark, lake, identities.related_dates(new))
    files.each(lambda load_id: files.delete(spark, f"{lake.new_loads}/{load_id}"), new)


def record_missing(spark: SparkSession, lake: Lake) -> None:
    """Count the loads that have no record: of a lake made before there were any, or cut off before theirs was written.

    Reads the rows of those loads only, once for all. Loads that are being written are left out.
    """
    loads, checks = _loads(spark, lake), load_checks.LoadChecks(spark, lake.root)
    loads.adopt()
    loads.recover()
    known = files.file_names(spark, loads.manifests) - files.file_names(spark, lake.open_loads) - {"_complete"}
    missing = sorted(known - checks.loads())
    if not missing:
        return
    dates = {d for places in files.each(loads.places, missing) for d in places}
    rows = read_bronze(spark, lake, dates).where(F.col("load_id").isin(missing))
    counted = rows.groupBy("load_id").agg(*[count_where(c).alias(name) for name, c in load_checks.conditions().items()])
    found = {r.load_id: r.asDict() for r in counted.collect()}  # a row per load
    files.each(lambda load_id: checks.note(load_id, found.get(load_id, {})), missing)


def load_report(spark: SparkSession, lake: Lake) -> DataFrame:
    """One row per closed load and rule: load_id, recorded_at, rule, failing, total. Reads records, no bronze rows."""
    use_utc(spark)
    record_missing(spark, lake)
    return load_checks.LoadChecks(spark, lake.root).report()


def load_drift(spark: SparkSession, lake: Lake, deviations: float = 4.0, least: float = 0.01) -> DataFrame:
    """The load report beside what earlier loads were like; see `load_checks.drift`."""
    return load_checks.drift(load_report(spark, lake), deviations, least)


def _loads(spark: SparkSession, lake: Lake) -> Loads:
    return Loads(spark, lake.root, lake.bronze)


def _identities(spark: SparkSession, lake: Lake) -> Identities:
    return Identities(spark, lake.root, lake.identity_buckets)


def compact(
    spark: SparkSession, lake: Lake, dates: Iterable[dt.date] | None = None, small: int = SMALL_BYTES
) -> list[dt.date]:
    """Merge the small loads of each date, or of the given ones, into one set of files; return the dates changed.

    Loads that are still being written are left out. What bronze says does not change, and a
    load can be written again as before. Nothing else may write to the lake meanwhile.
    """
    use_utc(spark)
    loads = _loads(spark, lake)
    loads.adopt()
    loads.recover()
    closed = files.file_names(spark, loads.manifests) - files.file_names(spark, lake.open_loads)
    return loads.compact(table_dates(spark, lake.bronze) if dates is None else dates, closed, small)


def ingest_batch(
    spark: SparkSession, landing: str, lake: Lake, load_id: str, ingest_date: dt.date | str
) -> list[dt.date]:
    """Load a landing directory in one batch; return the dates it touches."""
    use_utc(spark)
    return write_load(unwrap(read_landing(spark, landing), ingest_date), lake, load_id)


def import_table(
    spark: SparkSession, path: str, lake: Lake, load_id: str, ingest_date: dt.date | str
) -> list[dt.date]:
    """Load a Parquet table of events made elsewhere; return the dates it touches."""
    use_utc(spark)
    return write_load(as_text_events(spark.read.parquet(path), ingest_date), lake, load_id)


def _note_pending(spark: SparkSession, lake: Lake, dates: Iterable[dt.date]) -> None:
    notes = [f"{lake.pending}/event_date={d.isoformat()}/{uuid.uuid4().hex}" for d in dates]
    files.each(lambda note: files.touch(spark, note), notes)


# --- reading ----------------------------------------------------------------


def read_bronze(spark: SparkSession, lake: Lake, dates: Iterable[dt.date] | None = None) -> DataFrame:
    stored = read_table(spark, lake.bronze, BRONZE_STORED, dates)
    return stored.withColumn("load_id", F.coalesce("of_load", "load_id")).select(*BRONZE.fieldNames())


def read_events(spark: SparkSession, lake: Lake, dates: Iterable[dt.date] | None = None) -> DataFrame:
    """Bronze without the undated copies of events that count on another day."""
    return _identities(spark, lake).without_redelivered(read_bronze(spark, lake, dates))


def read_silver(spark: SparkSession, lake: Lake, dates: Iterable[dt.date] | None = None) -> DataFrame:
    return read_table(spark, lake.silver, SILVER, dates)


def read_quarantine(
    spark: SparkSession, lake: Lake, dates: Iterable[dt.date] | None = None
) -> DataFrame:
    stored = T.StructType(
        [QUARANTINE["event_date"], QUARANTINE["reason"], QUARANTINE["envelope"]]
    ).add("rejected_event", "string")
    rows = read_table(spark, lake.quarantine, stored, dates)
    event = F.from_json("rejected_event", EVENT_TEXT)
    return rows.withColumn("event", event).select(
        *[F.col(f"event.{name}").alias(name) for name in EVENT_COLUMNS],
        "event_date",
        "reason",
        "envelope",
    )


def read_gold(spark: SparkSession, lake: Lake, dates: Iterable[dt.date] | None = None) -> DataFrame:
    return read_table(spark, lake.gold, GOLD, dates)


def create_views(spark: SparkSession, lake: Lake) -> None:
    """Make the tables known to SQL as app_events_bronze, app_events,
    app_events_quarantine and daily_user_metrics."""
    use_utc(spark)
    read_bronze(spark, lake).createOrReplaceTempView("app_events_bronze")
    read_silver(spark, lake).createOrReplaceTempView("app_events")
    read_quarantine(spark, lake).createOrReplaceTempView("app_events_quarantine")
    read_gold(spark, lake).createOrReplaceTempView("daily_user_metrics")


# --- silver and gold --------------------------------------------------------


def rebuild_silver(spark: SparkSession, lake: Lake, dates: Iterable[dt.date] | Mapping[dt.date, int]) -> None:
    """Deduplicate and screen the given dates anew from bronze; with their sizes, in one run.

    Copies with one id and date collapse; undated copies count once in the whole history. Silver and quarantine are the two halves of one table, written in one pass.
    """
    use_utc(spark)
    record_identities(spark, lake)
    # A run of dates that `refresh` has measured is not measured again.
    for group in [dates] if isinstance(dates, Mapping) else _groups(spark, lake.bronze, dates):
        events = read_events(spark, lake, group).drop("load_id")
        owned = [f"verdict={v}/event_date={d.isoformat()}" for v in (ACCEPTED, REJECTED) for d in group]
        _replace_dates(
            lake, group, events, lambda rows: screen(dedup_events(rows)), lake.screened, ("verdict", "event_date"), owned
        )


def rebuild_gold(spark: SparkSession, lake: Lake, dates: Iterable[dt.date]) -> None:
    """Aggregate the given dates anew from silver."""
    use_utc(spark)
    for group in _groups(spark, lake.silver, dates):
        owned = [f"event_date={d.isoformat()}" for d in group]
        _replace_dates(lake, group, read_silver(spark, lake, group), daily_user_metrics, lake.gold, ("event_date",), owned)


def _replace_dates(
    lake: Lake,
    group: Mapping[dt.date, int],
    rows: DataFrame,
    make: Callable[[DataFrame], DataFrame],
    path: str,
    keys: Sequence[str],
    owned: list[str],
) -> None:
    """Write what `make` makes of `rows` in place of `owned`; `group` has the dates' sizes."""
    with shuffles_for(rows.sparkSession, sum(group.values())):
        large = [d for d, size in group.items() if size >= lake.large_date_bytes]
        made = _by_date(rows, large, len(large) < len(group), make, keys)
        replace_partitions(made, path, keys, owned, gather=False)


def _by_date(
    rows: DataFrame, large: Sequence[dt.date], others: bool, make: Callable[[DataFrame], DataFrame], keys: Sequence[str]
) -> DataFrame:
    """`make` of the rows, dealt out for a write by `keys`; `others` tells if there are dates beside the large ones.

    `make` shuffles by an id. Many dates in one such shuffle would leave a file per date in each
    task, so the rows of small dates are gathered by date in a second one. A large date fills many
    tasks alone: it gets a shuffle of its own, whose partitions are its files, and its rows move once.
    All are parts of one write, so large dates run beside each other.
    """
    date = F.col("event_date")
    # The date as a literal hides how the parts are distributed: a union must not deal equal ones out together.
    parts = [make(rows.where(date == d)).withColumn("event_date", F.lit(d)) for d in large]
    if others:
        rest = rows.where(~date.isin(*large)) if large else rows
        parts.append(make(rest).hint("rebalance", *keys))
    return reduce(DataFrame.unionByName, parts)


def _groups(
    spark: SparkSession, table: str, dates: Iterable[dt.date], most_bytes: int = GROUP_BYTES
) -> list[dict[dt.date, int]]:
    """Dates in order with their sizes, in runs of at most `most_bytes` of `table`.

    Dates do not depend on each other, so a long history is rebuilt run by run:
    the shuffle of one run at a time is on the cluster's disks, and a failure
    costs one run. A date larger than that is a run of its own.
    """
    dates = sorted(set(dates))
    sizes = files.each(
        lambda d: files.total_bytes(spark, f"{table}/event_date={d.isoformat()}"), dates
    )
    groups: list[dict[dt.date, int]] = []
    for date, size in zip(dates, sizes):
        if groups and sum(groups[-1].values()) + size <= most_bytes:
            groups[-1][date] = size
        else:
            groups.append({date: size})
    return groups


def refresh(
    spark: SparkSession, lake: Lake, dates: Iterable[dt.date] | None = None
) -> list[dt.date]:
    """Rebuild silver and gold for `dates`, or for all pending ones; return the dates.

    A pending note is removed once both tables are rebuilt for its date, and
    only if it was there at the start: a load that comes in meanwhile stays
    pending, and so do the dates a failure leaves undone.
    """
    use_utc(spark)
    _loads(spark, lake).recover()
    for load_id in sorted(files.file_names(spark, lake.open_loads)):
        places = _loads(spark, lake).found(load_id)
        _note_pending(spark, lake, places)
        _close(spark, lake, load_id, [d for d, place in places.items() if place == load_id])
    record_identities(spark, lake)
    notes = files.matching(spark, f"{lake.pending}/event_date=*/*")
    if dates is None:
        dates = {dt.date.fromisoformat(n.rsplit("event_date=", 1)[-1][:10]) for n in notes}
    dates = sorted(set(dates))
    for group in _groups(spark, lake.bronze, dates):
        rebuild_silver(spark, lake, group)
        rebuild_gold(spark, lake, group)
        done = {f"event_date={d.isoformat()}" for d in group}
        files.each(
            lambda note: files.delete(spark, note), [n for n in notes if n.rsplit("/", 2)[-2] in done]
        )
    return dates


def rebuild_all(spark: SparkSession, lake: Lake) -> list[dt.date]:
    """Rebuild silver and gold for every date bronze has."""
    return refresh(spark, lake, table_dates(spark, lake.bronze))
