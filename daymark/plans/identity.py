"""Which event an undated copy belongs to, over the whole history.

An event is known by its id and the date it states. A copy that states none gets a date
from its delivery, so a redelivery would count again on another day. The
identity table remembers, load by load, which ids came with a date (`kind=dated`) and
which without (`kind=undated`, a small part), clustered by a hash of the id:

    identity/kind=<kind>/bucket=<b>/load_id=<load>: event_id, event_date

An undated copy counts only if its id never came with a date, and then on the earliest of the days it was
delivered. Looking that up reads the buckets of the ids at hand and no others.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark import filesystem as files
from daymark.functions.events import stated_date
from daymark.session import listings_shared, stage
from daymark.sinks.tables import replace_partitions

DATED, UNDATED = "dated", "undated"
_ENTRY = T.StructType().add("event_id", "string").add("event_date", "date")


def is_undated() -> Column:
    """An event with an id whose date is not its own statement."""
    return (
        F.col("event_id").isNotNull()
        & F.col("ingest_fault").isNull()
        & stated_date(F.col("event_timestamp")).isNull()
    )


class Identities:
    """The identity table below `root`.

    The number of buckets is set when the table is made and stays; `buckets` is for a new one.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int) -> None:
        self.spark, self.path = spark, f"{root}/identity"
        stored = files.read_text(spark, f"{self.path}/_buckets")
        if stored is None:
            files.write_text(spark, f"{self.path}/_buckets", str(buckets))
        self.buckets = int(stored or buckets)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("event_id"), F.lit(self.buckets)).cast("int").alias("bucket")

    def _paths(self, kind: str, buckets: Iterable[int]) -> list[str]:
        """Directories of some buckets; no others are listed."""
        root = f"{self.path}/kind={kind}"
        found = files.each(lambda b: files.matching(self.spark, f"{root}/bucket={b}/load_id=*"), sorted(buckets))
        return [p for some in found for p in some]

    def _read(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], _ENTRY)
        with listings_shared(self.spark):
            return self.spark.read.schema(_ENTRY).parquet(*paths)

    def record(self, events: DataFrame, loads: Iterable[str]) -> None:
        """Replace what is known of these loads by the ids of their bronze rows, in one pass."""
        undated = is_undated()
        rows = events.where("event_id IS NOT NULL AND ingest_fault IS NULL").select(
            "event_id", "event_date", "load_id", F.when(undated, UNDATED).otherwise(DATED).alias("kind"), self._bucket()
        )
        # Of a dated id the first date does; an undated one is looked for on each of its days.
        day = F.when(F.col("kind") == UNDATED, F.col("event_date")).alias("day")
        entries = rows.groupBy("kind", "bucket", "load_id", "event_id", day).agg(F.min("event_date").alias("event_date"))
        entries = entries.select("event_id", "event_date", "kind", "bucket", "load_id")
        keys = ("kind", "bucket", "load_id")
        # Sorted, so that a look-up of a few ids can pass over most of a bucket; a large bucket is split among tasks.
        replace_partitions(
            entries.hint("rebalance", *keys).sortWithinPartitions(*keys, "event_id"),
            self.path,
            keys,
            [p for load_id in loads for p in self._directories(load_id)],
            gather=False,
        )

    def _directories(self, load_id: str) -> list[str]:
        """Where entries of a load are: a question for each of the fixed number of buckets."""
        places = [f"kind={k}/bucket={b}/load_id={load_id}" for k in (DATED, UNDATED) for b in range(self.buckets)]
        there = files.each(lambda p: files.exists(self.spark, f"{self.path}/{p}"), places)
        return [p for p, is_there in zip(places, there) if is_there]

    def has_undated(self) -> bool:
        return files.exists(self.spark, f"{self.path}/kind={UNDATED}")

    def related_dates(self, loads: Iterable[str]) -> list[dt.date]:
        """Days on which ids of these loads were delivered without a date, by any load."""
        if not self.has_undated():
            return []
        own = [p for load_id in loads for p in self._directories(load_id)]
        touched = {int(p.split("bucket=")[1].split("/")[0]) for p in own}
        undated = self._paths(UNDATED, touched)
        if not undated:
            return []
        ids = self._read([f"{self.path}/{p}" for p in own]).select("event_id")
        found = self._read(undated).join(ids, "event_id", "left_semi")
        return sorted(r.event_date for r in found.select("event_date").distinct().collect())

    def without_redelivered(self, events: DataFrame) -> DataFrame:
        """The events without undated copies that count elsewhere.

        One scan of three columns finds the undated ids; without any, nothing else is done. Only undated rows are
        then compared with what is known: the others, most of a history, stay where they are read.
        """
        if not self.has_undated():
            return events
        # Three queries below ask for these ids: they are found once.
        undated = stage(events.where(is_undated()).select("event_id", "event_date").distinct(), "undated")
        touched = [r.bucket for r in undated.select(self._bucket()).distinct().collect()]  # one number per bucket
        if not touched:
            return events
        known = [self._read(self._paths(k, touched)).withColumn("kind", F.lit(k)) for k in (DATED, UNDATED)]
        ids = undated.select("event_id").distinct()
        day = {k: F.min(F.when(F.col("kind") == k, F.col("event_date"))).alias(k) for k in (DATED, UNDATED)}
        home = known[0].unionByName(known[1]).join(ids, "event_id", "left_semi").groupBy("event_id").agg(*day.values())
        gone = undated.join(home, "event_id").where(f"{DATED} IS NOT NULL OR event_date > {UNDATED}")
        gone = stage(gone.select("event_id", "event_date"), "redelivered")
        kept = events.where(is_undated()).join(gone, ["event_id", "event_date"], "left_anti")
        return events.where(~is_undated()).unionByName(kept.select(*events.columns))
