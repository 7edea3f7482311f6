"""Where the rows of each bronze load are, and the merging of small loads.

A load is first a directory of its own within each date. Its manifest, a small file, lists these
places, so that replacing a load asks for its own directories only, however many dates
the lake has. `compact` merges the directories of many small loads of a date into a pack;
the rows keep the name of their load in `of_load`, and the manifests then name the pack.

Changes of packs are prepared beside the table and noted in a plan before anything is
moved; a plan found later is carried out to its end, however often it was begun.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections import defaultdict
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark import filesystem as files
from daymark.schemas import BRONZE_STORED

PACK = "pack-"
SMALL_BYTES = 2**27


class Loads:
    """Manifests and packs of the bronze table of a lake."""

    def __init__(self, spark: SparkSession, root: str, bronze: str) -> None:
        self.spark, self.bronze = spark, bronze
        self.manifests, self.changes = f"{root}/manifests", f"{root}/pack_changes"

    # --- manifests ---

    def places(self, load_id: str) -> dict[dt.date, str]:
        """Date -> directory that holds the load's rows of that date."""
        text = files.read_text(self.spark, f"{self.manifests}/{load_id}")
        lines = [line.split(" ") for line in (text or "").splitlines()]
        return {dt.date.fromisoformat(day): place for day, place in lines}

    def note(self, load_id: str, places: Mapping[dt.date, str]) -> None:
        text = "".join(f"{day.isoformat()} {place}\n" for day, place in sorted(places.items()))
        files.write_text(self.spark, f"{self.manifests}/{load_id}", text)

    def found(self, load_id: str) -> dict[dt.date, str]:
        """The places of a load whose manifest may be behind: also what the table's listing shows."""
        listed = files.matching(self.spark, f"{self.bronze}/event_date=*/load_id={load_id}")
        return {**self.places(load_id), **{_date(p): load_id for p in listed}}

    def adopt(self) -> None:
        """Write manifests for the loads of a lake made before there were any; done once."""
        done = f"{self.manifests}/_complete"
        if files.exists(self.spark, done):
            return
        places: dict[str, dict[dt.date, str]] = defaultdict(dict)
        for path in files.matching(self.spark, f"{self.bronze}/event_date=*/load_id=*"):
            load_id = path.rsplit("load_id=", 1)[-1]
            places[load_id][_date(path)] = load_id
        for load_id, own in places.items():
            self.note(load_id, own)
        files.touch(self.spark, done)

    # --- packs ---

    def withdraw(self, load_id: str, packed: Mapping[dt.date, str]) -> None:
        """Take a load's rows out of the packs that hold them."""
        by_pack: dict[str, list[dt.date]] = defaultdict(list)
        for day, pack in packed.items():
            by_pack[pack].append(day)
        for pack, days in by_pack.items():
            paths = [f"{self.bronze}/event_date={d.isoformat()}/load_id={pack}" for d in days]
            rows = self._rows(paths).drop("load_id")
            self._change(pack, rows.where(F.col("of_load") != load_id), {d: [pack] for d in days}, {})

    def compact(self, dates: Iterable[dt.date], closed: Iterable[str], small: int = SMALL_BYTES) -> list[dt.date]:
        """Merge the closed loads that are small on a date, where there are several; return those dates."""
        closed, merged = set(closed), {}
        for day in sorted(set(dates)):
            here = files.matching(self.spark, f"{self.bronze}/event_date={day.isoformat()}/load_id=*")
            own = [p for p in here if (name := p.rsplit("load_id=", 1)[-1]) in closed or name.startswith(PACK)]
            sizes = files.each(lambda p: files.total_bytes(self.spark, p), own)
            few = sorted(p.rsplit("load_id=", 1)[-1] for p, size in zip(own, sizes) if size < small)
            if len(few) > 1:
                merged[day] = few
        if not merged:
            return []
        paths = [f"{self.bronze}/event_date={d.isoformat()}/load_id={n}" for d, names in merged.items() for n in names]
        rows = self._rows(paths).withColumn("of_load", F.coalesce("of_load", "load_id")).drop("load_id")
        pack = f"{PACK}{uuid.uuid4().hex}"
        members: dict[str, list[str]] = defaultdict(list)
        for r in rows.select("of_load", "event_date").distinct().collect():  # a row per load and date
            members[r.of_load].append(r.event_date.isoformat())
        self._change(pack, rows, merged, members)
        return sorted(merged)

    def _rows(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(BRONZE_STORED).option("basePath", self.bronze).parquet(*paths)

    def _change(self, pack: str, rows: DataFrame, replaced: Mapping[dt.date, list[str]], members: Mapping[str, list[str]]) -> None:
        """Prepare the pack's new rows and the plan, then carry it out."""
        home = f"{self.changes}/{uuid.uuid4().hex}"
        rows.hint("rebalance", "event_date").write.partitionBy("event_date").parquet(f"{home}/data")
        filled = [_date(p).isoformat() for p in files.matching(self.spark, f"{home}/data/event_date=*")]
        plan = {
            "pack": pack,
            "filled": filled,
            "replaced": {d.isoformat(): names for d, names in replaced.items()},
            "members": members,
        }
        files.write_text(self.spark, f"{home}/plan.new", json.dumps(plan))
        files.rename(self.spark, f"{home}/plan.new", f"{home}/plan")
        self._carry_out(home)

    def _carry_out(self, home: str) -> None:
        plan = json.loads(files.read_text(self.spark, f"{home}/plan"))
        for day, names in plan["replaced"].items():
            new, target = f"{home}/data/event_date={day}", f"{self.bronze}/event_date={day}"
            ready = files.exists(self.spark, new)
            if ready or day not in plan["filled"]:
                files.each(lambda n: files.delete(self.spark, f"{target}/load_id={n}"), names)
            if ready:
                files.rename(self.spark, new, f"{target}/load_id={plan['pack']}")
        for load_id, days in plan["members"].items():
            self.note(load_id, {**self.places(load_id), **{dt.date.fromisoformat(d): plan["pack"] for d in days}})
        files.delete(self.spark, home)

    def recover(self) -> None:
        """Carry out plans that were left, and drop preparations without one."""
        for home in files.matching(self.spark, f"{self.changes}/*"):
            if files.exists(self.spark, f"{home}/plan"):
                self._carry_out(home)
            else:
                files.delete(self.spark, home)


def _date(path: str) -> dt.date:
    return dt.date.fromisoformat(path.rsplit("event_date=", 1)[-1][:10])
