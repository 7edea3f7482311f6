"""Stages of the lake: spark-submit run.py <stage> ..., or python -m daymark <stage> ..."""

from __future__ import annotations

import argparse
import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from daymark import filesystem as files
from daymark.operators import journeys
from daymark.plans import kpi, lake
from daymark.plans.audit import audit
from daymark.plans.customer_view import customer_view
from daymark.session import build_session, shuffles_for
from daymark.sinks import serving
from daymark.streaming.ingest import drain


class _Inputs:
    """Tables and arguments of a KPI, read or checked when asked for."""

    def __init__(self, spark: SparkSession, home: lake.Lake, args: argparse.Namespace) -> None:
        self.spark, self.home, self.args = spark, home, args

    @property
    def silver(self) -> DataFrame:
        return lake.read_silver(self.spark, self.home)

    @property
    def gold(self) -> DataFrame:
        return lake.read_gold(self.spark, self.home)

    def need(self, name: str):
        value = getattr(self.args, name)
        if value is None:
            raise SystemExit(f"kpi {self.args.name} needs --{name.replace('_', '-')}")
        return value

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.need(name))


KPIS: dict[str, Callable[[_Inputs], DataFrame]] = {
    "event_revenue_daily": lambda i: kpi.event_revenue_daily(i.silver),
    "order_revenue_daily": lambda i: kpi.order_revenue_daily(i.table("orders"), i.table("lineitem")),
    "retention": lambda i: kpi.retention(i.gold),
    "churn_proxy": lambda i: kpi.churn_proxy(i.gold, i.table("customers"), i.need("as_of")),
    "rfm_segments": lambda i: kpi.rfm_segments(i.table("orders")),
    "daily_summary": lambda i: kpi.daily_summary(i.silver),
    "checkout_carts": lambda i: journeys.checkout_carts(i.silver),
    "sessions": lambda i: journeys.sessions(i.silver),
    "conversion_daily": lambda i: journeys.conversion_daily(journeys.sessions(i.silver)),
    "customer_view": lambda i: customer_view(i.table("customers"), i.table("orders"), i.gold),
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="daymark", description=__doc__)
    stages = top.add_subparsers(dest="stage", required=True)

    def stage(name: str, text: str) -> argparse.ArgumentParser:
        sub = stages.add_parser(name, help=text)
        sub.add_argument("--lake", required=True, help="root folder of the tables")
        return sub

    day = dt.date.fromisoformat
    for name, text in (
        ("ingest", "load a landing folder into bronze in one batch"),
        ("import", "load a Parquet table of events made elsewhere into bronze"),
        ("drain", "stream what has landed into bronze, then refresh the touched dates"),
    ):
        sub = stage(name, text)
        if name == "import":
            sub.add_argument("--table", required=True, help="Parquet folder of the events")
        else:
            sub.add_argument("--landing", required=True, help="folder of envelope lines")
        sub.add_argument("--ingest-date", required=True, type=day, help="date of undated events")
        if name in ("ingest", "import"):
            sub.add_argument("--load-id", required=True, help="name of the load; repeating it replaces it")
        else:
            sub.add_argument("--checkpoint", required=True)
            sub.add_argument("--max-files", type=int, help="files per micro-batch")
            sub.add_argument(
                "--max-bytes", type=int, help="bytes per micro-batch; 1 TB without --max-files"
            )
            sub.add_argument("--archive", help="folder consumed files are moved to")

    sub = stage("kpi", "compute a KPI table and write it as Parquet")
    sub.add_argument("name", choices=sorted(KPIS))
    sub.add_argument("--out", required=True, help="folder the table is written to, replacing it")
    sub.add_argument("--as-of", type=day, help="day churn is judged on")
    for table in ("customers", "orders", "lineitem"):
        sub.add_argument(f"--{table}", help=f"Parquet folder of {table}, where the KPI needs it")

    stage("drift", "report on loads that break a rule more or less often than the loads before them")

    for name, text in (
        ("silver", "rebuild silver and quarantine from bronze"),
        ("gold", "rebuild daily user metrics from silver"),
        ("refresh", "rebuild silver and gold; without dates, those with new loads"),
        ("compact", "merge the small loads of each date in bronze"),
        ("publish", "replace dates in the serving table"),
        ("audit", "report on the raw events and check the tables; fails if a table is wrong"),
    ):
        sub = stage(name, text)
        sub.add_argument("--dates", nargs="+", type=day, help="dates to work on, YYYY-MM-DD")
        if name == "publish":
            target = sub.add_mutually_exclusive_group(required=True)
            target.add_argument("--target", help="folder of the Parquet serving table")
            target.add_argument("--jdbc-url", help="database of the serving table")
            sub.add_argument("--table", default="daily_user_metrics")
            sub.add_argument("--staging", default="daily_user_metrics_staging")
            sub.add_argument("--property", action="append", default=[], metavar="KEY=VALUE")
    return top


def run(spark: SparkSession, args: argparse.Namespace) -> list[dt.date]:
    """Run one stage; return the dates it touched."""
    home = lake.Lake(args.lake.rstrip("/"))
    match args.stage:
        case "ingest":
            return lake.ingest_batch(spark, args.landing, home, args.load_id, args.ingest_date)
        case "import":
            return lake.import_table(spark, args.table, home, args.load_id, args.ingest_date)
        case "drain":
            limits = {k: getattr(args, k) for k in ("max_files", "max_bytes", "archive")}
            if args.max_files is None and args.max_bytes is None:
                limits["max_bytes"] = 2**40
            return drain(spark, args.landing, home, args.checkpoint, args.ingest_date, **limits)
        case "silver":
            dates = args.dates or lake.table_dates(spark, home.bronze)
            lake.rebuild_silver(spark, home, dates)
            return dates
        case "gold":
            dates = args.dates or lake.table_dates(spark, home.silver)
            lake.rebuild_gold(spark, home, dates)
            return dates
        case "refresh":
            return lake.refresh(spark, home, args.dates)
        case "compact":
            return lake.compact(spark, home, args.dates)
        case "publish":
            gold = lake.read_gold(spark, home, args.dates)
            if args.target:
                with shuffles_for(spark, files.total_bytes(spark, home.gold)):
                    return serving.publish_parquet(gold, args.target, args.dates)
            properties = dict(p.split("=", 1) for p in args.property)
            return serving.publish_jdbc(
                gold, args.jdbc_url, args.table, args.staging, args.dates, properties
            )
        case "kpi":
            inputs = filter(None, (home.silver, args.orders, args.lineitem, args.customers))
            size = sum(files.total_bytes(spark, path) for path in inputs)
            with shuffles_for(spark, size):
                KPIS[args.name](_Inputs(spark, home, args)).write.mode("overwrite").parquet(args.out)
            return []
        case "drift":
            # A row per load and rule at most.
            found = lake.load_drift(spark, home).where("drifted").orderBy("recorded_at", "load_id", "rule").collect()
            for row in found:
                print(f"{row.load_id:40} {row.rule:35} {row.failing}/{row.total} before: {row.earlier_failing}/{row.earlier_total}")
            return []
        case "audit":
            # A few dozen rows, one per check.
            with shuffles_for(spark, files.total_bytes(spark, home.bronze)):
                report = audit(spark, home, args.dates).orderBy("scope", "check").collect()
            for row in report:
                print(f"{row.scope:6} {row.check:45} {row.failing}")
            wrong = [row.check for row in report if row.scope == "table" and row.failing]
            if wrong:
                raise SystemExit(f"Tables break these checks: {wrong}")
            return args.dates or lake.table_dates(spark, home.bronze)
    raise ValueError(args.stage)


def main() -> None:
    args = parser().parse_args()
    spark = build_session(f"daymark-{args.stage}")
    for date in run(spark, args):
        print(date.isoformat())


if __name__ == "__main__":
    main()
