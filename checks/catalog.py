"""The registered queries, each over whole tables.

Rounding is for the comparison only: double sums depend on the order of rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace
from statistics import median

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.raw_events import (
    INGEST_DATE,
    conflicting_copies,
    dated_events,
    envelope_lines,
    make_old,
    table,
    undated_copies,
    unsound_gold,
)
from daymark import filesystem as files
from daymark.operators import contracts, quality, screening
from daymark.operators.daily_metrics import daily_user_metrics
from daymark.operators.dedup import dedup_events
from daymark.operators.journeys import checkout_carts, conversion_daily, sessions
from daymark.plans import kpi, lake
from daymark.plans.customer_view import customer_view
from daymark.schemas import EVENT_COLUMNS, GOLD
from daymark.session import scratch_path, use_utc
from daymark.sinks import serving
from daymark.sources.landing import unwrap
from daymark.streaming.dedup import dedup_stream
from daymark.streaming.ingest import drain, start_ingest


def _rounded(df: DataFrame, digits: int = 2, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _numbers(df: DataFrame) -> DataFrame:
    """Text columns of the event as the numbers they hold."""
    return df.withColumns(
        {"product_id": F.col("product_id").cast("bigint"), "amount": F.col("amount").cast("double")}
    )


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return screening.clean(dedup_events(dated_events(spark, sf_dir)))


def _gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return daily_user_metrics(_silver(spark, sf_dir))


def _rounded_gold(gold: DataFrame) -> DataFrame:
    return _rounded(gold, 2, "total_amount")


def _both_golds(check: Callable[[DataFrame], DataFrame], sound: DataFrame) -> DataFrame:
    """What a check says of gold, and of an unsound table made from it."""
    parts = (("sound", sound), ("unsound", unsound_gold(sound)))
    first, second = (check(gold).withColumn("gold_table", F.lit(name)) for name, gold in parts)
    return first.unionByName(second)


# --- bronze -----------------------------------------------------------------


def envelope_parse(spark, sf_dir):
    """Every line opened, those that could not be with the fault."""
    opened = unwrap(envelope_lines(spark, sf_dir), INGEST_DATE)
    return _numbers(opened.select(*EVENT_COLUMNS, "ingest_fault", "event_date"))


def ingest_quarantine(spark, sf_dir):
    """Loads the landing files in one batch and counts what bronze keeps unopened."""
    home = lake.Lake(scratch_path(spark, "lake"))
    lake.ingest_batch(spark, _landing(spark, sf_dir), home, "one", INGEST_DATE)
    return (
        lake.read_bronze(spark, home)
        .filter("ingest_fault IS NOT NULL")
        .groupBy("ingest_fault")
        .agg(F.count("envelope").alias("lines"))
    )


def event_date_derive(spark, sf_dir):
    return dated_events(spark, sf_dir).select("event_id", "event_timestamp", "event_date")


def _landing(spark: SparkSession, sf_dir: str) -> str:
    """Landing files, as many as the cluster has cores."""
    path = scratch_path(spark, "landing")
    envelope_lines(spark, sf_dir).repartition(_cores(spark)).write.text(path)
    return path


def _cores(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


def _some_files(spark: SparkSession) -> int:
    """Files per micro-batch, so that the landing files take about three."""
    return -(-_cores(spark) // 3)


def bronze_ingest(spark, sf_dir):
    """Streams the landing files into bronze in several micro-batches and reads bronze."""
    home, landing = lake.Lake(scratch_path(spark, "lake")), _landing(spark, sf_dir)
    checkpoint, limit = scratch_path(spark, "checkpoint"), _some_files(spark)
    start_ingest(spark, landing, home, checkpoint, INGEST_DATE, max_files=limit).awaitTermination()
    return (
        lake.read_bronze(spark, home)
        .groupBy("event_date")
        .agg(F.count("*").alias("messages"), F.count("ingest_fault").alias("faulty"))
    )


def bronze_backfill(spark, sf_dir):
    """Streams half of the lines into bronze, then files with the other half, a year older."""
    home, landing = lake.Lake(scratch_path(spark, "lake")), scratch_path(spark, "landing")
    checkpoint, limit = scratch_path(spark, "checkpoint"), _some_files(spark)
    half = F.pmod(F.xxhash64("value"), F.lit(2))
    for part, name in enumerate(("first", "backfill")):
        lines = envelope_lines(spark, sf_dir).where(half == part)
        lines.repartition(_cores(spark)).write.text(f"{landing}/{name}")
        if name == "backfill":
            make_old(spark, f"{landing}/{name}", 400)
        start_ingest(spark, landing, home, checkpoint, INGEST_DATE, max_files=limit).awaitTermination()
    return (
        lake.read_bronze(spark, home)
        .groupBy("event_date")
        .agg(F.count("*").alias("messages"), F.count("ingest_fault").alias("faulty"))
    )


# --- silver -----------------------------------------------------------------


def dedup(spark, sf_dir):
    return _numbers(dedup_events(dated_events(spark, sf_dir)))


def _redelivered(spark, sf_dir):
    return dated_events(spark, sf_dir).unionByName(conflicting_copies(spark, sf_dir))


def dedup_conflicts(spark, sf_dir):
    """Copies that differ: one of each id and date is left."""
    return _numbers(dedup_events(_redelivered(spark, sf_dir)))


def dedup_history(spark, sf_dir):
    """Copies that differ, on any date: one of each id is left."""
    return _numbers(dedup_events(_redelivered(spark, sf_dir), identity=("event_id",)))


def silver_types(spark, sf_dir):
    typed = screening.enforce_types(dedup_events(dated_events(spark, sf_dir)))
    return typed.select(
        "event_id",
        F.col("typed_user_id").alias("user_id"),
        F.col("typed_product_id").alias("product_id"),
        F.col("typed_amount").alias("amount"),
        "event_timestamp_ts",
        "event_date",
    )


def silver_enrich(spark, sf_dir):
    return _silver(spark, sf_dir).select(
        "event_id", "is_purchase_event", "is_error_event", "event_hour", "event_day_of_week"
    )


def _quarantine(spark, sf_dir):
    return screening.quarantine(dedup_events(dated_events(spark, sf_dir)))


def silver_quarantine(spark, sf_dir):
    return _numbers(_quarantine(spark, sf_dir).drop("envelope"))


def quarantine_summary(spark, sf_dir):
    return screening.quarantine_summary(_quarantine(spark, sf_dir))


def _loaded_lake(spark: SparkSession, sf_dir: str) -> lake.Lake:
    """A lake with the raw events in bronze."""
    home = lake.Lake(scratch_path(spark, "lake"))
    none = F.lit(None).cast("string")
    events = dated_events(spark, sf_dir).withColumns({"ingest_fault": none, "envelope": none})
    lake.write_load(events, home, "one")
    return home


def silver_rebuild(spark, sf_dir):
    """Loads the same events again under another name; silver must not notice."""
    home = _loaded_lake(spark, sf_dir)
    lake.write_load(lake.read_bronze(spark, home).drop("load_id"), home, "again")
    lake.rebuild_silver(spark, home, lake.table_dates(spark, home.bronze))
    return lake.read_silver(spark, home)


def silver_large_dates(spark, sf_dir):
    """Silver of a lake in which half of the dates count as large and have a shuffle of their own."""
    home = _loaded_lake(spark, sf_dir)
    dates = lake.table_dates(spark, home.bronze)
    sizes = [files.total_bytes(spark, f"{home.bronze}/event_date={d.isoformat()}") for d in dates]
    home = replace(home, large_date_bytes=int(median(sizes)))
    lake.rebuild_silver(spark, home, dates)
    return lake.read_silver(spark, home)


def silver_scan(spark, sf_dir):
    """Reads the stored silver table through its contract."""
    home = _loaded_lake(spark, sf_dir)
    lake.rebuild_silver(spark, home, lake.table_dates(spark, home.bronze))
    return lake.read_silver(spark, home)


def _load(spark: SparkSession, home: lake.Lake, events: DataFrame, load_id: str) -> None:
    none = F.lit(None).cast("string")
    lake.write_load(events.withColumns({"ingest_fault": none, "envelope": none}), home, load_id)


def undated_redelivery(spark, sf_dir):
    """Copies without a date before the events themselves and after them: each event is in the tables once."""
    home = lake.Lake(scratch_path(spark, "lake"))
    events, copies = dated_events(spark, sf_dir), undated_copies(spark, sf_dir)
    loads = {
        "early": copies.where("CAST(event_id AS BIGINT) % 3 = 0").withColumn("event_date", F.lit("2024-02-03").cast("date")),
        "events": events,
        "late": copies.where("CAST(event_id AS BIGINT) % 3 = 1").withColumn("event_date", F.lit("2024-01-31").cast("date")),
    }
    for load_id, rows in loads.items():
        _load(spark, home, rows, load_id)
        lake.refresh(spark, home)
    accepted = lake.read_silver(spark, home).select("event_id", "event_date", F.lit(True).alias("accepted"))
    rejected = lake.read_quarantine(spark, home).select("event_id", "event_date", F.lit(False).alias("accepted"))
    return accepted.unionByName(rejected)


def bronze_compacted(spark, sf_dir):
    """Three loads merged into packs, one of them written again with fewer rows, and merged once more."""
    home, events = lake.Lake(scratch_path(spark, "lake")), dated_events(spark, sf_dir)
    part = F.col("event_id").cast("bigint") % 3
    for k in range(3):
        _load(spark, home, events.where(part == k), f"part-{k}")
    lake.compact(spark, home)
    _load(spark, home, events.where((part == 1) & (F.col("event_id").cast("bigint") % 2 == 0)), "part-1")
    lake.compact(spark, home)
    return lake.read_bronze(spark, home).groupBy("event_date", "load_id").agg(F.count("*").alias("messages"))


def load_drift(spark, sf_dir):
    """Four loads, the third with a fault of its own, each judged beside the loads before it."""
    home, events = lake.Lake(scratch_path(spark, "lake")), dated_events(spark, sf_dir)
    n = F.col("event_id").cast("bigint")
    damaged = events.withColumn("page", F.when(n % 12 == 2, "/admin").otherwise(F.col("page")))
    for k in range(4):
        _load(spark, home, damaged.where(n % 4 == k), f"part-{k}")
    return lake.load_drift(spark, home).drop("recorded_at")


# --- gold and serving -------------------------------------------------------


def gold_rebuild(spark, sf_dir):
    """Builds gold from the stored silver of all pending dates."""
    home = _loaded_lake(spark, sf_dir)
    lake.refresh(spark, home)
    return _rounded_gold(lake.read_gold(spark, home))


def reconciliation(spark, sf_dir):
    """Counts of the stored tables against each other, and with a gold that was appended twice."""
    home = _loaded_lake(spark, sf_dir)
    lake.refresh(spark, home)
    stored = [r(spark, home) for r in (lake.read_bronze, lake.read_silver, lake.read_quarantine)]
    gold = lake.read_gold(spark, home)
    once = contracts.reconciliation(*stored, gold).withColumn("gold_table", F.lit("sound"))
    twice = contracts.reconciliation(*stored, gold.unionByName(gold))
    return once.unionByName(twice.withColumn("gold_table", F.lit("appended twice")))


def projected(spark, sf_dir):
    """Gold with its columns turned round and others between them, as the serving table wants it."""
    gold = _gold(spark, sf_dir)
    turned = gold.select(F.lit("batch 1").alias("loaded_by"), *reversed(gold.columns), F.rand(1).alias("noise"))
    return _rounded_gold(serving.serving_projection(turned))


def publish_replace(spark, sf_dir):
    """Publishes gold, then a corrected gold for some of its dates; the other dates stay."""
    home = _loaded_lake(spark, sf_dir)
    lake.refresh(spark, home)
    target = f"{home.root}/serving/daily_user_metrics"
    gold = lake.read_gold(spark, home)
    serving.publish_parquet(gold, target)
    corrected = gold.withColumn("events_count", F.col("events_count") + 1000)
    dates = [d for d in lake.table_dates(spark, home.gold) if d.day <= 15]
    serving.publish_parquet(corrected, target, dates)
    return _rounded_gold(lake.read_table(spark, target, GOLD))


# --- streaming --------------------------------------------------------------


def stream_equals_batch(spark, sf_dir):
    """Gold by way of the stream, checked against the same SQL as the batch gold."""
    home = lake.Lake(scratch_path(spark, "lake"))
    landing = _landing(spark, sf_dir)
    checkpoint, limit = scratch_path(spark, "checkpoint"), _some_files(spark)
    drain(spark, landing, home, checkpoint, INGEST_DATE, max_files=limit)
    return _rounded_gold(lake.read_gold(spark, home))


def stream_dedup(spark, sf_dir):
    """Copies dropped within the stream, thinned out by landing file first."""
    landing, out = scratch_path(spark, "landing"), scratch_path(spark, "stream")
    events = dated_events(spark, sf_dir)
    events.repartition(_cores(spark)).write.parquet(landing)
    landed = (
        spark.readStream.schema(events.schema)
        .option("maxFilesPerTrigger", _some_files(spark))
        .parquet(landing)
        .select("*", "_metadata.file_name")
    )
    query = (
        dedup_stream(landed, "2 days", "file_name")
        .drop("file_name")
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", scratch_path(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return _numbers(spark.read.parquet(out).select(*EVENT_COLUMNS, "event_date"))


# --- KPIs -------------------------------------------------------------------


def order_revenue(spark, sf_dir):
    daily = kpi.order_revenue_daily(table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem"))
    return _rounded(_rounded(daily, 2, "gross_revenue"), 4, "net_revenue")


def active_users(spark, sf_dir):
    """Users of the last 7 and 28 days from stored daily sketches, beside the exact numbers."""
    silver, stored = _silver(spark, sf_dir), scratch_path(spark, "sketches")
    kpi.user_sketches(silver).write.parquet(stored)
    merged = kpi.active_users(spark.read.parquet(stored)).withColumnRenamed("active_users", "estimate")
    ends = silver.select(F.col("event_date").alias("as_of")).distinct()
    seen = silver.select("event_date", "user_id").distinct().withColumn("days", F.explode(F.array(F.lit(7), F.lit(28))))
    seen = seen.withColumn("as_of", F.explode(F.sequence("event_date", F.date_add("event_date", F.col("days") - 1))))
    exact = seen.join(ends, "as_of", "left_semi").groupBy("as_of", "days").agg(F.countDistinct("user_id").alias("active_users"))
    close = F.abs(F.col("estimate") - F.col("active_users")) <= 0.05 * F.col("active_users")
    return exact.join(merged, ["as_of", "days"]).select("as_of", "days", "active_users", close.alias("within_5_percent"))


def quintile_cuts(spark, sf_dir):
    """How far the rank of each cut from a sketch is from the share it stands for, over all customers."""
    measures, error = kpi.rfm_measures(table(spark, sf_dir, "orders")), 0.001
    shares = [0.2, 0.4, 0.6, 0.8]
    cut = F.posexplode(F.arrays_zip("cuts", F.array(*[F.lit(s) for s in shares]).alias("share")))
    cuts = kpi.quantile_cuts(measures, shares, error).select("measure", cut.alias("place", "at"))
    ranked = measures.join(cuts, "measure").groupBy("measure", F.col("at.share").alias("share")).agg(
        F.count("*").alias("customers"),
        F.count(F.when(F.col("value") < F.col("at.cuts"), 1)).alias("below"),
        F.count(F.when(F.col("value") <= F.col("at.cuts"), 1)).alias("up_to"),
    )
    # A rank is a whole number, so it may be one off beside the error.
    slack = error * F.col("customers") + 1
    wanted = F.col("share") * F.col("customers")
    close = (F.col("below") <= wanted + slack) & (F.col("up_to") >= wanted - slack)
    return ranked.select("measure", "share", "customers", close.alias("within_bound"))


# The generated events of a user are days apart, not minutes.
PAUSE = dt.timedelta(days=2)


def full_customer_view(spark, sf_dir):
    view = customer_view(
        table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders"), _gold(spark, sf_dir)
    )
    return _rounded(view, 2, "orders_total", "activity_amount")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "envelope_parse": envelope_parse,
    "ingest_quarantine": ingest_quarantine,
    "event_date_derive": event_date_derive,
    "bronze_ingest": bronze_ingest,
    "bronze_backfill": bronze_backfill,
    "dedup_events": dedup,
    "dedup_conflicts": dedup_conflicts,
    "dedup_history": dedup_history,
    "silver_types": silver_types,
    "silver_clean": _silver,
    "silver_enrich": silver_enrich,
    "silver_quarantine": silver_quarantine,
    "quarantine_summary": quarantine_summary,
    "silver_rebuild": silver_rebuild,
    "undated_redelivery": undated_redelivery,
    "bronze_compacted": bronze_compacted,
    "load_drift": load_drift,
    "silver_scan": silver_scan,
    "silver_large_dates": silver_large_dates,
    "gold_daily_user_metrics": lambda s, d: _rounded_gold(_gold(s, d)),
    "gold_rebuild": gold_rebuild,
    "gold_invariants": lambda s, d: _both_golds(contracts.metric_invariants, _gold(s, d)),
    "dq_reconciliation": reconciliation,
    "schema_contract": lambda s, d: contracts.column_profile(_gold(s, d), GOLD),
    "serving_projection": projected,
    "affected_dates": lambda s, d: serving.affected_dates(_gold(s, d)),
    "publish_replace": publish_replace,
    "dq_not_null": lambda s, d: _both_golds(contracts.null_violations, _gold(s, d)),
    "dq_unique_key": lambda s, d: _both_golds(contracts.key_summary, _gold(s, d)),
    "dq_duplicate_events": lambda s, d: contracts.duplicate_keys(
        dated_events(s, d), ("event_id", "event_date")
    ),
    "dq_report": lambda s, d: quality.dq_report(dated_events(s, d)),
    "stream_equals_batch": stream_equals_batch,
    "stream_dedup": stream_dedup,
    "kpi_event_revenue_daily": lambda s, d: _rounded(
        kpi.event_revenue_daily(_silver(s, d)), 2, "revenue"
    ),
    "kpi_order_revenue_daily": order_revenue,
    "kpi_retention": lambda s, d: kpi.retention(_gold(s, d)),
    "kpi_churn_proxy": lambda s, d: kpi.churn_proxy(_gold(s, d), table(s, d, "customer"), "2024-01-20"),
    "kpi_rfm_segments": lambda s, d: kpi.rfm_segments(table(s, d, "orders")),
    "kpi_daily_summary": lambda s, d: _rounded(kpi.daily_summary(_silver(s, d)), 2, "revenue"),
    "kpi_active_users": active_users,
    "kpi_quintile_cuts": quintile_cuts,
    "kpi_totals_by_grain": lambda s, d: _rounded(kpi.totals_by_grain(_silver(s, d)), 2, "revenue"),
    "kpi_checkout_carts": lambda s, d: checkout_carts(_silver(s, d), PAUSE),
    "kpi_sessions": lambda s, d: _rounded(sessions(_silver(s, d), PAUSE), 2, "revenue"),
    "kpi_conversion_daily": lambda s, d: _rounded(conversion_daily(sessions(_silver(s, d), PAUSE)), 2, "revenue"),
    "customer_360": full_customer_view,
}


def prepared(query: Callable[[SparkSession, str], DataFrame]):
    """The query with the session zone pinned first, whoever made the session."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(use_utc(spark), sf_dir)

    return run
