"""Shapes the `events` test table into raw application events with known dirt.

A test device, kept apart from the library. Every row of the table is used; the
remainders below only decide which kind of dirt a row gets (see FIXTURES.md).
`oracle.RAW_SQL` states the same rules in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.functions.events import event_date
from daymark.schemas import ERROR_CODES, EVENT_COLUMNS, PAGES

INGEST_DATE = "2024-02-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(index, values):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw events as text columns, with one in 25 delivered twice."""
    n, kind = F.col("event_id"), F.col("event_type")
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    known = k % 20 != 19
    has_item = known & kind.isin("click", "purchase")
    columns = {
        "event_id": n.cast("string"),
        "user_id": F.when(n % 100 == 99, "abc").when(n % 100 != 49, F.col("user_id").cast("string")),
        "event_type": F.when(~known, "unknown")
        .when(kind == "view", "page_view")
        .when(kind == "signup", "login")
        .when(kind == "click", "add_to_cart")
        .when(kind == "purchase", "checkout")
        .when(kind == "error", "error"),
        "event_timestamp": F.when(n % 40 == 17, "not-a-time")
        .when(n % 40 == 7, F.concat(iso, F.lit("-05:00")))
        .when(n % 40 != 39, F.concat(iso, F.lit("+00:00"))),
        "page": _pick(k % 7, [*PAGES, "/admin"]),
        "product_id": F.when(has_item, (1000 + k).cast("string")),
        "amount": F.when(has_item, F.col("value").cast("string")),
        "error_code": F.when(known & (kind == "error"), _pick(k % 3, ERROR_CODES)),
        "source": F.lit("web_app"),
    }
    copies = F.when(n % 25 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    once = table(spark, sf_dir, "events").select(
        *[columns[name].alias(name) for name in EVENT_COLUMNS], copies.alias("copies")
    )
    return once.select(*EVENT_COLUMNS, F.explode("copies").alias("_copy")).drop("_copy")


def dated_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_events(spark, sf_dir).withColumn(
        "event_date", event_date(F.col("event_timestamp"), INGEST_DATE)
    )


def conflicting_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events delivered again with another page, without a timestamp, or a day later."""
    n = F.col("event_id").cast("bigint") % 30
    return (
        dated_events(spark, sf_dir)
        .where(n.isin(7, 13, 19))
        .withColumns(
            {
                "page": F.when(n == 7, "/support").otherwise(F.col("page")),
                "event_timestamp": F.when(n != 13, F.col("event_timestamp")),
                "event_date": F.when(n == 19, F.date_add("event_date", 1)).otherwise(F.col("event_date")),
            }
        )
    )


def undated_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event delivered again without the date it stated."""
    kept = F.col("event_id").cast("bigint") % 40 == 17
    return raw_events(spark, sf_dir).withColumn("event_timestamp", F.when(kept, F.col("event_timestamp")))


def unsound_gold(gold: DataFrame) -> DataFrame:
    """Gold with some rows appended twice and some appended with broken values."""
    user = F.col("user_id")
    damage = {
        "events_count": F.when(user % 14 == 10, 0).otherwise(F.col("events_count") + 1),
        "purchase_events": F.col("purchase_events") + 1,
        "error_events": F.when(user % 3 == 0, F.col("error_events") + 1),
        "first_event_ts": F.when(user % 2 == 0, F.col("last_event_ts") + F.expr("INTERVAL 1 HOUR")),
        "user_id": F.when(user % 14 != 3, user),
    }
    again, broken = gold.where(user % 7 == 5), gold.where(user % 7 == 3)
    return gold.unionByName(again).unionByName(broken.withColumns(damage))


def envelope_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every raw event as an envelope line, and a broken line beside some of them."""
    raw = raw_events(spark, sf_dir)
    body = F.struct(
        "event_id",
        F.col("user_id"),
        "event_type",
        "event_timestamp",
        "page",
        F.col("product_id").cast("int").alias("product_id"),
        F.col("amount").cast("double").alias("amount"),
        "error_code",
        "source",
    )
    message = F.to_json(body, {"ignoreNullFields": "false"})
    envelope = F.to_json(F.struct(F.lit("Notification").alias("Type"), message.alias("Message")))
    empty = F.lit('{"Type":"Notification","Message":""}')
    half_message = F.substring(message, 1, 20)
    kind = F.col("event_id").cast("bigint") % 97
    two_messages = F.to_json(F.struct(F.concat(message, F.lit("], ["), message).alias("Message")))
    variants = F.when(kind.isin(5, 11, 17, 23, 29), F.array(F.lit(True), F.lit(False))).otherwise(
        F.array(F.lit(True))
    )
    line = (
        F.when(F.col("is_whole"), envelope)
        .when(kind == 5, F.substring(envelope, 1, 40))
        .when(kind == 11, empty)
        .when(kind == 23, two_messages)
        .when(kind == 29, F.concat(envelope, F.lit("], ["), envelope))
        .otherwise(F.to_json(F.struct(half_message.alias("Message"))))
    )
    return raw.select("*", F.explode(variants).alias("is_whole")).select(line.alias("value"))


def make_old(spark: SparkSession, directory: str, days: int) -> None:
    """Sets the files' modification times back, as a copy that keeps old times does."""
    root = spark._jvm.org.apache.hadoop.fs.Path(directory)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in fs.listStatus(root):
        fs.setTimes(status.getPath(), status.getModificationTime() - days * 86_400_000, -1)
