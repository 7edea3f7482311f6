"""Micro-batch ingest of the landing directory."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from daymark.plans.lake import Lake, refresh, write_load
from daymark.session import use_utc
from daymark.sources.landing import read_landing_stream, unwrap


def start_ingest(
    spark: SparkSession,
    landing: str,
    lake: Lake,
    checkpoint: str,
    ingest_date: dt.date | str,
    max_files: int | None = None,
    max_bytes: int | None = None,
    archive: str | None = None,
    every: str | None = None,
) -> StreamingQuery:
    """Load everything now in the landing directory into bronze, then stop.

    With `every`, such as "5 minutes", keep looking for more at that interval
    until stopped; `plans.lake.refresh` can run beside it at its own pace.

    Each micro-batch is one bronze load named after the checkpoint's own id and
    the batch number. A batch that is repeated after a crash replaces itself,
    and a new checkpoint can never overwrite the loads of an old one. A message
    file counts as consumed only once its batch is committed.
    """
    use_utc(spark)

    def load(lines: DataFrame, batch_id: int) -> None:
        # The batch's own session: a copy of ours.
        session = use_utc(lines.sparkSession)
        query_id = (
            session.read.text(f"{checkpoint}/metadata")
            .select(F.get_json_object("value", "$.id"))
            .first()[0]
        )
        write_load(unwrap(lines, ingest_date), lake, f"{query_id}-{batch_id:09d}")

    return (
        read_landing_stream(spark, landing, max_files, max_bytes, archive)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(**({"processingTime": every} if every else {"availableNow": True}))
        .start()
    )


def drain(
    spark: SparkSession, landing: str, lake: Lake, checkpoint: str, ingest_date: dt.date | str, **limits
) -> list[dt.date]:
    """Ingest what has landed, then rebuild each touched date once.

    However many micro-batches the drain takes, a date is rebuilt once per
    drain, not once per batch. Returns the rebuilt dates.
    """
    start_ingest(spark, landing, lake, checkpoint, ingest_date, **limits).awaitTermination()
    return refresh(spark, lake)
