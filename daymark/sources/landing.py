"""Landing directory of message envelopes: one JSON object per line."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.functions.events import event_date, stated_date
from daymark.schemas import EVENT_COLUMNS, EVENT_TEXT

_END = "_end"
_ENVELOPE = T.StructType().add("Message", "string").add("Timestamp", "string")
# By default a stream passes over files a week older than the newest, which is what a
# backfill that keeps file times brings. The list of files seen grows instead; `archive`
# keeps the directory itself short.
_ANY_AGE = "36500d"


def _only_object(text: Column, kind: T.StructType, end: str) -> Column:
    """The one JSON object a text holds; null for anything else.

    `from_json` stops at the end of the first value and leaves what follows without a
    trace. So the text is read as the first element of an array whose second carries
    `end`: only if that is reached as the second element was the text one value to its last
    character. `end` must be a word that no sender can know.
    """
    marked = T.StructType([*kind.fields, T.StructField(_END, T.StringType())])
    parsed = F.from_json(F.concat(F.lit("["), text, F.lit(f',{{"{_END}":"{end}"}}]')), T.ArrayType(marked))
    is_whole = (F.size(parsed) == 2) & (F.get(parsed, F.lit(1))[_END] == end)
    return F.when(is_whole, F.get(parsed, F.lit(0)))


# Without it, files in folders below the directory would be passed over in silence.
_BELOW = "recursiveFileLookup"


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """Envelope lines of a directory and those below it, as one `value` column."""
    return spark.read.option(_BELOW, True).text(path)


def read_landing_stream(
    spark: SparkSession,
    path: str,
    max_files: int | None = None,
    max_bytes: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """Envelope lines as a stream, bounded per micro-batch by files or bytes.

    With `archive`, consumed files move there, but only after the batch that
    read them is committed; this also keeps the directory listing short.
    """
    reader = spark.readStream.format("text").option(_BELOW, True).option("maxFileAge", _ANY_AGE)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    if archive is not None:
        if f"{archive.rstrip('/')}/".startswith(f"{path.rstrip('/')}/"):
            raise ValueError("The archive must lie outside the landing directory, or it is read again")
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(path)


def unwrap(lines: DataFrame, ingest_date: dt.date | str) -> DataFrame:
    """Open the two JSON levels; no line is lost and none fails the job.

    A line that cannot be opened keeps its text in `envelope` and names the
    trouble in `ingest_fault`. The date is the one stated in the event; without
    it the envelope's publish time counts, which a redelivery repeats, and then
    `ingest_date`. The wall clock is never read.
    """
    end = uuid.uuid4().hex
    opened = lines.select("value", _only_object(F.col("value"), _ENVELOPE, end).alias("outer"))
    opened = opened.select(
        "value",
        F.col("outer.Message").alias("message"),
        F.col("outer.Timestamp").alias("published"),
        F.col("outer").isNull().alias("bad_outer"),
        _only_object(F.col("outer.Message"), EVENT_TEXT, end).alias("event"),
    )
    fault = (
        F.when(F.col("bad_outer"), "bad_envelope")
        .when(F.coalesce(F.col("message"), F.lit("")) == "", "empty_message")
        .when(F.col("event").isNull(), "bad_message")
    )
    # An empty timestamp counts as absent. Bare NaN and out-of-range numbers
    # come back from the JSON reader as quoted words.
    made = {
        "event_timestamp": F.nullif(F.col("event.event_timestamp"), F.lit("")),
        "amount": F.btrim(F.col("event.amount"), F.lit('"')),
    }
    return opened.select(
        *[made.get(name, F.col(f"event.{name}")).alias(name) for name in EVENT_COLUMNS],
        fault.alias("ingest_fault"),
        F.when(fault.isNotNull(), F.col("value")).alias("envelope"),
        event_date(made["event_timestamp"], stated_date(F.col("published")), ingest_date).alias(
            "event_date"
        ),
    )
