"""Publishing gold to a serving table, whole dates at a time."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daymark.operators.contracts import require_columns, require_sound
from daymark.schemas import GOLD, GOLD_KEY
from daymark.session import use_utc
from daymark.sinks.tables import replace_partitions

_TABLE_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?")


def serving_projection(gold: DataFrame) -> DataFrame:
    """The contract's columns in the contract's order; extra ones are dropped."""
    return require_columns(gold, GOLD).select(*GOLD.fieldNames())


def affected_dates(gold: DataFrame) -> DataFrame:
    """The dates a publish of `gold` replaces."""
    return gold.select("event_date").distinct()


def _dates(gold: DataFrame) -> list[dt.date]:
    # At most one row per calendar day.
    return sorted(r.event_date for r in affected_dates(gold).collect())


def _of_dates(rows: DataFrame, dates: Iterable[dt.date] | None) -> tuple[DataFrame, list[dt.date]]:
    """The rows of these dates, and the dates in order; None: all there are."""
    if dates is None:
        return rows, _dates(rows)
    dates = sorted(set(dates))
    return rows.where(F.col("event_date").isin(dates)), dates


def publish_parquet(
    gold: DataFrame, target: str, dates: Iterable[dt.date] | None = None
) -> list[dt.date]:
    """Replace the dates of `gold` in a Parquet serving table; return those dates.

    `dates` names what to replace: rows of other dates stay out, and a date without
    rows is removed from the target. Without it, the dates that have rows are replaced. A frame that
    breaks the table's constraints is refused before anything is written.
    """
    rows, dates = _of_dates(serving_projection(gold), dates)
    require_sound(rows)
    if dates:
        replace_partitions(
            rows, target, ("event_date",), [f"event_date={d.isoformat()}" for d in dates]
        )
    return dates


_SQL_TYPES = {
    T.DateType(): "date",
    T.LongType(): "bigint",
    T.DoubleType(): "double precision",
    T.TimestampNTZType(): "timestamp with time zone",
}


def create_statement(table: str) -> str:
    """SQL that creates the serving table where it does not exist."""
    columns = [
        f"{f.name} {_SQL_TYPES[f.dataType]}{'' if f.nullable else ' NOT NULL'}" for f in GOLD.fields
    ]
    key = f"PRIMARY KEY ({', '.join(GOLD_KEY)})"
    return f"CREATE TABLE IF NOT EXISTS {table} ({', '.join([*columns, key])})"


def replace_statements(table: str, staging: str, dates: Iterable[dt.date]) -> list[str]:
    """SQL that replaces `dates` in `table` by the staged rows, to run in one transaction.

    DISTINCT because a task that is run again after its executor was lost may
    have staged its rows twice.
    """
    for name in (table, staging):
        if not _TABLE_NAME.fullmatch(name):
            raise ValueError(f"Not a plain table name: {name!r}")
    columns = ", ".join(GOLD.fieldNames())
    days = ", ".join(f"DATE '{d.isoformat()}'" for d in dates)
    return [
        create_statement(table),
        f"DELETE FROM {table} WHERE event_date IN ({days})",
        f"INSERT INTO {table} ({columns}) SELECT DISTINCT {columns} FROM {staging}",
    ]


def run_in_transaction(connection, statements: Iterable[str]) -> None:
    """Run statements on a JDBC connection: all of them, or none."""
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for sql in statements:
            statement.executeUpdate(sql)
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()


def publish_jdbc(
    gold: DataFrame,
    url: str,
    table: str,
    staging: str,
    dates: Iterable[dt.date] | None = None,
    properties: dict[str, str] | None = None,
    connections: int = 8,
) -> list[dt.date]:
    """Replace whole dates in a relational table; return those dates.

    Executors write the rows to `staging` in parallel; the swap is one
    transaction in the database, so readers see the old or the new rows, and a
    key violation leaves the old ones. Only the statements pass through the
    driver. `dates` is as in `publish_parquet`. UTC wall-clock times go out as
    instants.
    """
    use_utc(gold.sparkSession)
    rows, dates = _of_dates(serving_projection(gold), dates)
    if not dates:
        return []
    statements = replace_statements(table, staging, dates)
    properties = dict(properties or {})
    instants = {c: rows[c].cast("timestamp") for c in ("first_event_ts", "last_event_ts")}
    rows.withColumns(instants).repartition(connections).write.jdbc(
        url, staging, mode="overwrite", properties=properties
    )
    run_in_transaction(_connect(gold.sparkSession, url, properties), statements)
    return dates


def _connect(spark: SparkSession, url: str, properties: dict[str, str]):
    jvm = spark._jvm
    settings = jvm.java.util.Properties()
    for key, value in properties.items():
        settings.setProperty(key, value)
    if "driver" in properties:
        jvm.java.lang.Class.forName(properties["driver"])
    return jvm.java.sql.DriverManager.getConnection(url, settings)
