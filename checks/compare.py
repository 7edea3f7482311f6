"""Runs every registered query beside its SQL: python -m checks.compare [sf_dir] [name ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

from checks.catalog import QUERIES, prepared
from checks.oracle import SQL


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(columns: list[str], rows) -> list[tuple]:
    """Rows with columns in name order, sorted; types kept, so 1 and 1.0 differ."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def compare(spark: SparkSession, con, name: str, sf_dir: str) -> tuple[bool, int, str]:
    """(equal, rows, note). Collects both sides, which are test-sized."""
    df = prepared(QUERIES[name])(spark, sf_dir)
    ours = canonical(df.columns, df.collect())
    cursor = con.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    theirs = canonical(columns, cursor.fetchall())
    if sorted(df.columns) != sorted(columns):
        return False, len(ours), f"columns {sorted(df.columns)} vs {sorted(columns)}"
    if ours != theirs:
        mine, other = set(ours) - set(theirs), set(theirs) - set(ours)
        return False, len(ours), f"{len(theirs)} in SQL; {sorted(mine)[:2]} vs {sorted(other)[:2]}"
    return True, len(ours), ""


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = oracle(sf_dir), 0
    for name in names:
        start = time.time()
        equal, rows, note = compare(spark, con, name, sf_dir)
        failed += not equal
        print(f"{'ok  ' if equal else 'FAIL'} {name} rows={rows} {time.time() - start:.1f}s {note}", flush=True)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
