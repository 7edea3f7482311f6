"""Session settings the jobs rely on."""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str) -> SparkSession:
    """Session for the command line; the master and sizes come from spark-submit."""
    spark = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    return use_utc(spark)


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone: event times are stored as UTC wall-clock times."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def require_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone}")


# Parquet bytes per shuffle partition: about four times as much once decoded.
_SHARE = 32 * 2**20


@contextmanager
def shuffles_for(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Enough shuffle partitions for a job over `input_bytes` of Parquet.

    Adaptive execution merges partitions that turn out small, but does not
    split those of an aggregate or window that are too large. The session's own
    number is the least.
    """
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    needed = math.ceil(input_bytes / _SHARE)
    spark.conf.set(setting, str(max(int(before), needed)))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


@contextmanager
def listings_shared(spark: SparkSession) -> Iterator[None]:
    """List many directories in a few tasks per core.

    Spark would start a task for each directory, up to 10,000, which costs more than the listing.
    """
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(min(int(before), 4 * spark.sparkContext.defaultParallelism)))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name in the shared folder the cluster names for checkpoints.

    Where `spark.checkpoint.dir` is unset, /tmp of the session's default file
    system serves; on a cluster that must be a file system all executors share.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root is None:
        hadoop = spark._jvm.org.apache.hadoop.fs
        home = hadoop.FileSystem.get(spark._jsc.hadoopConfiguration())
        if home.getScheme() == "file" and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = home.makeQualified(hadoop.Path("/tmp")).toString()
    return f"{root.rstrip('/')}/daymark/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write `df` to the shared scratch folder and read it back.

    Fixes values that a re-run of lost tasks could compute differently, and
    cuts the lineage in a way that outlives any executor.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
