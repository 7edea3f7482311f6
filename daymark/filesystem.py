"""The few directory operations Spark's writers do not offer.

They go through the Hadoop file system of the session, so any storage Spark
reads will do, and touch directory entries only, never data. Their number
follows the dates at hand; `each` overlaps the waiting on remote storage.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark.sql import SparkSession

A, B = TypeVar("A"), TypeVar("B")


def each(call: Callable[[A], B], items: Iterable[A]) -> list[B]:
    """`call` for each item, several at a time, results in order."""
    with ThreadPoolExecutor(max_workers=32) as pool:
        return list(pool.map(call, items))


def _open(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern."""
    fs, path = _open(spark, pattern)
    return [str(s.getPath().toString()) for s in fs.globStatus(path) or []]


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _open(spark, path)
    return fs.exists(hadoop_path)


def file_names(spark: SparkSession, directory: str) -> frozenset[str]:
    """Names of what is directly in a directory; empty if there is none."""
    return frozenset(p.rsplit("/", 1)[-1] for p in matching(spark, f"{directory}/*"))


def total_bytes(spark: SparkSession, path: str) -> int:
    """Size of all files below a directory; 0 if there is none."""
    fs, hadoop_path = _open(spark, path)
    return fs.getContentSummary(hadoop_path).getLength() if fs.exists(hadoop_path) else 0


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _open(spark, path)
    fs.delete(hadoop_path, True)


def rename(spark: SparkSession, path: str, target: str) -> None:
    """Move a file or directory; the folder it goes to is made first."""
    fs, hadoop_path = _open(spark, path)
    _, to = _open(spark, target)
    fs.mkdirs(to.getParent())
    if not fs.rename(hadoop_path, to):
        raise OSError(f"{path} could not be moved to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, in place of any there."""
    fs, hadoop_path = _open(spark, path)
    out = fs.create(hadoop_path, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is none."""
    fs, hadoop_path = _open(spark, path)
    if not fs.exists(hadoop_path):
        return None
    stream = fs.open(hadoop_path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file."""
    fs, hadoop_path = _open(spark, path)
    fs.create(hadoop_path, True).close()
