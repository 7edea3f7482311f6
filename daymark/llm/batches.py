"""Further columns computed in Python, one Arrow batch at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Compute = Callable[[pa.StructArray], Sequence[pa.Array]]
# What one call of a compute function gets at most; a row that is larger comes alone.
SLICE_ROWS, SLICE_BYTES = 512, 2**22


def send(spark: SparkSession, value: object) -> Broadcast:
    """A broadcast of an object with its class, for executors that do not have this package.

    A plain broadcast names the classes of what it holds, which these could not import.
    """
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(shared: Broadcast) -> object:
    """In a task: what was sent."""
    return cloudpickle.loads(shared.value)


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: T.StructType | str) -> DataFrame:
    """`df.mapInArrow(run, schema)` over batches of about `SLICE_BYTES`, or of one row that is larger.

    Spark's own batches of long texts reach 64 MB, which executor and Python worker hold several
    times over, and a worker keeps what it once took. The bound stays set, as Spark reads it only
    when the result is computed; one that the session was given is left alone.
    """
    setting, conf = "spark.sql.execution.arrow.maxBytesPerBatch", df.sparkSession.conf
    if setting not in conf.getAll:
        conf.set(setting, str(SLICE_BYTES))
    return df.mapInArrow(run, schema)


def slices(rows: pa.StructArray) -> Iterator[pa.StructArray]:
    """The rows of an Arrow batch in order, cut by number and by bytes of text."""
    sizes = np.zeros(len(rows) + 1, np.int64)
    for k, field in enumerate(rows.type):
        if pa.types.is_string(field.type) or pa.types.is_binary(field.type):
            sizes[1:] += np.asarray(pc.fill_null(pc.binary_length(rows.field(k)), 0))
    ends, at = sizes.cumsum(), 0
    while at < len(rows):
        fits = int(np.searchsorted(ends, ends[at] + SLICE_BYTES, "right")) - 1
        end = max(at + 1, min(at + SLICE_ROWS, fits))
        yield rows.slice(at, end - at)
        at = end


def extend(
    df: DataFrame, start: Callable[[], Compute], fields: str, keep: Sequence[str] | None = None
) -> DataFrame:
    """Column `row`, a struct of the `keep` columns of `df` (default: all), and `fields`.

    `start` is called once per task and returns the function that turns some
    rows into one array per field. As the columns of `df` stay inside
    `row`, their names cannot clash with `fields`.
    """
    names = list(df.columns)
    kept = names if keep is None else list(keep)
    added = T.StructType.fromDDL(fields)
    places = [names.index(c) for c in kept]
    row = T.StructType([T.StructField(c, df.schema[i].dataType) for c, i in zip(kept, places)])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = start()
        for part in parts:
            for rows in slices(part.column(0)):
                old = pa.StructArray.from_arrays([rows.field(i) for i in places], names=kept)
                yield pa.RecordBatch.from_arrays([old, *compute(rows)], ["row", *added.names])

    packed = df.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"))
    return map_arrow(packed, run, T.StructType([T.StructField("row", row, False), *added.fields]))
