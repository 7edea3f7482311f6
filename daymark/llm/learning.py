"""What the learned operators share: the held-out rule and bounded training samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """crc32 of the id as text leaves 2 when divided by 4; null ids are held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(True))


def bounded(rows: DataFrame, most: int, *by: str) -> DataFrame:
    """About `most` of the rows, chosen by the hash of the columns `by`; all if there are fewer.

    The share is found from the count, so no sort and no single task is needed.
    """
    total = rows.count()
    if total <= most:
        return rows
    share = F.lit(int(most / total * 2**31))
    return rows.where(F.pmod(F.xxhash64(*by), F.lit(2**31)) < share)
