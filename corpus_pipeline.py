"""A training corpus from `documents`: filtered, deduplicated, decontaminated, made private, mixed.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and
read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.llm.decontaminate import remove_contamination
from daymark.llm.mixing import mixed_documents
from daymark.llm.near_dedup import near_duplicates
from daymark.llm.surrogates import with_surrogates
from daymark.llm.toxicity import without_toxic
from daymark.session import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity scan rejects go."""
    return without_toxic(docs, _table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one with the smallest doc_id."""
    gone = near_duplicates(docs).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items are cut out of the texts."""
    return remove_contamination(docs, _table(spark, sf_dir, "benchmark"))


def make_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data give way to surrogates."""
    return with_surrogates(docs)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn for the mixture, with their rate and number of copies. Toxic ones are gone."""
    return mixed_documents(docs, _table(spark, sf_dir, "labels"), SHARES)


SHARES = {"sound": 0.95, "poor": 0.05}

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("pii", make_private),
    ("mixing", mix_domains),
]

# Learned scores, automata and keyed surrogates are beyond SQL; tests hold the operators against brute force
# or planted cases, and the stages against their operators' promises.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
