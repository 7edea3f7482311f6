"""The registered queries of these operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daymark.llm.collocations import collocations
from daymark.llm.decontaminate import contamination_report
from daymark.llm.language import language_report
from daymark.llm.licenses import scan
from daymark.llm.main_text import text_report
from daymark.llm.mixing import mixing_report
from daymark.llm.near_dedup import near_duplicates
from daymark.llm.simhash import simhash_duplicates
from daymark.llm.surrogates import surrogate_report
from daymark.llm.top_k import top_k
from daymark.llm.toxicity import toxicity_report
from daymark.llm.variants import spelling_variants
from daymark.llm.warc import archive_report
from daymark.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_report(_table(spark, sf_dir, "pages"), scratch_path(spark, "warc"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_report(_table(spark, sf_dir, "documents"))


def op6_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogate_report(_table(spark, sf_dir, "documents"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_report(_table(spark, sf_dir, "pages"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_duplicates(_table(spark, sf_dir, "documents"))


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(_table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_licenses": op2_licenses,
    "op3_toxicity": op3_toxicity,
    "op4_warc": op4_warc,
    "op5_language": op5_language,
    "op6_surrogates": op6_surrogates,
    "op7_near_dedup": op7_near_dedup,
    "op8_top_k": op8_top_k,
    "op9_main_text": op9_main_text,
    "op10_decontaminate": op10_decontaminate,
    "op11_simhash": op11_simhash,
    "op12_variants": op12_variants,
    "op13_collocations": op13_collocations,
}
