"""Registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from ebbtide.llm import bpe, decontaminate, divergence, jaccard, licenses, linededup, lm, quality, sharding, suffixes, toolcalls, warc, whitening
from ebbtide.llm.shared import new_folder, ship
from ebbtide.llm.sql import SQL  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(function):
    @wraps(function)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query
def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(table(spark, sf_dir, "documents"), with_ids=False)


@_query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.deduplicated(table(spark, sf_dir, "documents"))


@_query
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"))


@_query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "warc")
    warc.write(warc.with_revisits(table(spark, sf_dir, "pages")), folder)
    return warc.page_report(spark, folder)


@_query
def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toolcalls.chat_report(table(spark, sf_dir, "conversations"))


@_query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(table(spark, sf_dir, "documents"))


@_query
def op3_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored(table(spark, sf_dir, "documents"))


@_query
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.joined(table(spark, sf_dir, "documents"))


@_query
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


@_query
def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


@_query
def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.report(table(spark, sf_dir, "documents"))
