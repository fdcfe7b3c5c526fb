"""Corpus pipeline: quality rules, line dedup, near duplicates, benchmark decontamination, encoding.

Every stage takes (spark, docs, sf_dir) and returns a frame; all but the last return the columns of documents.
``run`` writes each stage as Parquet in the cluster's shared folder and hands the reread table to the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ebbtide.llm import bpe, decontaminate, jaccard, linededup, quality
from ebbtide.llm.shared import ship, written

#: Encoding cannot be written in SQL; the stages are tested against brute force.
ORACLE_SQL = None

#: Near duplicates here share 80 percent of their shingles of five words; op8_jaccard_join has values of its own.
NEAR_SHINGLE, NEAR_PERCENT = 5, 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    ship(spark)
    return quality.keep(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of lines that stand earlier in the corpus."""
    ship(spark)
    return linededup.deduplicated(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates: the one with the smallest id."""
    ship(spark)
    return jaccard.representatives(docs, NEAR_PERCENT, NEAR_SHINGLE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that also stand in benchmark items."""
    ship(spark)
    return decontaminate.removed(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the text decoded from them."""
    ship(spark)
    return bpe.encoded(docs)


STAGES = [
    ("quality rules", quality_rules), ("line dedup", line_dedup), ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination), ("BPE encoding and decoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
