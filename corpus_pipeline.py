"""The corpus pipeline: five stages over ``documents``, each working on all that its predecessor kept.

Every stage but the last returns the columns of documents; ``n_chars`` follows the text. ORACLE_SQL is None: votes
fitted by expectation-maximisation, weighted sampling and tokenization have no SQL form, so the tests hold the rows
against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kithscope.llm.frames import stored
from kithscope.llm.op6_decontaminate import decontaminate
from kithscope.llm.op7_near_duplicates import keep_first
from kithscope.llm.op8_line_dedup import drop_repeated_lines
from kithscope.llm.op9_quality_votes import keep_good
from kithscope.llm.queries import packed


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior quality is too low, or that fail the base rules, go."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of three or more documents stay in one of them."""
    return drop_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are cut out; documents that are mostly benchmark go."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of at most 2048, one row per piece of a document."""
    return packed(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
