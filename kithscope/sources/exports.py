"""Rows of the CSV and line exports; writers only add the file format."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kithscope.functions.text import csv_cell, fixed_decimals, label_word, one_line

HIGH_HEADER = ["HANDLE", "BIO", "FOLLOWERS", "SCORE", "IS_LIKELY", "TAGS"]
LOW_HEADER = ["HANDLE", "BIO", "FOLLOWERS", "FINAL_SCORE", "HAS_SCORE", "AVG_LLM", "HAS_LLM", "IS_LIKELY", "TAGS"]
LABEL_HEADER = ["handle", "bio", "label", "reason"]


def high_score_rows(final: DataFrame, minimum: float = 0.6) -> DataFrame:
    """Labelled accounts at or above the minimum, ready to write."""
    picked = final.filter(F.col("has_llm") & (F.col("final_score") >= minimum))
    return picked.select(
        "handle",
        one_line(F.col("bio")).alias("bio"),
        F.coalesce("followers", F.lit(0)).alias("followers"),
        fixed_decimals(F.col("final_score"), 4).alias("score"),
        F.coalesce("likely_is", F.lit("Unknown")).alias("is_likely"),
        F.array_join("keywords", "; ").alias("tags"),
    )


def low_score_rows(final: DataFrame, maximum: float = 0.5) -> DataFrame:
    """All accounts below the maximum, labelled or not."""
    picked = final.filter(F.col("final_score") < maximum)
    mean = F.when(F.col("has_llm"), fixed_decimals(F.col("avg_llm"), 4)).otherwise(F.lit(""))
    return picked.select(
        "handle",
        one_line(F.col("bio")).alias("bio"),
        F.coalesce("followers", F.lit(0)).alias("followers"),
        fixed_decimals(F.col("final_score"), 4).alias("final_score"),
        fixed_decimals(F.col("human_score"), 4).alias("has_score"),
        mean.alias("avg_llm"),
        F.col("has_llm").cast("string").alias("has_llm"),
        F.coalesce("likely_is", F.lit("Unknown")).alias("is_likely"),
        F.array_join("keywords", "; ").alias("tags"),
    )


def label_rows(labels: DataFrame, *keys: str) -> DataFrame:
    return labels.select(*keys, "handle", "bio", label_word(F.col("label")).alias("label"), "reason")


def write_ranked(df: DataFrame, path: str, header: list[str], by: str) -> None:
    """Range-sorted parts, highest score first; the part order is the global order."""
    ordered = df.repartitionByRange(F.col(by).desc()).sortWithinPartitions(F.col(by).desc(), "handle")
    writer = ordered.toDF(*header).write.mode("errorifexists").option("header", True)
    # Blanks at the ends of a cell are part of it.
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.option("quote", '"').option("escape", '"').csv(path)


def read_ranked(spark: SparkSession, path: str, header: list[str]) -> DataFrame:
    """The rows of such files as text columns of the given names. The format knows no null: an empty cell, quoted or not, is an empty text."""
    schema = ", ".join(f"`{name}` string" for name in header)
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("escape", '"').option("multiLine", True)
    return reader.csv(path).select(*(F.coalesce(F.col(f"`{name}`"), F.lit("")).alias(name) for name in header))


def write_labels(df: DataFrame, path: str, keyword: str = "keyword") -> None:
    """Label rows in one folder per keyword, handles in order; every part has the header."""
    ordered = df.repartitionByRange(keyword, "handle").sortWithinPartitions(keyword, "handle")
    named = ordered.select(keyword, *(F.col(c) for c in LABEL_HEADER))
    writer = named.write.mode("errorifexists").option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.option("quote", '"').option("escape", '"').partitionBy(keyword).csv(path)


def read_labels(spark: SparkSession, path: str, keyword: str = "keyword") -> DataFrame:
    """Rows of the label files of all keywords. ``label`` is true, false or null (uncertain), empty cells are empty texts."""
    schema = ", ".join([*(f"{name} string" for name in LABEL_HEADER), f"{keyword} string"])
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("escape", '"').option("multiLine", True)
    text = {c: F.coalesce(c, F.lit("")) for c in LABEL_HEADER if c != "label"}
    return reader.csv(path).withColumns({**text, "label": F.col("label").try_cast("boolean")})


def master_lines(df: DataFrame) -> DataFrame:
    """Empty label row per handle, for labelling by hand."""
    handle = csv_cell(F.col("handle"))
    return df.select(F.concat(F.lit("  "), handle, F.lit(', null, ""')).alias("value"))
