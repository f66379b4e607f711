"""Small text inputs: lead lists, handle lists, hand-label progress, configs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kithscope.functions.text import label_word, trim_all
from kithscope.schemas import AUDIENCE

LEAD_COLUMNS = ["username", "bio", "followers", "score", "tags", "rationale"]


def _read_csv(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    reader = spark.read.schema(ddl).option("header", True).option("quote", '"').option("escape", '"')
    return reader.option("enforceSchema", True).option("mode", "PERMISSIVE").csv(path)


def _unquoted(name: str) -> Column:
    """Free text without a stray quote at either end; missing text is empty."""
    return trim_all(F.regexp_replace(trim_all(F.coalesce(F.col(name), F.lit(""))), '^"|"$', ""))


def read_leads(spark: SparkSession, path: str) -> DataFrame:
    """Lead list with doubled-quote escaping. Rows need five cells; a bad number counts as 0."""
    raw = _read_csv(spark, path, "username string, bio string, followers string, score string, tags string, rationale string")
    followers = F.regexp_extract(trim_all(F.col("followers")), r"^[+-]?\d+", 0)
    score = F.regexp_extract(trim_all(F.col("score")), r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", 0)
    return raw.filter(F.col("tags").isNotNull()).select(
        trim_all(F.col("username")).alias("username"),
        _unquoted("bio").alias("bio"),
        F.coalesce(followers.try_cast("bigint"), F.lit(0)).alias("followers"),
        F.coalesce(score.try_cast("double"), F.lit(0.0)).alias("score"),
        trim_all(F.col("tags")).alias("tags"),
        _unquoted("rationale").alias("rationale"),
    )


def read_handles(spark: SparkSession, path: str) -> DataFrame:
    """Handle list: one per line, blanks and # comments dropped."""
    lines = spark.read.text(path).select(trim_all(F.col("value")).alias("handle"))
    return lines.filter((F.col("handle") != "") & ~F.col("handle").startswith("#"))


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """Hand labels: key in lower case, label true/false else null, class human/entity/other else null."""
    raw = _read_csv(spark, path, "handle string, label string, reason string, class string")
    label, kind = F.lower(trim_all(F.col("label"))), F.lower(trim_all(F.col("class")))
    return raw.filter(F.col("handle").isNotNull()).select(
        F.lower(trim_all(F.col("handle"))).alias("handle"),
        F.when(label == "true", F.lit(True)).when(label == "false", F.lit(False)).alias("label"),
        F.coalesce(trim_all(F.col("reason")), F.lit("")).alias("reason"),
        F.when(kind.isin("human", "entity", "other"), kind).alias("class"),
    )


def write_progress(df: DataFrame, path: str) -> None:
    """CSV parts, each with its header, readable by :func:`read_progress`."""
    out = df.select("handle", label_word(F.col("label")).alias("label"), F.coalesce("reason", F.lit("")).alias("reason"),
                    F.coalesce("class", F.lit("")).alias("class"))
    renamed = out.toDF("HANDLE", "LABEL", "REASON", "CLASS")
    renamed.write.mode("errorifexists").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def read_audience(spark: SparkSession, path: str) -> DataFrame:
    """Audience description: one JSON object, one row."""
    return spark.read.schema(AUDIENCE).option("multiLine", True).json(path)


def write_lines(df: DataFrame, path: str, header: list[str]) -> None:
    """Rows as CSV parts in the order of the DataFrame's range partitions, a header in every part."""
    df.toDF(*header).write.mode("errorifexists").option("header", True).option("quote", '"').option("escape", '"').csv(path)

