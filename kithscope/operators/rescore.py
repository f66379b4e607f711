"""Re-scoring of stored accounts under another config, and comparison with the stored scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kithscope.functions.authenticity import score_accounts
from kithscope.functions.bands import score_bucket
from kithscope.functions.numbers import count_if
from kithscope.functions.scoring_config import Config
from kithscope.operators.accounts import fill_missing_stats

UNCHANGED = 0.001


def rescore(stored: DataFrame, as_of, config: Config, use_stored_media: bool = True) -> DataFrame:
    """Old and new score and class per account that has an old score."""
    base = fill_missing_stats(stored.filter(F.col("human_score").isNotNull()), use_stored_media)
    renamed = base.withColumnsRenamed({"human_score": "old_score", "likely_is": "old_class"})
    scored = score_accounts(renamed, as_of, config)
    diff = F.col("human_score") - F.col("old_score")
    change = (
        F.when(F.abs(diff) < UNCHANGED, "unchanged").when(diff > 0, "upgrade").otherwise("downgrade")
    )
    return scored.select(
        "twitter_id", "handle", "old_score", F.coalesce("old_class", F.lit("Unknown")).alias("old_class"),
        F.col("human_score").alias("new_score"), F.col("likely_is").alias("new_class"),
        diff.alias("diff"), change.alias("change"),
    )


def change_summary(changes: DataFrame) -> DataFrame:
    return changes.agg(
        count_if(F.col("change") == "upgrade").alias("upgrades"),
        count_if(F.col("change") == "downgrade").alias("downgrades"),
        count_if(F.col("change") == "unchanged").alias("unchanged"),
        count_if(F.col("old_class") != F.col("new_class")).alias("class_changes"),
    )


def distributions(changes: DataFrame) -> DataFrame:
    """Old and new counts of every bucket and class in one pass: each row gives four small facts,
    which are summed on the map side. A name that exists on one side only has 0 on the other."""
    facts = F.array(
        F.struct(F.lit("bucket").alias("kind"), score_bucket(F.col("old_score")).alias("name"), F.lit(1).alias("o"), F.lit(0).alias("w")),
        F.struct(F.lit("bucket").alias("kind"), score_bucket(F.col("new_score")).alias("name"), F.lit(0).alias("o"), F.lit(1).alias("w")),
        F.struct(F.lit("class").alias("kind"), F.col("old_class").alias("name"), F.lit(1).alias("o"), F.lit(0).alias("w")),
        F.struct(F.lit("class").alias("kind"), F.col("new_class").alias("name"), F.lit(0).alias("o"), F.lit(1).alias("w")),
    )
    summed = changes.select(F.inline(facts)).groupBy("kind", "name").agg(
        F.sum("o").alias("old_count"), F.sum("w").alias("new_count")
    )
    return summed.withColumn("change", F.col("new_count") - F.col("old_count"))


def biggest_downgrades(changes: DataFrame, n: int = 20) -> DataFrame:
    return changes.filter(F.col("change") == "downgrade").orderBy("diff", "handle").limit(n)
