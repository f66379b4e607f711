"""Raw account records to relational rows, and row-level account rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kithscope.functions.text import first_category, non_empty, normalize_or_null
from kithscope.functions.times import parse_created_at


def flatten_profile(user: Column) -> list[Column]:
    """Profile columns of a nested account record."""
    legacy = user["legacy"]
    return [
        user["rest_id"].alias("twitter_id"),
        legacy["screen_name"].alias("handle"),
        legacy["name"].alias("name"),
        normalize_or_null(legacy["description"]).alias("bio"),
        legacy["created_at"].alias("created_at"),
        legacy["followers_count"].alias("follower_count"),
        F.coalesce(legacy["can_dm"], F.lit(False)).alias("can_dm"),
        normalize_or_null(legacy["location"]).alias("location"),
        normalize_or_null(first_category(user["professional"])).alias("category"),
    ]


def flatten_stats(user: Column) -> list[Column]:
    """Counter columns of a nested account record, as stored."""
    legacy = user["legacy"]
    return [
        user["rest_id"].alias("twitter_id"),
        legacy["followers_count"].alias("followers"),
        legacy["friends_count"].alias("following"),
        legacy["statuses_count"].alias("statuses"),
        legacy["favourites_count"].alias("favorites"),
        legacy["listed_count"].alias("listed"),
        legacy["media_count"].alias("media"),
        legacy["verified"].alias("verified"),
        user["is_blue_verified"].alias("blue_verified"),
        legacy["default_profile"].alias("default_profile"),
        legacy["default_profile_image"].alias("default_image"),
        legacy["possibly_sensitive"].alias("sensitive"),
        legacy["can_dm"].alias("can_dm"),
    ]


def scoring_input(user: Column) -> list[Column]:
    """Inputs of the heuristic from a nested record, with the creation date parsed."""
    counters = flatten_stats(user)
    return [*counters, parse_created_at(user["legacy"]["created_at"]).alias("created_at")]


def fill_missing_stats(df: DataFrame, use_stored_media: bool = True) -> DataFrame:
    """Neutral values for accounts without counters. Unknown default flags count as default."""
    zero = {name: F.coalesce(F.col(name), F.lit(0).cast("bigint")) for name in
            ("followers", "following", "statuses", "favorites", "listed")}
    media = F.coalesce(F.col("media"), F.lit(0).cast("bigint")) if use_stored_media else F.lit(0).cast("bigint")
    flags = {
        "blue_verified": F.coalesce("blue_verified", F.lit(False)),
        "default_profile": F.coalesce("default_profile", F.lit(True)),
        "default_image": F.coalesce("default_image", F.lit(True)),
        "sensitive": F.coalesce("sensitive", F.lit(False)),
    }
    return df.withColumns({**zero, "media": media, **flags})


def labelable(df: DataFrame) -> DataFrame:
    return df.filter(non_empty(F.col("bio")) & non_empty(F.col("name")))


def follow_ratio(df: DataFrame, limit: float = 10.0) -> DataFrame:
    ratio = F.col("following") / (F.col("followers") + 1)
    return df.filter(F.col("followers") > 0).withColumn("follow_ratio", ratio).filter(F.col("follow_ratio") < limit)


def page_fingerprint(handles: Column) -> Column:
    """First 16 hex digits of the md5 of the handles of one page, in page order."""
    return F.substring(F.md5(F.array_join(handles, ",")), 1, 16)


def tag_table(spark, mapping: list[tuple[tuple[str, ...], tuple[str, ...]]]) -> DataFrame:
    """Mapping of (tags, keywords) pairs as a table; a longer one is read from a file of these columns."""
    rows = [(keyword, list(tags)) for tags, keywords in mapping for keyword in keywords]
    return spark.createDataFrame(rows, "keyword string, new_tags array<string>")


def assign_tags(keyword_stats: DataFrame, tags: DataFrame) -> DataFrame:
    """Replace the tags of mapped keywords; the others keep theirs."""
    joined = keyword_stats.join(tags, "keyword", "left")
    return joined.withColumn("semantic_tags", F.coalesce("new_tags", "semantic_tags")).drop("new_tags")


def untagged(keyword_stats: DataFrame) -> DataFrame:
    return keyword_stats.filter(F.col("semantic_tags").isNull() | (F.size("semantic_tags") == 0)).select("keyword")


def model_table(spark, names: list[tuple[str, str]]) -> DataFrame:
    """Alias and full name of each labeler."""
    return spark.createDataFrame(names, "alias string, full_name string")


def canonical_model(labels: DataFrame, models: DataFrame, column: str = "scored_by") -> DataFrame:
    """Aliases become full names; unknown names stay."""
    joined = labels.join(models, F.col(column) == F.col("alias"), "left")
    return joined.withColumn(column, F.coalesce("full_name", column)).drop("alias", "full_name")


def backfill_audience(labels: DataFrame, cutoff: Column, before: str, after: str) -> DataFrame:
    """Audience version by time where none is set."""
    version = F.when(F.col("scored_at") < cutoff, F.lit(before)).when(F.col("scored_at") >= cutoff, F.lit(after))
    return labels.withColumn("audience", F.coalesce(F.col("audience"), version))


def backfill_preview(labels: DataFrame, cutoff: Column) -> DataFrame:
    """Counts of a dry run: rows before and after the cut-off and rows that already have a version."""
    return labels.agg(
        F.count(F.when(F.col("scored_at") < cutoff, 1)).alias("before_cutoff"),
        F.count(F.when(F.col("scored_at") >= cutoff, 1)).alias("after_cutoff"),
        F.count("audience").alias("already_set"),
    )

