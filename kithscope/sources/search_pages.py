"""Landed search responses: one JSON object per page, with nested account records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kithscope.functions.times import platform_text
from kithscope.operators.accounts import page_fingerprint
from kithscope.schemas import SEARCH_PAGE, SEARCH_PAGE_WITH_REQUEST

CORRUPT = "_corrupt_record"


def _with_corrupt(schema: str) -> str:
    return f"{schema}, {CORRUPT} string"


def read_search_pages(spark: SparkSession, path: str, with_request: bool = False) -> DataFrame:
    """All pages; a line that is not valid JSON is kept in ``_corrupt_record`` with empty data."""
    schema = SEARCH_PAGE_WITH_REQUEST if with_request else SEARCH_PAGE
    reader = spark.read.schema(_with_corrupt(schema)).option("mode", "PERMISSIVE")
    return reader.option("columnNameOfCorruptRecord", CORRUPT).json(path)


def stream_search_pages(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """The same pages as a stream of landed files."""
    return (
        spark.readStream.schema(_with_corrupt(SEARCH_PAGE_WITH_REQUEST))
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("maxFilesPerTrigger", files_per_batch)
        .json(path)
    )


def explode_users(pages: DataFrame) -> DataFrame:
    """One row per account of a page, with its position and the fingerprint of the page."""
    handles = F.transform("data", lambda u: u["legacy"]["screen_name"])
    kept = [c for c in pages.columns if c != "data"]
    return pages.filter(F.col("data").isNotNull()).select(
        *kept, page_fingerprint(handles).alias("ids_hash"), F.posexplode("data").alias("position", "user")
    )


def nest_user() -> Column:
    """Flat profile and counter columns as one nested record, the shape of the search service."""
    c = F.col
    return F.struct(
        c("twitter_id").alias("rest_id"),
        c("blue_verified").alias("is_blue_verified"),
        F.struct(
            c("handle").alias("screen_name"),
            c("name"),
            c("bio").alias("description"),
            platform_text(c("created_at")).alias("created_at"),
            c("location"),
            c("followers").alias("followers_count"),
            c("following").alias("friends_count"),
            c("statuses").alias("statuses_count"),
            c("favorites").alias("favourites_count"),
            c("listed").alias("listed_count"),
            c("media").alias("media_count"),
            c("can_dm"),
            F.lit(False).alias("verified"),
            c("default_profile"),
            c("default_image").alias("default_profile_image"),
            c("sensitive").alias("possibly_sensitive"),
        ).alias("legacy"),
        F.struct(
            F.lit("Business").alias("professional_type"),
            F.array(
                F.struct(F.lit(1).alias("id"), c("category").alias("name"), F.lit("icon").alias("icon_name"))
            ).alias("category"),
        ).alias("professional"),
    )
