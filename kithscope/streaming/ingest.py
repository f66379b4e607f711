"""Continuous ingest of landed search pages into the snapshot tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kithscope.functions.authenticity import score_accounts
from kithscope.functions.bands import QUEUE_GATE
from kithscope.functions.times import parse_created_at
from kithscope.operators.accounts import fill_missing_stats, flatten_profile, flatten_stats, page_fingerprint
from kithscope.operators.keywords import latest_pages
from kithscope.operators.merges import upsert_profiles
from kithscope.operators.ordering import BROADCAST_ROWS
from kithscope.operators.quality import quarantine_taken, taken_handles
from kithscope.sources.search_pages import CORRUPT, explode_users, stream_search_pages
from kithscope.sources.snapshots import SnapshotTable

PROFILE_DDL = (
    "twitter_id string, handle string, name string, bio string, created_at string, follower_count bigint, can_dm boolean,"
    " location string, category string, human_score double, likely_is string, platform string,"
    " got_by_keywords array<string>, updated_at timestamp"
)
STATS_DDL = (
    "twitter_id string, followers bigint, following bigint, statuses bigint, favorites bigint, listed bigint, media bigint,"
    " verified boolean, blue_verified boolean, default_profile boolean, default_image boolean, sensitive boolean,"
    " can_dm boolean, updated_at timestamp"
)
SEARCH_DDL = (
    "keyword string, page bigint, id string, ids_hash string, items bigint, next_page string, new_profiles bigint,"
    " query_at timestamp, platform string"
)
KEYWORD_DDL = "twitter_id string, keyword string, search_id string, added_at timestamp"
LABEL_DDL = "twitter_id string, scored_by string, label boolean, reason string, scored_at timestamp, audience string"
KEYWORD_STATS_DDL = (
    "keyword string, semantic_tags array<string>, profiles_found bigint, avg_human_score decimal(4,3), label_rate decimal(4,3),"
    " still_valid boolean, pages_searched bigint, high_quality_count bigint, low_quality_count bigint,"
    " first_search_at timestamp, last_search_at timestamp, updated_at timestamp"
)
QUEUE_DDL = "twitter_id string, handle string, added_at timestamp"


DEFAULT_PLATFORM = "twitter"
SEARCH_KEYS = ["keyword", "page", "platform"]


@dataclass
class Store:
    """The seven tables: five that an ingest writes, labels and keyword statistics; beside the labels their log. Side tables are append-only, one folder per batch."""

    spark: SparkSession
    root: str
    buckets: int = 64

    def _table(self, name: str, ddl: str, keys: list[str]) -> SnapshotTable:
        return SnapshotTable(self.spark, f"{self.root}/{name}", ddl, keys, self.buckets)

    def __post_init__(self) -> None:
        self.profiles = self._table("user_profiles", PROFILE_DDL, ["twitter_id"])
        self.stats = self._table("user_stats", STATS_DDL, ["twitter_id"])
        self.keywords = self._table("user_keywords", KEYWORD_DDL, ["twitter_id", "keyword"])
        self.queue = self._table("profiles_to_score", QUEUE_DDL, ["twitter_id"])
        self.labels = self._table("profile_scores", LABEL_DDL, ["twitter_id", "scored_by"])
        self.label_log = self._table("profile_score_log", LABEL_DDL, ["twitter_id", "scored_by", "scored_at"])
        self.keyword_stats = self._table("keyword_stats", KEYWORD_STATS_DDL, ["keyword"])
        self.searches = self._table("api_search_usage", SEARCH_DDL, SEARCH_KEYS)

    def write_side(self, name: str, df: DataFrame, batch_id: int) -> None:
        # Overwriting the folder of one batch makes a repeated batch harmless.
        df.write.mode("overwrite").parquet(f"{self.root}/{name}/batch_id={batch_id}")


def sort_messages(pages: DataFrame, searches: DataFrame) -> DataFrame:
    """``verdict`` per page: failed (broken JSON, or without keyword, page, time or data), skipped (keyword fully
    paged on that platform), ok. One bad page never stops the others."""
    pages = pages.withColumn("platform", F.coalesce("platform", F.lit(DEFAULT_PLATFORM)))
    ended = latest_pages(searches, ("platform", "keyword")).filter(~F.col("has_more"))
    joined = pages.join(ended.select("platform", "keyword", F.col("page").alias("_last")), ["platform", "keyword"], "left")
    missing = F.col("keyword").isNull() | (F.trim("keyword") == "")
    verdict = (
        F.when(F.col(CORRUPT).isNotNull(), "failed: broken json")
        .when(missing, "failed: missing keyword")
        .when(F.col("page").isNull(), "failed: missing page")
        .when(F.col("query_at").isNull(), "failed: missing time")
        .when(F.col("data").isNull(), "failed: no data")
        .when(F.col("page") > F.col("_last"), "skipped: fully paged")
        .otherwise("ok")
    )
    return joined.withColumn("verdict", verdict).drop("_last")


def ingest_batch(pages: DataFrame, batch_id: int, store: Store, as_of) -> None:
    """One micro-batch: set-based merges, the same whether it runs once or again after a failure."""
    tag = f"batch-{batch_id}"
    judged = sort_messages(pages, store.searches.read())
    refused = judged.filter(F.col("verdict") != "ok").select("platform", "keyword", "page", "query_at", CORRUPT, "verdict")
    store.write_side("dead_letters", refused, batch_id)

    good = judged.filter(F.col("verdict") == "ok").drop("verdict", CORRUPT)
    search_id = F.substring(F.md5(F.concat_ws("|", "platform", "keyword", F.col("page").cast("string"))), 1, 16)
    good = good.withColumn("search_id", search_id)
    users = explode_users(good)
    user = F.col("user")
    profile, counters = flatten_profile(user), flatten_stats(user)
    context = ["keyword", "page", "query_at", "platform", "search_id"]
    rows = users.select(*context, *profile, F.struct(*counters).alias("stats"))
    inputs = [c for c in ("followers", "following", "statuses", "favorites", "listed", "media", "blue_verified",
                          "default_profile", "default_image", "sensitive")]
    wide = rows.select("*", *[F.col(f"stats.{c}").alias(c) for c in inputs])
    parsed = wide.withColumnRenamed("created_at", "created_text").withColumn("created_at", parse_created_at(F.col("created_text")))
    scored = score_accounts(fill_missing_stats(parsed), as_of).drop(*inputs)
    # Used by every merge below, so the parsed and scored batch is written once and read back.
    staged = f"{store.root}/staging/batch_id={batch_id}"
    scored.write.mode("overwrite").option("compression", "zstd").parquet(f"{staged}/rows")
    hits = store.spark.read.schema(scored.schema).parquet(f"{staged}/rows")
    # Pairs of id and handle that are refused, mostly few: then the rows with their texts stay where they are.
    found = taken_handles(hits, stored=store.profiles.read().select("twitter_id", "handle"))
    found.write.mode("overwrite").parquet(f"{staged}/taken")
    taken = store.spark.read.schema(found.schema).parquet(f"{staged}/taken")
    hits = quarantine_taken(hits, F.broadcast(taken) if taken.count() <= BROADCAST_ROWS else taken)
    store.write_side("rejected", hits.filter(F.col("reject_reason").isNotNull()), batch_id)
    hits = hits.filter(F.col("reject_reason").isNull()).drop("reject_reason")

    # New accounts per page: first page of the batch that shows an account no earlier batch stored.
    firsts = hits.groupBy("twitter_id").agg(F.min_by(F.struct(*SEARCH_KEYS), F.struct("query_at", *SEARCH_KEYS)).alias("f"))
    unseen = firsts.join(store.profiles.read().select("twitter_id"), "twitter_id", "left_anti")
    new = unseen.groupBy("f.keyword", "f.page", "f.platform").agg(F.count(F.lit(1)).alias("new_profiles"))
    # Every fetched page is logged, also one without accounts: the last page of a keyword may be empty.
    handles = F.transform("data", lambda u: u["legacy"]["screen_name"])
    per_page = good.withColumns({"ids_hash": page_fingerprint(handles), "items": F.size("data").cast("bigint")})
    log = per_page.join(new, SEARCH_KEYS, "left").select(
        "keyword", "page", F.col("search_id").alias("id"), "ids_hash", "items", F.col("cursor").alias("next_page"),
        F.coalesce("new_profiles", F.lit(0)).alias("new_profiles"), "query_at", "platform",
    )
    # The search log goes first: its counts must be taken before the profiles are stored.
    store.searches.insert(log, F.col("query_at"), tag)

    incoming = hits.select(
        "twitter_id", "handle", "name", "bio", F.col("created_text").alias("created_at"), "follower_count", "can_dm",
        "location", "category", "human_score", "likely_is", "platform", "keyword", F.col("query_at").alias("updated_at"),
    )
    store.profiles.merge(incoming, upsert_profiles, tag)
    stats = hits.select("stats.*", F.col("query_at").alias("updated_at"))
    store.stats.replace(stats, F.col("updated_at"), tag)
    words = hits.select("twitter_id", "keyword", "search_id", F.col("query_at").alias("added_at"))
    store.keywords.insert(words, F.struct("added_at", "search_id"), tag)
    above = hits.filter(F.col("human_score") > QUEUE_GATE).select("twitter_id", "handle", F.col("query_at").alias("added_at"))
    store.queue.insert(above, F.col("added_at"), tag)


def start_ingest(
    spark: SparkSession, landing: str, store: Store, checkpoint: str, as_of, files_per_batch: int = 1000, once: bool = True
) -> StreamingQuery:
    """Follow a folder of landed pages. ``once`` takes what is there and stops, else it keeps running."""
    pages = stream_search_pages(spark, landing, files_per_batch)
    writer = pages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda df, batch_id: ingest_batch(df, batch_id, store, as_of)
    )
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="15 minutes")).start()


