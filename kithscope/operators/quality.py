"""Integrity checks and the quarantine of rows a table must not take."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kithscope.functions.bands import QUEUE_GATE
from kithscope.functions.numbers import count_if, row_count
from kithscope.operators.lookups import by_handle
from kithscope.operators.ranking import blend, label_means
from kithscope.schemas import ACCOUNT_CLASSES

FOLLOWER_TOLERANCE = 0.2
SCORE_TOLERANCE = 0.05


def search_references(keywords: DataFrame, searches: DataFrame) -> DataFrame:
    """Keyword hits without a search id, and with one that no search has."""
    known = searches.select(F.col("id").alias("search_id"), F.lit(True).alias("_known")).distinct()
    joined = keywords.select("search_id").join(known, "search_id", "left")
    given = F.col("search_id").isNotNull()
    return joined.agg(
        row_count().alias("total"), count_if(~given).alias("missing"),
        count_if(given & F.col("_known").isNull()).alias("dangling"),
    )


def new_profile_counts(searches: DataFrame) -> DataFrame:
    n = F.col("new_profiles")
    return searches.agg(
        row_count().alias("total"), count_if(n == 0).alias("zero"), count_if(n > 0).alias("positive"),
        count_if((n < 0) | (n > F.col("items"))).alias("out_of_range"), F.avg(n).alias("mean"), F.max(n).alias("maximum"),
    )


def without_stats(profiles: DataFrame, stats: DataFrame) -> DataFrame:
    return profiles.join(stats.select("twitter_id"), "twitter_id", "left_anti")


def queue_scores(queue: DataFrame, scores: DataFrame, gate: float = QUEUE_GATE) -> DataFrame:
    s = F.col("human_score")
    return queue.select("twitter_id").join(scores, "twitter_id").agg(
        row_count().alias("queued"), count_if(s <= gate).alias("below_gate"), F.min(s).alias("minimum"),
        F.max(s).alias("maximum"), F.avg(s).alias("mean"),
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [df.agg(row_count().alias("n")).select(F.lit(name).alias("name"), "n") for name, df in tables.items()]
    out = counts[0]
    for other in counts[1:]:
        out = out.unionByName(other)
    return out


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(row_count().alias("n")).filter(F.col("n") > 1)


def bad_classes(df: DataFrame) -> DataFrame:
    return df.filter(F.col("likely_is").isNotNull() & ~F.col("likely_is").isin(ACCOUNT_CLASSES))


def too_long(df: DataFrame, limits: dict[str, int]) -> DataFrame:
    """Rows with a text longer than its column allows."""
    broken: Column = F.lit(False)
    for name, limit in limits.items():
        broken = broken | (F.coalesce(F.length(name), F.lit(0)) > limit)
    return df.filter(broken)


def quarantine(profiles: DataFrame, created_at: str = "created_at", stored: DataFrame | None = None) -> DataFrame:
    """Every row with ``reject_reason`` (null when fine): no id, no handle, a creation date that cannot be
    read, or a handle that another account owns. No row is lost.

    A handle belongs to the account that ``stored`` (twitter_id, handle) has it for, else to the smallest id
    of the rows that are otherwise fine. Ids are numbers in text: the shorter is smaller. Owners are
    map-side minima, and of ``stored`` only the handles of the rows are looked at.
    """
    owners = _owners(profiles, created_at, stored)
    reason = _reason(created_at, F.col("twitter_id") != F.col("_owner"))
    return profiles.join(owners, "handle", "left").withColumn("reject_reason", reason).drop("_owner")


def _owners(profiles: DataFrame, created_at: str, stored: DataFrame | None) -> DataFrame:
    number = F.struct(F.length("twitter_id").alias("digits"), F.col("twitter_id"))
    fine = F.col("twitter_id").isNotNull() & F.col("handle").isNotNull() & F.col(created_at).isNotNull()
    owners = profiles.filter(fine).groupBy("handle").agg(F.min(number).alias("_first"))
    if stored is None:
        return owners.select("handle", F.col("_first.twitter_id").alias("_owner"))
    held = stored.join(profiles.select("handle").distinct(), "handle", "left_semi")
    held = held.groupBy("handle").agg(F.min(number).alias("_held"))
    owner = F.coalesce(F.col("_held.twitter_id"), F.col("_first.twitter_id"))
    return owners.join(held, "handle", "full").select("handle", owner.alias("_owner"))


def _reason(created_at: str, taken: Column) -> Column:
    return (
        F.when(F.col("twitter_id").isNull(), "no_id")
        .when(F.col("handle").isNull(), "no_handle")
        .when(F.col(created_at).isNull(), "bad_created_at")
        .when(taken, "handle_taken")
    )


def taken_handles(profiles: DataFrame, created_at: str = "created_at", stored: DataFrame | None = None) -> DataFrame:
    """The (twitter_id, handle) of ``profiles`` whose handle another account owns, each once."""
    pairs = profiles.select("twitter_id", "handle").distinct()
    return pairs.join(_owners(profiles, created_at, stored), "handle").filter(F.col("twitter_id") != F.col("_owner")).select("twitter_id", "handle")


def quarantine_taken(profiles: DataFrame, taken: DataFrame, created_at: str = "created_at") -> DataFrame:
    """:func:`quarantine` by the pairs that :func:`taken_handles` has found; where they are few, rows stay in place."""
    marked = profiles.join(taken.withColumn("_taken", F.lit(True)), ["twitter_id", "handle"], "left")
    return marked.select(*profiles.columns, _reason(created_at, F.col("_taken")).alias("reject_reason"))


def validate_leads(leads: DataFrame, profiles: DataFrame, labels: DataFrame) -> DataFrame:
    """Leads against stored accounts; the first failing check names the status.

    ``profiles`` brings twitter_id, handle, followers, human_score, can_dm. The lookup is by exact handle.
    """
    means = label_means(labels).select("twitter_id", F.col("avg_llm").alias("_mean"))
    wanted = leads.withColumnRenamed("username", "handle").withColumnRenamed("followers", "csv_followers")
    wanted = wanted.withColumnsRenamed({"score": "csv_score", "bio": "csv_bio"})
    stored = profiles.select("twitter_id", "handle", "followers", "human_score", "can_dm")
    joined = by_handle(wanted, stored, ignore_case=False).join(means, "twitter_id", "left")
    db = F.coalesce("followers", F.lit(0))
    gap = (
        F.when(db > 0, F.abs(F.col("csv_followers") - db) / db)
        .when(F.col("csv_followers") > 0, F.lit(1.0))
        .otherwise(F.lit(0.0))
    )
    score = blend(F.coalesce("human_score", F.lit(0.0)), F.coalesce("_mean", F.lit(0.0)))
    found = F.col("twitter_id").isNotNull()
    checked = joined.withColumns(
        {
            "db_followers": F.when(found, db),
            "db_score": F.when(found, score),
            "follower_gap": F.when(found, gap),
        }
    ).withColumn("score_gap", F.abs(F.col("csv_score") - F.col("db_score")))
    status = (
        F.when(~found, "not_found")
        .when(F.col("follower_gap") > FOLLOWER_TOLERANCE, "follower_mismatch")
        .when(F.col("score_gap") > SCORE_TOLERANCE, "score_mismatch")
        .otherwise("valid")
    )
    return checked.withColumn("status", status)


def validated_rows(checked: DataFrame) -> DataFrame:
    """Valid leads, best stored score first, ready to write."""
    can_dm = F.coalesce(F.col("can_dm").cast("string"), F.lit("unknown"))
    valid = checked.filter(F.col("status") == "valid")
    return valid.orderBy(F.col("db_score").desc(), "wanted_handle").select(
        F.col("wanted_handle").alias("username"), F.col("db_followers").alias("followers"),
        F.format_string("%.4f", "db_score").alias("score"), can_dm.alias("can_dm"),
    )


def status_counts(checked: DataFrame) -> DataFrame:
    return checked.groupBy("status").agg(row_count().alias("n"))
