"""Keyword pool: statistics, paging state, yield, selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kithscope.functions.numbers import count_if, seeded_order, share
from kithscope.functions.times import as_timestamp
from kithscope.operators.lookups import not_labelled_by


def searched_keywords(searches: DataFrame) -> DataFrame:
    return searches.select("keyword").distinct()


def latest_pages(searches: DataFrame, keys: tuple[str, ...] = ("keyword",)) -> DataFrame:
    """Newest page per keyword (or other ``keys``) and whether more can follow. A null cursor ends a keyword; an
    empty cursor does not. ``max_by`` keeps the null cursor of the newest page."""
    newest = F.max_by(F.struct("next_page", "query_at"), "page").alias("last")
    grouped = searches.groupBy(*keys).agg(F.max("page").alias("page"), newest)
    return grouped.select(
        *keys, "page", F.col("last.next_page").alias("next_page"), F.col("last.query_at").alias("query_at"),
        F.col("last.next_page").isNotNull().alias("has_more"),
    )


def fully_paged(searches: DataFrame, keys: tuple[str, ...] = ("keyword",)) -> DataFrame:
    return latest_pages(searches, keys).filter(~F.col("has_more")).select(*keys, "page")


def keyword_stats(
    searches: DataFrame, keywords: DataFrame, scores: DataFrame, labels: DataFrame, previous: DataFrame | None = None
) -> DataFrame:
    """Statistics of every searched keyword in one plan.

    Labels are first counted per account, so the join with the keyword hits carries one row per account
    and hit and both account facts are summed in one grouped pass; a hot keyword is combined map-side.
    """
    per_account = labels.groupBy("twitter_id").agg(
        count_if(F.col("label").isNotNull()).alias("rated"), count_if(F.col("label")).alias("liked")
    )
    facts = scores.select("twitter_id", "human_score").join(per_account, "twitter_id", "full")
    known = facts.withColumn("_profile", F.col("twitter_id").isNotNull())
    hits = keywords.select("twitter_id", "keyword").join(known, "twitter_id")
    found = hits.groupBy("keyword").agg(
        F.count(F.lit(1)).alias("profiles_found"),
        F.avg("human_score").alias("avg_human_score"),
        count_if(F.col("human_score") > 0.7).alias("high_quality_count"),
        count_if(F.col("human_score") < 0.4).alias("low_quality_count"),
        F.coalesce(F.sum("rated"), F.lit(0)).alias("rated"),
        F.coalesce(F.sum("liked"), F.lit(0)).alias("liked"),
    )
    paging = searches.groupBy("keyword").agg(
        F.max("page").alias("pages_searched"),
        F.count(F.lit(1)).alias("pages_count"),
        F.min("query_at").alias("first_search_at"),
        F.max("query_at").alias("last_search_at"),
        F.max_by(F.struct("next_page"), "page").alias("_last"),
    )
    joined = paging.join(found, "keyword", "left")
    zero = lambda name: F.coalesce(F.col(name), F.lit(0)).alias(name)
    out = joined.select(
        "keyword",
        zero("profiles_found"),
        F.coalesce("avg_human_score", F.lit(0.0)).alias("avg_human_score"),
        F.coalesce(share(F.col("liked"), F.col("rated")), F.lit(0.0)).alias("label_rate"),
        F.col("_last.next_page").isNotNull().alias("still_valid"),
        "pages_searched",
        "pages_count",
        zero("high_quality_count"),
        zero("low_quality_count"),
        "first_search_at",
        "last_search_at",
    )
    if previous is None:
        return out.withColumn("semantic_tags", F.array().cast("array<string>"))
    tags = previous.select("keyword", "semantic_tags")
    kept = out.join(tags, "keyword", "left")
    return kept.withColumn("semantic_tags", F.coalesce("semantic_tags", F.array().cast("array<string>")))


def count_unscored(profiles: DataFrame, keywords: DataFrame, labels: DataFrame, model: str) -> DataFrame:
    """Per keyword the accounts one model has not labelled."""
    hits = keywords.select("twitter_id", "keyword").join(profiles.select("twitter_id"), "twitter_id")
    return not_labelled_by(hits, labels, model).groupBy("keyword").agg(F.count(F.lit(1)).alias("unscored"))


def count_accounts(keywords: DataFrame) -> DataFrame:
    return keywords.groupBy("keyword").agg(F.count(F.lit(1)).alias("accounts"))


def usage_totals(searches: DataFrame) -> DataFrame:
    return searches.agg(
        F.count(F.lit(1)).alias("searches"), F.sum("items").alias("items"), F.sum("new_profiles").alias("new_profiles")
    )


def usage_by_keyword(searches: DataFrame, n: int = 20) -> DataFrame:
    grouped = searches.groupBy("keyword").agg(
        F.count(F.lit(1)).alias("searches"), F.sum("items").alias("items"), F.sum("new_profiles").alias("new_profiles")
    )
    return grouped.orderBy(F.col("new_profiles").desc(), "keyword").limit(n)


def effectiveness(searches: DataFrame, as_of: str | None = None, days: int = 7) -> DataFrame:
    """Searches and new accounts per keyword, over everything or over the last days before ``as_of``."""
    rows = searches
    if as_of is not None:
        rows = rows.filter(F.col("query_at") > as_timestamp(as_of) - F.expr(f"interval {days} days"))
    return rows.groupBy("keyword").agg(
        F.count(F.lit(1)).alias("searches"),
        F.sum("new_profiles").alias("total_new"),
        F.avg("new_profiles").alias("avg_per_search"),
    )


def quota_by_platform(searches: DataFrame, as_of: str, days: int = 30) -> DataFrame:
    recent = searches.filter(F.col("query_at") > as_timestamp(as_of) - F.expr(f"interval {days} days"))
    return recent.groupBy("platform").agg(F.count(F.lit(1)).alias("searches"))


def new_by_platform(searches: DataFrame) -> DataFrame:
    return searches.groupBy("keyword", "platform").agg(F.avg("new_profiles").alias("mean_new"))


def rollup_counts(keywords: DataFrame, profiles: DataFrame) -> DataFrame:
    """Accounts and mean score at four grains: keyword, platform, class; keyword, platform; keyword; all."""
    hits = keywords.select("twitter_id", "keyword").join(
        profiles.select("twitter_id", "platform", "likely_is", "human_score"), "twitter_id"
    )
    return hits.rollup("keyword", "platform", "likely_is").agg(
        F.grouping_id().alias("grain"), F.count(F.lit(1)).alias("accounts"), F.avg("human_score").alias("mean_score")
    )


def pick_keywords(stats: DataFrame, searches: DataFrame, seed: str, n: int = 5) -> DataFrame:
    """Valid keywords with pages left, in a repeatable random order. The paging check is live: a stale
    ``still_valid`` does not let an exhausted keyword through, and a keyword never searched counts."""
    state = latest_pages(searches).select("keyword", "has_more")
    valid = stats.filter(F.col("still_valid")).select("keyword", "profiles_found")
    open_rows = valid.join(state, "keyword", "left").filter(F.coalesce("has_more", F.lit(True)))
    return open_rows.orderBy(seeded_order(seed, F.col("keyword")), "keyword").limit(n).select("keyword", "profiles_found")


def pool_for_platform(stats: DataFrame, status: DataFrame, platform: str) -> DataFrame:
    """Keywords that are still valid on one platform."""
    valid = status.filter((F.col("platform") == platform) & F.col("still_valid")).select("keyword")
    return stats.join(valid, "keyword").select("keyword")


def resume_points(searches: DataFrame, wanted: DataFrame, keys: tuple[str, ...] = ("keyword",)) -> DataFrame:
    """Next page of each wanted keyword; a fully paged keyword is refused. With ``platform`` among the ``keys`` every platform has
    pages of its own, and the last page of one neither ends nor moves another."""
    last = latest_pages(searches, keys).select(*keys, F.col("page").alias("_page"), "next_page", "has_more")
    joined = wanted.join(last, list(keys), "left")
    seen = F.col("_page").isNotNull()
    return joined.select(
        *keys,
        F.when(seen, F.col("_page") + 1).otherwise(F.lit(0)).cast("bigint").alias("page"),
        F.col("next_page").alias("cursor"),
        F.when(seen & ~F.col("has_more"), "fully_paged").otherwise("ready").alias("status"),
    )


def health(stats: DataFrame, recent: DataFrame, minimum: float = 2.0) -> DataFrame:
    """Pool report: a keyword with fewer than ``minimum`` new accounts per search is exhausted."""
    joined = stats.select("keyword", "pages_count", "profiles_found").join(
        recent.select("keyword", "avg_per_search"), "keyword", "left"
    )
    yield_ = F.coalesce("avg_per_search", F.lit(0.0))
    return joined.withColumns({"avg_per_search": yield_, "exhausted": yield_ < F.lit(minimum)})


def page_new_counts(first_seen: DataFrame, keys: list[str]) -> DataFrame:
    """New accounts per page from the first page each account was seen on."""
    return first_seen.groupBy(*keys).agg(F.count(F.lit(1)).alias("new_profiles"))


def first_seen(hits: DataFrame, order: list[Column], keep: list[str], key: str = "twitter_id") -> DataFrame:
    """First hit per account by the given order, combined on the map side."""
    return (
        hits.groupBy(key).agg(F.min_by(F.struct(*keep), F.struct(*order)).alias("f")).select(key, "f.*")
    )
