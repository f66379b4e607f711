"""Jobs that keep the stored tables up to date between ingests: labels, keyword statistics, curated accounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kithscope.operators.keywords import keyword_stats
from kithscope.operators.merges import load_curated, upsert_keyword_stats
from kithscope.session import scratch_path
from kithscope.streaming.ingest import Store

LABEL_KEYS = ["twitter_id", "scored_by"]


def save_labels(store: Store, fresh: DataFrame, tag: str | None = None, again: bool = False) -> int:
    """Labels into ``profile_scores``: the first of an account and model stays, or the latest wins if ``again``.

    Every label that takes effect goes to the append-only log first, so that the log of a run that broke off is complete when it is repeated.
    """
    if tag is not None and store.label_log.applied(tag) and store.labels.applied(tag):
        return store.labels.version()
    at = F.col("scored_at")
    fresh = fresh.select(*store.labels.columns())
    if again or store.labels.version():
        fresh = _kept(store, fresh)
    if again:
        store.label_log.insert(fresh, at, tag)
        return store.labels.replace(fresh, at, tag)
    new = _kept(store, store.labels.absent(fresh, at))
    store.label_log.insert(new, at, tag)
    return store.labels.insert(new, at, tag)


def _kept(store: Store, rows: DataFrame) -> DataFrame:
    """Rows written once, for merges that look at them several times."""
    path = scratch_path(store.spark, "fresh")
    rows.write.parquet(path)
    return store.spark.read.schema(rows.schema).parquet(path)


def refresh_keyword_stats(store: Store, at: Column, tag: str | None = None) -> int:
    """Statistics of all searched keywords from the stored tables; known keywords keep their tags."""
    scores = store.profiles.read().select("twitter_id", "human_score", "likely_is")
    fresh = keyword_stats(store.searches.read(), store.keywords.read(), scores, store.labels.read())
    columns = store.keyword_stats.columns()
    fresh = fresh.withColumns({"semantic_tags": F.array().cast("array<string>"), "updated_at": at}).select(*columns)
    # A merge looks at its rows three times.
    path = scratch_path(store.spark, "keyword-stats")
    fresh.write.parquet(path)
    return store.keyword_stats.merge(store.spark.read.schema(fresh.schema).parquet(path), upsert_keyword_stats, tag)


def save_curated(store: Store, handles: DataFrame, curated: str, at: Column, tag: str | None = None) -> DataFrame:
    """Tags and queues the found accounts whatever their score; returns one result row per wanted handle."""
    profiles = store.profiles.read().withColumnRenamed("follower_count", "followers")
    result = load_curated(handles, profiles, curated)
    if tag is not None and store.keywords.applied(tag) and store.queue.applied(tag):
        return result
    found = result.filter(F.col("status") == "success").join(profiles.select("twitter_id", "handle"), "twitter_id")
    found = _kept(store, found.select("twitter_id", "handle", "keyword"))
    words = found.select("twitter_id", "keyword", F.lit(None).cast("string").alias("search_id"), at.alias("added_at")).distinct()
    store.keywords.insert(words, F.col("added_at"), tag)
    queued = found.select("twitter_id", "handle", at.alias("added_at")).distinct()
    store.queue.insert(queued, F.col("added_at"), tag)
    return result
