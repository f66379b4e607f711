"""Merges of incoming rows into stored tables, as pure functions of two DataFrames.

Parquet has no MERGE, so a merge gives the complete new state of the rows it is shown. Several incoming
rows for one key are resolved first. ``sources.snapshots`` applies these to the touched buckets only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kithscope.functions.bands import LABEL_GATE
from kithscope.functions.numbers import count_if, row_count
from kithscope.operators.lookups import by_handle


def latest(rows: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """Last row per key, combined on the map side. A row without order counts as the first."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(order.isNotNull(), order)).alias("_r")).select(*keys, "_r.*").select(*rows.columns)


def earliest(rows: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """First row per key, combined on the map side. A row without order counts as the last."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(order.isNull(), order)).alias("_r")).select(*keys, "_r.*").select(*rows.columns)


def append_once(existing: Column, added: Column) -> Column:
    """Array with the new elements that were not in it; a missing array counts as empty."""
    empty = F.array().cast("array<string>")
    return F.array_union(F.coalesce(existing, empty), F.coalesce(added, empty))


def upsert_profiles(stored: DataFrame, incoming: DataFrame, refresh: bool = False) -> DataFrame:
    """New accounts are added. A known account keeps its fields: only ``updated_at`` and the keyword
    array change, unless ``refresh`` asks for the fields of the latest incoming row.

    ``incoming`` has the columns of ``stored`` with ``keyword`` in place of ``got_by_keywords``.
    """
    fields = [c for c in stored.columns if c not in ("twitter_id", "got_by_keywords", "updated_at")]
    words = F.array_sort(F.collect_set("keyword"))
    pick = F.max_by if refresh else F.min_by
    resolved = incoming.groupBy("twitter_id").agg(
        pick(F.struct(*fields), F.struct("updated_at", "keyword")).alias("_new"),
        words.alias("_words"),
        F.max("updated_at").alias("_at"),
    )
    old = stored.select("twitter_id", F.struct(*fields).alias("_old"), "got_by_keywords", "updated_at")
    joined = old.join(resolved, "twitter_id", "full")
    known, seen = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    row = F.when(known & seen, F.col("_new") if refresh else F.col("_old")).otherwise(F.coalesce("_old", "_new"))
    merged = joined.select(
        "twitter_id",
        row.alias("_row"),
        F.when(seen, append_once(F.col("got_by_keywords"), F.col("_words")))
        .otherwise(F.col("got_by_keywords"))
        .alias("got_by_keywords"),
        F.coalesce("_at", "updated_at").alias("updated_at"),
    )
    return merged.select("twitter_id", "_row.*", "got_by_keywords", "updated_at").select(*stored.columns)


def upsert_latest(stored: DataFrame, incoming: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Full replace: per key the incoming row wins, the latest of several by ``order``."""
    fresh = latest(incoming.select(*stored.columns), keys, F.col(order))
    return stored.join(fresh.select(*keys), keys, "left_anti").unionByName(fresh)


def insert_absent(stored: DataFrame, incoming: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """Only keys not stored yet are added, the earliest incoming row of each."""
    new = incoming.select(*stored.columns).join(stored.select(*keys), keys, "left_anti")
    return stored.unionByName(earliest(new, keys, order))


def insert_counts(stored: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Rows a first-wins insert adds and skips; a repeat inside the batch is skipped as well."""
    known = stored.select(*keys, F.lit(True).alias("_known"))
    per_key = incoming.groupBy(*keys).agg(row_count().alias("_n")).join(known, keys, "left")
    added = count_if(F.col("_known").isNull())
    return per_key.agg(added.alias("labeled"), (F.coalesce(F.sum("_n"), F.lit(0)) - added).alias("skipped"))


def upsert_counts(stored: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Keys an upsert inserts and updates."""
    known = stored.select(*keys, F.lit(True).alias("_known"))
    per_key = incoming.select(*keys).distinct().join(known, keys, "left")
    return per_key.agg(
        count_if(F.col("_known").isNull()).alias("inserted"), count_if(F.col("_known").isNotNull()).alias("updated")
    )


def upsert_keyword_stats(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Statistics are replaced, tags stay. Both rates are stored with three decimals."""
    stats = fresh.withColumns({c: F.col(c).cast("decimal(4,3)") for c in ("avg_human_score", "label_rate")})
    tags = stored.select("keyword", F.col("semantic_tags").alias("_tags"), F.lit(True).alias("_known"))
    joined = stats.join(tags, "keyword", "left")
    kept = joined.withColumn("semantic_tags", F.when(F.col("_known"), F.col("_tags")).otherwise(F.col("semantic_tags")))
    untouched = stored.join(fresh.select("keyword"), "keyword", "left_anti")
    return untouched.unionByName(kept.select(*stored.columns))


def add_keywords(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """A new keyword starts valid; a known one only takes the new tags. ``incoming``: keyword, new_tags."""
    marked = stored.withColumn("_known", F.lit(True))
    joined = marked.join(incoming.withColumn("_given", F.lit(True)), "keyword", "full")
    return joined.withColumns(
        {
            "semantic_tags": F.when(F.col("_given"), F.col("new_tags")).otherwise(F.col("semantic_tags")),
            "still_valid": F.when(F.col("_known"), F.col("still_valid")).otherwise(F.lit(True)),
        }
    ).select(*stored.columns)


def load_curated(handles: DataFrame, profiles: DataFrame, curated: str) -> DataFrame:
    """Result row per wanted handle. Found accounts are to be tagged and queued whatever their score."""
    found = by_handle(handles, profiles.select("twitter_id", "handle", "human_score", "likely_is", "followers"))
    ok = F.col("twitter_id").isNotNull()
    return found.select(
        "wanted_handle",
        "twitter_id",
        F.coalesce("human_score", F.lit(0.0)).alias("human_score"),
        F.coalesce("likely_is", F.lit("-")).alias("likely_is"),
        "followers",
        F.when(ok, F.lit(curated)).alias("keyword"),
        F.when(ok, "success").otherwise("not_found").alias("status"),
    )


def curated_totals(result: DataFrame) -> DataFrame:
    return result.agg(
        row_count().alias("total"), count_if(F.col("status") == "success").alias("success"),
        count_if(F.col("human_score") > LABEL_GATE).alias("humans"),
    )
