"""Joins between accounts, queue, labels, keyword hits and lists of handles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kithscope.functions.bands import LABEL_GATE, label_to_number
from kithscope.functions.numbers import seeded_order
from kithscope.functions.text import non_empty
from kithscope.operators.accounts import labelable
from kithscope.operators.ordering import first_per_key


def with_followers(profiles: DataFrame, stats: DataFrame) -> DataFrame:
    """Follower count from the counters, 0 where an account has none."""
    counters = stats.select("twitter_id", F.col("followers").alias("_followers"))
    joined = profiles.join(counters, "twitter_id", "left")
    return joined.withColumn("followers", F.coalesce("_followers", F.lit(0))).drop("_followers")


def not_labelled_by(profiles: DataFrame, labels: DataFrame, model: str) -> DataFrame:
    done = labels.filter(F.col("scored_by") == model).select("twitter_id")
    return profiles.join(done, "twitter_id", "left_anti")


def without_keyword(profiles: DataFrame, keywords: DataFrame, keyword: str) -> DataFrame:
    marked = keywords.filter(F.col("keyword") == keyword).select("twitter_id")
    return profiles.join(marked, "twitter_id", "left_anti")


def labelled_at_all(profiles: DataFrame, labels: DataFrame) -> DataFrame:
    return profiles.join(labels.select("twitter_id"), "twitter_id", "left_semi")


def keywords_of_model(keywords: DataFrame, labels: DataFrame, model: str) -> DataFrame:
    """Keyword hits of the accounts one model has labelled."""
    done = labels.filter(F.col("scored_by") == model).select("twitter_id")
    return keywords.join(done, "twitter_id", "left_semi")


def split_known(incoming: DataFrame, existing: DataFrame, key: str = "twitter_id") -> DataFrame:
    """Incoming rows with ``is_new``: one join instead of one lookup per row."""
    known = existing.select(key).distinct().withColumn("_known", F.lit(True))
    return incoming.join(known, key, "left").withColumn("is_new", F.col("_known").isNull()).drop("_known")


def by_handle(wanted: DataFrame, profiles: DataFrame, ignore_case: bool = True, how: str = "left") -> DataFrame:
    """Accounts by handle. ``wanted`` brings ``handle``; its spelling is kept as ``wanted_handle``."""
    fold = F.lower if ignore_case else (lambda c: c)
    left = wanted.withColumnRenamed("handle", "wanted_handle").withColumn("_key", fold(F.col("wanted_handle")))
    right = profiles.withColumn("_key", fold(F.col("handle")))
    return left.join(right, "_key", how).drop("_key")


def in_list_order(wanted: DataFrame, profiles: DataFrame) -> DataFrame:
    """Ordered handle list (``ord``, ``handle``) with ``found``; sort by ``ord`` to get the list back."""
    joined = by_handle(wanted, profiles)
    return joined.withColumn("found", F.col("twitter_id").isNotNull())


def batch_labels(batches: DataFrame, labels: DataFrame, *more_keys: str) -> DataFrame:
    """Batch profiles with the label of the same batch; the last label of a repeated handle wins.

    With ``more_keys`` (a model, say) of ``labels`` there is one row per value of them, which is in the result.
    """
    keyed = labels.withColumn("_key", F.lower("handle"))
    last = keyed.groupBy("batch_no", *more_keys, "_key").agg(
        F.max_by(F.struct("label", "reason"), "pos").alias("_last")
    )
    left = batches.withColumn("_key", F.lower("handle"))
    joined = left.join(last, ["batch_no", "_key"])
    return joined.select(*batches.columns, *more_keys, F.col("_last.label").alias("label"), F.col("_last.reason").alias("reason"))


def without_batched(handles: DataFrame, batches: DataFrame) -> DataFrame:
    done = batches.select(F.lower("handle").alias("_key"))
    return handles.withColumn("_key", F.lower("handle")).join(done, "_key", "left_anti").drop("_key")


def label_pairs(labels: DataFrame) -> DataFrame:
    """Every pair of models that labelled the same account, numeric labels side by side.

    A self join on the account id: an account has at most one label per model, so the pairs of one
    account are bounded by the number of models squared.
    """
    numbered = labels.select("twitter_id", F.col("scored_by"), label_to_number(F.col("label")).alias("llm"))
    a = numbered.withColumnsRenamed({"scored_by": "model_a", "llm": "llm_a"})
    b = numbered.withColumnsRenamed({"scored_by": "model_b", "llm": "llm_b"})
    return a.join(b, "twitter_id").filter(F.col("model_a") < F.col("model_b"))


def disagreements(labels: DataFrame, prefix_a: str, prefix_b: str, gap: float = 0.3) -> DataFrame:
    """Accounts on which two model families differ by more than ``gap``, largest first."""
    numbered = labels.select("twitter_id", "scored_by", label_to_number(F.col("label")).alias("llm"))
    a = numbered.filter(F.col("scored_by").startswith(prefix_a)).withColumnsRenamed({"scored_by": "model_a", "llm": "llm_a"})
    b = numbered.filter(F.col("scored_by").startswith(prefix_b)).withColumnsRenamed({"scored_by": "model_b", "llm": "llm_b"})
    joined = a.join(b, "twitter_id").withColumn("disagreement", F.abs(F.col("llm_a") - F.col("llm_b")))
    return joined.filter(F.col("disagreement") > gap).orderBy(F.col("disagreement").desc(), "twitter_id")


WORK_COLUMNS = ["twitter_id", "handle", "name", "bio", "category", "followers"]


def label_work_list(
    profiles: DataFrame, stats: DataFrame, queue: DataFrame, labels: DataFrame, model: str,
    threshold: float = LABEL_GATE, seed: str = "0", limit: int | None = 25, oldest_first: bool = False,
) -> DataFrame:
    """Queued accounts one model has still to label, in a repeatable random order or oldest first."""
    added = queue.select("twitter_id", "added_at")
    open_rows = not_labelled_by(labelable(profiles.filter(F.col("human_score") > threshold)), labels, model)
    joined = with_followers(open_rows.join(added, "twitter_id"), stats)
    order: list[Column] = [F.col("added_at"), F.col("twitter_id")] if oldest_first else [
        seeded_order(seed, F.col("twitter_id")), F.col("twitter_id")]
    picked = joined if limit is None else joined.orderBy(*order).limit(limit)
    return picked.select(*WORK_COLUMNS)


def keyword_work_list(
    profiles: DataFrame, stats: DataFrame, keywords: DataFrame, labels: DataFrame, keyword: str,
    model: str | None = None, seed: str = "0", limit: int | None = 100,
) -> DataFrame:
    """Accounts of a keyword with a bio: those ``model`` has not labelled, or all without a model."""
    hits = keywords.filter(F.col("keyword") == keyword).select("twitter_id")
    rows = profiles.filter(non_empty(F.col("bio"))).join(hits, "twitter_id")
    if model is not None:
        rows = not_labelled_by(rows, labels, model)
    if limit is not None:
        rows = rows.orderBy(seeded_order(seed, F.col("twitter_id")), "twitter_id").limit(limit)
    full = with_followers(rows, stats)
    return full.select(*WORK_COLUMNS[:2], F.coalesce("name", F.lit("")).alias("name"), *WORK_COLUMNS[3:])


def labels_for_handles(wanted: DataFrame, profiles: DataFrame, labels: DataFrame, pattern: str) -> DataFrame:
    """Labels of models matching a LIKE pattern for a list of handles, with the list order in ``ord``."""
    matching = labels.filter(F.col("scored_by").like(pattern)).select("twitter_id", "scored_by", "label", "reason")
    found = by_handle(wanted, profiles.select("twitter_id", "handle"), how="inner").join(matching, "twitter_id")
    return first_per_key(found, ["ord"], [F.col("scored_by")])
