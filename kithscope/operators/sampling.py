"""Repeatable samples, fixed-size batches and splits.

Random order is always an md5 over the key and a seed, so a sample is the same on every run and on
every retry of a lost task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kithscope.functions.numbers import row_count, seeded_order, unit_hash
from kithscope.operators.accounts import labelable
from kithscope.operators.lookups import with_followers, without_keyword
from kithscope.operators.ordering import bottom_k, first_per_key, global_row_number
from kithscope.session import scratch_path


def random_sample(df: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """``n`` rows in the order of md5; ``key`` is unique. A sample of any size leaves its rows where they are."""
    return bottom_k(df, seeded_order(seed, F.col(key)), key, n)


def stratified_sample(
    labels: DataFrame, profiles: DataFrame, stats: DataFrame, total: int = 600, true_share: float = 0.3, seed: str = "0"
) -> DataFrame:
    """Accounts labelled true against the others, one row per account inside each stratum.

    An account may be in both strata. Missing true rows are filled from the other stratum, so that one is sized by a count
    of the first. Neither is ever gathered: both are cut off by :func:`bottom_k`.
    """
    usable = labelable(profiles).select("twitter_id", "handle", "name", "bio", "category")
    # Chosen by narrow rows, written once: the texts are joined to those that are picked.
    narrow = labels.select("twitter_id", "scored_by", "label", "reason").join(usable.select("twitter_id").distinct(), "twitter_id", "left_semi")
    path = scratch_path(labels.sparkSession, "strata")
    narrow.write.parquet(path)
    joined = labels.sparkSession.read.schema(narrow.schema).parquet(path)
    order = seeded_order(seed, F.col("twitter_id"), F.col("scored_by"))

    def stratum(rows: DataFrame, name: str) -> DataFrame:
        return first_per_key(rows, ["twitter_id"], [order, F.col("scored_by")]).withColumn("stratum", F.lit(name))

    good = stratum(joined.filter(F.col("label")), "true")
    rest = stratum(joined.filter(F.col("label").isNull() | ~F.col("label")), "other")
    n_true = min(int(total * true_share), good.count())
    picked = random_sample(good, "twitter_id", n_true, f"{seed}true").unionByName(random_sample(rest, "twitter_id", total - n_true, f"{seed}other"))
    accounts = first_per_key(usable, ["twitter_id"], [F.col("handle")])
    full = picked.join(accounts, "twitter_id").select("twitter_id", "label", "reason", *accounts.columns[1:], "stratum")
    return with_followers(full, stats)


def hand_pick(
    labels: DataFrame, profiles: DataFrame, stats: DataFrame, keywords: DataFrame, curated: str, n: int = 600,
    seed: str | None = None,
) -> DataFrame:
    """Labelled accounts with a bio that are not curated, one per handle. Without a seed the first
    ``n`` by handle are taken; with one it is a true sample."""
    usable = profiles.filter(F.col("bio").isNotNull() & (F.col("bio") != ""))
    rows = usable.join(labels.select("twitter_id"), "twitter_id", "left_semi")
    rows = first_per_key(without_keyword(rows, keywords, curated), ["handle"], [F.col("twitter_id")])
    order = F.col("handle") if seed is None else seeded_order(seed, F.col("handle"))
    picked = bottom_k(rows, order, "handle", n)
    return with_followers(picked, stats).select("twitter_id", "handle", "name", "bio", "category", "followers")


ROWS_PER_SHARD = 200_000


def shard_count(df: DataFrame, rows_per_shard: int = ROWS_PER_SHARD) -> int:
    return max(1, -(-df.count() // rows_per_shard))


def sharded_batches(df: DataFrame, key: str, size: int, shards: int | None = None, rows_per_shard: int = ROWS_PER_SHARD) -> DataFrame:
    """Batches of at most ``size`` rows without any global order.

    Rows go by the md5 of their unique key into shards and are numbered inside a shard, so the shards - and not one task - do the
    numbering. Without ``shards`` their number follows from a count of the rows, so that one holds about ``rows_per_shard``.
    """
    shards = shards or shard_count(df, rows_per_shard)
    shard = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("bigint") % F.lit(shards)
    placed = df.withColumn("shard", shard)
    within = Window.partitionBy("shard").orderBy(key)
    number = F.floor((F.row_number().over(within) - 1) / size)
    return placed.withColumns({"batch_no": number, "position": ((F.row_number().over(within) - 1) % size).cast("bigint")})


def numbered_batches(df: DataFrame, order: list[Column], size: int, first: int = 1) -> DataFrame:
    """Batches of ``size`` rows in the given total order, numbered from ``first``."""
    ranked = global_row_number(df, order, name="_rn")
    batch = (F.floor((F.col("_rn") - 1) / size) + first).cast("bigint")
    place = ((F.col("_rn") - 1) % size).cast("bigint")
    return ranked.withColumns({"batch": batch, "position": place}).drop("_rn")


# Share of runs each labeler takes part in, and its batch size.
MODEL_GATES = [("meta-maverick-17b", 0.8, 25), ("claude-haiku-4.5", 0.7, 25), ("gemini-flash-2.0", 0.4, 15)]


def model_gate(runs: DataFrame, gates=MODEL_GATES) -> DataFrame:
    """Which labelers take part in which run (column ``run_id``); a repeated run decides the same."""
    options = F.array(*[
        F.struct(F.lit(m).alias("model"), F.lit(p).alias("probability"), F.lit(b).alias("batch_size")) for m, p, b in gates
    ])
    tried = runs.select("run_id", F.inline(options))
    return tried.withColumn("takes_part", unit_hash(F.col("model"), F.col("run_id")) < F.col("probability"))


def split_by_class(rows: DataFrame, key: str, seed: str, train: float = 0.8) -> DataFrame:
    """Repeatable split into train and test inside every class: the hash of a row decides, not its place."""
    return rows.withColumn("part", F.when(unit_hash(F.col(key), F.lit(seed)) < F.lit(train), "train").otherwise("test"))


def with_folds(rows: DataFrame, key: str, label: str, k: int, seed: str) -> DataFrame:
    """``fold`` of 0 to k - 1 by the hash of key and class: every class falls into all folds evenly, and a row keeps its fold."""
    return rows.withColumn("fold", F.floor(unit_hash(F.col(key), F.col(label), F.lit(seed)) * k).cast("int"))


def balance_classes(rows: DataFrame, key: str, label: str, seed: str, true_share: float = 0.3) -> DataFrame:
    """Thin the larger class by hash so that true rows make up about ``true_share``.

    The class counts are one row; each row is kept or not by its own hash, so nothing is sorted.
    """
    counts = rows.agg(F.count(F.when(F.col(label), 1)).alias("t"), F.count(F.when(~F.col(label), 1)).alias("f")).first()
    wanted = counts["t"] * (1 - true_share) / true_share
    keep_true = min(1.0, counts["f"] / wanted) if wanted else 1.0
    keep_false = min(1.0, wanted / counts["f"]) if counts["f"] else 1.0
    keep = F.when(F.col(label), F.lit(keep_true)).when(~F.col(label), F.lit(keep_false))
    return rows.filter(unit_hash(F.col(key), F.lit(seed)) < keep)


def out_of_domain(keywords: DataFrame, profiles: DataFrame, foreign: list[str], n: int, seed: str) -> DataFrame:
    """Accounts found by foreign keywords only, as certain negatives."""
    hit = keywords.filter(F.col("keyword").isin(foreign)).select("twitter_id").distinct()
    other = keywords.filter(~F.col("keyword").isin(foreign)).select("twitter_id")
    only = hit.join(other, "twitter_id", "left_anti")
    picked = random_sample(profiles.join(only, "twitter_id"), "twitter_id", n, seed)
    return picked.withColumn("label", F.lit(False))
