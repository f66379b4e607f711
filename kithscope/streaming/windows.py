"""Streams of keyword hits: first-seen counting, duplicate removal, yield per time window."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from kithscope.functions.numbers import count_if, row_count

HIT = "twitter_id string, keyword string, seen_at timestamp, seq bigint"


def drop_repeats(hits: DataFrame, at: str, delay: str = "7 days") -> DataFrame:
    """Each (account, keyword) once within the watermark; the merge stays the exact backstop."""
    return hits.withWatermark(at, delay).dropDuplicatesWithinWatermark(["twitter_id", "keyword"])


def first_seen_stream(hits: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """The first hit of each account the stream has not seen before.

    ``hits``: twitter_id, keyword, seen_at, seq. State is one flag per account; with ``ttl_ms`` the flag
    goes after that long without a hit, and the profile table then decides whether the account is new.
    Within one micro-batch the earliest hit counts. Before the shuffle every Arrow batch keeps one row
    per account, so an account with a large share of all hits sends only a few rows to its task.
    """

    def thin(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.sort_values(["seen_at", "seq"]).drop_duplicates("twitter_id")

    def decide(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        known, best = state.exists, None
        for frame in frames:
            if known:
                continue
            at, seq = frame["seen_at"].to_numpy(), frame["seq"].to_numpy()
            row = np.lexsort((seq, at))[0]
            found = (at[row], seq[row], frame["keyword"].iat[row])
            best = found if best is None or found < best else best
        if ttl_ms is not None:
            state.setTimeoutDuration(ttl_ms)
        if best is not None:
            state.update((True,))
            first = {"twitter_id": key[0], "keyword": best[2], "seen_at": best[0], "seq": best[1]}
            yield pd.DataFrame([first])

    timeout = GroupStateTimeout.NoTimeout if ttl_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    thinned = hits.select("twitter_id", "keyword", "seen_at", "seq").mapInPandas(thin, HIT)
    return thinned.groupBy("twitter_id").applyInPandasWithState(decide, HIT, "seen boolean", "append", timeout)


def first_seen_sessions(hits: DataFrame, ttl: str, delay: str = "1 day") -> DataFrame:
    """The first hit of each account that had none for ``ttl`` before it.

    An account's hits form a session that ends ``ttl`` after the last of them; the earliest hit by (seen_at, seq) is given out when
    the watermark passes that end, and the account's state goes with it. State holds the accounts seen within ``ttl`` and ``delay``,
    however long the stream runs, and a hit may come in any order within ``delay``. All of it is Spark's own: no Python per account.
    """
    session = F.session_window("seen_at", ttl)
    first = F.min_by(F.struct("keyword", "seen_at", "seq"), F.struct("seen_at", "seq"))
    grouped = hits.withWatermark("seen_at", delay).groupBy(session.alias("s"), "twitter_id").agg(first.alias("f"), row_count().alias("hits"))
    return grouped.select("twitter_id", "f.keyword", "f.seen_at", "f.seq", "hits", F.col("s.end").alias("until"))


FIRST_BUCKETS = 64


def follow_firsts(hits: DataFrame, path: str, checkpoint: str, buckets: int = FIRST_BUCKETS):
    """First hit of each account as a table below ``path``, from a stream of ``hits``, without any Python per account.

    Each micro-batch takes the earliest hit per account (map-side combined) and adds those that are earlier than what is stored: a hit
    that comes late replaces a stored later one, so :func:`read_firsts` gives the same rows in whatever order files arrive. Only the buckets
    of the batch's accounts are read. The folder of a batch is overwritten, and only folders of smaller batches
    count as stored, so a repeated batch gives the same rows.
    """

    def keep(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        bucket = F.pmod(F.xxhash64("twitter_id"), F.lit(buckets)).cast("int")
        rest = F.struct("keyword", "seen_at", "seq")
        first = batch.groupBy("twitter_id").agg(F.min_by(rest, F.struct("seen_at", "seq")).alias("r")).select("twitter_id", "r.*")
        first = first.withColumn("bucket", bucket)
        try:
            # One small integer per bucket comes back.
            touched = [r.bucket for r in first.select("bucket").distinct().collect()]
            stored = spark.read.schema(STORED_HIT).parquet(path).filter((F.col("batch_id") < batch_id) & F.col("bucket").isin(touched))
            known = stored.groupBy("twitter_id").agg(F.min(F.struct("seen_at", "seq")).alias("known"))
            first = first.join(known, "twitter_id", "left").filter(F.col("known").isNull() | (F.struct("seen_at", "seq") < F.col("known"))).drop("known")
        except AnalysisException:  # nothing stored yet
            pass
        first.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/batch_id={batch_id}")

    return hits.writeStream.option("checkpointLocation", checkpoint).foreachBatch(keep)


STORED_HIT = f"{HIT}, batch_id bigint, bucket int"


def read_firsts(spark: SparkSession, path: str) -> DataFrame:
    """The earliest stored hit of each account."""
    rows = spark.read.schema(STORED_HIT).parquet(path)
    first = F.min_by(F.struct("keyword", "seen_at", "seq"), F.struct("seen_at", "seq")).alias("r")
    return rows.groupBy("twitter_id").agg(first).select("twitter_id", "r.*")


def yield_by_window(searches: DataFrame, length: str = "7 days", slide: str = "1 day", delay: str = "1 day") -> DataFrame:
    """New accounts per keyword and event-time window; a window is given out when the watermark passes it."""
    window = F.window("query_at", length, slide)
    grouped = searches.withWatermark("query_at", delay).groupBy(window.alias("w"), "keyword")
    return grouped.agg(row_count().alias("searches"), F.sum("new_profiles").alias("new_profiles")).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "keyword", "searches", "new_profiles"
    )


MARK = "batch_id bigint, newest timestamp, n_rows bigint, n_late bigint"
PARTIAL = "window_start timestamp, window_end timestamp, keyword string, searches bigint, new_profiles bigint, batch_id bigint"


def follow_yield(searches: DataFrame, path: str, checkpoint: str, length: str = "7 days", slide: str = "1 day", delay: str = "1 day"):
    """New accounts per keyword and event-time window as a table, and every late row in a side table.

    The watermark of a micro-batch is the newest ``query_at`` of all earlier ones less ``delay``. Rows at or after it are summed per window and
    keyword; a row before it may belong to windows already given out, so it counts in none and goes to ``late`` whole. What a
    batch writes lies in folders of its number, and its watermark depends on smaller numbers only: a repeated batch changes nothing.
    """

    def keep(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        limit = watermark(spark, path, delay, batch_id)
        late = F.lit(False) if limit is None else F.coalesce(F.col("query_at") < F.lit(limit), F.lit(True))
        marked = batch.withColumn("_late", F.col("query_at").isNull() | late)
        marked.filter("_late").drop("_late").write.mode("overwrite").parquet(f"{path}/late/batch_id={batch_id}")
        on_time = marked.filter(~F.col("_late"))
        window = F.window("query_at", length, slide)
        sums = on_time.groupBy(window.alias("w"), "keyword").agg(row_count().alias("searches"), F.sum("new_profiles").alias("new_profiles"))
        sums = sums.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "keyword", "searches", "new_profiles")
        sums.write.mode("overwrite").parquet(f"{path}/sums/batch_id={batch_id}")
        # The mark goes last: a batch that broke off before has none.
        mark = marked.agg(F.max(F.when(~F.col("_late"), F.col("query_at"))).alias("newest"), row_count().alias("n_rows"), count_if(F.col("_late")).alias("n_late"))
        mark.write.mode("overwrite").parquet(f"{path}/marks/batch_id={batch_id}")

    return searches.writeStream.option("checkpointLocation", checkpoint).foreachBatch(keep)


def watermark(spark: SparkSession, path: str, delay: str, before: int | None = None):
    """Newest time of the batches before ``before`` (or of all) less ``delay``; None while there is none. One row per batch is read."""
    try:
        marks = spark.read.schema(MARK).parquet(f"{path}/marks")
    except AnalysisException:
        return None
    if before is not None:
        marks = marks.filter(F.col("batch_id") < before)
    return marks.agg((F.max("newest") - F.expr(f"interval {delay}")).alias("limit")).first()["limit"]


def read_yield(spark: SparkSession, path: str, delay: str = "1 day") -> DataFrame:
    """All windows so far; ``closed`` ones can change no more."""
    sums = spark.read.schema(PARTIAL).parquet(f"{path}/sums")
    grouped = sums.groupBy("window_start", "window_end", "keyword").agg(F.sum("searches").alias("searches"), F.sum("new_profiles").alias("new_profiles"))
    limit = watermark(spark, path, delay)
    return grouped.withColumn("closed", F.lit(False) if limit is None else F.col("window_end") <= F.lit(limit))


def read_late(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(f"{schema}, batch_id bigint").parquet(f"{path}/late")
