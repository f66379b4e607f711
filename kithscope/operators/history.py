"""Labels over time: when each was valid, and which one held at a given moment.

The log holds one row per change and is never rewritten; a row's time is unique for its keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

LABEL_KEYS = ["twitter_id", "scored_by"]


def validity(log: DataFrame, keys: list[str], at: str) -> DataFrame:
    """Each row with ``valid_from`` and ``valid_to``, the time of the next row of its keys (null for the last)."""
    later = Window.partitionBy(*keys).orderBy(at)
    return log.withColumns({"valid_from": F.col(at), "valid_to": F.lead(at).over(later)})


def held_at(log: DataFrame, times: list[Column], keys: list[str], at: str) -> DataFrame:
    """The row of every key that held at each of a few given times, in one pass and combined map-side: no row is moved but the winners."""
    rest = F.struct(*[c for c in log.columns if c not in keys])
    winners = [F.max_by(rest, F.when(F.col(at) <= t, F.col(at))).alias(f"_{i}") for i, t in enumerate(times)]
    found = log.groupBy(*keys).agg(*winners)
    asked = F.array(*[F.struct(t.alias("asked_at"), F.col(f"_{i}").alias("row")) for i, t in enumerate(times)])
    return found.select(*keys, F.inline(asked)).filter(F.col("row").isNotNull()).select(*keys, "asked_at", "row.*")


def as_of(requests: DataFrame, log: DataFrame, keys: list[str], asked: str, at: str) -> DataFrame:
    """Every request with the fields of the log row of its keys that held at its time; null fields where none did.

    Both sides are laid in one order of time per key and the last log row is carried along: one shuffle, a sort that spills, and no
    comparison of each request with each row.
    """
    fields = [c for c in log.columns if c not in keys]
    more = [c for c in requests.columns if c not in (*keys, asked)]
    left = requests.select(*keys, F.col(asked).alias("_at"), F.lit(1).alias("_kind"), F.struct(F.lit(True).alias("_own"), *more).alias("_request"))
    right = log.select(*keys, F.col(at).alias("_at"), F.lit(0).alias("_kind"), F.struct(*fields).alias("_row"))
    both = left.unionByName(right, allowMissingColumns=True)
    so_far = Window.partitionBy(*keys).orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = both.withColumn("_held", F.last("_row", ignorenulls=True).over(so_far)).filter("_kind = 1")
    # Keys and time stand beside the request and are not carried in it again.
    own = {**{k: F.col(k) for k in keys}, asked: F.col("_at").alias(asked)}
    return carried.select(*(own.get(c, F.col(f"_request.`{c}`")) for c in requests.columns), "_held.*")
