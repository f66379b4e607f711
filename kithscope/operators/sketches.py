"""Small summaries per group and day that can be stored and united later: distinct accounts and quantiles of a value.

Error, whatever the number of rows: distinct accounts within 5 % (three standard deviations of 2^12 registers), and a quantile's
rank within 3 % of all rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kithscope.functions.numbers import row_count

REGISTER_BITS = 12
COUNT_ERROR = 0.05
RANK_ERROR = 0.03


def daily_sketches(rows: DataFrame, keys: list[str], day: str, account: str, value: str) -> DataFrame:
    """One row of a few kilobytes per group and day, combined map-side; null values and accounts count nowhere."""
    return rows.groupBy(*keys, day).agg(
        row_count().alias("n"), F.count(value).alias("n_values"), F.hll_sketch_agg(account, REGISTER_BITS).alias("accounts"),
        F.kll_sketch_agg_double(F.col(value).cast("double")).alias("values"),
    )


def united(sketches: DataFrame, keys: list[str], quantile: float = 0.5) -> DataFrame:
    """Rows, accounts and a quantile per group over all sketches given, from any range of days."""
    merged = sketches.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.sum("n_values").alias("n_values"), F.hll_union_agg("accounts").alias("accounts"),
        F.kll_merge_agg_double(F.when(F.col("n_values") > 0, F.col("values"))).alias("values"),
    )
    at = F.when(F.col("n_values") > 0, F.kll_sketch_get_quantile_double("values", F.lit(quantile)))
    return merged.select(*keys, "n", F.hll_sketch_estimate("accounts").alias("accounts"), at.alias("quantile"))


def close_count(estimate: Column, exact: Column) -> Column:
    return F.abs(estimate - exact) <= F.lit(COUNT_ERROR) * exact + 1


def close_rank(below: Column, up_to: Column, n: Column, quantile: float = 0.5) -> Column:
    """Whether a value that ``below`` of ``n`` rows are under and ``up_to`` are not over is near enough to the quantile."""
    return (below / n <= F.lit(quantile + RANK_ERROR)) & (up_to / n >= F.lit(quantile - RANK_ERROR))
