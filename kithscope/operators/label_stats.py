"""Statistics over numeric labels: by model, by pair of models, by keyword, over time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kithscope.functions.bands import (
    correlation_strength,
    label_score_bucket,
    label_to_number,
    score_bucket,
)
from kithscope.functions.numbers import count_if, pearson, row_count
from kithscope.operators.lookups import label_pairs
from kithscope.operators.ordering import rolling_mean


def numbered_labels(labels: DataFrame, profiles: DataFrame) -> DataFrame:
    """Labels as numbers next to the heuristic score of the account."""
    heuristic = profiles.select("twitter_id", F.col("human_score").alias("has"))
    return labels.withColumn("llm", label_to_number(F.col("label"))).join(heuristic, "twitter_id")


def five_numbers(x: Column) -> list[Column]:
    """Quartiles by exact percentile. Its buffer maps distinct values to counts, and scores have four
    decimals, so the buffer is bounded however many rows there are."""
    q = F.percentile(x, F.array(*[F.lit(p) for p in (0.0, 0.25, 0.5, 0.75, 1.0)]))
    return [q[i].alias(name) for i, name in enumerate(("minimum", "q1", "median", "q3", "maximum"))]


def describe(scores: DataFrame, column: str = "human_score") -> DataFrame:
    x = F.col(column)
    return scores.agg(
        F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), *five_numbers(x)
    )


def overview(profiles: DataFrame, queue: DataFrame, stats: DataFrame) -> DataFrame:
    """Totals, queue length and means as (name, value) rows."""
    a = profiles.agg(row_count().cast("double").alias("profiles"), F.avg("human_score").alias("mean_human_score"))
    b = queue.agg(row_count().cast("double").alias("pending"))
    c = stats.agg(
        row_count().cast("double").alias("with_stats"), F.avg("followers").alias("mean_followers"),
        F.avg("following").alias("mean_following"), F.avg("statuses").alias("mean_statuses"),
    )
    parts = [df.unpivot([], df.columns, "name", "value") for df in (a, b, c)]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def bucket_counts(profiles: DataFrame) -> DataFrame:
    scored = profiles.filter(F.col("human_score").isNotNull())
    return scored.groupBy(score_bucket(F.col("human_score")).alias("bucket")).agg(row_count().alias("n"))


def by_model(numbered: DataFrame) -> DataFrame:
    """Distribution of labels and correlation with the heuristic, per model."""
    x = F.col("llm")
    return numbered.groupBy("scored_by").agg(
        row_count().alias("n"), F.avg(x).alias("mean"), F.percentile(x, F.lit(0.5)).alias("median"),
        F.stddev_samp(x).alias("std"), F.min(x).alias("minimum"), F.max(x).alias("maximum"),
        F.avg("has").alias("mean_has"), count_if(x >= 0.7).alias("high"),
        count_if((x >= 0.4) & (x < 0.7)).alias("medium"), count_if(x < 0.4).alias("low"),
        pearson(x, F.col("has")).alias("correlation"),
    )


def agreement(labels: DataFrame) -> DataFrame:
    """Overlap, correlation and mean absolute difference of every pair of models."""
    return label_pairs(labels).groupBy("model_a", "model_b").agg(
        row_count().alias("overlap"), pearson(F.col("llm_a"), F.col("llm_b")).alias("correlation"),
        F.avg(F.abs(F.col("llm_a") - F.col("llm_b"))).alias("mean_difference"),
    )


def correlation_matrix(labels: DataFrame) -> DataFrame:
    """All ordered pairs: the computed half, its mirror, and 1 for a model that varies with itself."""
    half = agreement(labels).select("model_a", "model_b", "correlation")
    mirror = half.select(F.col("model_b").alias("model_a"), F.col("model_a").alias("model_b"), "correlation")
    numbered = labels.select("scored_by", label_to_number(F.col("label")).alias("llm"))
    own = numbered.groupBy("scored_by").agg(pearson(F.col("llm"), F.col("llm")).alias("correlation"))
    diagonal = own.select(F.col("scored_by").alias("model_a"), F.col("scored_by").alias("model_b"), "correlation")
    return half.unionByName(mirror).unionByName(diagonal)


def pivot_models(labels: DataFrame, models: list[str]) -> DataFrame:
    """One column per given model. (account, model) is unique, so ``first`` is exact."""
    numbered = labels.withColumn("llm", label_to_number(F.col("label")))
    return numbered.groupBy("twitter_id").pivot("scored_by", models).agg(F.first("llm", ignorenulls=True))


def keyword_frequency(keywords: DataFrame, n: int = 15) -> DataFrame:
    counted = keywords.groupBy("keyword").agg(row_count().alias("n"))
    return counted.orderBy(F.col("n").desc(), "keyword").limit(n)


def unique_keywords(keywords: DataFrame, approximate: bool = False) -> DataFrame:
    count = F.approx_count_distinct("keyword") if approximate else F.count_distinct("keyword")
    return keywords.agg(count.alias("unique_keywords"))


def keyword_means(keywords: DataFrame, numbered: DataFrame, minimum: int = 5) -> DataFrame:
    joined = keywords.select("twitter_id", "keyword").join(numbered.select("twitter_id", "llm"), "twitter_id")
    grouped = joined.groupBy("keyword").agg(F.avg("llm").alias("mean"), row_count().alias("n"))
    return grouped.filter(F.col("n") >= minimum)


def best_and_worst(means: DataFrame, n: int = 5) -> DataFrame:
    best = means.orderBy(F.col("mean").desc(), "keyword").limit(n).withColumn("side", F.lit("best"))
    worst = means.orderBy(F.col("mean").asc(), "keyword").limit(n).withColumn("side", F.lit("worst"))
    return best.unionByName(worst)


def histogram(df: DataFrame, column: str, bins: int, low: float = 0.0, high: float = 1.0) -> DataFrame:
    """Equal bins; the upper edge belongs to the last bin."""
    number = F.least(F.width_bucket(F.col(column), F.lit(low), F.lit(high), F.lit(bins)), F.lit(bins))
    return df.groupBy(number.cast("bigint").alias("bin")).agg(row_count().alias("n"))


def differences(numbered: DataFrame) -> DataFrame:
    """Five-number summary of label minus heuristic, per model."""
    diff = F.round(F.col("llm") - F.col("has"), 6)
    return numbered.groupBy("scored_by").agg(*five_numbers(diff))


def by_audience(labels: DataFrame) -> DataFrame:
    return labels.groupBy("audience").agg(row_count().alias("n"))


def global_stats(numbered: DataFrame) -> DataFrame:
    x = F.col("llm")
    return numbered.agg(
        row_count().alias("total"), F.round(F.avg(x), 3).alias("mean"), F.round(F.min(x), 3).alias("minimum"),
        F.round(F.max(x), 3).alias("maximum"), F.round(F.stddev_samp(x), 3).alias("std"),
    )


def global_bands(numbered: DataFrame) -> DataFrame:
    return numbered.groupBy(label_score_bucket(F.col("llm")).alias("bucket")).agg(row_count().alias("n"))


def global_correlation(numbered: DataFrame) -> DataFrame:
    r = numbered.agg(pearson(F.col("has"), F.col("llm")).alias("correlation"))
    return r.withColumn("strength", correlation_strength(F.col("correlation")))


def label_mix(labels: DataFrame) -> DataFrame:
    kind = F.coalesce(F.col("label").cast("string"), F.lit("null"))
    counted = labels.groupBy(kind.alias("label")).agg(row_count().alias("n"))
    # At most three rows are left here, so the total over all of them is a tiny window.
    whole = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return counted.withColumn("percent", F.lit(100.0) * F.col("n") / whole)


def label_trend(numbered: DataFrame, rows: int = 50, block: int = 100_000) -> DataFrame:
    """Rolling mean of the labels of a model in time order."""
    order = [F.col("scored_at"), F.col("twitter_id")]
    return rolling_mean(numbered, "llm", order, "scored_by", rows, "rolling_mean", block)
