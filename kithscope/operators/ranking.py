"""Final scores from heuristic and labels, ranked lists, and rank shares on grouped scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kithscope.functions.bands import label_to_number
from kithscope.operators.ordering import running_counts

HEURISTIC_WEIGHT = 0.2
LABEL_WEIGHT = 0.8
CURATED = "@customers"


def label_means(labels: DataFrame) -> DataFrame:
    """Mean numeric label, label count and model names per account."""
    numbered = labels.withColumn("_n", label_to_number(F.col("label")))
    return numbered.groupBy("twitter_id").agg(
        F.avg("_n").alias("avg_llm"),
        F.count(F.lit(1)).alias("llm_count"),
        F.array_sort(F.collect_set("scored_by")).alias("models"),
    )


def keyword_sets(keywords: DataFrame, curated: str = CURATED) -> DataFrame:
    """Distinct keywords and the curated flag per account. The set is bounded by the keyword pool."""
    return keywords.groupBy("twitter_id").agg(
        F.array_sort(F.collect_set("keyword")).alias("keywords"),
        F.bool_or(F.col("keyword") == curated).alias("is_curated"),
    )


def blend(heuristic: Column, label_mean: Column, weight: float = HEURISTIC_WEIGHT) -> Column:
    return F.lit(weight) * heuristic + F.lit(round(1 - weight, 6)) * label_mean


def final_scores(profiles: DataFrame, labels: DataFrame, keywords: DataFrame | None = None) -> DataFrame:
    """All accounts with the final score: the blend where labels exist, else the heuristic alone."""
    joined = profiles.join(label_means(labels), "twitter_id", "left")
    has_label = F.coalesce(F.col("llm_count"), F.lit(0)) > 0
    joined = joined.withColumns(
        {
            "final_score": F.when(has_label, blend(F.col("human_score"), F.col("avg_llm"))).otherwise(F.col("human_score")),
            "has_llm": has_label,
            "avg_llm": F.coalesce("avg_llm", F.lit(0.0)),
            "llm_count": F.coalesce("llm_count", F.lit(0)),
        }
    )
    if keywords is None:
        return joined
    with_words = joined.join(keyword_sets(keywords), "twitter_id", "left")
    return with_words.withColumns(
        {
            "keywords": F.coalesce("keywords", F.array().cast("array<string>")),
            "is_curated": F.coalesce("is_curated", F.lit(False)),
        }
    )


def curated_finals(profiles: DataFrame, labels: DataFrame, keywords: DataFrame, curated: str = CURATED) -> DataFrame:
    """Final scores with the curated flag only; the flag needs no keyword arrays, so none are built."""
    marked = keywords.filter(F.col("keyword") == curated).select("twitter_id").distinct().withColumn("_c", F.lit(True))
    finals = final_scores(profiles, labels).join(marked, "twitter_id", "left")
    return finals.withColumn("is_curated", F.coalesce("_c", F.lit(False))).drop("_c")


def ranked_list(profiles: DataFrame, labels: DataFrame, minimum: float = 0.6, n: int = 100) -> DataFrame:
    """Labelled accounts above the minimum, best first."""
    final = final_scores(profiles, labels).filter(F.col("has_llm") & (F.col("final_score") >= minimum))
    return final.orderBy(F.col("final_score").desc(), "twitter_id").limit(n)


def top_share(scored: DataFrame, score: str = "final_score") -> DataFrame:
    """Per distinct score the share (percent) of rows at or above it."""
    counts = running_counts(scored, score)
    return counts.select(score, (F.col("at_or_above") / F.col("total") * 100).alias("top_share"))


def curated_top_share(finals: DataFrame) -> DataFrame:
    """Top share of each labelled curated account among all labelled accounts."""
    scored = finals.filter(F.col("has_llm"))
    shares = top_share(scored.select("final_score"))
    curated = scored.filter(F.col("is_curated")).select("twitter_id", "handle", "final_score")
    return curated.join(shares, "final_score")


def competition_rank(scored: DataFrame, score: str) -> DataFrame:
    """RANK() by descending score per distinct score: one more than the rows strictly above."""
    counts = running_counts(scored, score)
    return counts.select(score, (F.col("at_or_above") - F.col("n") + 1).alias("rank"))


def empirical_cdf(scored: DataFrame, group: str, score: str) -> DataFrame:
    """Cumulative share of rows at or below each distinct score, by group."""
    counts = running_counts(scored.select(group, score), score, [group])
    return counts.select(group, score, "n", (F.col("at_or_below") / F.col("total")).alias("cdf"))


def largest_gaps(profiles: DataFrame, labels: DataFrame, n: int = 10) -> DataFrame:
    """Labels furthest from the heuristic score."""
    joined = labels.join(profiles.select("twitter_id", "handle", "human_score", "likely_is"), "twitter_id")
    gap = F.abs(F.col("human_score") - F.col("llm"))
    return (
        joined.withColumn("llm", label_to_number(F.col("label")))
        .withColumn("gap", gap)
        .orderBy(F.col("gap").desc(), "twitter_id", "scored_by")
        .limit(n)
    )
