"""How well the ranking finds the curated accounts; comparison of models and audience versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kithscope.functions.bands import label_to_number, rating
from kithscope.functions.numbers import count_if, pearson, row_count, share
from kithscope.operators.ranking import curated_top_share

HIGH = 0.7
MEDIUM = 0.6


def curated_report(finals: DataFrame) -> DataFrame:
    """Labelled curated accounts against the other labelled accounts, one row per side.

    ``percentile`` is exact; its buffer maps distinct final scores to counts, and those are few because
    both inputs have a short fixed set of values.
    """
    x = F.col("final_score")
    scored = finals.filter(F.col("has_llm"))
    grouped = scored.groupBy("is_curated").agg(
        row_count().alias("n"), F.avg(x).alias("mean"), F.percentile(x, F.lit(0.5)).alias("median"),
        F.stddev_samp(x).alias("std"), F.min(x).alias("minimum"), F.max(x).alias("maximum"),
        count_if(x >= HIGH).alias("above_high"), count_if(x >= MEDIUM).alias("above_medium"),
        count_if(x < MEDIUM).alias("below_medium"),
    )
    return grouped.withColumns(
        {
            "fnr_high": 1 - share(F.col("above_high"), F.col("n")),
            "fnr_medium": 1 - share(F.col("above_medium"), F.col("n")),
        }
    )


def dataset_counts(finals: DataFrame) -> DataFrame:
    curated, scored = F.col("is_curated"), F.col("has_llm")
    return finals.agg(
        row_count().alias("total_profiles"), count_if(curated).alias("total_curated"),
        count_if(scored).alias("total_scored"), count_if(curated & scored).alias("curated_scored"),
        count_if(curated & ~scored).alias("curated_unscored"),
    )


def rank_report(finals: DataFrame) -> DataFrame:
    """Where the curated accounts stand among all labelled accounts."""
    p = F.col("top_share")
    return curated_top_share(finals).agg(
        row_count().alias("n"), F.avg(p).alias("mean_top_share"), F.percentile(p, F.lit(0.5)).alias("median_top_share"),
        count_if(p <= 10).alias("in_top_10"), count_if(p <= 25).alias("in_top_25"), count_if(p <= 50).alias("in_top_50"),
    )


def false_negatives(finals: DataFrame) -> DataFrame:
    return finals.filter(F.col("is_curated") & F.col("has_llm") & (F.col("final_score") < MEDIUM))


def top_performers(finals: DataFrame, n: int = 10) -> DataFrame:
    curated = finals.filter(F.col("is_curated") & F.col("has_llm"))
    return curated.orderBy(F.col("final_score").desc(), "twitter_id").limit(n)


def ratings(report: DataFrame, ranks: DataFrame) -> DataFrame:
    """Verdicts on the curated side; they are given also when a rate is exactly zero."""
    curated = report.filter(F.col("is_curated")).select("fnr_high", "fnr_medium", F.lit(True).alias("k"))
    joined = curated.join(ranks.select("mean_top_share", F.lit(True).alias("k")), "k", "left").drop("k")
    well = (F.col("fnr_medium") <= 0.1) & (F.col("mean_top_share") <= 25)
    return joined.select(
        rating(F.col("fnr_high"), 0.1, 0.2).alias("fnr_high_rating"),
        rating(F.col("fnr_medium"), 0.05, 0.1).alias("fnr_medium_rating"),
        rating(F.col("mean_top_share"), 15, 30).alias("rank_rating"),
        F.when(well, "performs_well").otherwise("needs_tuning").alias("overall"),
    )


def validate_model(labels: DataFrame, seeds: DataFrame, model: str, reference: str) -> DataFrame:
    """Acceptance of a model on seed accounts: mean above .75, minimum above .5, correlation with a
    reference model above .85."""
    numbered = labels.join(seeds.select("twitter_id"), "twitter_id", "left_semi")
    own = numbered.filter(F.col("scored_by") == model).select("twitter_id", label_to_number(F.col("label")).alias("x"))
    other = numbered.filter(F.col("scored_by") == reference).select(
        "twitter_id", label_to_number(F.col("label")).alias("y")
    )
    facts = own.join(other, "twitter_id", "left").agg(
        row_count().alias("seeds"), F.avg("x").alias("mean"), F.min("x").alias("minimum"),
        pearson(F.col("x"), F.col("y")).alias("correlation"),
    )
    return facts.withColumns(
        {
            "scores_pass": (F.col("mean") > 0.75) & (F.col("minimum") > 0.5),
            "correlation_pass": F.coalesce(F.col("correlation") > 0.85, F.lit(False)),
        }
    )


def audience_mix(labels: DataFrame) -> DataFrame:
    label = F.col("label")
    return labels.groupBy("audience").agg(
        row_count().alias("n"), count_if(label).alias("n_true"), count_if(~label).alias("n_false"),
        count_if(label.isNull()).alias("n_null"),
    )


def audience_flips(history: DataFrame, before: str, after: str) -> DataFrame:
    """How labels of one (account, model) moved between two audience versions. ``history`` is the
    append-only log; the last label inside a version counts."""
    last = history.filter(F.col("audience").isin(before, after)).groupBy("twitter_id", "scored_by").agg(
        F.max_by(F.struct("label"), F.when(F.col("audience") == before, F.col("scored_at"))).alias("old"),
        F.max_by(F.struct("label"), F.when(F.col("audience") == after, F.col("scored_at"))).alias("new"),
    )
    both = last.filter(F.col("old").isNotNull() & F.col("new").isNotNull())
    word = lambda c: F.coalesce(F.col(f"{c}.label").cast("string"), F.lit("null"))
    return both.groupBy(word("old").alias("old_label"), word("new").alias("new_label")).agg(row_count().alias("n"))
