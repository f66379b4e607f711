"""Score bands, gates and label conversions.

The cut-offs and names below are fixed values: downstream reports depend on them literally.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Gates (all strict): queueing for labels, the per-run label list, the bulk label list.
QUEUE_GATE = 0.65
LABEL_GATE = 0.55
BULK_LABEL_GATE = 0.6

SCORE_BUCKETS = [(0.9, "0.9-1.0"), (0.8, "0.8-0.9"), (0.7, "0.7-0.8"), (0.6, "0.6-0.7"), (0.5, "0.5-0.6")]
LABEL_SCORE_BUCKETS = [(0.9, "0.90-1.00"), (0.8, "0.80-0.89"), (0.7, "0.70-0.79"), (0.6, "0.60-0.69"), (0.5, "0.50-0.59")]
LEVELS = [(0.7, "high"), (0.4, "medium")]
CURATED_LEVELS = [(0.7, "high"), (0.6, "marginal")]
AUTHENTICITY_ACTIONS = [(0.85, "priority"), (0.65, "include"), (0.45, "caution"), (0.2, "review")]
FINAL_ACTIONS = [(0.8, "priority"), (0.7, "target"), (0.6, "include")]
WORTH_TIERS = [(0.7, "high"), (0.5, "medium"), (0.33, "low")]


def band(score: Column, steps: Sequence[tuple[float, str]], rest: str) -> Column:
    """First step whose lower bound the score reaches; null scores stay null."""
    out = F.when(score.isNull(), F.lit(None).cast("string"))
    for lower, name in steps:
        out = out.when(score >= F.lit(lower), F.lit(name))
    return out.otherwise(F.lit(rest))


def score_bucket(score: Column) -> Column:
    return band(score, SCORE_BUCKETS, "<0.5")


def label_score_bucket(score: Column) -> Column:
    return band(score, LABEL_SCORE_BUCKETS, "0.00-0.49")


def level(score: Column) -> Column:
    return band(score, LEVELS, "low")


def curated_level(score: Column) -> Column:
    return band(score, CURATED_LEVELS, "miss")


def authenticity_action(score: Column) -> Column:
    return band(score, AUTHENTICITY_ACTIONS, "discard")


def final_action(score: Column) -> Column:
    return band(score, FINAL_ACTIONS, "exclude")


def worth_tier(probability: Column) -> Column:
    return band(probability, WORTH_TIERS, "skip")


def label_to_number(label: Column) -> Column:
    """true 1, false 0, uncertain (null) one half."""
    return F.when(label, F.lit(1.0)).when(~label, F.lit(0.0)).otherwise(F.lit(0.5))


def number_to_label(score: Column) -> Column:
    return F.when(score >= F.lit(0.7), F.lit(True)).when(score < F.lit(0.4), F.lit(False))


def correlation_strength(r: Column) -> Column:
    return F.when(r > F.lit(0.7), F.lit("strong")).when(r > F.lit(0.4), F.lit("moderate")).when(r.isNotNull(), F.lit("weak"))


def rating(value: Column, excellent: float, good: float) -> Column:
    return (
        F.when(value <= F.lit(excellent), F.lit("excellent"))
        .when(value <= F.lit(good), F.lit("good"))
        .when(value.isNotNull(), F.lit("needs_improvement"))
    )
