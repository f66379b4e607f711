"""Numbers of the authenticity heuristic.

Fixed values: results are only comparable with earlier scores when these stay as they are. Callers
override single numbers through :func:`merge_config`.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

Config = dict[str, dict[str, float]]

DEFAULT_CONFIG: Config = {
    "personWeights": {
        "custom": 0.1,
        "engaged": 0.1,
        "age": 0.1,
        "safe": 0.05,
        "balanced": 0.12,
        "normalActivity": 0.12,
        "established": 0.08,
        "moderateFollowing": 0.08,
        "reasonableVolume": 0.08,
    },
    "activityThresholds": {"veryLow": 0.1, "low": 0.5, "optimalMax": 2, "highMax": 4, "veryHighMax": 8},
    "penaltyThresholds": {
        "veryFewFollowers": 10,
        "fewFollowers": 50,
        "veryFewStatuses": 10,
        "fewStatuses": 0,
        "veryNewDays": 30,
        "newDays": 90,
        "hyperactiveTweets": 20,
        "highActivityTweets": 10,
        "massFollowing": 5000,
        "highFollowing": 10000,
        "hugeStatuses": 30000,
        "veryHighStatuses": 15000,
        "lowEngagementRate": 0.1,
        "highActivityForLowEngagement": 5,
    },
    "classificationThresholds": {"bot": 0.65, "entity": 0.55, "creator": 0.55, "human": 0.55},
    "penalties": {
        "veryFewFollowers": 0.6,
        "fewFollowers": 0.8,
        "zeroStatuses": 0.4,
        "veryFewStatuses": 0.7,
        "veryNewAccount": 0.6,
        "newAccount": 0.85,
        "spamPattern": 0.5,
        "hyperactive": 0.65,
        "highActivity": 0.85,
        "highVolumeNoFollowers": 0.7,
        "defaultProfile": 0.75,
        "lowEngagementHighActivity": 0.7,
    },
}


def merge_config(overrides: Mapping[str, Mapping[str, float]] | None = None) -> Config:
    """Defaults with the given numbers replaced, group by group."""
    overrides = overrides or {}
    unknown = set(overrides) - set(DEFAULT_CONFIG)
    if unknown:
        raise ValueError(f"unknown config groups: {sorted(unknown)}")
    return {group: {**numbers, **overrides.get(group, {})} for group, numbers in DEFAULT_CONFIG.items()}


def config_from_json(text: str) -> Config:
    return merge_config(json.loads(text))


def config_column(config: Config) -> Column:
    """The whole config as one struct literal, so that several configs can sit in an array."""
    return F.struct(
        *[
            F.struct(*[F.lit(float(v)).alias(name) for name, v in sorted(numbers.items())]).alias(group)
            for group, numbers in sorted(config.items())
        ]
    )
