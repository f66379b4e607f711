"""Small numeric Column builders shared by the scoring and evaluation code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sigmoid(x: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def r6(x: Column) -> Column:
    """Six decimals for comparison. The tiny shift settles exact halves, where the order in which a mean
    was summed (or the engine's rounding) would otherwise decide the last digit."""
    return F.round(x + F.lit(1e-9), 6)


def pearson(x: Column, y: Column) -> Column:
    """Correlation as an aggregate that is null, not an error, when a side is constant."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    spread = F.stddev_pop(a) * F.stddev_pop(b)
    return F.when(spread > 0, F.covar_pop(a, b) / F.nullif(spread, F.lit(0.0)))


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def share(part: Column, whole: Column) -> Column:
    """part / whole as double, null for an empty whole."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def seeded_order(seed: str, *keys: Column) -> Column:
    """Repeatable random order: md5 over the key and a seed, equal on every run and engine."""
    return F.md5(F.concat_ws("|", *[k.cast("string") for k in keys], F.lit(seed)))


def unit_hash(*parts: Column) -> Column:
    """Deterministic number in [0, 1) from the first 32 bits of an md5."""
    digest = F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def row_count() -> Column:
    return F.count(F.lit(1))
