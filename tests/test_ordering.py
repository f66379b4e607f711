"""Distributed ranks and windows against brute force, with one key holding most rows."""

import random

from pyspark.sql import functions as F

from kithscope.operators.ordering import first_per_key, global_row_number, rolling_mean, running_counts


def skewed(spark, n=3000):
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.8 else rng.choice("abc"), rng.randrange(40), i, float(rng.choice([0, 0.5, 1]))) for i in range(n)]
    return rows, spark.createDataFrame(rows, "g string, t int, id int, x double").repartition(7)


def test_global_row_number(spark):
    rows, df = skewed(spark)
    got = {r.id: r.rn for r in global_row_number(df, [F.col("t").desc(), F.col("id")]).collect()}
    order = sorted(rows, key=lambda r: (-r[1], r[2]))
    assert got == {r[2]: i + 1 for i, r in enumerate(order)}


def test_row_number_within_groups(spark):
    rows, df = skewed(spark)
    got = {r.id: r.rn for r in global_row_number(df, [F.col("t"), F.col("id")], ["g"]).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        for i, r in enumerate(sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2]))):
            want[r[2]] = i + 1
    assert got == want


def test_rolling_mean_across_blocks(spark):
    rows, df = skewed(spark)
    got = {r.id: r.m for r in rolling_mean(df, "x", [F.col("t"), F.col("id")], "g", 50, "m", block=64).collect()}
    assert len(got) == len(rows)
    for g in {r[0] for r in rows}:
        ordered = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1], r[2]))
        for i, r in enumerate(ordered):
            part = [q[3] for q in ordered[max(0, i - 49): i + 1]]
            assert abs(got[r[2]] - sum(part) / len(part)) < 1e-12


def test_running_counts(spark):
    rows, df = skewed(spark)
    scores = [(r[0], r[1] / 40 + r[3] / 1000) for r in rows]
    sdf = spark.createDataFrame(scores, "g string, s double").repartition(5)
    for r in running_counts(sdf, "s", ["g"], scale=10).collect():
        own = [s for g, s in scores if g == r.g]
        assert r.n == own.count(r.s) and r.total == len(own)
        assert r.at_or_above == sum(s >= r.s for s in own) and r.at_or_below == sum(s <= r.s for s in own)


def test_first_per_key(spark):
    rows, df = skewed(spark)
    got = {r.g: r.id for r in first_per_key(df, ["g"], [F.col("t").desc(), F.col("id")]).collect()}
    want = {g: min((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))[2] for g in {r[0] for r in rows}}
    assert got == want


def test_row_numbers_do_not_shuffle_the_rows_again(spark):
    df = spark.range(5000).select((F.col("id") % 3).cast("string").alias("g"), F.col("id").alias("v"))
    ranked = global_row_number(df, [F.col("v")], ["g"])
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan
    assert sorted((r.g, r.v, r.rn) for r in ranked.collect()) == sorted((str(i % 3), i, i // 3 + 1) for i in range(5000))
