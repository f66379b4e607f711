"""Samples of any size, shards, folds, sketches and stored models."""

import duckdb
import pytest
from pyspark.sql import functions as F

from kithscope.functions.numbers import seeded_order
from kithscope.operators import ordering, sampling, sketches, worth


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [0, 1, 400, 1500, 2999, 3000, 5000])
def test_a_large_sample_is_that_of_an_ordered_limit(spark, n):
    df = spark.range(3000).select(F.col("id").cast("string").alias("k")).repartition(7)
    order = seeded_order("s", F.col("k"))
    want = {r.k for r in df.orderBy(order, "k").limit(n).collect()}
    got = ordering.bottom_k(df, order, "k", n, few=50)
    assert {r.k for r in got.collect()} == want and got.count() == min(n, 3000)
    assert n <= 50 or "SinglePartition" not in plan(got) and "TakeOrdered" not in plan(got)


def test_ordered_texts_with_shared_prefixes_and_of_any_length(spark):
    names = ["", "a", "ab", "abc", *(f"abc{i:04d}" for i in range(300)), "b", "é", "日本"]
    df = spark.createDataFrame([(x,) for x in names], "k string").repartition(4)
    for n in (3, 120, 302, 305):
        assert sorted(r.k for r in ordering.bottom_k(df, F.col("k"), "k", n, few=2).collect()) == sorted(names)[:n]


def test_strata_of_half_of_a_table_stay_in_place(spark, monkeypatch):
    monkeypatch.setattr(ordering, "FEW", 10)
    profiles = spark.range(2000).select(F.col("id").cast("string").alias("twitter_id"), F.lit("h").alias("handle"), F.lit("n").alias("name"), F.lit("b").alias("bio"), F.lit(None).cast("string").alias("category"))
    labels = profiles.select("twitter_id", F.lit("m").alias("scored_by"), (F.col("twitter_id").cast("int") % 10 == 0).alias("label"), F.lit("r").alias("reason"))
    stats = profiles.select("twitter_id", F.lit(1).alias("followers"))
    counts = {r.stratum: r["count"] for r in sampling.stratified_sample(labels, profiles, stats, total=1000).groupBy("stratum").count().collect()}
    assert counts == {"true": 200, "other": 800}


def test_shards_follow_the_rows(spark):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    placed = sampling.sharded_batches(df, "k", 25, rows_per_shard=100)
    assert sampling.shard_count(df, 100) == 10 and sampling.shard_count(df.limit(0)) == 1
    sizes = [r["count"] for r in placed.groupBy("shard").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 200 and sum(sizes) == 1000


def test_no_row_is_scored_by_a_model_that_saw_it(spark):
    rows = spark.range(600).select(
        F.col("id").cast("string").alias("k"), (F.col("id") % 3 == 0).cast("int").alias("label"), (F.rand(1) + (F.col("id") % 3 == 0).cast("int")).alias("x"), F.rand(2).alias("y"),
    )
    models, scored = worth.out_of_fold(rows, "k", features=("x", "y"), k=4)
    got = scored.collect()
    assert len(got) == 600 and {r.fold for r in got} == set(range(4))
    folds = {r.k: r.fold for r in sampling.with_folds(rows, "k", "label", 4, "fold").collect()}
    for f, model in enumerate(models):
        # Fitted again without the fold, the model is the same: what it scores cannot have entered it.
        other, _ = worth.fit_worth(scored.drop("probability", "fold").filter(~F.col("k").isin([k for k, v in folds.items() if v == f])), features=("x", "y"))
        assert other.coefficients.toArray() == pytest.approx(model.coefficients.toArray(), rel=1e-4)
        assert all(folds[r.k] == r.fold for r in got)
    report = {r.fold: r for r in worth.fold_thresholds(scored).collect()}
    for f in (-1, 0, 1, 2, 3):
        own = [(r.probability, r.label) for r in got if f in (-1, r.fold)]
        f2 = lambda c: 5 * sum(y for p, y in own if int(p * 100 + 1e-12) / 100 >= c) / max(1, 4 * sum(y for _, y in own) + sum(int(p * 100 + 1e-12) / 100 >= c for p, _ in own))
        assert report[f].n == len(own) and f2(report[f].threshold) == pytest.approx(max(f2(c / 100) for c in range(101)))


def test_centroids_are_read_from_the_stored_table(spark, tmp_path):
    vectors = spark.range(300).select(F.col("id").alias("vec_id"), F.array(*[F.sin(F.col("id") * (i + 1)).cast("float") for i in range(8)]).alias("v"))
    worth.centroid_table(spark, worth.fit_centroids(vectors, "v", 4)).write.parquet(str(tmp_path / "c"))
    vectors.write.parquet(str(tmp_path / "v"))
    rows = worth.nearest_centroid(vectors, "v", spark.read.parquet(str(tmp_path / "c"))).collect()
    assert [(r.centre, r.cos_sim) for r in rows if r.vec_id == 0] == [(None, None)]  # all zeros
    got = {r.vec_id: (r.centre, round(r.cos_sim, 6)) for r in rows if r.vec_id}
    sql = f"""select vec_id, centre, cos from (select *, row_number() over (partition by vec_id order by cos desc, centre) as rn from (select vec_id, centre,
      list_cosine_similarity(cast(v as double[]), centroid) as cos from '{tmp_path}/v/*.parquet', '{tmp_path}/c/*.parquet' where vec_id > 0) t) u where rn = 1"""
    want = {i: (c, round(x, 6)) for i, c, x in duckdb.sql(sql).fetchall()}
    assert got == want and len({c for c, _ in want.values()}) > 1


def test_sketches_of_any_days_unite_and_empty_values_do_no_harm(spark):
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("g"), (F.col("id") % 9).alias("day"), (F.col("id") % 7001).cast("string").alias("k"),
        F.when(F.col("id") % 4 != 0, F.col("id") % 1000).cast("double").alias("x"),
    )
    daily = sketches.daily_sketches(rows, ["g"], "day", "k", "x")
    for days in (range(9), (2, 5)):
        part = rows.filter(F.col("day").isin(*days))
        exact = {r.g: r for r in part.groupBy("g").agg(F.count_distinct("k").alias("k"), F.percentile("x", F.lit(0.5)).alias("m"), F.count("*").alias("n")).collect()}
        got = {r.g: r for r in sketches.united(daily.filter(F.col("day").isin(*days)), ["g"]).collect()}
        for g, e in exact.items():
            assert got[g].n == e.n and abs(got[g].accounts - e.k) <= sketches.COUNT_ERROR * e.k + 1
            assert (got[g].quantile is None) == (e.m is None) and (e.m is None or abs(got[g].quantile - e.m) <= 1000 * sketches.RANK_ERROR)
