"""Which accounts are worth a label: audience similarity, a small classifier, queue and recall reports."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kithscope.functions.bands import WORTH_TIERS, worth_tier
from kithscope.functions.numbers import count_if, row_count, share, sigmoid
from kithscope.operators.sampling import with_folds
from kithscope.session import scratch_path

# Published weights and cut-off. The intercept was never published and is a parameter.
WEIGHTS = {"cos_sim": 6.09, "activity": 2.98, "bio_quality": 0.17}
CUTOFF = 0.33


def centroid(vectors: DataFrame, column: str, dimensions: int) -> DataFrame:
    """Mean vector as one row. One average per dimension in a single aggregate: nothing is exploded."""
    means = [F.avg(F.element_at(column, i + 1)) for i in range(dimensions)]
    return vectors.agg(F.array(*means).alias("centroid"))


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def cosine(a: Column, b: Column) -> Column:
    norm = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norm > 0, dot(a, b) / norm)


def similarity(vectors: DataFrame, column: str, centre: DataFrame) -> DataFrame:
    """Cosine of every vector to a one-row centroid, which enters the plan as a scalar subquery."""
    placed = vectors.withColumn("_centre", centre.select("centroid").scalar())
    return placed.withColumn("cos_sim", cosine(F.col(column), F.col("_centre"))).drop("_centre")


def worth_probability(intercept: float) -> Column:
    z = F.lit(intercept)
    for name, weight in WEIGHTS.items():
        z = z + F.lit(weight) * F.col(name)
    return sigmoid(z)


def _assembled(rows: DataFrame, features: tuple[str, ...]) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=list(features), outputCol="_features").transform(rows)


def score_worth(model, rows: DataFrame, features: tuple[str, ...] = tuple(WEIGHTS)) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    scored = model.transform(_assembled(rows, features))
    return scored.select(*rows.columns, vector_to_array("probability")[1].alias("probability"))


def fit_worth(rows: DataFrame, label: str = "label", features: tuple[str, ...] = tuple(WEIGHTS)):
    """Logistic model with balanced class weights. Returns the model and the rows with ``probability``."""
    from pyspark.ml.classification import LogisticRegression

    # Two counts come back: a join on the label would send all rows of a class to one task.
    totals = rows.agg(row_count().alias("n"), count_if(F.col(label) == 1).alias("ones")).first()
    ones, zeros = max(1, totals["ones"]), max(1, totals["n"] - totals["ones"])
    weighted = rows.withColumn("_weight", F.when(F.col(label) == 1, totals["n"] / (2 * ones)).otherwise(totals["n"] / (2 * zeros)))
    model = LogisticRegression(featuresCol="_features", labelCol=label, weightCol="_weight", regParam=0.01).fit(_assembled(weighted, features))
    return model, score_worth(model, rows, features)


def out_of_fold(
    rows: DataFrame, key: str, label: str = "label", features: tuple[str, ...] = tuple(WEIGHTS), k: int = 5, seed: str = "fold"
) -> tuple[list, DataFrame]:
    """The ``k`` models and all rows with ``fold`` and ``probability``, which is that of the one model fitted without the row's fold.

    ``label`` is 0 or 1. The rows are written once: every model reads them several times.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "folds")
    with_folds(rows, key, label, k, seed).write.parquet(path)
    placed = spark.read.parquet(path)
    models = [fit_worth(placed.filter(F.col("fold") != f), label, features)[0] for f in range(k)]
    parts = [score_worth(model, placed.filter(F.col("fold") == f), features) for f, model in enumerate(models)]
    return models, functools.reduce(DataFrame.unionByName, parts)


def fold_thresholds(scored: DataFrame, label: str = "label", beta: float = 2.0) -> DataFrame:
    """Rows, positives and best cut-off by F-beta of each fold, and (fold -1) of all together; scores are of unseen rows.

    Rows are counted per fold and hundredth first, so the running sums of a fold go over at most 101 rows.
    """
    both = scored.withColumn("fold", F.explode(F.array("fold", F.lit(-1))))
    step = F.floor(F.col("probability") * 100) / 100
    counted = both.groupBy("fold", step.alias("cutoff")).agg(count_if(F.col(label) == 1).alias("tp"), row_count().alias("n"))
    above = Window.partitionBy("fold").orderBy(F.col("cutoff").desc()).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy("fold")
    sums = counted.select(
        "fold", "cutoff", F.sum("tp").over(above).alias("found"), F.sum("n").over(above).alias("picked"),
        F.sum("tp").over(whole).alias("positives"), F.sum("n").over(whole).alias("n"),
    )
    # F-beta from counts: (1 + b2) tp / (b2 * positives + picked).
    b2 = beta * beta
    f = F.try_divide((1 + b2) * F.col("found"), b2 * F.col("positives") + F.col("picked"))
    best = sums.groupBy("fold").agg(F.max_by(F.struct("n", "positives", F.col("cutoff").alias("threshold")), F.struct(F.coalesce(f, F.lit(0.0)), -F.col("cutoff"))).alias("b"))
    return best.select("fold", "b.*")


def threshold_scores(scored: DataFrame, label: str = "label", beta: float = 2.0) -> DataFrame:
    """Precision, recall and F-beta for every cut-off in steps of one hundredth.

    Rows are counted per hundredth first, so the running sums go over at most 101 rows.
    """
    step = F.floor(F.col("probability") * 100) / 100
    counted = scored.groupBy(step.alias("cutoff")).agg(
        count_if(F.col(label) == 1).alias("_tp"), row_count().alias("_n")
    )
    above = Window.orderBy(F.col("cutoff").desc()).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(F.lit(1))
    sums = counted.select(
        "cutoff", F.sum("_tp").over(above).alias("tp"), F.sum("_n").over(above).alias("picked"),
        F.sum("_tp").over(whole).alias("positives"),
    )
    precision, recall = share(F.col("tp"), F.col("picked")), share(F.col("tp"), F.col("positives"))
    b2 = beta * beta
    f = F.try_divide((1 + b2) * precision * recall, b2 * precision + recall)
    return sums.select("cutoff", "tp", "picked", precision.alias("precision"), recall.alias("recall"), F.coalesce(f, F.lit(0.0)).alias("f_beta"))


def best_cutoff(scores: DataFrame) -> DataFrame:
    return scores.orderBy(F.col("f_beta").desc(), "cutoff").limit(1)


def fit_centroids(vectors: DataFrame, column: str, k: int, seed: int = 7) -> list[list[float]]:
    """k mean vectors of the audience (k-means); the model itself is k short vectors."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    ready = vectors.select(array_to_vector(F.col(column).cast("array<double>")).alias("features"))
    return [[float(x) for x in c] for c in KMeans(k=k, seed=seed).fit(ready).clusterCenters()]


def nearest_similarity(vectors: DataFrame, column: str, centres: list[list[float]]) -> DataFrame:
    scores = [cosine(F.col(column), F.array(*[F.lit(x) for x in centre])) for centre in centres]
    return vectors.withColumn("cos_sim", F.greatest(*scores) if len(scores) > 1 else scores[0])


def centroid_table(spark, centres: list[list[float]]) -> DataFrame:
    """(centre, centroid): a fitted model as a table to store."""
    return spark.createDataFrame([(i, c) for i, c in enumerate(centres)], "centre int, centroid array<double>")


def nearest_centroid(vectors: DataFrame, column: str, table: DataFrame) -> DataFrame:
    """Every vector with the ``centre`` of the stored table that it is nearest to, the first of several, and the cosine to it; both are null for a vector
    of zeros.

    The table has a few rows; they enter the plan as one scalar subquery.
    """
    whole = table.agg(F.array_sort(F.collect_list(F.struct("centre", "centroid"))).alias("t")).scalar()
    options = F.transform(F.col("_table"), lambda t: F.struct(cosine(F.col(column), t["centroid"]).alias("cos_sim"), (-t["centre"]).alias("minus")))
    best = vectors.withColumn("_table", whole).withColumn("_best", F.array_max(options))
    return best.withColumns({"centre": F.when(F.col("_best.cos_sim").isNotNull(), -F.col("_best.minus")), "cos_sim": F.col("_best.cos_sim")}).drop("_table", "_best")


def priority_queue(scored: DataFrame, n: int) -> DataFrame:
    """Accounts above the lowest tier, most probable first."""
    lowest = min(cut for cut, _ in WORTH_TIERS)
    ready = scored.filter(F.col("probability") >= lowest).withColumn("tier", worth_tier(F.col("probability")))
    return ready.orderBy(F.col("probability").desc(), "twitter_id").limit(n)


def feedback_rows(scored: DataFrame, labels: DataFrame) -> DataFrame:
    """Accounts that were sent and answered, with their features, for the next training."""
    sent = scored.filter(F.col("worth"))
    answered = labels.filter(F.col("label").isNotNull()).select("twitter_id", "scored_by", "label")
    return sent.join(answered, "twitter_id")


def queue_depth(queue: DataFrame, labels: DataFrame) -> DataFrame:
    """Queued accounts without any label yet."""
    waiting = queue.join(labels.select("twitter_id"), "twitter_id", "left_anti")
    return waiting.agg(row_count().alias("queue_depth"))


def labels_per_hour(labels: DataFrame) -> DataFrame:
    hour = F.date_trunc("hour", F.col("scored_at")).cast("timestamp_ntz")
    return labels.groupBy(hour.alias("hour")).agg(row_count().alias("labels"))


def rolling_worth_rate(scored: DataFrame, at: str, days: int = 7) -> DataFrame:
    """Share of worth accounts over the last days, per day. The window goes over one row per day."""
    day = F.unix_date(F.col(at).cast("date"))
    daily = scored.groupBy(day.alias("_day")).agg(row_count().alias("_n"), count_if(F.col("worth")).alias("_w"))
    recent = Window.orderBy("_day").rangeBetween(-(days - 1), 0)
    rate = F.sum("_w").over(recent) / F.sum("_n").over(recent)
    return daily.select(F.date_from_unix_date(F.col("_day").cast("int")).alias("day"), rate.alias("worth_rate"))


def recall_report(scored: DataFrame) -> DataFrame:
    """Share of worth accounts among the curated and the hand-picked, and by platform."""
    groups = F.array(
        F.when(F.col("is_curated"), "curated"), F.when(F.col("hand_picked"), "hand_picked"),
        F.concat(F.lit("platform:"), "platform"), F.lit("all"),
    )
    rows = scored.select(F.explode(F.filter(groups, lambda g: g.isNotNull())).alias("group_name"), "worth")
    return rows.groupBy("group_name").agg(
        row_count().alias("n"), count_if(F.col("worth")).alias("found"),
        share(count_if(F.col("worth")), row_count()).alias("rate"),
    )


def product_blend(heuristic: Column, label_mean: Column) -> Column:
    return heuristic * label_mean


def gated_blend(heuristic: Column, label_mean: Column, gate: float = 0.55) -> Column:
    return F.when(heuristic >= F.lit(gate), label_mean).otherwise(heuristic * label_mean)


def normalise_platforms(sources: dict[str, tuple[DataFrame, dict[str, str]]]) -> DataFrame:
    """Accounts of several platforms in common columns. Per platform: its rows and, per common column,
    the expression that gives it; a column a platform lacks becomes null."""
    parts = []
    for platform, (df, mapping) in sources.items():
        columns = [F.expr(expr).alias(name) for name, expr in mapping.items()]
        parts.append(df.select(F.lit(platform).alias("platform"), *columns))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out

