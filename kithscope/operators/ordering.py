"""Exact global ranks and running counts that never gather a whole group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kithscope.session import cut_lineage, scratch_path

BROADCAST_ROWS = 100_000  # a few megabytes
LOCAL_INDEX_BITS = 33  # monotonically_increasing_id keeps the row index in the low 33 bits


def global_row_number(df: DataFrame, order: list[Column], within: list[str] | None = None, name: str = "rn") -> DataFrame:
    """Exact 1-based row number over the whole input, or inside each ``within`` group.

    Rows are range-partitioned on the full sort key, so one huge group spreads over many tasks. The
    sorted rows are checkpointed once: the number of a row depends on partition sizes, which must not
    change when an executor is lost. Offsets come from one count per (group, partition) - a table no
    longer than groups x partitions. It is counted, and broadcast up to ``BROADCAST_ROWS``, so that the rows
    stay where they are; a longer one is joined by a shuffle.
    ``order`` must be a total order.
    """
    within = within or []
    keys = [F.col(k).asc() for k in within]
    placed = cut_lineage(
        df.repartitionByRange(*keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    placed = placed.withColumns(
        {"_part": F.shiftright("_id", LOCAL_INDEX_BITS), "_pos": F.col("_id").bitwiseAND(F.lit((1 << LOCAL_INDEX_BITS) - 1))}
    )
    return number_in_blocks(placed, within, ["_part"], "_pos", name).select(*df.columns, name)


def number_in_blocks(df: DataFrame, within: list[str], block: list[str], pos: str, name: str) -> DataFrame:
    """1-based row number inside each ``within`` group of rows that stand in ordered blocks, with places ``pos`` without gaps inside a block.

    ``df`` must give a row the same place whenever it is read.
    """
    blocks = df.groupBy(*within, *block).agg(F.count(F.lit(1)).alias("_n"), F.min(pos).alias("_start"))
    earlier = Window.partitionBy(*within).orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        *within, *block, "_start", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    # Written once: they are counted and joined.
    path = scratch_path(df.sparkSession, "offsets")
    offsets.write.parquet(path)
    offsets = df.sparkSession.read.schema(offsets.schema).parquet(path)
    if offsets.count() <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    numbered = df.join(offsets, [*within, *block])
    rank = F.col("_before") + F.col(pos) - F.col("_start") + 1
    return numbered.withColumn(name, rank.cast("bigint"))


FEW = 10_000


def bottom_k(df: DataFrame, order: Column, key: str, n: int, step: int = 3, few: int = FEW) -> DataFrame:
    """The ``n`` rows that are first by the text ``order``, then by the unique ``key``; rows stay in their partitions.

    Up to ``few`` rows come from Spark's own ordered limit, which holds ``n`` rows in one task. Beyond, the cut-off is found first: rows are counted by
    the first ``step`` characters, whole prefixes are taken while they fit, and only the prefix at the border is looked at further, until it has
    ``few`` rows or less. Its last row wanted is the cut-off, and one filter gives the result, whatever ``n`` is.
    """
    if n <= few:
        return df.orderBy(order, key).limit(max(0, n))
    spark = df.sparkSession
    path = scratch_path(spark, "order")
    df.select(order.alias("o"), F.col(key).alias("k")).write.parquet(path)
    narrow = spark.read.parquet(path)
    prefix, left = "", n
    while True:
        inside = narrow.filter(F.col("o").startswith(prefix))
        part = F.substring("o", len(prefix) + 1, step)
        # As many small rows come back as there are prefixes of a few characters.
        counts = inside.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect()
        border = None
        for c in counts:
            if c["n"] >= left:
                border = c
                break
            left -= c["n"]
        if border is None:
            return df
        ended = len(border["p"]) < step
        prefix += border["p"]
        if ended or border["n"] <= few:
            break
    last = narrow.filter(F.col("o") == prefix if ended else F.col("o").startswith(prefix)).orderBy("o", "k").limit(left)
    cut = last.agg(F.max(F.struct("o", "k")).alias("m")).first()["m"]
    return df.filter((order < F.lit(cut["o"])) | ((order == F.lit(cut["o"])) & (F.col(key) <= F.lit(cut["k"]))))


def rolling_mean(
    df: DataFrame, value: str, order: list[Column], within: str, rows: int, name: str, block: int = 100_000
) -> DataFrame:
    """Mean over the current and the ``rows - 1`` previous rows of a group.

    Groups are few and huge (one per model), so each is cut into blocks of consecutive rows; the last
    ``rows - 1`` rows of a block are also sent to the next one, which makes every window local and exact.
    """
    if block < rows:
        raise ValueError("a block must hold at least one full window")
    ranked = global_row_number(df, order, [within], "_rn")
    home = F.floor((F.col("_rn") - 1) / block)
    spill = F.floor((F.col("_rn") - 1 + (rows - 1)) / block)
    copies = F.when(spill > home, F.array(home, spill)).otherwise(F.array(home))
    spread = ranked.withColumn("_home", home).withColumn("_block", F.explode(copies))
    window = Window.partitionBy(within, "_block").orderBy("_rn").rowsBetween(-(rows - 1), 0)
    return (
        spread.withColumn(name, F.avg(value).over(window))
        .filter(F.col("_home") == F.col("_block"))
        .select(*df.columns, name)
    )


def running_counts(df: DataFrame, score: str, within: list[str] | None = None, scale: int = 1000) -> DataFrame:
    """Per distinct score: rows with it, rows at or above, rows at or below, rows in the group.

    Two levels keep it distributed. Rows are first counted per distinct score (map-side), then summed per
    coarse score band; only the bands (at most ``scale`` + 1 for scores in 0..1) pass an ordered window
    over a whole group, and distinct scores are ordered inside their band only.
    """
    within = within or []
    counted = df.groupBy(*within, score).agg(F.count(F.lit(1)).alias("n"))
    counted = counted.withColumn("_band", F.floor(F.col(score) * scale))
    bands = counted.groupBy(*within, "_band").agg(F.sum("n").alias("_n"))
    below = Window.partitionBy(*within).orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*within)
    bands = bands.select(
        *within, "_band",
        F.coalesce(F.sum("_n").over(below), F.lit(0)).alias("_below"),
        F.sum("_n").over(whole).alias("total"),
    )
    inside = Window.partitionBy(*within, "_band").orderBy(score).rowsBetween(Window.unboundedPreceding, 0)
    joined = counted.join(bands, [*within, "_band"])
    at_or_below = F.col("_below") + F.sum("n").over(inside)
    return joined.withColumn("at_or_below", at_or_below).select(
        *within, score, "n", "at_or_below",
        (F.col("total") - F.col("at_or_below") + F.col("n")).alias("at_or_above"), "total",
    )


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first by ``order``. Spark limits each map task to one row per key before
    the shuffle (window group limit), so a hot key does not gather."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")
