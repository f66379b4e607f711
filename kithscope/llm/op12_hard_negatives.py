"""Hard-negative mining: for every anchor and positive the best other-label rows whose score lies in that positive's window.

A positive of score s allows negatives from ``low`` to ``high`` hundredths of s. The windows of one anchor overlap, but their
upper limits cut the scores into disjoint slots: a negative belongs to the slot of the least limit it keeps below. Combiners keep the
best ``n_negatives`` of each slot; merging the slots from the lowest limit up, best first, then gives for every positive the
best below its limit, and cutting these at the lower limit answers its window. One pass serves all windows of an anchor.

Anchors are a stated set of queries against all rows. Rows lie in chunks and anchors in blocks, both by hash and of bounded
size; every chunk meets every block in a task of its own, which keeps at most ``n_positives`` rows, then ``n_negatives`` per slot, of an anchor.
The best of all chunks are found by a limited window, which Spark applies before the shuffle as well. Labels play no part in how
rows are dealt, so a label of a third of all rows makes no large task. Nothing passes through the driver but two counts.

Nulls: rows whose id, label or vector is null, and rows with an empty vector or one with null, NaN or infinite entries, take no part.
Rows equal in id, label and vector count once. Rows that share an id but differ are rows of their own, yet none is the other's
positive. Vectors are compared with those of their own length; scaled entries are held within 2^53 and scores within 64 bits. A positive score below zero gives an empty window.
Tables without anchors, and anchors without positives, give no rows. Other columns, whatever their names, are not read.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kithscope.llm.frames import stored
from kithscope.llm.vectors import largest, matrix, usable, whole

OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
ANCHOR = ["anchor_id", "anchor_key"]
CHUNK_ROWS, BLOCK_ROWS = 2048, 1024
LIST = "array<struct<minus:bigint,id:bigint>>"


def _scores(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Exact integer products, one line per anchor: doubles where they hold all of them, else 64 bits or Python's integers."""
    most = largest(rows) * largest(anchors) * max(1, rows.shape[1])
    if most < 1 << 53:
        return np.rint(anchors.astype(float) @ rows.T.astype(float)).astype(np.int64)
    if most < 1 << 63:
        return anchors @ rows.T
    return np.clip(anchors.astype(object) @ rows.T.astype(object), -(2**63) + 1, 2**63 - 1).astype(np.int64)


def _best(scores: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the ``n`` highest scores, ties by smaller id."""
    places = np.arange(len(scores))
    if len(scores) > n:
        places = np.flatnonzero(scores >= np.partition(scores, len(scores) - n)[len(scores) - n])
    return places[np.lexsort((ids[places], -scores[places]))][:n]


def _table(columns: dict[str, list[np.ndarray]], schema: pa.Schema) -> pa.Table:
    return pa.table({f.name: pa.array(np.concatenate(columns[f.name]) if columns[f.name] else [], f.type) for f in schema}, schema=schema)


FOUND = pa.schema([("anchor_id", pa.int64()), ("anchor_key", pa.int64()), ("slot", pa.int32()), ("score", pa.int64()), ("id", pa.int64())])
FOUND_DDL = "anchor_id long, anchor_key long, slot int, score long, id long"


def _meet(rows: pa.Table, anchors: pa.Table, pick: Callable) -> pa.Table:
    """``pick`` (anchor number, its scores, ids, equal label) gives (slot, places) pairs to keep for each anchor."""
    out: dict[str, list[np.ndarray]] = {f.name: [] for f in FOUND}
    if rows.num_rows and anchors.num_rows:
        ids, labels = rows["id"].to_numpy(), rows["label"].to_numpy()
        anchor_ids, keys, anchor_labels = anchors["anchor_id"].to_numpy(), anchors["anchor_key"].to_numpy(), anchors["anchor_label"].to_numpy()
        scores = _scores(matrix(rows["x"], np.int64), matrix(anchors["anchor_x"], np.int64))
        for k in range(len(anchor_ids)):
            for slot, places in pick(k, scores[k], ids, labels == anchor_labels[k], anchor_ids[k]):
                if len(places):
                    m = len(places)
                    parts = (np.full(m, anchor_ids[k]), np.full(m, keys[k]), np.full(m, slot, dtype=np.int32), scores[k][places], ids[places])
                    for name, part in zip(FOUND.names, parts):
                        out[name].append(part)
    return _table(out, FOUND)


def _first(found: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The best ``n`` per key; Spark limits the rows of each task before it shuffles them."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("score").desc(), "id"))
    return found.withColumn("place", place).filter(F.col("place") <= n)


def mine_hard_negatives(
    vectors: DataFrame,
    is_anchor: Callable[[Column], Column],
    n_positives: int = 5,
    n_negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    chunk_rows: int = CHUNK_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Rows of OUT. ``is_anchor`` says from the id which rows are anchors; ``low`` and ``high`` are hundredths of the positive's score."""
    spark = vectors.sparkSession
    kind = vectors.schema[label_col].dataType.typeName()
    label = F.col(label_col).cast("long") if kind in ("byte", "short", "integer", "long") else F.xxhash64(label_col)
    ok = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & usable(F.col(vector_col))
    plain = vectors.filter(ok).select(F.col(id_col).cast("long").alias("id"), label.alias("label"), whole(F.col(vector_col), scale).alias("x"))
    hashed = plain.distinct().withColumns({"size": F.size("x"), "key": F.xxhash64("id", "label", "x")})
    rows = stored(hashed, "rows")
    counts = rows.agg(F.count(F.lit(1)).alias("rows"), F.count(F.when(is_anchor(F.col("id")), 1)).alias("anchors")).first()
    if not counts["anchors"]:
        return spark.createDataFrame([], OUT)
    chunks, blocks = -(-counts["rows"] // chunk_rows), -(-counts["anchors"] // block_rows)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    anchors = rows.filter(is_anchor(F.col("id"))).select(
        F.col("id").alias("anchor_id"), F.col("key").alias("anchor_key"), F.col("label").alias("anchor_label"), F.col("x").alias("anchor_x"),
        F.col("size").alias("anchor_size"), F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int").alias("anchor_block"),
    )
    dealt = rows.select("size", "id", "label", "x", F.pmod("key", F.lit(chunks)).cast("int").alias("chunk")).withColumn("block", every(blocks))

    def positives(left: pa.Table, right: pa.Table) -> pa.Table:
        def pick(k, scores, ids, same, anchor_id):
            fit = np.flatnonzero(same & (ids != anchor_id))
            return [(0, fit[_best(scores[fit], ids[fit], n_positives)])]

        return _meet(left, right, pick)

    def negatives(left: pa.Table, right: pa.Table) -> pa.Table:
        uppers, lowers = right["uppers"].to_pylist(), right["lowers"].to_pylist()

        def pick(k, scores, ids, same, anchor_id):
            # Limits fall from positive to positive; the last one that is not below a score names its slot.
            upper, lower = np.array(uppers[k]), np.array(lowers[k])
            fit = np.flatnonzero(~same & (scores <= upper[0]) & (scores >= lower[-1]))
            slots = np.searchsorted(-upper, -scores[fit], side="right")
            for slot in range(1, len(upper) + 1):
                # A score below the slot's own lower limit is below those of all higher windows.
                part = fit[(slots == slot) & (scores[fit] >= lower[slot - 1])]
                yield slot, part[_best(scores[part], ids[part], n_negatives)]

        return _meet(left, right, pick)

    def met(anchors: DataFrame, keep: Callable) -> DataFrame:
        # All names of the two sides differ: both come from the same stored rows.
        asked = anchors.withColumn("anchor_chunk", every(chunks)).groupBy("anchor_size", "anchor_chunk", "anchor_block")
        return dealt.groupBy("size", "chunk", "block").cogroup(asked).applyInArrow(keep, FOUND_DDL)

    best = _first(met(anchors, positives), ANCHOR, n_positives).groupBy(*ANCHOR).agg(F.array_sort(F.collect_list(F.struct("place", "id", "score"))).alias("positives"))
    best = stored(best, "positives")
    limits = best.select(
        *ANCHOR,
        F.transform("positives", lambda p: F.floor(p["score"] * F.lit(high).cast("decimal(5,0)") / F.lit(100)).cast("long")).alias("uppers"),
        F.transform("positives", lambda p: F.ceil(p["score"] * F.lit(low).cast("decimal(5,0)") / F.lit(100)).cast("long")).alias("lowers"),
    )
    limits = stored(limits, "limits")
    slots = _first(met(anchors.join(limits, ANCHOR), negatives), [*ANCHOR, "slot"], n_negatives)
    # At most n_positives slots of n_negatives rows for an anchor. Sorted structs put the highest score first.
    better = F.struct((-F.col("score")).alias("minus"), "id")
    lists = slots.groupBy(*ANCHOR, "slot").agg(F.array_sort(F.collect_list(better)).alias("rows"))
    by_slot = lists.groupBy(*ANCHOR).agg(F.map_from_entries(F.collect_list(F.struct("slot", "rows"))).alias("slots"))

    def merged(acc: Column, slot: Column) -> Column:
        """The best below this limit: those of its slot and of all lower ones."""
        empty = F.array().cast(LIST)
        lower = F.coalesce(F.try_element_at(acc, F.lit(-1)), empty)
        own = F.coalesce(F.try_element_at("slots", slot), empty)
        return F.array_append(acc, F.slice(F.array_sort(F.concat(own, lower)), 1, n_negatives))

    downward = F.sequence(F.size("positives"), F.lit(1), F.lit(-1))
    suffixes = F.reverse(F.aggregate(downward, F.array().cast(f"array<{LIST}>"), merged))
    answered = best.join(limits, ANCHOR).join(by_slot, ANCHOR).withColumn("found", suffixes)
    each = answered.select("anchor_id", "lowers", "found", F.posexplode("positives").alias("i", "p"))
    inside = F.filter(F.get("found", F.col("i")), lambda r: -r["minus"] >= F.get("lowers", F.col("i")))
    ranked = each.select("anchor_id", F.col("p.id").alias("positive_id"), F.col("p.score").alias("positive_score"), F.posexplode(inside).alias("at", "r"))
    return ranked.select(
        "anchor_id", "positive_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("r.id").alias("negative_id"), "positive_score", (-F.col("r.minus")).alias("negative_score")
    )

