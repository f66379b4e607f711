"""Connected components of a graph given as links, without ever gathering a component."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kithscope.llm.frames import stored

#: As many links are settled by one task, in a quarter of a megabyte.
FEW = 1 << 14


def join_roots(roots: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Roots (the least place of each component) once the pairs are joined as well."""
    while True:
        a, b = roots[i], roots[j]
        apart = a != b
        if not apart.any():
            return roots
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        np.minimum.at(roots, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(jumped := roots[roots], roots):
            roots = jumped


def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, to) of every label that ``batches`` of links (a, b) move to another, the least of its component."""
    links = [np.stack([batch.column(c).to_numpy() for c in ("a", "b")]) for batch in batches]
    if links:
        names, place = np.unique(np.concatenate(links, axis=1), return_inverse=True)
        roots = join_roots(np.arange(len(names)), *place.reshape(2, -1))
        moved = np.flatnonzero(roots != np.arange(len(names)))
        yield pa.RecordBatch.from_arrays([pa.array(names[moved]), pa.array(names[roots[moved]])], names=["label", "to"])


def relabelled(labels: DataFrame, moves: DataFrame) -> DataFrame:
    return stored(labels.join(moves, "label", "left").select("node", F.coalesce("to", "label").alias("label")), "labels")


def merge_labels(labels: DataFrame, links: DataFrame, most_rounds: int = 200, few: int = FEW) -> DataFrame:
    """``labels`` (node, label) joined up by ``links`` (a, b) between labels: linked labels become one of them.

    In each round every label moves to the one of least hash among itself and those it is linked to; links move along and
    those within one label go. Hashes change from round to round, so a constant share of the labels is expected to go in
    each, also along paths, and rounds grow with the logarithm of a component's size. A label's least neighbour is combined
    map-side, so a hub of many links is no hot group. Rounds go on while more than ``few`` links are left between labels: those
    take one step, in one task, where further rounds would move less and less at the price of the first.
    """
    for step in range(most_rounds):
        links = links.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        links = stored(links, "links")
        left = links.count()
        if not left:
            return labels
        if left <= few:
            moves = stored(links.coalesce(1).mapInArrow(settled, "label long, to long"), "moves")
            return relabelled(labels, moves)
        both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        order = lambda c: F.xxhash64(c, F.lit(step))
        least = both.groupBy(F.col("a").alias("label")).agg(F.min_by("b", order("b")).alias("to"))
        moves = stored(least.filter(order("to") < order("label")), "moves")
        labels = relabelled(labels, moves)
        a, b = moves.select(F.col("label").alias("a"), F.col("to").alias("to_a")), moves.select(F.col("label").alias("b"), F.col("to").alias("to_b"))
        links = links.join(a, "a", "left").join(b, "b", "left").select(F.coalesce("to_a", "a").alias("a"), F.coalesce("to_b", "b").alias("b"))
    raise RuntimeError("links do not settle")
