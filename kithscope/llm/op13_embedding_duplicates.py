"""Near duplicates among embeddings of one label, by randomly rotated binary codes.

Every vector is scaled to length one and turned by a fixed random rotation; the signs are its code (a bit a dimension), and beside it stands a
correction factor, the product of the vector with its own code. The product of another turned vector with the code, divided by
the factor, is an unbiased estimate of the cosine, whose error has the standard deviation sqrt(1 - cosine^2) * sqrt((1 - factor^2) / (factor^2 (d - 1))). A pair
whose estimate is more than ``sure`` deviations below what the threshold would give is no link; all others are recomputed
in double precision, and only that decides. At the default of 6 deviations a link is lost with a probability below 1e-8.

Copies are one node. The nodes of a label are dealt into blocks of bounded size by their number, and every two blocks meet in a
task of their own: all pairs of a label are estimated, so no link hangs on a bucket, and a label of a third of all rows is many equal tasks.
A meeting returns one row per node with a link (its links, and one node standing for its local component), never pairs.
The work of a label grows with the square of its distinct vectors: that is the price of losing no link; rows and memory do not.

Nulls: rows with a null label, a null id, or a vector that is null, empty, zero or holds a null, NaN or infinite entry link with nothing
(the id, where there is one, is its own component). Vectors of different lengths do not link. Repeated rows, and rows that share an id,
are vectors of their own and count as links. Of ties for the component the smallest id stands. An empty table gives no rows.
Further columns, whatever their names, travel in ``row`` if asked for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kithscope.llm.components import join_roots, merge_labels
from kithscope.llm.frames import stored
from kithscope.llm.vectors import matrix, usable

BLOCK_ROWS = 4096
SLAB = 1 << 21
"""Pairs estimated at once."""

_rotations: dict[tuple[int, int], np.ndarray] = {}


def rotation(d: int, seed: int) -> np.ndarray:
    """A random rotation, the same in every process. One is kept per length of vector met by a task."""
    if (d, seed) not in _rotations:
        _rotations.clear()
        q, r = np.linalg.qr(np.random.default_rng([seed, d]).standard_normal((d, d)))
        _rotations[d, seed] = q * np.sign(np.diag(r))
    return _rotations[d, seed]


def unit(vectors: np.ndarray) -> np.ndarray:
    # Scaled by the largest entry first, so that squares neither overflow nor vanish.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def encode(vectors: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(signs of the turned unit vectors as packed bits, correction factors)."""
    turned = unit(vectors) @ rotation(vectors.shape[1], seed)
    return np.packbits(turned >= 0, axis=1), np.abs(turned).sum(axis=1) / np.sqrt(vectors.shape[1])


def least_product(factors: np.ndarray, d: int, threshold: float, sure: float) -> np.ndarray:
    """The product of a turned vector with the signs of each code, below which the pair is surely under the threshold."""
    spread = np.sqrt(np.maximum(1 - factors**2, 0) / (factors**2 * max(d - 1, 1)))
    least = threshold - sure * np.sqrt(max(0.0, 1 - threshold**2)) * spread
    # The last term allows for the rounding of single-precision products.
    return least * factors * np.sqrt(d) - 1e-4 * np.sqrt(d)


class Side:
    """The nodes of one block."""

    def __init__(self, table: pa.Table, seed: int, threshold: float, sure: float) -> None:
        vectors = matrix(table["vector"], float)
        d = vectors.shape[1]
        codes = np.frombuffer(b"".join(table["code"].to_pylist()), dtype=np.uint8).reshape(len(vectors), -1)
        self.unit = unit(vectors)
        self.turned = (self.unit @ rotation(d, seed)).astype(np.float32)
        self.signs = np.unpackbits(codes, axis=1)[:, :d].astype(np.float32) * 2 - 1
        self.least = least_product(table["factor"].to_numpy(), d, threshold, sure).astype(np.float32)
        self.copies = table["copies"].to_numpy()


def linked_pairs(a: Side, b: Side, same: bool, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (in a, in b) of all pairs with a cosine of the threshold or more; of one block each pair once."""
    step = max(1, SLAB // max(1, len(b.copies)))
    for lo in range(0, len(a.copies), step):
        maybe = a.turned[lo : lo + step] @ b.signs.T >= b.least
        if same:
            maybe &= np.arange(len(b.copies)) > np.arange(lo, lo + len(maybe))[:, None]
        i, j = np.nonzero(maybe)
        if len(i) * 8 > maybe.size:
            cosines = (a.unit[lo : lo + step] @ b.unit.T)[i, j]
        else:
            parts = [np.einsum("ij,ij->i", a.unit[lo + i[k : k + 65536]], b.unit[j[k : k + 65536]]) for k in range(0, len(i), 65536)]
            cosines = np.concatenate(parts) if parts else np.zeros(0)
        keep = cosines >= threshold
        yield i[keep] + lo, j[keep]


MET = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def near_embeddings(
    vectors: DataFrame,
    threshold: float = 0.93,
    sure: float = 6.0,
    seed: int = 7,
    block_rows: int = BLOCK_ROWS,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    carry: bool = False,
) -> DataFrame:
    """(row, vec_id, n_links, component_id, kept), one row per row of ``vectors``."""
    row = F.struct(*[vectors[c] for c in vectors.columns]) if carry else F.lit(None).cast("boolean")
    v = F.col("vector")
    given = vectors.select(row.alias("row"), F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vector"))
    linkable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(v) & F.exists(v, lambda c: c != 0)
    content = ["label", "size", "h1", "h2"]
    keyed = given.withColumn("ok", linkable).withColumns({"size": F.size(v), "h1": F.xxhash64(v), "h2": F.xxhash64(F.lit(seed), v)})
    kinds = keyed.filter("ok").groupBy(*content, "vector").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least_id"))

    code = T.StructType([T.StructField("node", T.LongType()), *kinds.schema.fields, T.StructField("code", T.BinaryType()), T.StructField("factor", T.DoubleType())])

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            for size in np.unique(sizes):
                part = batch.take(pa.array(np.flatnonzero(sizes == size)))
                bits, factors = encode(matrix(part.column("vector"), float), seed)
                columns = [part.column(f.name) for f in code.fields[:-2]]
                yield pa.record_batch([*columns, pa.array([b.tobytes() for b in bits], pa.binary()), pa.array(factors)], names=code.names)

    # Numbers are given once, when the table is written; everything after reads them from there.
    numbered = kinds.select(F.monotonically_increasing_id().alias("node"), "*")
    nodes = stored(numbered.mapInArrow(coded, code), "nodes")
    counts = nodes.groupBy("label", "size").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    blocks = counts.select(F.col("label").alias("l"), F.col("size").alias("s"), F.ceil(F.col("n") / F.lit(block_rows)).cast("int").alias("blocks"))
    placed = nodes.join(blocks, (F.col("label") == F.col("l")) & (F.col("size") == F.col("s"))).drop("l", "s")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("node", F.lit(seed)), F.col("blocks")).cast("int"))
    dealt = placed.select(
        "label", "size", "node", "block", "vector", "copies", "code", "factor", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    ).withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})

    def meet(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        lo, block, number = table["lo"][0].as_py(), table["block"].to_numpy(), table["node"].to_numpy()
        same = lo == table["hi"][0].as_py()
        place = [np.flatnonzero(block == lo), np.flatnonzero(block != lo)]
        sides = [Side(table.take(pa.array(p)), seed, threshold, sure) if len(p) else None for p in place]
        if same:
            place[1], sides[1] = place[0], sides[0]
        links, roots = np.zeros(len(block), dtype=np.int64), np.arange(len(block))
        if sides[0] is not None and sides[1] is not None:
            copies = table["copies"].to_numpy()
            for i, j in linked_pairs(*sides, same, threshold):
                a, b = place[0][i], place[1][j]
                np.add.at(links, a, copies[b])
                np.add.at(links, b, copies[a])
                roots = join_roots(roots, a, b)
        found = links > 0
        return pa.table([number[found], links[found], number[roots[found]]], schema=MET)

    met = stored(dealt.groupBy("label", "size", "lo", "hi").applyInArrow(meet, "node long, links long, root long"), "met")
    linked = met.groupBy("node").agg(F.sum("links").alias("links"))
    ties = met.filter("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b"))
    settled = merge_labels(linked.select("node", F.col("node").alias("label")), ties).withColumnRenamed("label", "component")
    known = nodes.select("node", *content, "copies", "least_id")
    members = settled.join(known.select("node", "least_id"), "node")
    least = members.groupBy("component").agg(F.min("least_id").alias("component_id"))
    component = settled.join(least, "component").select("node", "component_id")
    # What has neither copies nor links needs no row here: it is its own component.
    told = known.join(linked, "node", "left").join(component, "node", "left").filter("copies > 1 or links is not null")
    told = told.select(*content, (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n"), F.coalesce("component_id", "least_id").alias("c"), F.lit(True).alias("ok"))
    out = keyed.select("row", "vec_id", "ok", *content).join(told, [*content, "ok"], "left")
    component_id = F.coalesce("c", "vec_id")
    return out.select(
        "row", "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component_id.alias("component_id"),
        F.coalesce(component_id == F.col("vec_id"), F.lit(False)).alias("kept"),
    )
