"""Embedding whitening: all covariances from variances alone, by polarisation.

Entries become whole numbers x = floor(scale * c) + 1,000,000. Over the distinct x-vectors Spark adds up, for every dimension and every
sum of two dimensions, the squared centred values; Var(i + j) - Var(i) - Var(j) is twice Cov(i, j). All sums are exact:
values are centred on the whole number next to the mean, what that leaves of the mean is taken off at the end in Python's
integers, and only the finished quotients are rounded. The symmetric matrix goes through ``eigh`` on the driver.

Bounds: a task holds one slab of rows and one total per pair of dimensions; the driver gets d (d + 1) / 2 totals. Nothing
else depends on the number of rows, and a vector that many rows share is one row of the fit list before any sum.

Nulls: rows whose vector is null, empty or has a null, NaN or infinite entry are dropped. Vectors of another length than most distinct
ones (of several such lengths: the largest) are dropped too. Rows without id are kept, with a null id. Repeated rows each
get their result and count once in the fit. Components whose eigenvalue is not above 1e-12 of the first are left out, as
nothing can be divided by their spread; a table of one distinct vector, or an empty one, gives no rows. Scaled entries
beyond 2^53 count as that. Further columns, whatever their names, travel in ``row`` if asked for.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kithscope.llm.frames import stored
from kithscope.llm.vectors import ints, largest, matrix, usable, whole

SHIFT = 1_000_000
SLAB = 1 << 19
"""Entries worked on at once."""

EXACT = pa.decimal128(38, 0)
FIELDS = [("n", T.LongType()), ("deviation", T.DecimalType(38, 0)), ("whitened", T.ArrayType(T.DoubleType())), ("explained", T.ArrayType(T.DoubleType()))]


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """(length, matrix) of each length, in slabs."""
    sizes = np.asarray(pc.list_value_length(batch.column("x")))
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        step = max(1, SLAB // max(1, int(size)))
        for lo in range(0, len(rows), step):
            yield int(size), matrix(batch.column("x").take(pa.array(rows[lo : lo + step])), np.int64)


def _totals(fit: DataFrame, of_slab: Callable[[np.ndarray], list[int]]) -> dict[int, list[int]]:
    """Exact totals of ``of_slab`` over all rows, by length of vector: one row per task and total, added up by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[int]] = {}
        for batch in batches:
            for size, x in _by_length(batch):
                part = of_slab(x)
                held[size] = [a + b for a, b in zip(held[size], part)] if size in held else part
        for size, values in held.items():
            yield pa.record_batch(
                [pa.array([size] * len(values), pa.int32()), pa.array(range(len(values)), pa.int32()), pa.array([Decimal(v) for v in values], EXACT)],
                names=["size", "place", "total"],
            )

    rows = fit.mapInArrow(run, "size int, place int, total decimal(38,0)").groupBy("size", "place").agg(F.sum("total").alias("total")).collect()
    out: dict[int, dict[int, int]] = defaultdict(dict)
    for r in rows:
        out[r["size"]][r["place"]] = int(r["total"])
    return {size: [places[k] for k in range(len(places))] for size, places in out.items()}


def _sums(x: np.ndarray) -> list[int]:
    return [len(x), *(int(v) for v in ints(x, largest(x) * len(x)).sum(axis=0))]


def _squares(x: np.ndarray, centre: np.ndarray) -> list[int]:
    """Sums of u_i^2, then for each i of (u_i + u_j)^2 for all j above it."""
    u = x - centre
    u = ints(u, (2 * largest(u)) ** 2 * len(u))
    out = list((u * u).sum(axis=0))
    for i in range(u.shape[1] - 1):
        both = u[:, i + 1 :] + u[:, i : i + 1]
        out.extend((both * both).sum(axis=0))
    return [int(v) for v in out]


def covariance(n: int, rest: list[int], squares: list[int]) -> np.ndarray:
    """The covariances (divisor n) from sums of squares around a whole centre; ``rest`` is n * (mean - centre)."""
    d = len(rest)
    # n^2 times each variance, exact; those of the sums of two dimensions follow those of single ones.
    single = [n * squares[i] - rest[i] ** 2 for i in range(d)]
    out = np.zeros((d, d))
    place = d
    for i in range(d):
        out[i, i] = single[i] / n**2
        for j in range(i + 1, d):
            both = n * squares[place] - (rest[i] + rest[j]) ** 2
            out[i, j] = out[j, i] = (both - single[i] - single[j]) / (2 * n**2)
            place += 1
    return out


def whiten(
    vectors: DataFrame, components: int = 16, scale: int = 64, id_col: str = "vec_id", vector_col: str = "embedding", carry: bool = False
) -> DataFrame:
    """(row, vec_id, n, deviation, whitened, explained, identity_error), one row per usable vector, components by falling variance."""
    spark = vectors.sparkSession
    row = F.struct(*[vectors[c] for c in vectors.columns]) if carry else F.lit(None).cast("boolean")
    given = vectors.select(row.alias("row"), F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v")).filter(usable(F.col("v")))
    scaled = given.select("row", "vec_id", whole(F.col("v"), scale, SHIFT).alias("x"))
    fields = [T.StructField("row", scaled.schema["row"].dataType), T.StructField("vec_id", T.LongType()), *(T.StructField(n, t) for n, t in FIELDS)]
    schema = T.StructType(fields)
    fit = stored(scaled.select("x").distinct(), "fit")

    sums = _totals(fit, _sums)
    if not sums:
        return spark.createDataFrame([], schema).withColumn("identity_error", F.lit(0.0))
    d = max(sums, key=lambda size: (sums[size][0], size))
    n, totals = sums[d][0], sums[d][1:]
    middle = [(s + n // 2) // n for s in totals]
    rest = [s - n * m for s, m in zip(totals, middle)]
    centre = np.array(middle, dtype=np.int64)
    fit = fit.filter(F.size("x") == d)
    cov = covariance(n, rest, _totals(fit, lambda x: _squares(x, centre))[d])
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    k = int((values[:components] > max(values[0], 0.0) * 1e-12).sum())
    if not k:
        return spark.createDataFrame([], schema).withColumn("identity_error", F.lit(0.0))
    shares = values[:k] / np.trace(cov)
    to_white = axes[:, :k] / np.sqrt(values[:k])
    offset = np.array([r / n for r in rest])

    def white(x: np.ndarray) -> np.ndarray:
        return ((x - centre) - offset) @ to_white

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k * k + k)
        for batch in batches:
            for _, x in _by_length(batch):
                w = white(x)
                total += np.concatenate([(w.T @ w).ravel(), w.sum(axis=0)])
        yield pa.record_batch([pa.array(range(len(total)), pa.int32()), pa.array(total)], names=["place", "total"])

    found = fit.mapInArrow(products, "place int, total double").groupBy("place").agg(F.sum("total").alias("total")).orderBy("place").collect()
    flat = np.array([r["total"] for r in found]) / n
    error = float(np.abs(flat[: k * k].reshape(k, k) - np.outer(flat[k * k :], flat[k * k :]) - np.eye(k)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            step = max(1, SLAB // d)
            for lo in range(0, batch.num_rows, step):
                part = batch.slice(lo, step)
                x = matrix(part.column("x"), np.int64)
                u = x - centre
                far = ints(u, d * (n * (largest(u) + 1)) ** 2) * n - (np.array(rest, dtype=object) if n * (largest(u) + 1) >= 1 << 31 else np.array(rest, dtype=np.int64))
                apart = [Decimal(int(v)) for v in (far * far).sum(axis=1)]
                lists = lambda a: pa.ListArray.from_arrays(pa.array(np.arange(len(a) + 1) * k, pa.int32()), pa.array(a.ravel()))
                yield pa.record_batch(
                    [part.column("row"), part.column("vec_id"), pa.array([n] * len(x), pa.int64()), pa.array(apart, EXACT), lists(white(x)), lists(np.tile(shares, (len(x), 1)))],
                    names=schema.names,
                )

    return scaled.filter(F.size("x") == d).mapInArrow(project, schema).withColumn("identity_error", F.lit(error))
