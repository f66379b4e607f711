"""Sharding by extendible hashing.

The directory is a tree of hash prefixes: a bucket whose rows exceed the byte limit splits on its next bit, others stay as they are,
until every shard fits. The sizes of all prefixes come from one aggregation over cells (long prefixes, some 64 per
expected shard), so no level needs a pass of its own over the rows; only cells that are still too large, as under a hot
key, go on to more bits with their rows alone.

A row's bits are those of its key, then of its whole content, then of its place in the input. So rows of one key share a shard as
long as they fit, a key of a third of all rows is split like any bucket, and even repeated rows can be told apart.

Cases: a row larger than the limit is a shard of its own; null keys are one key; an empty text has 0 bytes; an empty table gives an
empty directory; columns of any name may come along.
"""

from __future__ import annotations

from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kithscope.llm.frames import stored

PART_BITS = 60
MOST_BITS = 3 * PART_BITS
CELLS_PER_SHARD = 64
DEEPER_BITS = 16


def hash_bits(value: Column) -> Column:
    """60 bits of the md5 of a string, as text of 0 and 1."""
    return F.lpad(F.conv(F.substring(F.md5(value), 1, PART_BITS // 4), 16, 2), PART_BITS, "0")


def _leaves(cells: DataFrame, from_bits: int, to_bits: int, max_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(cell, shard, depth, shard_bytes, shard_rows) of prefixes of ``from_bits`` to ``to_bits`` bits that fit; cells too large for any."""
    paths = cells.select("cell", "n_bytes", "n_rows", F.explode(F.sequence(F.lit(from_bits), F.lit(to_bits))).alias("depth"))
    paths = paths.withColumn("shard", F.substring("cell", F.lit(1), F.col("depth")))
    sizes = paths.groupBy("shard", "depth").agg(F.sum("n_bytes").alias("shard_bytes"), F.sum("n_rows").alias("shard_rows"))
    fits = (F.col("shard_bytes") <= max_bytes) | (F.col("shard_rows") == 1)
    parents = sizes.filter(~fits).select(F.col("shard").alias("parent"), F.col("depth").alias("parent_depth"))
    child = sizes.filter(fits).withColumn("parent", F.expr("substring(shard, 1, depth - 1)")).withColumn("parent_depth", F.col("depth") - 1)
    top = child.filter(F.col("depth") == from_bits)
    leaves = top.unionByName(child.filter(F.col("depth") > from_bits).join(parents, ["parent", "parent_depth"], "left_semi"))
    leaves = leaves.select("shard", "depth", "shard_bytes", "shard_rows")
    oversize = sizes.filter(~fits & (F.col("depth") == to_bits)).select(F.col("shard").alias("cell"))
    return paths.select("cell", "shard", "depth").join(leaves, ["shard", "depth"]), oversize


def shard_rows(df: DataFrame, key: list[Column], size: Column, content: list[Column], max_bytes: int) -> DataFrame:
    """``df`` as (row, n_bytes, shard, depth, shard_bytes, shard_rows); ``shard`` is the prefix of bits, ``depth`` its length.

    Leaves cover the bits without gap or overlap, so each row has exactly one shard.
    """
    text = lambda cols: F.concat_ws("\x1f", *(F.coalesce(c.cast("string"), F.lit("\x00")) for c in cols))
    bits = F.concat(hash_bits(text(key)), hash_bits(text([*key, *content])), hash_bits(F.monotonically_increasing_id().cast("string")))
    rows = df.select(F.struct(*df.columns).alias("row"), bits.alias("bits"), F.coalesce(size, F.lit(0)).cast("long").alias("n_bytes"))
    total = df.select(F.sum(F.coalesce(size, F.lit(0))).alias("n")).first()["n"] or 0
    to_bits = min(MOST_BITS, ceil(log2(max(1, total / max_bytes))) + int(log2(CELLS_PER_SHARD)))
    from_bits, parts, open_rows = 0, [], rows
    while True:
        celled = open_rows.withColumn("cell", F.substring("bits", 1, to_bits))
        cells = stored(celled.groupBy("cell").agg(F.sum("n_bytes").alias("n_bytes"), F.count("*").alias("n_rows")), "cells")
        directory, oversize = _leaves(cells, from_bits, to_bits, max_bytes)
        parts.append(celled.join(stored(directory, "directory"), "cell").select("row", "n_bytes", "shard", "depth", "shard_bytes", "shard_rows"))
        if to_bits == MOST_BITS or (oversize := stored(oversize, "oversize")).isEmpty():
            break
        open_rows = celled.join(oversize, "cell", "left_semi").select("row", "bits", "n_bytes")
        from_bits, to_bits = to_bits + 1, min(MOST_BITS, to_bits + DEEPER_BITS)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def shard_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_col: str | None = None, *, max_bytes: int) -> DataFrame:
    """Documents sharded by ``key_col`` (the id unless given), sized by the UTF-8 bytes of their texts."""
    return shard_rows(docs, [F.col(key_col or id_col)], F.octet_length(text_col), [F.col(id_col), F.col(text_col)], max_bytes)


def write_shards(sharded: DataFrame, path: str) -> None:
    """The rows as Parquet, one folder per shard."""
    sharded.select("shard", "row.*").repartition("shard").write.partitionBy("shard").parquet(path)
