"""Line dedup by a sharded minimal perfect hash.

Spark counts in how many documents each distinct line occurs (map-side combined, so a line of a third of all documents
is no hot group). All distinct lines are cut into shards of about ``SHARD_LINES`` by hash; one task per shard builds a
minimal perfect hash with arrays of fingerprints, counts and keepers. Documents then probe the arrays: a
line's hash is sent to its shard, where it streams past the arrays; the count found there decides, and only the places of lines to drop
come back. A shard whose lines occur very often is replicated and its probes are dealt over the replicas.

Cases: a null or empty text is one empty line; lines that repeat within one document count once; a document is a row, so
repeated rows count each and all rows with the largest doc_id keep the line; a null doc_id is the smallest;
an empty table gives an empty table; extra columns are carried whatever their names; long texts are worked off whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kithscope.llm.arrays import BLANK, HASH, LOWER, SECOND, Texts, code_points, find_lines, find_words, mix, signed, slices
from kithscope.llm.frames import carried, stored, with_text

LOWEST = -(1 << 63)
SHARD_LINES = 50_000
REPLICA_PROBES = 500_000


def line_hashes(texts: Texts, min_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, line number, hash, second hash) of each line whose key has at least ``min_chars`` code points."""
    texts = Texts(LOWER[texts.buf], texts.offs)
    lines, words = find_lines(texts), find_words(texts, BLANK)
    lo, hi = np.searchsorted(words.start, lines.start), np.searchsorted(words.start, lines.end)
    full = np.flatnonzero(hi > lo)
    start, end = words.start[lo[full]], words.end[hi[full] - 1]
    points = code_points(texts.buf)
    long_enough = points[end] - points[start] >= min_chars
    full, start, end = full[long_enough], start[long_enough], end[long_enough]
    doc = lines.doc()[full]
    return doc, full - lines.first[doc], HASH.of_bytes(texts.buf, start, end), SECOND.of_bytes(texts.buf, start, end)


def _keyed(docs: DataFrame, id_col: str, text_col: str, carry: bool) -> DataFrame:
    """(row, doc_id, text, id_key, text_key): the keys name a row's document, also where ids are null or used twice."""
    keys = {"id_key": F.coalesce("doc_id", F.lit(LOWEST)), "text_key": F.xxhash64(F.coalesce("text", F.lit("")))}
    return carried(docs, id_col, text_col, carry).withColumns(keys)


def _hashed(keyed: DataFrame, min_chars: int, once: bool) -> DataFrame:
    """One row per long line (per distinct one of a document if ``once``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, texts in slices(batch.column("text")):
                doc, line, first, second = line_hashes(texts, min_chars)
                ids = batch.column("id_key").slice(lo, hi - lo)
                if once:
                    _, keep = np.unique(mix(first + doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ second, return_index=True)
                    yield pa.RecordBatch.from_arrays([signed(first[keep]), signed(second[keep]), ids.take(pa.array(doc[keep]))], names=["h1", "h2", "id_key"])
                else:
                    rows = pa.array(doc)
                    yield pa.RecordBatch.from_arrays(
                        [signed(first), signed(second), ids.take(rows), batch.column("text_key").slice(lo, hi - lo).take(rows), pa.array(line.astype(np.int32))],
                        names=["h1", "h2", "id_key", "text_key", "line"],
                    )

    schema = "h1 long, h2 long, id_key long" + ("" if once else ", text_key long, line int")
    return keyed.select("id_key", "text_key", "text").mapInArrow(run, schema)


class PerfectHash:
    """Minimal perfect hash by levels of bitmaps: a key's place is the rank of its bit in the first level that is its alone."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray) -> None:
        self.sizes, self.bits = sizes, bits
        self.rank = np.concatenate([[0], np.cumsum(bits)])

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (mix(keys + np.uint64(level + 1) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        """``keys`` are distinct, so some level separates any two of them."""
        sizes, levels = [], []
        while len(keys):
            size = 2 * len(keys) + 1
            at = cls._place(keys, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            keys = keys[~alone[at]]
        return cls(np.array(sizes, dtype=np.int64), np.concatenate(levels) if levels else np.zeros(0, dtype=bool))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places of ``keys``; -1 or any place for a key that is not in the table."""
        out = np.full(len(keys), -1, dtype=np.int64)
        open_, base = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = base + self._place(keys[open_], level, int(size))
            here = self.bits[at]
            out[open_[here]] = self.rank[at[here]]
            open_, base = open_[~here], base + int(size)
        return out


def _shard(n: int) -> Column:
    return F.pmod(F.shiftrightunsigned("h1", 20), F.lit(n)).cast("int")


ARRAYS = "shard int, probes long, sizes binary, bits binary, fingerprints binary, counts binary, keepers binary"


def build_arrays(counted: DataFrame, shards: int) -> DataFrame:
    """One row of arrays per shard of (h1, h2, n_docs, keeper). A shard is bounded: ``shards`` follows the number of lines."""

    def build(group: pd.DataFrame) -> pd.DataFrame:
        key = (group["h1"].to_numpy().view(np.uint64) ^ mix(group["h2"].to_numpy().view(np.uint64))).copy()
        table = PerfectHash.build(key)
        order = np.empty(len(key), dtype=np.int64)
        order[table.find(key)] = np.arange(len(key))
        arrays = [table.sizes, np.packbits(table.bits), *(group[c].to_numpy()[order] for c in ("h2", "n_docs", "keeper"))]
        return pd.DataFrame([[group["shard"].iloc[0], group["n_docs"].sum(), *(a.tobytes() for a in arrays)]], columns=[c.split()[0] for c in ARRAYS.split(", ")])

    return counted.withColumn("shard", _shard(shards)).groupBy("shard").applyInPandas(build, ARRAYS)


def probe(probes: DataFrame, arrays: DataFrame, shards: int, min_docs: int) -> DataFrame:
    """(id_key, text_key, line) of the lines to drop: those counted in ``min_docs`` documents or more, but for the keeper's.

    Rows of a shard stream past its arrays, which come first.
    """
    spread = F.lit(1)
    # No more entries than one in REPLICA_PROBES probes.
    hot = {r["shard"]: 1 + int(r["probes"]) // REPLICA_PROBES for r in arrays.select("shard", "probes").filter(F.col("probes") >= REPLICA_PROBES).collect()}
    if hot:
        spread = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for item in hot.items() for x in item)), F.col("shard")), F.lit(1))
    blobs = ["sizes", "bits", "fingerprints", "counts", "keepers"]
    places = ["h1", "h2", "id_key", "text_key", "line"]
    left = arrays.withColumn("replica", F.explode(F.sequence(F.lit(0), spread - 1))).select(
        "shard", "replica", F.lit(0).alias("kind"), *blobs, *(F.lit(None).cast("int" if c == "line" else "long").alias(c) for c in places)
    )
    right = probes.withColumn("shard", _shard(shards)).select(
        "shard", F.pmod(F.xxhash64("id_key", "text_key", "line"), spread).cast("int").alias("replica"), F.lit(1).alias("kind"), *(F.lit(None).cast("binary").alias(c) for c in blobs), *places
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, table, fingerprints, counts, keepers = -1, None, None, None, None
        for batch in batches:
            shards_, kinds = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("shard", "kind"))
            cuts = np.flatnonzero((shards_[1:] != shards_[:-1]) | (kinds[1:] == 0) | (kinds[:-1] == 0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(kinds)], strict=True):
                if lo == hi:
                    continue
                if kinds[lo] == 0:
                    sizes, bits, second, docs, keep = (batch.column(c)[int(lo)].as_py() for c in blobs)
                    sizes = np.frombuffer(sizes, dtype=np.int64)
                    table = PerfectHash(sizes, np.unpackbits(np.frombuffer(bits, dtype=np.uint8), count=int(sizes.sum())).astype(bool))
                    fingerprints, counts, keepers = (np.frombuffer(x, dtype=np.int64) for x in (second, docs, keep))
                    shard = shards_[lo]
                elif shards_[lo] == shard:
                    part = batch.slice(lo, hi - lo)
                    h1, h2, ids = (part.column(c).to_numpy() for c in ("h1", "h2", "id_key"))
                    at = table.find(h1.view(np.uint64) ^ mix(h2.view(np.uint64)))
                    drop = (at >= 0) & (fingerprints[at] == h2) & (counts[at] >= min_docs) & (keepers[at] != ids)
                    yield pa.RecordBatch.from_arrays([part.column(c).filter(pa.array(drop)) for c in places[2:]], names=places[2:])

    dealt = left.unionByName(right).repartition("shard", "replica").sortWithinPartitions("shard", "replica", "kind")
    return dealt.mapInArrow(run, "id_key long, text_key long, line int")


def _masks(dropped: DataFrame) -> DataFrame:
    """(id_key, text_key, mask): mask[i] says whether line i goes, up to the last such line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks = []
            for lines in batch.column("lines").to_pylist():
                mask = np.zeros(max(lines) + 1, dtype=bool)
                mask[lines] = True
                masks.append(mask)
            yield pa.RecordBatch.from_arrays([batch.column("id_key"), batch.column("text_key"), pa.array(masks, pa.list_(pa.bool_()))], names=["id_key", "text_key", "mask"])

    grouped = dropped.groupBy("id_key", "text_key").agg(F.collect_set("line").alias("lines"))
    return grouped.mapInArrow(run, "id_key long, text_key long, mask array<boolean>")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_chars: int = 20, min_docs: int = 3, carry: bool = False) -> DataFrame:
    """(row, doc_id, text, n_lines, n_dropped, kept) per document; ``kept`` is the text of the lines that stay."""
    keyed = _keyed(docs, id_col, text_col, carry)
    counted = _hashed(keyed, min_chars, once=True).groupBy("h1", "h2").agg(F.count("*").alias("n_docs"), F.max("id_key").alias("keeper"))
    counted = stored(counted, "lines")
    shards = 1 + counted.count() // SHARD_LINES
    arrays = stored(build_arrays(counted, shards), "line-arrays")
    masks = _masks(probe(_hashed(keyed, min_chars, once=False), arrays, shards, min_docs))
    joined = keyed.join(masks, ["id_key", "text_key"], "left")
    text = F.coalesce("text", F.lit(""))
    lines = F.split(text, "\n", -1)
    kept = F.array_join(F.filter(lines, lambda x, i: ~F.coalesce(F.get("mask", i), F.lit(False))), "\n")
    n_dropped = F.when(F.col("mask").isNull(), 0).otherwise(F.size(F.filter("mask", lambda x: x)))
    return joined.select(
        "row",
        "doc_id",
        "text",
        (F.length(text) - F.length(F.translate(text, "\n", "")) + 1).cast("long").alias("n_lines"),
        n_dropped.cast("long").alias("n_dropped"),
        F.when(F.col("mask").isNull(), text).otherwise(kept).alias("kept"),
    )


def drop_repeated_lines(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` without repeated lines; documents that lose nothing keep their text as it is, null or not."""
    done = dedup_lines(docs, text_col=text_col, carry=True, **options)
    return done.select(*with_text(F.when(F.col("n_dropped") > 0, F.col("kept")).otherwise(F.col("text")), docs.columns, text_col))
