"""Substring dedup by level-wise doubling.

Level by level, windows of words that occur in several documents are kept, and windows of twice that length are looked at only
where the shorter ones were repeated, up to the removal length; a level without survivors ends the search by itself. The first level
looks only at the smallest-hashed window within each window of the removal length: equal long windows hold the same one, so
none is lost, and about one place in six is shuffled. At the last level every word covered by a window whose words also start
earlier (in a smaller id, or before in the same document) goes. Repeats within one document are found where the document is.

Whole copies of a text are found by two hashes first; only the smallest id of each text goes through the levels, the others lose all
their windows. Counting and smallest ids are map-side combined, so a passage of a third of all documents is no hot
group, and joins on window hashes are plain equi-joins that Spark splits where they are skewed. Windows are compared by 64-bit hashes.

Cases: texts of fewer words than a window, null and empty texts lose nothing; repeated rows (one id, one text) and different texts
under one id remove nothing from each other; a null id is the smallest; an empty table gives an empty table; extra columns are
ignored; long texts are worked off whole.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kithscope.llm.arrays import BLANK, HASH, Texts, Words, covered, find_words, mix, per_document, signed, slices, windows

LOWEST = -(1 << 63)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


class Windows:
    """Word windows of one slice of texts."""

    def __init__(self, texts: Texts) -> None:
        self.words: Words = find_words(texts, BLANK)
        self.sums = HASH.prefix(HASH.of_bytes(texts.buf, self.words.start, self.words.end))
        self.doc = self.words.doc()

    def starts(self, size: int) -> np.ndarray:
        return windows(self.words, size)

    def hashes(self, starts: np.ndarray, size: int) -> np.ndarray:
        return HASH.ranges(self.sums, starts, starts + size)

    def anchors(self, starts: np.ndarray, size: int, base: int) -> np.ndarray:
        """Smallest hash among the windows of ``base`` words within each window of ``size`` words."""
        n = len(self.doc)
        least = np.full(n, ~np.uint64(0))
        inner = self.starts(base)
        least[inner] = self.hashes(inner, base)
        wide, want = 1, size - base + 1
        while wide < want:
            step = min(wide, want - wide)
            least[: n - step] = np.minimum(least[: n - step], least[step:])
            wide += step
        return least[starts]

    def local(self, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Hashes that also tell documents of the slice apart."""
        return mix(hashes + self.doc[starts].astype(np.uint64) * GOLDEN)


def _listed(column: pa.Array, lo: int, n: int) -> np.ndarray:
    """Hash lists of rows lo:lo + n as hashes that tell the rows apart."""
    part = column.slice(lo, n)
    lengths = np.array([0 if x is None else x for x in part.value_lengths().to_pylist()], dtype=np.int64)
    values = part.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).view(np.uint64)
    return mix(values + np.repeat(np.arange(n), lengths).astype(np.uint64) * GOLDEN)


def _distinct(w: Windows, hashes: np.ndarray, starts: np.ndarray, ids: pa.Array) -> pa.RecordBatch:
    _, index = np.unique(w.local(hashes, starts), return_index=True)
    return pa.RecordBatch.from_arrays([signed(hashes[index]), ids.take(pa.array(w.doc[starts[index]]))], names=["h", "id_key"])


def first_level(texts: DataFrame, length: int, base: int) -> DataFrame:
    """(h, id_key): each document's anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, part in slices(batch.column("text")):
                w = Windows(part)
                starts = w.starts(length)
                yield _distinct(w, w.anchors(starts, length, base), starts, batch.column("id_key").slice(lo, hi - lo))

    return texts.select("id_key", "text").mapInArrow(run, "h long, id_key long")


def next_level(texts: DataFrame, length: int, base: int, size: int) -> DataFrame:
    """(h, id_key): windows of ``size`` words of documents with ``known`` windows (or anchors) of half that size repeated.

    ``size`` windows lie within windows of ``length`` words that may survive: after the anchors, those whose anchor is known;
    later, where both halves are known.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, part in slices(batch.column("text")):
                w = Windows(part)
                known = _listed(batch.column("known"), lo, hi - lo)
                if size == 2 * base:
                    starts = w.starts(length)
                    live = covered(starts[np.isin(w.local(w.anchors(starts, length, base), starts), known)], length, len(w.doc))
                    starts = w.starts(size)
                    total = np.concatenate([[0], np.cumsum(live)])
                    starts = starts[total[starts + size] - total[starts] == size]
                else:
                    half = size // 2
                    starts = w.starts(size)
                    ok = [np.isin(w.local(w.hashes(starts + at, half), starts), known) for at in (0, half)]
                    starts = starts[ok[0] & ok[1]]
                yield _distinct(w, w.hashes(starts, size), starts, batch.column("id_key").slice(lo, hi - lo))

    return texts.select("id_key", "text", "known").mapInArrow(run, "h long, id_key long")


def _of_several(found: DataFrame) -> DataFrame:
    """(h, least): windows of several documents, with the smallest id."""
    return found.groupBy("h").agg(F.min("id_key").alias("least"), F.max("id_key").alias("most")).filter("least < most").select("h", "least")


def without_windows(texts: DataFrame, length: int) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): words less those of ``known`` windows, repeats within the document and whole copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, part in slices(batch.column("text")):
                w = Windows(part)
                starts = w.starts(length)
                local = w.local(w.hashes(starts, length), starts)
                _, index = np.unique(local, return_index=True)
                again = np.ones(len(starts), dtype=bool)
                again[index] = False
                copy = batch.column("is_copy").slice(lo, hi - lo).to_numpy(zero_copy_only=False).astype(bool)
                gone = again | np.isin(local, _listed(batch.column("known"), lo, hi - lo)) | copy[w.doc[starts]]
                stay = ~covered(starts[gone], length, len(w.doc))
                n_words = np.diff(w.words.first)
                n_removed = n_words - per_document(stay, w.words.first)
                raw, kept = part.buf.tobytes(), []
                for i in range(hi - lo):
                    words = raw[part.offs[i] : part.offs[i + 1]].split()
                    if n_removed[i]:
                        words = itertools.compress(words, stay[w.words.first[i] : w.words.first[i + 1]].tolist())
                    kept.append(b" ".join(words))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id_key").slice(lo, hi - lo), pa.array(n_words), pa.array(n_removed), pa.array(kept, pa.binary()).cast(pa.string())],
                    names=["id_key", "n_words", "n_removed", "kept"],
                )

    done = texts.select("id_key", "text", "known", "is_copy").mapInArrow(run, "id_key long, n_words long, n_removed long, kept string")
    return done.select(F.nullif("id_key", F.lit(LOWEST)).alias("doc_id"), "n_words", "n_removed", "kept")


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, length: int = 20, first: int = 10) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) per document. ``length`` is ``first`` times a power of two."""
    if length <= first or length % first or (length // first) & (length // first - 1):
        raise ValueError("length must be first times 2, 4, 8, ...")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # Every pass joins all columns of this frame on id_key, so that one exchange of the texts serves them all.
    keyed = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)).alias("id_key"), text.alias("text"))
    keyed = keyed.select("id_key", F.xxhash64("text").alias("text_key"), "text")
    marks = keyed.select("id_key", "text_key", F.hash("text").alias("text_mark"))
    texts = marks.groupBy("text_key", "text_mark").agg(F.min("id_key").alias("least"), F.max("id_key").alias("most")).filter("least < most")
    copies = marks.join(texts, ["text_key", "text_mark"]).filter("id_key > least").select("id_key", F.col("text_key").alias("copy_key")).distinct()

    def joined(known: DataFrame | None, how: str) -> DataFrame:
        """Documents with their known windows; ``is_copy`` for those whose text a smaller id has."""
        more = copies.groupBy("id_key").agg(F.collect_set("copy_key").alias("copy_keys"))
        if known is not None:
            more = known.groupBy("id_key").agg(F.collect_list("h").alias("known")).join(more, "id_key", "full" if how == "left" else "left")
        else:
            more = more.withColumn("known", F.lit(None).cast("array<long>"))
        all_ = keyed.join(more, "id_key", how)
        return all_.withColumn("is_copy", F.coalesce(F.array_contains("copy_keys", F.col("text_key")), F.lit(False)))

    found, size = first_level(joined(None, "left").filter("not is_copy"), length, first), first
    while size < length:
        size *= 2
        known = found.join(_of_several(found).select("h"), "h").select("id_key", "h")
        found = next_level(joined(known, "inner").filter("not is_copy"), length, first, size)
    later = found.join(_of_several(found), "h").filter("id_key > least").select("id_key", "h")
    return without_windows(joined(later, "left"), length)
