"""Parquet tables that grow by deltas: a merge writes the rows it changed, never the rest.

Every merge appends one version folder, split by hash bucket of the first key, with the new state of the keys it was
given, or only its new keys. Readers take the newest row of each key over all versions since the last compaction; ``compact`` writes that as one
version and removes the older folders. A version counts once the manifest names it, so readers never see half a merge.
A merge may carry a tag (a stream batch id): a tag seen before changes nothing. One writer at a time: a merge that
finds another version committed meanwhile is refused.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kithscope.operators.merges import earliest, latest
from kithscope.operators.ordering import BROADCAST_ROWS
from kithscope.session import scratch_path

Merge = Callable[[DataFrame, DataFrame], DataFrame]
MANIFEST = "version int, tag string, whole boolean, added boolean"
ROWS_PER_FILE = 1_000_000


class SnapshotTable:
    def __init__(self, spark: SparkSession, root: str, schema: str, keys: list[str], buckets: int = 64):
        self.spark, self.root, self.schema, self.keys, self.buckets = spark, root.rstrip("/"), schema, keys, buckets

    def _bucket(self):
        # The first key alone places a row, so tables that share it keep their rows in equal buckets.
        return F.pmod(F.xxhash64(self.keys[0]), F.lit(self.buckets)).cast("int")

    def _entries(self) -> list:
        """One small row per merge, oldest first."""
        try:
            return sorted(self.spark.read.schema(MANIFEST).json(f"{self.root}/manifest").collect(), key=lambda e: e.version)
        except AnalysisException:  # nothing merged yet
            return []

    def _manifest(self, entries: list | None = None) -> list:
        """The merges since the last compaction."""
        entries = self._entries() if entries is None else entries
        whole = max((e.version for e in entries if e.whole), default=0)
        return [e for e in entries if e.version >= whole]

    def columns(self) -> list[str]:
        return self.spark.createDataFrame([], self.schema).columns

    def version(self) -> int:
        return max((e.version for e in self._manifest()), default=0)

    def applied(self, tag: str) -> bool:
        return any(e.tag == tag for e in self._entries())

    def _empty(self) -> DataFrame:
        # Known to the optimizer as empty, so that a join with it is none.
        fields = self.spark.createDataFrame([], self.schema).schema
        return self.spark.range(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in fields))

    def _version(self, version: int, buckets: list[int] | None) -> DataFrame | None:
        """One version's rows, of some buckets only if asked; their folders are no columns, whatever the table's are called."""
        path = f"{self.root}/data/v={version}"
        if buckets is not None:
            path += f"/bucket={{{','.join(map(str, buckets))}}}"
        try:
            return self.spark.read.schema(self.schema).option("recursiveFileLookup", True).parquet(path)
        except AnalysisException:  # none of these buckets in this version
            return None

    def _versions(self, entries: list, buckets: list[int] | None) -> list[tuple[int, DataFrame]]:
        return [(e.version, rows) for e in entries if (rows := self._version(e.version, buckets)) is not None]

    def _matching(self, rows: DataFrame, keys: DataFrame) -> DataFrame:
        asked = keys.select(*(F.col(k).alias(f"_{k}") for k in self.keys))
        return rows.join(asked, [F.col(f"_{k}").eqNullSafe(F.col(k)) for k in self.keys], "left_semi")

    def _read(self, entries: list, buckets: list[int] | None = None, keys: DataFrame | None = None) -> DataFrame:
        columns = self.columns()
        found = self._versions(entries, buckets)
        if keys is not None:
            found = [(version, self._matching(rows, keys)) for version, rows in found]
        if not found:
            return self._empty()
        # Versions that only added keys, each once, need no look at each other.
        if len(found) == 1 or all(e.added for e in entries):
            return functools.reduce(DataFrame.unionByName, [rows for _version, rows in found])
        rest = F.struct(*(c for c in columns if c not in self.keys))
        tagged = [rows.select(*self.keys, rest.alias("_row"), F.lit(version).alias("_version")) for version, rows in found]
        newest = functools.reduce(DataFrame.unionByName, tagged).groupBy(*self.keys).agg(F.max_by("_row", "_version").alias("_row"))
        return newest.select(*self.keys, "_row.*").select(*columns)

    def read(self) -> DataFrame:
        return self._read(self._manifest())

    def read_for(self, rows: DataFrame) -> DataFrame:
        """The stored rows in the buckets that the first key of ``rows`` touches."""
        return self._read(self._manifest(), self._touched(rows))

    def _touched(self, rows: DataFrame) -> list[int]:
        # One small integer per bucket comes back, never data.
        return sorted(r.b for r in rows.select(self._bucket().alias("b")).distinct().collect())

    def _commit(self, rows: DataFrame, seen: int, tag: str | None, whole: bool, added: bool = False, skip_empty: bool = False) -> int:
        version = seen + 1
        # A bucket may be large: its rows go to as many files as its share of all rows asks for.
        parts = rows.withColumn("bucket", self._bucket())
        slot = F.pmod(F.xxhash64(*self.keys, F.lit("slot")), F.lit(8))
        writer = parts.repartition(F.col("bucket"), slot).write.option("maxRecordsPerFile", ROWS_PER_FILE).option("compression", "zstd")
        writer.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/data/v={version}")
        if self.version() != seen:
            raise RuntimeError(f"another writer has changed {self.root}")
        if skip_empty and ((written := self._version(version, None)) is None or written.isEmpty()):
            return seen
        entry = self.spark.createDataFrame([(version, tag, whole, added)], MANIFEST)
        entry.coalesce(1).write.mode("append").json(f"{self.root}/manifest")
        return version

    def _begin(self, tag: str | None) -> tuple[list, int, bool]:
        """Entries to read, the current version, and whether ``tag`` was merged before."""
        every = self._entries()
        entries = self._manifest(every)
        return entries, max((e.version for e in entries), default=0), tag is not None and any(e.tag == tag for e in every)

    def merge(self, incoming: DataFrame, resolve: Merge, tag: str | None = None) -> int:
        """Append ``resolve(stored, incoming)`` for the keys of ``incoming``; returns the current version."""
        entries, seen, done = self._begin(tag)
        if done:
            return seen
        if not entries:
            return self._commit(resolve(self._empty(), incoming), seen, tag, whole=False, skip_empty=True)
        touched = self._touched(incoming)
        if not touched:
            return seen
        # The stored keys asked for come first, alone: mostly they are few, and whole rows then stay where they are.
        keys = incoming.select(*self.keys).distinct()
        known = self._matching(functools.reduce(DataFrame.unionByName, [rows.select(*self.keys) for _version, rows in self._versions(entries, touched)] or [self._empty().select(*self.keys)]), keys)
        path = scratch_path(self.spark, "known-keys")
        known.distinct().write.parquet(path)
        known = self.spark.read.schema(known.schema).parquet(path)
        if known.count() <= BROADCAST_ROWS:
            known = F.broadcast(known)
        stored = self._read(entries, touched, known)
        return self._commit(resolve(stored, incoming), seen, tag, whole=False)

    def insert(self, incoming: DataFrame, order: Column, tag: str | None = None) -> int:
        """Add the first row by ``order`` of every key not stored yet; stored rows stay where they are. Returns the current version.

        Of the stored rows only the keys are read; they and the incoming rows are combined map-side and shuffled once.
        """
        entries, seen, done = self._begin(tag)
        if done:
            return seen
        if not entries:
            return self._commit(self._absent(incoming, order, [], None), seen, tag, whole=False, added=True, skip_empty=True)
        touched = self._touched(incoming)
        if not touched:
            return seen
        return self._commit(self._absent(incoming, order, entries, touched), seen, tag, whole=False, added=True)

    def absent(self, incoming: DataFrame, order: Column) -> DataFrame:
        """What ``insert`` would add."""
        entries = self._manifest()
        return self._absent(incoming, order, entries, self._touched(incoming) if entries else None)

    def _absent(self, incoming: DataFrame, order: Column, entries: list, buckets: list[int] | None) -> DataFrame:
        known = [rows.select(*self.keys, F.lit(True).alias("_known")) for _version, rows in self._versions(entries, buckets)]
        if not known:
            return earliest(incoming.select(*self.columns()), self.keys, order)
        rest = [c for c in self.columns() if c not in self.keys]
        given = incoming.select(*self.keys, F.struct(*rest).alias("_row"), F.struct(order.isNull(), order).alias("_order"))
        both = functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [given, *known])
        found = both.groupBy(*self.keys).agg(F.min_by("_row", "_order").alias("_row"), F.max("_known").alias("_known"))
        return found.filter("_known is null").select(*self.keys, "_row.*").select(*self.columns())

    def replace(self, incoming: DataFrame, order: Column, tag: str | None = None) -> int:
        """The last row by ``order`` of every key of ``incoming`` takes the place of what is stored. Returns the current version."""
        entries, seen, done = self._begin(tag)
        if done:
            return seen
        return self._commit(latest(incoming.select(*self.columns()), self.keys, order), seen, tag, whole=False, added=not entries, skip_empty=True)

    def compact(self) -> int:
        """All rows as one version; folders of older versions go. Readers that began before may have to begin again."""
        entries = self._manifest()
        seen = max((e.version for e in entries), default=0)
        if len(entries) < 2:
            return seen
        version = self._commit(self._read(entries), seen, None, whole=True, added=True)
        jvm = self.spark._jvm
        for e in entries:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/data/v={e.version}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        return version
