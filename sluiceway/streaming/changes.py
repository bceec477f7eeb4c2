"""A table by key as a log of changes: a write costs what it writes, whatever the table holds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway import storage
from sluiceway.operators.ranking import latest
from sluiceway.sinks import merge

VERSION = "_version"


class ChangeLog:
    """Rows by key below ``path``: a compacted table in ``base`` and later versions of rows in ``changes``.

    ``append`` stages a frame and publishes it with one rename as the next version; a crash leaves nothing
    half written, and rows that are appended again are newer versions of themselves. ``read`` takes the newest
    version of every key. ``compact`` moves the versions into the base; broken off at any point, it leaves
    a log that reads the same. One writer and one compaction at a time; keys are unique within a version,
    and null keys are equal to each other.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], partition_by: list[str] | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.partition_by = list(keys), list(partition_by or [])
        self.base, self.changes = f"{self.path}/base", f"{self.path}/changes"

    def versions(self) -> list[int]:
        """Numbers of the versions that are not compacted yet."""
        if not storage.exists(self.spark, self.changes):
            return []
        return sorted(int(name.rpartition("=")[2]) for name in storage.subfolders(self.spark, self.changes, 1))

    def append(self, rows: DataFrame) -> int:
        """Writes rows that are new or replace those with their keys; returns the version's number."""
        staged = f"{self.path}/_staged_{storage.unused()}"
        rows.write.parquet(staged)
        known = self.versions()
        version = known[-1] + 1 if known else 0
        storage.make_folder(self.spark, self.changes)
        storage.move(self.spark, staged, self._folder(version))
        return version

    def read(self, schema: T.StructType | None = None) -> DataFrame:
        """The newest row of every key. Without a schema, partition values get the type their text suggests.

        The base is not shuffled as long as the changes are small enough to be sent to its tasks, and a
        log without changes is a plain scan.
        """
        changes = self._changes(self.versions(), schema)
        if changes is None:
            return self._base(schema)
        newest = latest(changes, self.keys, [F.desc(VERSION)]).drop(VERSION)
        if not self._has_base():
            return newest
        base = self._base(newest.schema)
        same = reduce(lambda a, b: a & b, [F.col(f"b.{k}").eqNullSafe(F.col(f"n.{k}")) for k in self.keys])
        return base.alias("b").join(newest.select(*self.keys).alias("n"), same, "left_anti").unionByName(newest)

    def compact(self) -> int:
        """Moves all versions there are into the base; returns how many.

        Where the base is partitioned by some of the keys, only the partitions that have changes are written.
        """
        storage.recover(self.spark, self.base)
        versions = self.versions()
        changes = self._changes(versions, None)
        if changes is None:
            return 0
        rows, depth = changes, 0
        if self._has_base():
            base = self._base(changes.drop(VERSION).schema)
            if self.partition_by and set(self.partition_by) <= set(self.keys):
                base = merge.touched(base, changes, self.partition_by, self.base)
                depth = len(self.partition_by)
            rows = changes.unionByName(base.withColumn(VERSION, F.lit(-1)))
        newest = merge.arranged(latest(rows, self.keys, [F.desc(VERSION)]).drop(VERSION), self.partition_by)
        staged = storage.sibling(self.base, "staged")
        newest.write.partitionBy(*self.partition_by).parquet(staged)
        storage.swap_in(self.spark, staged, self.base, depth)
        for version in versions:
            storage.remove(self.spark, self._folder(version))
        return len(versions)

    def _folder(self, version: int) -> str:
        return f"{self.changes}/{VERSION}={version}"

    def _has_base(self) -> bool:
        return storage.exists(self.spark, self.base)

    def _base(self, schema: T.StructType | None) -> DataFrame:
        columns = {c: schema[c].dataType for c in self.partition_by} if schema else {}
        found = merge.read_as(self.spark, self.base, columns)
        return found.select(*schema.names) if schema else found

    def _changes(self, versions: list[int], schema: T.StructType | None) -> DataFrame | None:
        """Rows of some versions with their number, read by folder so that later ones stay out."""
        if not versions:
            return None
        reader = self.spark.read.option("basePath", self.changes)
        if schema:
            reader = reader.schema(T.StructType([*schema.fields, T.StructField(VERSION, T.IntegerType())]))
        return reader.parquet(*[self._folder(version) for version in versions])
