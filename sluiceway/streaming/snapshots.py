"""Dimensions of a stream as stored snapshots, so that no micro-batch computes them again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluiceway import storage


class Snapshots:
    """Versions of static frames below a folder.

    ``take`` computes a frame once and returns a scan of that very version, which every micro-batch of a
    query then names in its plan. A query that starts later takes a later version; the one before stays,
    for a query that is still running on it.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def versions(self, name: str) -> list[int]:
        folder = f"{self.folder}/{name}"
        if not storage.exists(self.spark, folder):
            return []
        return sorted(int(found.rpartition("=")[2]) for found in storage.subfolders(self.spark, folder, 1))

    def take(self, name: str, df: DataFrame) -> DataFrame:
        known = self.versions(name)
        version = known[-1] + 1 if known else 0
        staged = f"{self.folder}/_staged_{storage.unused()}"
        df.write.parquet(staged)
        storage.make_folder(self.spark, f"{self.folder}/{name}")
        path = f"{self.folder}/{name}/version={version}"
        storage.move(self.spark, staged, path)
        for old in known[:-1]:
            storage.remove(self.spark, f"{self.folder}/{name}/version={old}")
        return self.spark.read.schema(df.schema).parquet(path)
