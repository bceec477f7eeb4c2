"""Intermediate tables in the shared folder of the session, and reading of input tables."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import sluiceway
from sluiceway import storage

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this library to the executors, whose Python workers need not have it installed."""
    application = spark.sparkContext.applicationId
    if application not in _shipped:
        package = os.path.dirname(os.path.abspath(sluiceway.__file__))
        folder = tempfile.mkdtemp(prefix="shipped-")  # the driver serves it as long as the session lasts
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        name = os.path.basename(package)
        copied = shutil.copytree(package, f"{folder}/{name}/{name}", ignore=shutil.ignore_patterns("__pycache__"))
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/{name}", "zip", os.path.dirname(copied)))
        _shipped.add(application)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


#: Columns of documents, the ones that operators work on.
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")


def with_extras_aside(docs: DataFrame, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``work`` makes of the documents, with the columns of ``docs``.

    Columns that documents do not have are one struct meanwhile, so whatever they are called, no column
    that an operator makes has their name. Without such columns nothing is moved.
    """
    extra = [c for c in docs.columns if c not in DOCUMENT]
    if not extra:
        return work(docs).select(*docs.columns)
    own = [c for c in docs.columns if c in DOCUMENT]
    found = work(docs.select(*own, F.struct(*[_named(c) for c in extra]).alias("_extra")))
    return found.select(*[F.col("_extra").getField(c).alias(c) if c in extra else F.col(c) for c in docs.columns])


def _named(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def task_count(spark: SparkSession) -> int:
    """Partitions a shuffle of the session has before adaptive execution joins small ones."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Scratch:
    """Tables written below ``spark.checkpoint.dir``, so that a lost executor costs no recomputed lineage.

    ``keep`` writes a frame and reads it back. A name that is kept again replaces its older table,
    which is removed once the new one is complete; the last table of each name stays for the result
    that reads it.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.folder = storage.new_folder(spark, label)
        self._turns: dict[str, int] = {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        turn = self._turns.get(name, 0)
        path = f"{self.folder}/{name}-{turn}"
        df.write.mode("overwrite").parquet(path)
        self._turns[name] = turn + 1
        if turn:
            storage.remove(self.spark, f"{self.folder}/{name}-{turn - 1}")
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Removes the table of a name that no later plan reads."""
        if turn := self._turns.pop(name, 0):
            storage.remove(self.spark, f"{self.folder}/{name}-{turn - 1}")
