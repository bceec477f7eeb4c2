"""File layout of a written folder: fewer files, or rows sorted into ranges."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway import storage
from sluiceway.sinks import merge

FILE_BYTES = 256 * 1024 * 1024


def clustered(df: DataFrame, columns: list[str], files: int, within: list[str] | None = None) -> DataFrame:
    """Rows in ``files`` ranges of the columns, in their order, inside each ``within`` value.

    The row number as last range key lets the ranges cut through a value that has very many rows.
    """
    order = [*(within or []), *columns]
    numbered = df.withColumn("_tie", F.monotonically_increasing_id())
    return numbered.repartitionByRange(files, *order, "_tie").sortWithinPartitions(*order).drop("_tie")


def file_ranges(df: DataFrame, column: str) -> DataFrame:
    """``file, rows, lowest, highest`` of a column for every file of a scan."""
    file = df.metadataColumn("_metadata")["file_path"]
    return df.groupBy(file.alias("file")).agg(
        F.count(F.lit(1)).alias("rows"), F.min(column).alias("lowest"), F.max(column).alias("highest")
    )


def overlaps(ranges: DataFrame) -> DataFrame:
    """One row: ``files, rows, lowest, highest`` and how many files begin before another one below them ends.

    Files in order are compared as one array, which has an entry for each file and not for each row.
    """
    found = ranges.where(F.col("lowest").isNotNull()).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("rows").alias("rows"),
        F.min("lowest").alias("lowest"),
        F.max("highest").alias("highest"),
        F.array_sort(F.collect_list(F.struct("lowest", "highest"))).alias("_all"),
    )
    early = F.filter("_all", lambda range, at: (at > 0) & (range["lowest"] < F.get("_all", at - 1)["highest"]))
    return found.withColumn("overlapping", F.size(early)).drop("_all")


def compact(
    spark: SparkSession,
    path: str,
    partition_by: list[str] | None = None,
    zorder_by: list[str] | None = None,
    file_bytes: int = FILE_BYTES,
) -> int:
    """Rewrites a Parquet folder into files of about ``file_bytes``; returns the number of tasks asked for.

    The new folder is staged next to the old one and swapped in. Rows of one partition value are
    gathered by a rebalance, which splits a value that is too large for one task.
    """
    storage.recover(spark, path)
    # Read as text, partition values come out as they went in.
    df = merge.read_as(spark, path, {column: T.StringType() for column in partition_by or []})
    files = max(1, ceil(storage.size_in_bytes(spark, path) / file_bytes))
    if zorder_by:
        df = clustered(df, zorder_by, files, partition_by)
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    else:
        df = df.repartition(files)
    staged = storage.sibling(path, "staged")
    df.write.partitionBy(*(partition_by or [])).parquet(staged)
    storage.swap_in(spark, staged, path)
    return files
