"""Upsert on key columns for plain Parquet folders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceway import storage
from sluiceway.errors import SinkError

# Up to this many touched partitions are listed in a filter, which Spark prunes folders by; more are read by the
# names of their folders, so many in one scan.
LISTED_PARTITIONS = 1_000
FOLDERS_IN_A_SCAN = 5_000


def _known(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(key).isNotNull() for key in keys])


def like_target(source: DataFrame, target: DataFrame) -> DataFrame:
    """Source columns in the order and types of the target; both must have the same names."""
    lacking = set(target.columns) - set(source.columns)
    extra = set(source.columns) - set(target.columns)
    if lacking or extra:
        raise SinkError(f"merge: source lacks {sorted(lacking)} and adds {sorted(extra)}")
    return source.select([F.col(field.name).cast(field.dataType) for field in target.schema.fields])


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target after the merge: matched rows replaced, other source rows added.

    A null key matches nothing, so such rows of both sides stay; they also keep out of the
    shuffle, where they would all meet in one task. Source keys are reduced to one row each before
    the shuffle. Two source rows for one target row end the job, as MERGE does.
    """
    source = like_target(source, target)
    incoming = source.where(_known(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_times"))
    ambiguous = F.raise_error(F.lit(f"merge: several source rows match one target row on {keys}"))
    untouched = F.when(F.col("_times") > 1, ambiguous.cast("boolean")).otherwise(F.col("_times").isNull())
    kept = target.where(_known(keys)).join(incoming, keys, "left").where(untouched).select(target.columns)
    keyless = target.where(~_known(keys))
    return kept.unionByName(keyless).unionByName(source)


def touched(target: DataFrame, source: DataFrame, columns: list[str], path: str) -> DataFrame:
    """Target rows in the partitions the source has rows for; no file of another partition is read."""
    values = source.select(*columns).distinct()
    found = values.limit(LISTED_PARTITIONS + 1).collect()
    if len(found) > LISTED_PARTITIONS:
        return _in_folders(target, values, columns, path)
    if not found:
        return target.limit(0)
    if len(columns) == 1:
        values = [row[0] for row in found]
        test = F.col(columns[0]).isin([v for v in values if v is not None])
        if None in values:
            test = test | F.col(columns[0]).isNull()
        return target.where(test)
    tests = [
        reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(row[c])) for c in columns]) for row in found
    ]
    return target.where(_any(tests))


def _in_folders(target: DataFrame, values: DataFrame, columns: list[str], path: str) -> DataFrame:
    """Target rows of very many partitions.

    The values are written as folders of their own, so that Spark's writer gives them the names it has
    given the target's, and the folders that both have are read. Names are all the driver sees, of which
    the index of a partitioned scan holds as many.
    """
    spark, depth = target.sparkSession, len(columns)
    named = storage.sibling(path, "touched")
    values.withColumn("_there", F.lit(True)).write.partitionBy(*columns).parquet(named)
    there = set(storage.subfolders(spark, path, depth))
    names = sorted(there.intersection(storage.subfolders(spark, named, depth)))
    storage.remove(spark, named)
    reader = spark.read.schema(target.schema).option("basePath", path)
    scans = [
        reader.parquet(*[path.rstrip("/") + name for name in names[at : at + FOLDERS_IN_A_SCAN]])
        for at in range(0, len(names), FOLDERS_IN_A_SCAN)
    ]
    return reduce(DataFrame.unionByName, scans) if scans else target.limit(0)


def _any(tests: list[Column]) -> Column:
    """Tests joined by OR as a balanced tree; a chain of a thousand would overflow the stack."""
    if len(tests) == 1:
        return tests[0]
    half = len(tests) // 2
    return _any(tests[:half]) | _any(tests[half:])


def read_as(spark: SparkSession, path: str, partitions: dict[str, T.DataType]) -> DataFrame:
    """A folder whose partition columns have the given types; by their names alone, '01' would become 1."""
    found = spark.read.parquet(path).schema
    fields = [T.StructField(f.name, partitions.get(f.name, f.dataType)) for f in found.fields]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def merge_folder(source: DataFrame, path: str, keys: list[str], partition_by: list[str]) -> None:
    """Merges a frame into a Parquet folder; a missing folder is created.

    ``source`` is read more than once, so it should be a stored frame. Where the folder is
    partitioned by some of the keys, only the partitions the source touches are read and
    replaced, otherwise the whole folder. Either is staged next to the folder and swapped in.
    """
    spark = source.sparkSession
    by_part = bool(partition_by) and set(partition_by) <= set(keys)
    depth = len(partition_by) if by_part else 0
    storage.recover(spark, path)
    staged = storage.sibling(path, "staged")
    if not storage.exists(spark, path):
        arranged(source, partition_by).write.partitionBy(*partition_by).parquet(staged)
        storage.swap_in(spark, staged, path)
        return
    target = read_as(spark, path, {c: source.schema[c].dataType for c in partition_by if c in source.columns})
    affected = touched(target, like_target(source, target), partition_by, path) if by_part else target
    merged = arranged(upsert(affected, source, keys), partition_by)
    merged.write.partitionBy(*partition_by).parquet(staged)
    storage.swap_in(spark, staged, path, depth)


def arranged(df: DataFrame, partition_by: list[str]) -> DataFrame:
    """Rows of one partition value in few tasks; adaptive execution splits a value that is too large."""
    return df.hint("rebalance", *partition_by) if partition_by else df
