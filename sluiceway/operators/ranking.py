"""Row numbers, sorting and top-k."""

from __future__ import annotations

from functools import reduce
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway import storage
from sluiceway.settings import session_settings

ROWS_PER_TASK = 5_000_000
#: Rows that the driver samples for each range: Spark's own number, fewer if all ranges take more than ``SAMPLED``, but
#: ``LEAST_SAMPLED``. Spark draws three times that; with thirty rows a range the sizes vary by a fifth.
MOST_SAMPLED, LEAST_SAMPLED, SAMPLED = 100, 10, 20_000
SAMPLE_SETTING = "spark.sql.execution.rangeExchange.sampleSizePerPartition"


def numbered(df: DataFrame, keys: list[str], order: list[Column], output: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Row number (a 64-bit one) within each key in the given order.

    A plain window sorts all rows of a key in one task, which suits keys of up to ``rows_per_task``
    rows. Rows of larger keys are cut by Spark's range partitioning on key and order into ranges of
    about that many rows, so text and equal leading values are cut as well; only rows equal in the
    whole order stay together. A range starts from the number of its key's rows in the ranges before.

    Rows per key are counted by a job while the plan is built, and the rows of larger keys are stored
    in the shared folder. The frame is read more than once and has to give the same rows each time,
    as a scan or a stored frame does.
    """
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("bigint")
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    large = storage.stored(counts.where(F.col("_rows") > rows_per_task))
    total = large.agg(F.sum("_rows")).first()[0]
    if total is None:
        return df.withColumn(output, place)

    same = _same(keys)
    small = df.alias("r").join(large.alias("s"), same, "left_anti").withColumn(output, place)
    rows = df.alias("r").join(large.alias("s"), same, "left_semi")
    number = ceil(total / rows_per_task)
    ranges = rows.repartitionByRange(number, *keys, *order)
    sampled = max(LEAST_SAMPLED, min(MOST_SAMPLED, SAMPLED // number))
    with session_settings(df.sparkSession, {SAMPLE_SETTING: str(sampled)}):
        ranged = storage.stored(ranges.withColumn("_range", F.spark_partition_id()))
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy(*keys, "_range")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(*keys, "_range", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    within = F.row_number().over(Window.partitionBy(*keys, "_range").orderBy(*order))
    joined = ranged.alias("r").join(starts.alias("s"), _same([*keys, "_range"])).select("r.*", "s._before")
    placed = joined.withColumn(output, F.col("_before") + within).drop("_range", "_before")
    return small.unionByName(placed)


def _same(keys: list[str]) -> Column:
    """Equal keys of the frames ``r`` and ``s``, where null keys are equal as in a grouping."""
    return reduce(lambda a, b: a & b, [F.col(f"r.{key}").eqNullSafe(F.col(f"s.{key}")) for key in keys])


def number_newest_first(
    df: DataFrame, keys: list[str], time: str, tie: str, output: str = "event_rank", rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Row number within each key, newest first, equal times by descending ``tie``; see ``numbered``."""
    return numbered(df, keys, [F.desc_nulls_last(time), F.desc(tie)], output, rows_per_task)


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row of every key in the given order.

    The filter on the row number lets Spark keep one row per key in every task before the
    shuffle, so a hot key sends one row per task and not all its rows.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(window)).where("_place = 1").drop("_place")


def top(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """First ``k`` rows in the given order; every task keeps only its own first ``k``."""
    return df.orderBy(*order).limit(k)
