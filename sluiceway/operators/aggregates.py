"""Aggregations beyond a plain ``groupBy().agg()``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway import storage
from sluiceway.functions.columns import half_up
from sluiceway.operators.ranking import numbered

# Function names the aggregate step knows.
FUNCTIONS = {"sum": F.sum, "avg": F.avg, "count": F.count, "min": F.min, "max": F.max}


def distinct_count(df: DataFrame, column: str | Column) -> Column:
    """Exact distinct count on a batch frame; streams support only the approximate one."""
    return F.approx_count_distinct(column) if df.isStreaming else F.count_distinct(column)


def with_share_of_total(df: DataFrame, measure: str, output: str, digits: int = 2) -> DataFrame:
    """Adds the percentage each row has of the column total; see ``with_column_total``."""
    rows, total = _with_total(df, measure)
    return rows.withColumn(output, half_up(F.col(measure).cast("double") * 100 / total, digits))


def with_column_total(df: DataFrame, measure: str, output: str) -> DataFrame:
    """Adds the column total to every row.

    The frame is computed once and stored while the plan is built; the total is a scalar subquery over the
    stored rows. A window without partitions would move all rows to one task.
    """
    rows, total = _with_total(df, measure)
    return rows.withColumn(output, total)


def _with_total(df: DataFrame, measure: str) -> tuple[DataFrame, Column]:
    rows = storage.stored(df)
    return rows, rows.agg(F.sum(measure)).scalar()


def pivot_counts(df: DataFrame, keys: list[str], column: str, values: list) -> DataFrame:
    """One column per value with its number of rows; null where a key has none."""
    return df.groupBy(*keys).pivot(column, values).agg(F.count(F.lit(1)))


def collect_values(
    df: DataFrame, keys: list[str], value: str, row_id: str, size: int, output: str = "items"
) -> DataFrame:
    """Sorted arrays of the values of each key, one row per key and ``chunk``.

    Chunk 0 holds the first ``size`` values of a key in order, chunk 1 the next and so on, so that no
    array is longer than ``size`` and the chunks in order are the whole sorted list. Equal values go
    by ``row_id``; nulls are left out. Large keys are put in order by several tasks, see ``numbered``.
    """
    rows = numbered(df.where(F.col(value).isNotNull()), keys, [F.asc(value), F.asc(row_id)], "_place")
    chunk = F.floor((F.col("_place") - 1) / size).alias("chunk")
    return rows.groupBy(*keys, chunk).agg(F.array_sort(F.collect_list(value)).alias(output))


#: Size of quantile sketches, and the share of rows by which the rank of an answer may be off.
SKETCH_SIZE, RANK_ERROR = 1_000, 0.01


def quantile_sketches(df: DataFrame, keys: list[str | Column], value: str) -> DataFrame:
    """A quantile sketch of the non-null values of each key; keys may hold a part of a table, such as a month.

    Sketches can be stored and merged, so quantiles of a table that grows need its new parts only.
    """
    known = df.where(F.col(value).isNotNull())
    return known.groupBy(*keys).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), SKETCH_SIZE).alias("sketch"))


def sketched_quantile(sketches: DataFrame, keys: list[str], fraction: float, output: str) -> DataFrame:
    """Value whose rank is ``fraction`` of the rows, give or take ``RANK_ERROR``, from all sketches of each key."""
    merged = sketches.groupBy(*keys).agg(F.kll_merge_agg_double("sketch", SKETCH_SIZE).alias("_sketch"))
    return merged.select(*keys, F.kll_sketch_get_quantile_double("_sketch", F.lit(float(fraction))).alias(output))


def with_rank_check(df: DataFrame, answers: DataFrame, keys: list[str], value: str, answer: str, fraction: float) -> DataFrame:
    """Per key its ``rows`` and whether the rank of an answer is within ``RANK_ERROR`` of the one asked for."""
    joined = _join_null_safe(df.where(F.col(value).isNotNull()).select(*keys, value), answers, keys)
    count, by = F.count(F.lit(1)), F.col(value) - F.col(answer)
    held = (F.count_if(by < 0) / count <= fraction + RANK_ERROR) & (F.count_if(by <= 0) / count >= fraction - RANK_ERROR)
    return joined.groupBy(*keys).agg(count.alias("rows"), held.alias("within_bound"))


#: Distinct values of one key that a task sorts at most, and the parts that more of them are cut into.
WITHIN = 50_000
PARTS = 64


def exact_percentile(
    df: DataFrame, keys: list[str], value: str, fraction: float, output: str, accuracy: int = 10_000, within: int = WITHIN
) -> DataFrame:
    """Exact interpolated percentile per key without gathering a key in one task.

    Spark's own exact percentile holds every distinct value of a group in one buffer. Here a
    mergeable sketch first brackets the wanted rank for each key with more than ``accuracy`` values.
    Rows below the bracket are only counted, rows above it need no count, and equal values are one
    row before the shuffle. Where more than ``within`` distinct values of a key are left, rank selection
    is repeated: pivots cut them into parts, and only the parts with the wanted ranks go on. So no task
    sorts more than ``within`` values of a key, whatever the key has. Each task sends a sketch of
    at most some ``accuracy`` numbers per key. A sketch that missed its guarantee would raise an error, never give
    another number.

    The values in the brackets are stored while the plan is built, and once more for each repetition. The
    frame is read twice and has to give the same values both times, as a scan or a stored
    frame does; sums of doubles computed again may differ in their last digits.
    """
    placed = _around_rank(df, keys, value, fraction, accuracy, within)
    upto = Window.partitionBy(*keys).orderBy(F.asc_nulls_first("_v"))
    upto = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = placed.withColumn("_end", F.sum("_n").over(upto))
    placed = placed.withColumn("_start", F.col("_end") - F.col("_n"))

    def at(rank: Column) -> Column:
        return F.max(F.when(_holds(rank), F.col("_v")))

    low, high = F.floor("_rank"), F.ceil("_rank")
    part = F.max(F.col("_rank") - low)
    ends = placed.groupBy(*keys).agg(at(low).alias("_low"), at(high).alias("_high"), part.alias("_part"))
    missed = F.raise_error(F.lit("percentile sketch missed its bracket")).cast("double")
    result = F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part")
    return ends.select(*keys, F.when(result.isNull(), missed).otherwise(result).alias(output))


def _holds(rank: Column) -> Column:
    """Whether the rows from ``_start`` to ``_end`` hold a rank."""
    return (F.col("_start") <= rank) & (rank < F.col("_end"))


def _around_rank(df: DataFrame, keys: list[str], value: str, fraction: float, accuracy: int, within: int) -> DataFrame:
    """``_v`` and its number of rows ``_n`` for at most ``within`` values of a key around the wanted ``_rank``.

    The row of a key without a value has the number of rows below them.
    """
    # One part in ``accuracy`` is the error of the sketch, the rest covers the two ranks in between
    # which the result lies.
    slack = 3 / accuracy
    bracket_at = [max(fraction - slack, 0.0), min(fraction + slack, 1.0)]
    count = F.count(F.lit(1))
    whole = F.array(F.min("_v"), F.max("_v"))
    bracket = F.when(count > accuracy, F.percentile_approx("_v", bracket_at, accuracy)).otherwise(whole)
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    brackets = rows.groupBy(*keys).agg(
        bracket.alias("_bracket"), (F.lit(fraction) * (count - 1)).alias("_rank")
    )
    joined = _join_null_safe(rows, brackets, keys)
    inside = F.when(F.col("_v") >= F.col("_bracket")[0], F.col("_v")).alias("_v")
    left = joined.where(F.col("_v") <= F.col("_bracket")[1]).groupBy(*keys, "_rank", inside).agg(count.alias("_n"))
    left, done = storage.stored(left), []
    while True:
        crowded = left.groupBy(*keys).agg(F.count("_v").alias("_values")).where(F.col("_values") > within)
        crowded = storage.stored(crowded.drop("_values"))
        if crowded.isEmpty():
            return reduce(DataFrame.unionByName, done, left)
        done.append(_join_null_safe(left, crowded, keys, "left_anti"))
        left = storage.stored(_narrowed(_join_null_safe(left, crowded, keys, "left_semi"), keys))


def _narrowed(left: DataFrame, keys: list[str]) -> DataFrame:
    """The values of each key in the one or two of its parts that hold the wanted ranks."""
    at = [n / PARTS for n in range(1, PARTS)]
    pivots = left.groupBy(*keys).agg(F.percentile_approx("_v", at, 16 * PARTS).alias("_pivots"))
    part = F.size(F.filter("_pivots", lambda pivot: pivot < F.col("_v")))
    # Rows that were below the values already are a part of their own, before all others.
    cut = _join_null_safe(left, pivots, keys).withColumn("_part", F.when(F.col("_v").isNull(), -1).otherwise(part)).drop("_pivots")
    upto = Window.partitionBy(*keys).orderBy("_part")
    parts = cut.groupBy(*keys, "_rank", "_part").agg(F.sum("_n").alias("_rows"))
    parts = parts.withColumn("_end", F.sum("_rows").over(upto)).withColumn("_start", F.col("_end") - F.col("_rows"))
    wanted = _holds(F.floor("_rank")) | _holds(F.ceil("_rank"))
    chosen = parts.where(wanted & (F.col("_part") >= 0))
    chosen = chosen.groupBy(*keys, "_rank").agg(F.collect_list("_part").alias("_parts"), F.min("_start").alias("_below"))
    kept = _join_null_safe(cut.drop("_rank"), chosen, keys).where(F.array_contains("_parts", F.col("_part")))
    below = chosen.select(*keys, "_rank", F.lit(None).cast("double").alias("_v"), F.col("_below").alias("_n"))
    return kept.select(*keys, "_rank", "_v", "_n").unionByName(below)


def _join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join where null keys match each other, as in a grouping."""
    same = F.lit(True)
    for key in keys:
        same = same & F.col(f"a.{key}").eqNullSafe(F.col(f"b.{key}"))
    joined = left.alias("a").join(right.alias("b"), same, how)
    if how != "inner":
        return joined
    return joined.select("a.*", *[F.col(f"b.{c}") for c in right.columns if c not in keys])
