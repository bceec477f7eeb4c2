"""Joins, with plans that hold when one key has a large part of the rows.

Adaptive execution splits a skewed partition of an inner join on both sides, of a left or right join only
on the side that keeps all its rows, and of a full outer join on neither. ``split_outer`` rewrites outer
joins into parts that can be split, where that is asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_list(on: str | list[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def join(
    left: DataFrame, right: DataFrame, on: str | list[str], how: str = "inner", split: bool = False
) -> DataFrame:
    """Join on equally named columns, each of which appears once in the result.

    A semi or anti join only asks whether a key exists, so the right side is reduced to its
    distinct keys first: the reduction starts before the shuffle and a hot key moves once. ``split``
    does an outer join in parts, for sides that may have a hot key; that reads them more than once.
    """
    keys = as_list(on)
    word = how.lower().replace("_", "").removesuffix("outer") or "outer"
    if word in {"semi", "leftsemi", "anti", "leftanti"}:
        right = right.select(*keys).distinct()
    if split and word in {"outer", "full", "left", "right"}:
        return split_outer(left, right, keys, "outer" if word == "full" else word)
    return left.join(right, on=keys, how=how)


def split_outer(left: DataFrame, right: DataFrame, on: str | list[str], how: str = "outer") -> DataFrame:
    """Left, right or full outer join as matches plus the rows without a match.

    Adaptive execution can split a hot key on either side of the inner join and on the row side of the
    anti joins, which read the other side as distinct keys. Each part reads its sides, so they should
    be tables. Rows with a null key never match and stay out of the shuffles. Equal names that are
    no keys come from either side, as in a plain join.
    """
    keys = as_list(on)
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    rest_left = [c for c in left.columns if c not in keys]
    rest_right = [c for c in right.columns if c not in keys]

    def missing(frame: DataFrame, names: list[str]) -> list[Column]:
        return [F.lit(None).cast(frame.schema[n].dataType).alias(n) for n in names]

    def alone(frame: DataFrame, other: DataFrame) -> DataFrame:
        without = frame.where(known).join(other.where(known).select(*keys).distinct(), keys, "left_anti")
        return without.unionByName(frame.where(~known))

    sides = [F.col(f"l.{c}") for c in rest_left] + [F.col(f"r.{c}") for c in rest_right]
    result = left.alias("l").join(right.alias("r"), keys, "inner").select(*keys, *sides)
    if how in ("left", "outer"):
        result = result.union(alone(left, right).select(*keys, *rest_left, *missing(right, rest_right)))
    if how in ("right", "outer"):
        result = result.union(alone(right, left).select(*keys, *missing(left, rest_left), *rest_right))
    return result


def broadcast_if_small(small: DataFrame, max_rows: int = 100_000, max_bytes: int = 64 << 20) -> DataFrame:
    """Marks the frame for a broadcast only if it is proven to have few rows that are few bytes as JSON.

    The check is a job of its own that reads no more than ``max_rows + 1`` rows, so it is meant for
    tables and stored frames; for the result of a large plan it would run that plan. A larger frame
    comes back unmarked and the join shuffles it.
    """
    size = F.sum(F.octet_length(F.to_json(F.struct(*small.columns))))
    rows, found = small.limit(max_rows + 1).agg(F.count(F.lit(1)), size).first()
    return small if rows > max_rows or (found or 0) > max_bytes else F.broadcast(small)


def star(fact: DataFrame, dimensions: list[tuple[DataFrame, str]], how: str = "left") -> DataFrame:
    """Chains joins of one fact table with dimensions, each on its own key."""
    for dimension, key in dimensions:
        fact = fact.join(dimension, key, how)
    return fact


def join_totals(
    left: DataFrame, fact: DataFrame, on: str | list[str], totals: dict[str, Column], defaults: dict[str, object]
) -> DataFrame:
    """Left join with per-key totals of a fact table; absent totals take their defaults.

    The fact table is aggregated before it meets the other side, so a hot key is one row by then.
    """
    keys = as_list(on)
    summed = fact.groupBy(*keys).agg(*[expr.alias(name) for name, expr in totals.items()])
    joined = left.join(summed, keys, "left")
    return joined.withColumns({n: F.coalesce(F.col(n), F.lit(v)) for n, v in defaults.items()})


def top_cross_totals(
    left: DataFrame,
    right: DataFrame,
    left_group: str,
    right_group: str,
    member: str,
    measure: str,
    k: int,
) -> DataFrame:
    """First ``k`` rows of: cross join, group by both groups, distinct members and sum of a measure.

    In a cross product every left row meets every right row once. So the sum of a pair of groups
    is the left sum times the number of right rows, and its distinct members are those of the
    left group; neither needs the product itself.

    Only few groups can reach the first ``k`` pairs (largest sum first, then group names): the
    first ``k`` left groups, each paired with right groups that come first by size (positive
    sum), last by size (negative sum) or first by name (sum zero). That is exact and leaves at
    most ``k`` times ``3k`` pairs whatever the number of groups.
    """
    sums = left.groupBy(left_group).agg(
        F.count_distinct(member).alias("users"), F.sum(measure).alias("_sum")
    )
    sizes = right.groupBy(right_group).agg(F.count(F.lit(1)).alias("_rows"))
    by_name = F.asc_nulls_first(right_group)
    candidates = (
        sizes.orderBy(F.desc("_rows"), by_name).limit(k)
        .unionAll(sizes.orderBy(F.asc("_rows"), by_name).limit(k))
        .unionAll(sizes.orderBy(by_name).limit(k))
        .distinct()
    )
    listed = candidates.agg(F.collect_list(F.struct(right_group, "_rows"))).scalar()
    first = sums.orderBy(F.desc_nulls_last("_sum"), F.asc_nulls_first(left_group)).limit(k)
    return (
        first.select(left_group, "users", "_sum", F.inline(listed))
        .select(left_group, right_group, "users", (F.col("_sum") * F.col("_rows")).alias("revenue"))
        .orderBy(F.desc_nulls_last("revenue"), F.asc_nulls_first(left_group), by_name)
        .limit(k)
    )
