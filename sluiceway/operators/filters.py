"""Row filters and samples."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def active_users(df: DataFrame, min_events: int = 5) -> DataFrame:
    """Rows with at least ``min_events`` events."""
    return df.where(F.col("total_events") >= min_events)


def by_threshold(df: DataFrame, column: str, threshold: float, operator: str = "greater") -> DataFrame:
    """Rows above (``greater``) or below (``less``) the threshold; any other word means equal."""
    value, bound = F.col(column), F.lit(threshold)
    tests = {"greater": value > bound, "less": value < bound}
    return df.where(tests.get(operator, value == bound))


def by_date_range(df: DataFrame, start: str | date, end: str | date, column: str = "date") -> DataFrame:
    """Rows from ``start`` to ``end``, both included."""
    first, last = F.lit(start).cast("date"), F.lit(end).cast("date")
    return df.where(F.col(column).between(first, last))


def sample_of_size(df: DataFrame, size: int, key: str, seed: int = 42) -> DataFrame:
    """The rows of ``size`` keys, those whose digests with the seed are the smallest.

    It needs no number of keys beforehand, and any engine with an MD5 draws the same ones; keys of a
    larger sample include those of a smaller one. Each task keeps its own ``size`` smallest, so that
    number is for samples that fit one task; null keys are not drawn.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    drawn = df.where(F.col(key).isNotNull()).select(key).distinct().orderBy(digest, key).limit(size)
    return df.join(drawn, key, "left_semi")


def sample(df: DataFrame, fraction: float, key: str | list[str] | None = None, seed: int = 42) -> DataFrame:
    """A sample of rows, or, with ``key``, of whole keys.

    The keyed form hashes the key, so a retried task and any other table sampled on that key
    choose the same rows.
    """
    if key is None:
        return df.sample(fraction=fraction, seed=seed)
    keys = [key] if isinstance(key, str) else key
    if fraction >= 1:
        return df
    # The hash without its sign has 63 bits, so that no fraction is too small to be told from none.
    place = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *keys), 1)
    return df.where(place < int(fraction * 2**63))
