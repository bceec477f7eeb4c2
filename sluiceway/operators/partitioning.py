"""Placing and reusing rows, for use in ``python`` steps."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame


def gathered(df: DataFrame, *keys: str, partitions: int | None = None) -> DataFrame:
    """Rows of equal keys close together, as before a write by these keys.

    Without a number of partitions adaptive execution sizes them and splits a key that is too large for
    one; a given number is kept, and then a key is never split.
    """
    if partitions is None:
        return df.hint("rebalance", *keys)
    return df.repartition(partitions, *keys)


def reused(df: DataFrame) -> DataFrame:
    """The frame kept for further uses, on disk where memory is short; the caller unpersists it."""
    return df.persist(StorageLevel.MEMORY_AND_DISK)
