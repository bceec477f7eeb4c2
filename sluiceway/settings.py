"""Settings of a session for the time of a block."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


@contextmanager
def session_settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings for what runs, or starts, within the block; the session has its own back after that."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)
