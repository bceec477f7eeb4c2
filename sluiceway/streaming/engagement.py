"""Streaming forms of the engagement metrics, and the join of two streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.streaming.late import Split


def with_event_time(df: DataFrame, column: str, delay: str) -> DataFrame:
    """Watermark on a time column; a time without zone is first read in the session's zone."""
    if dict(df.dtypes)[column] == "timestamp_ntz":
        df = df.withColumn(column, F.col(column).cast("timestamp"))
    return df.withWatermark(column, delay)


def windowed_metrics(events: DataFrame, time: str = "timestamp", delay: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Events and purchases per user and time window, for append mode.

    A window comes out once the watermark has passed its end, and its state is then dropped; so
    state is bounded by the open windows and not by the history.
    """
    return _dated(_in_windows(with_event_time(events, time, delay), time, width))


def _in_windows(events: DataFrame, time: str, width: str) -> DataFrame:
    return events.groupBy("user_id", F.window(time, width)).agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(F.col("event_type") == "purchase").alias("purchases"),
    )


def _dated(windows: DataFrame) -> DataFrame:
    return windows.select("user_id", F.col("window.start").cast("date").alias("date"), "total_events", "purchases")


def window_end(time: str = "timestamp", width: str = "1 day") -> Column:
    """The time up to which a row is of use to its window."""
    return F.window(F.col(time).cast("timestamp"), width)["end"]


def settled_windows(closed: DataFrame, split: Split, time: str = "timestamp", width: str = "1 day") -> DataFrame:
    """Closed windows with the late rows of their side table added; windows that only late rows have, too.

    Late rows are counted per window first, so the merge sees one row per window from either side.
    Late rows of a window that is still open wait in the side table.
    """
    late = split.late().withColumn(time, F.col(time).cast("timestamp"))
    counted = _in_windows(late, time, width).where(F.col("window.end") <= split.watermark())
    both = closed.unionByName(_dated(counted))
    return both.groupBy("user_id", "date").agg(*[F.sum(c).alias(c) for c in ("total_events", "purchases")])


def join_in_range(
    one: DataFrame,
    many: DataFrame,
    key: str,
    one_time: str,
    many_time: str,
    within: str,
    delay: str = "1 hour",
    salts: int = 1,
) -> DataFrame:
    """Inner join of two streams: equal key and ``many_time`` at most ``within`` after ``one_time``.

    The time range lets Spark drop state that can no longer match. ``salts`` spreads the rows of
    one key of ``many`` over that many tasks at the price of as many copies of each ``one`` row;
    streaming joins have no adaptive split for a hot key. The same call joins two batch frames.
    """
    left, right = with_event_time(one, one_time, delay), with_event_time(many, many_time, delay)
    right = right.withColumnRenamed(key, "_key")
    limit = F.col(one_time) + F.expr(f"INTERVAL {within}")
    match = (F.col(key) == F.col("_key")) & F.col(many_time).between(F.col(one_time), limit)
    if salts > 1:
        left = left.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        place = F.xxhash64(*[c for c in right.columns if c != "_key"])
        right = right.withColumn("_spread", F.pmod(place, F.lit(salts)).cast("int"))
        match = match & (F.col("_salt") == F.col("_spread"))
    return left.join(right, match, "inner").drop("_key", "_salt", "_spread")


def settled_join(
    stored: DataFrame, one: Split, many: Split, key: str, one_time: str, many_time: str, within: str
) -> DataFrame:
    """What ``join_in_range`` has stored, with the matches of late rows of either side added.

    A late row of one side meets all rows of the other, late ones included; scans of the other side go no
    further than the times that late rows can match.
    """

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        return join_in_range(left, right, key, one_time, many_time, within)

    reach = F.expr(f"INTERVAL {within}")
    late_one, late_many = one.late(), many.late()
    first, last = late_one.agg(F.min(one_time), F.max(one_time)).first()
    matched = many.accepted_so_far().where(F.col(many_time).between(F.lit(first), F.lit(last) + reach))
    extra = joined(late_one, matched.unionByName(late_many))
    first, last = late_many.agg(F.min(many_time), F.max(many_time)).first()
    matched = one.accepted_so_far().where(F.col(one_time).between(F.lit(first) - reach, F.lit(last)))
    extra = extra.unionByName(joined(matched, late_many))
    return stored.unionByName(extra.select(stored.columns))
