"""Scalar expressions used by the plans; all of them stay inside generated JVM code."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def minutes_between(first: str | Column, last: str | Column) -> Column:
    """Minutes from ``first`` to ``last``, measured in whole seconds."""
    return (F.unix_timestamp(last) - F.unix_timestamp(first)) / 60


def days_between(start: str | Column, end: str | Column) -> Column:
    """Whole days from ``start`` to ``end``; both may be dates or ``yyyy-MM-dd`` strings."""
    return F.datediff(end, start)


def ratio(numerator: Column, denominator: Column, otherwise: float = 0.0) -> Column:
    """``numerator / denominator`` where the denominator is positive, else ``otherwise``."""
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(otherwise))


def half_up(value: Column, digits: int = 2) -> Column:
    """Rounds half up, the same on every run.

    A double that was summed in another order may fall on the other side of a half by its last
    digits; cutting those off first gives one answer.
    """
    return F.round(F.round(value.cast("double"), 8), digits)


def percent(numerator: Column, denominator: Column) -> Column:
    """Percentage with two decimals as a double; 0 where the denominator is not positive."""
    share = numerator.cast("double") * 100 / denominator
    return F.when(denominator > 0, half_up(share)).otherwise(F.lit(0.0))


def weighted(weights: Mapping[str, float]) -> Column:
    """Sum of the named columns, each times its weight."""
    terms = [F.col(name) * weight for name, weight in weights.items()]
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def dollars(amount: Column) -> Column:
    """Amount as text such as ``$12.50``."""
    return F.concat(F.lit("$"), F.format_string("%.2f", half_up(amount)))


def customer_class(purchases: str = "purchases", revenue: str = "revenue") -> Column:
    """VIP, Active or Casual by the number of purchases and the revenue of a customer."""
    bought, paid = F.col(purchases), F.col(revenue)
    return (
        F.when((bought > 10) & (paid > 1000), "VIP")
        .when((bought > 5) | (paid > 500), "Active")
        .otherwise("Casual")
    )


def with_timestamp_features(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Adds ``date``, ``hour`` and ``day_of_week`` (Sunday is 1)."""
    return df.withColumns(
        {"date": F.to_date(column), "hour": F.hour(column), "day_of_week": F.dayofweek(column)}
    )


def with_conversion_rate(df: DataFrame, visits: str = "visits", purchases: str = "purchases") -> DataFrame:
    """Adds ``conversion_rate``, 0 where there are no visits."""
    return df.withColumn("conversion_rate", ratio(F.col(purchases), F.col(visits)))
