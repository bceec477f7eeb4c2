"""Daily engagement of users: metrics per user and day, profile, score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.columns import days_between, minutes_between, weighted
from sluiceway.operators.aggregates import distinct_count
from sluiceway.operators.filters import active_users

# Counted event types, their columns and their weight in the engagement score.
COUNTED = {"page_views": "page_view", "clicks": "click", "purchases": "purchase"}
SCORE = {"page_views": 1, "clicks": 2, "purchases": 10}

# Rules of the result of active users.
ACTIVE_RULES = [
    {"name": "user_id_not_null", "type": "null_check", "column": "user_id", "threshold": 0.0},
    {"name": "positive_events", "type": "range_check", "column": "total_events", "min_value": 1},
    {"name": "valid_engagement_score", "type": "range_check", "column": "engagement_score", "min_value": 0, "max_value": 10000},
    {"name": "minimum_records", "type": "row_count", "min_count": 1},
]

# Rules of the daily result of all users.
RULES = [
    {"name": "check_user_id_not_null", "type": "null_check", "column": "user_id", "threshold": 0.0},
    {"name": "check_positive_events", "type": "range_check", "column": "total_events", "min_value": 1},
    {
        "name": "check_engagement_score_range",
        "type": "range_check",
        "column": "engagement_score",
        "min_value": 0,
        "max_value": 100000,
    },
    {"name": "check_minimum_records", "type": "row_count", "min_count": 1},
]


def daily_metrics(events: DataFrame, revenue: bool = False) -> DataFrame:
    """Events, types and session length per user and day, on a batch or a stream.

    All counts are partial before the shuffle, so a user with very many events moves as few rows
    as any other. On a stream the distinct count is the approximate one.
    """
    kind = F.col("event_type")
    counts = [F.count_if(kind == word).alias(name) for name, word in COUNTED.items()]
    if revenue:
        paid = F.when(kind == COUNTED["purchases"], F.col("revenue")).otherwise(F.lit(0.0))
        counts.append(F.sum(paid).alias("total_revenue"))
    return (
        events.groupBy("user_id", F.to_date("timestamp").alias("date"))
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            distinct_count(events, "event_type").alias("unique_event_types"),
            *counts,
            F.min("timestamp").alias("first_event_time"),
            F.max("timestamp").alias("last_event_time"),
        )
        .withColumn("session_duration_minutes", minutes_between("first_event_time", "last_event_time"))
    )


def enrich(metrics: DataFrame, profiles: DataFrame) -> DataFrame:
    """Adds the profile, the days since sign-up and the score; metrics without a profile stay."""
    return metrics.join(profiles, "user_id", "left").withColumns(
        {"days_since_signup": days_between("signup_date", "date"), "engagement_score": weighted(SCORE)}
    )


def daily_engagement(events: DataFrame, profiles: DataFrame, min_events: int = 3) -> DataFrame:
    """Daily metrics of active users with profile and score."""
    # Days below the limit leave before the join, which cannot change their number of events.
    active = active_users(daily_metrics(events), min_events)
    return enrich(active, profiles.select("user_id", "name", "segment", "signup_date"))


def user_daily(events: DataFrame, profiles: DataFrame) -> DataFrame:
    """Daily metrics of all users with revenue, contact data, country and score."""
    wanted = profiles.select("user_id", "name", "email", "segment", "country", "signup_date")
    return enrich(daily_metrics(events, revenue=True), wanted)


def by_segment_and_day(daily: DataFrame) -> DataFrame:
    """Users and totals per segment and day."""
    totals = {
        "total_events": "total_events",
        "total_page_views": "page_views",
        "total_clicks": "clicks",
        "total_purchases": "purchases",
    }
    means = {
        "avg_engagement_score": "engagement_score",
        "avg_session_duration": "session_duration_minutes",
    }
    return daily.groupBy("segment", "date").agg(
        F.count("user_id").alias("active_users"),
        *[F.sum(column).alias(name) for name, column in totals.items()],
        *[F.avg(column).alias(name) for name, column in means.items()],
    )


_DAILY = """
    SELECT user_id, to_date(timestamp) AS date, count(1) AS total_events, {kinds} AS unique_event_types,
           count_if(event_type = 'page_view') AS page_views, count_if(event_type = 'click') AS clicks,
           count_if(event_type = 'purchase') AS purchases,
           sum(if(event_type = 'purchase', revenue, 0)) AS total_revenue,
           min(timestamp) AS first_event_time, max(timestamp) AS last_event_time
    FROM events GROUP BY user_id, to_date(timestamp)
"""

#: The daily result of all users in SQL, over ``events`` and ``user_profiles``; also as streams.
SQL_STEPS = [
    {
        "name": "daily",
        "type": "sql",
        "inputs": ["events"],
        "output": "daily_metrics",
        "sql": _DAILY.format(kinds="count(DISTINCT event_type)"),
        "streaming_sql": _DAILY.format(kinds="approx_count_distinct(event_type)"),
    },
    {
        "name": "duration",
        "type": "sql",
        "inputs": ["daily_metrics"],
        "output": "timed_metrics",
        "sql": """
            SELECT *, (unix_timestamp(last_event_time) - unix_timestamp(first_event_time)) / 60
                      AS session_duration_minutes
            FROM daily_metrics
        """,
    },
    {
        "name": "profile",
        "type": "sql",
        "inputs": ["timed_metrics", "user_profiles"],
        "output": "enriched_metrics",
        "sql": """
            SELECT t.*, p.name, p.email, p.segment, p.country, p.signup_date,
                   datediff(t.date, p.signup_date) AS days_since_signup
            FROM timed_metrics t LEFT JOIN user_profiles p ON p.user_id = t.user_id
        """,
    },
    {
        "name": "score",
        "type": "sql",
        "inputs": ["enriched_metrics"],
        "output": "final_metrics",
        "sql": "SELECT *, page_views + 2 * clicks + 10 * purchases AS engagement_score FROM enriched_metrics",
    },
]


def daily_spec(events: dict, profiles: dict, target: str, name: str = "user_daily") -> dict:
    """Spec of the daily result of all users in SQL, from two source dicts into a folder partitioned by day."""
    return {
        "pipeline": {"name": name, "description": "Daily metrics of all users with revenue and profile"},
        "sources": [{**events, "name": "events"}, {**profiles, "name": "user_profiles"}],
        "transformations": SQL_STEPS,
        "validation": {"enabled": True, "fail_on_error": True, "rules": RULES},
        "target": {"type": "parquet", "path": target, "mode": "overwrite", "partition_by": ["date"]},
    }


def spec(events: dict, profiles: dict, target: str, min_events: int = 3, name: str = "user_analytics") -> dict:
    """Spec that runs the plan from two source dicts into a folder partitioned by day."""
    here = "sluiceway.plans.user_engagement"
    return {
        "pipeline": {"name": name, "description": "Daily user engagement"},
        "sources": [{**events, "name": "events"}, {**profiles, "name": "user_profiles"}],
        "transformations": [
            {
                "name": "calculate_daily_metrics",
                "type": "python",
                "inputs": ["events"],
                "output": "daily_metrics",
                "function": f"{here}.daily_metrics",
            },
            {
                "name": "enrich_with_profiles",
                "type": "python",
                "inputs": ["daily_metrics", "user_profiles"],
                "output": "enriched_metrics",
                "function": f"{here}.enrich",
            },
            {
                "name": "filter_active_users",
                "type": "python",
                "inputs": ["enriched_metrics"],
                "output": "active_users",
                "function": "sluiceway.operators.filters.active_users",
                "params": {"min_events": min_events},
            },
        ],
        "validation": {"enabled": True, "fail_on_error": True, "rules": ACTIVE_RULES},
        "target": {"type": "parquet", "path": target, "mode": "overwrite", "partition_by": ["date"]},
    }
