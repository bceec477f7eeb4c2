"""The three domain plans."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import query
from sluiceway import entities as e
from sluiceway.plans import product_performance, segment_performance, user_engagement


def user_daily(spark, folder):
    return user_engagement.user_daily(e.user_events(spark, folder), e.user_profiles(spark, folder))


def products(spark, folder):
    return product_performance.product_performance(
        e.products(spark, folder), e.user_events(spark, folder), e.transactions(spark, folder)
    )


def segments(spark, folder):
    return segment_performance.segment_performance(
        e.user_profiles(spark, folder), e.user_events(spark, folder), e.transactions(spark, folder)
    )


@query(
    "e1_user_daily_engagement",
    """
    SELECT user_id, "date", total_events, unique_event_types, page_views, clicks, purchases, first_event_time,
           last_event_time, round(session_duration_minutes, 4) AS session_duration_minutes, name, segment, signup_date,
           days_since_signup, engagement_score
    FROM user_daily WHERE total_events >= 3
    """,
    ["user_daily"],
)
def e1(spark, folder):
    found = user_engagement.daily_engagement(e.user_events(spark, folder), e.user_profiles(spark, folder))
    return found.withColumn("session_duration_minutes", F.round("session_duration_minutes", 4))


@query(
    "e2_user_daily_revenue",
    "SELECT * REPLACE (round(total_revenue, 2) AS total_revenue, "
    "round(session_duration_minutes, 4) AS session_duration_minutes) FROM user_daily",
    ["user_daily"],
)
def e2(spark, folder):
    rounded = {"total_revenue": 2, "session_duration_minutes": 4}
    return user_daily(spark, folder).withColumns({name: F.round(name, d) for name, d in rounded.items()})


@query(
    "e3_product_performance",
    "SELECT * REPLACE (round(total_revenue, 2) AS total_revenue) FROM product_performance",
    ["product_performance"],
)
def e3(spark, folder):
    return products(spark, folder).withColumn("total_revenue", F.round("total_revenue", 2))


# Amounts are summed in any order, so their last digits are not compared; averages of counts are exact.
DIGITS = {"total_revenue": 2, "avg_revenue_per_user": 6, "avg_transaction_value": 6}


def rounded_segments(spark, folder):
    return segments(spark, folder).withColumns({name: F.round(name, n) for name, n in DIGITS.items()})


SEGMENTS = f"SELECT * REPLACE ({', '.join(f'round({name}, {n}) AS {name}' for name, n in DIGITS.items())}) FROM segment_performance"


@query("e4_segment_performance", SEGMENTS, ["segment_performance"])
def e4(spark, folder):
    return rounded_segments(spark, folder)


@query(
    "e5_segment_rollup",
    """
    SELECT segment, "date", count(user_id) AS active_users, CAST(sum(total_events) AS BIGINT) AS total_events,
           CAST(sum(page_views) AS BIGINT) AS total_page_views, CAST(sum(clicks) AS BIGINT) AS total_clicks,
           CAST(sum(purchases) AS BIGINT) AS total_purchases,
           avg(engagement_score) AS avg_engagement_score,
           round(avg(session_duration_minutes), 8) AS avg_session_duration
    FROM user_daily WHERE total_events >= 3 GROUP BY ALL
    """,
    ["user_daily"],
)
def e5(spark, folder):
    active = user_engagement.daily_engagement(e.user_events(spark, folder), e.user_profiles(spark, folder))
    found = user_engagement.by_segment_and_day(active)
    return found.withColumn("avg_session_duration", F.round("avg_session_duration", 8))
