"""Performance of user segments: activity and sales per user, then per segment, and a score."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.columns import half_up, weighted
from sluiceway.operators.joins import join_totals

# Weights of the engagement score of a segment.
SCORE = {"avg_events_per_user": 0.3, "avg_purchases_per_user": 0.4, "avg_revenue_per_user": 0.3 / 100}

# Rules of the result.
RULES = [
    {"name": "check_segment_not_null", "type": "null_check", "column": "segment", "threshold": 0.0},
    {"name": "check_positive_users", "type": "range_check", "column": "total_users", "min_value": 1},
    {"name": "check_minimum_records", "type": "row_count", "min_count": 1},
]


def activity_totals() -> dict:
    bought = F.col("event_type") == "purchase"
    return {
        "total_events": F.count(F.lit(1)),
        "active_days": F.count_distinct(F.to_date("timestamp")),
        "purchase_count": F.count_if(bought),
        "total_spent_events": F.sum(F.when(bought, F.col("revenue")).otherwise(F.lit(0.0))),
    }


def sales_totals() -> dict:
    return {
        "transaction_count": F.count(F.lit(1)),
        "transaction_revenue": F.sum("total_amount"),
        "avg_transaction_value": F.avg("total_amount"),
    }


def per_user(profiles: DataFrame, events: DataFrame, transactions: DataFrame) -> DataFrame:
    """Every profile with its activity and its completed sales, 0 where it has none."""
    completed = transactions.where(F.col("status") == "completed")
    activity, sales = activity_totals(), sales_totals()
    users = profiles.select("user_id", "name", "segment", "country", "age")
    active = join_totals(users, events, "user_id", activity, dict.fromkeys(activity, 0))
    return join_totals(active, completed, "user_id", sales, dict.fromkeys(sales, 0))


def segment_performance(profiles: DataFrame, events: DataFrame, transactions: DataFrame) -> DataFrame:
    """Totals and averages per segment, and their score."""
    users = per_user(profiles, events, transactions)
    totals = users.groupBy("segment").agg(
        F.count_distinct("user_id").alias("total_users"),
        F.sum("total_events").alias("total_events"),
        F.avg("total_events").alias("avg_events_per_user"),
        F.sum("active_days").alias("total_active_days"),
        F.avg("active_days").alias("avg_active_days_per_user"),
        F.sum("purchase_count").alias("total_purchases"),
        F.avg("purchase_count").alias("avg_purchases_per_user"),
        F.sum("transaction_revenue").alias("total_revenue"),
        F.avg("transaction_revenue").alias("avg_revenue_per_user"),
        F.avg("avg_transaction_value").alias("avg_transaction_value"),
    )
    return totals.withColumn("engagement_score", half_up(weighted(SCORE)))


def spec(user_profiles: dict, events: dict, transactions: dict, target: str, name: str = "segment_performance") -> dict:
    """Spec that runs the plan from three source dicts into a folder, which is optimized after the write."""
    sources = {"user_profiles": user_profiles, "events": events, "transactions": transactions}
    return {
        "pipeline": {"name": name},
        "sources": [{**source, "name": key} for key, source in sources.items()],
        "transformations": [
            {
                "name": "segment_performance",
                "type": "python",
                "inputs": list(sources),
                "output": "segment_performance",
                "function": "sluiceway.plans.segment_performance.segment_performance",
            }
        ],
        "validation": {"enabled": True, "fail_on_error": True, "rules": RULES},
        "target": {"type": "parquet", "path": target, "mode": "overwrite", "optimize": {"enabled": True}},
    }
