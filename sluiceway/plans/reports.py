"""Report queries over the results of the three plans.

``daily`` is the result of ``user_daily``, ``products`` of ``product_performance`` and ``segments``
of ``segment_performance``. Amounts are rounded to cents. Top lists break ties by a unique key, so
that a rerun lists the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.functions.columns import dollars, half_up
from sluiceway.operators.aggregates import exact_percentile, with_share_of_total
from sluiceway.operators.joins import top_cross_totals
from sluiceway.operators.ranking import top
from sluiceway.storage import stored


def top_users(daily: DataFrame, k: int = 10) -> DataFrame:
    scores = daily.groupBy("user_id", "name", "segment").agg(F.sum("engagement_score").alias("total_engagement"))
    return top(scores, k, F.desc("total_engagement"), F.asc("user_id"))


def revenue_by_segment(daily: DataFrame) -> DataFrame:
    totals = daily.groupBy("segment").agg(
        half_up(F.sum("total_revenue")).alias("revenue"), F.count_distinct("user_id").alias("users")
    )
    return totals.orderBy(F.desc("revenue"), "segment")


def daily_active_users(daily: DataFrame) -> DataFrame:
    days = daily.groupBy("date").agg(
        F.count_distinct("user_id").alias("active_users"), half_up(F.sum("total_revenue")).alias("revenue")
    )
    return days.orderBy(F.desc("date"))


def purchasing_users(daily: DataFrame) -> DataFrame:
    buyers = daily.where(F.col("purchases") > 0).groupBy("user_id", "name", "segment")
    totals = buyers.agg(
        F.sum("purchases").alias("total_purchases"), half_up(F.sum("total_revenue")).alias("revenue")
    )
    return totals.orderBy(F.desc("revenue"), "user_id")


def top_products(products: DataFrame, k: int = 10) -> DataFrame:
    wanted = products.select(
        "product_id", "product_name", "category", half_up(F.col("total_revenue")).alias("total_revenue"), "transaction_count"
    )
    return top(wanted, k, F.desc("total_revenue"), F.asc("product_id"))


def best_converting(products: DataFrame, k: int = 10) -> DataFrame:
    clicked = products.where(F.col("clicks") > 0).select(
        "product_id",
        "product_name",
        "category",
        "click_to_cart_rate",
        "cart_to_purchase_rate",
        half_up(F.col("total_revenue")).alias("total_revenue"),
    )
    return top(clicked, k, F.desc("cart_to_purchase_rate"), F.asc("product_id"))


def category_performance(products: DataFrame) -> DataFrame:
    totals = products.groupBy("category").agg(
        F.count(F.lit(1)).alias("num_products"),
        half_up(F.sum("total_revenue")).alias("category_revenue"),
        F.round(F.avg("click_to_cart_rate"), 8).alias("avg_conversion"),
    )
    return totals.orderBy(F.desc("category_revenue"), "category")


def low_performers(products: DataFrame, min_viewers: int = 10, max_revenue: float = 100) -> DataFrame:
    weak = (F.col("unique_viewers") > min_viewers) & (F.col("total_revenue") < max_revenue)
    wanted = products.where(weak).select(
        "product_id",
        "product_name",
        "category",
        "unique_viewers",
        "clicks",
        half_up(F.col("total_revenue")).alias("total_revenue"),
    )
    return wanted.orderBy(F.desc("unique_viewers"), "product_id")


def segment_comparison(segments: DataFrame) -> DataFrame:
    wanted = segments.select(
        "segment",
        "total_users",
        half_up(F.col("avg_revenue_per_user")).alias("avg_revenue"),
        half_up(F.col("avg_purchases_per_user")).alias("avg_purchases"),
        half_up(F.col("engagement_score")).alias("engagement"),
    )
    return wanted.orderBy(F.desc("avg_revenue"), "segment")


def revenue_per_user(segments: DataFrame) -> DataFrame:
    ordered = segments.orderBy(F.desc("avg_revenue_per_user"), "segment")
    return ordered.select(
        "segment",
        dollars(F.col("avg_revenue_per_user")).alias("avg_revenue_per_user"),
        dollars(F.col("total_revenue")).alias("total_revenue"),
        "total_users",
    )


def segment_by_category(daily: DataFrame, products: DataFrame, k: int = 20) -> DataFrame:
    pairs = top_cross_totals(daily, products, "segment", "category", "user_id", "total_revenue", k)
    return pairs.withColumn("revenue", half_up(F.col("revenue")))


def segment_users(segments: DataFrame, daily: DataFrame, k: int = 20) -> DataFrame:
    """Revenue of users next to the average of their segment, largest first.

    Users are summed up before the join. The segments are a plan of their own, so their size is left
    to adaptive execution, which broadcasts them once it has seen that they are few.
    """
    users = daily.groupBy("segment", "user_id", "name").agg(F.sum("total_revenue").alias("user_revenue"))
    wanted = segments.select("segment", "total_users", F.col("avg_revenue_per_user").alias("segment_avg_revenue"))
    joined = users.join(wanted, "segment")
    rounded = joined.withColumns(
        {"segment_avg_revenue": half_up(F.col("segment_avg_revenue")), "user_revenue": half_up(F.col("user_revenue"))}
    )
    return top(rounded, k, F.desc("user_revenue"), F.asc("user_id"))


def lifetime_value(daily: DataFrame) -> DataFrame:
    """Customers, revenue, mean and exact median revenue per segment.

    The totals per user are stored once: the median reads them twice, and sums of amounts differ
    in their last digits when they are computed again.
    """
    users = stored(daily.groupBy("user_id", "segment").agg(F.sum("total_revenue").alias("paid")))
    totals = users.groupBy("segment").agg(
        F.count_distinct("user_id").alias("customers"),
        half_up(F.sum("paid")).alias("total_revenue"),
        half_up(F.avg("paid")).alias("avg_customer_value"),
    )
    medians = exact_percentile(users, ["segment"], "paid", 0.5, "median_customer_value")
    medians = medians.withColumn("median_customer_value", half_up(F.col("median_customer_value")))
    return totals.join(medians, "segment", "left").orderBy(F.desc("avg_customer_value"), "segment")


def product_mix(products: DataFrame) -> DataFrame:
    totals = products.groupBy("category").agg(
        F.count(F.lit(1)).alias("products"),
        F.sum("total_revenue").alias("revenue"),
        F.round(F.avg("cart_to_purchase_rate"), 8).alias("avg_conversion"),
    )
    shared = with_share_of_total(totals, "revenue", "revenue_pct")
    return shared.withColumn("revenue", half_up(F.col("revenue"))).orderBy(F.desc("revenue"), "category")


def engagement_trend(daily: DataFrame) -> DataFrame:
    totals = daily.groupBy("date", "segment").agg(
        F.count_distinct("user_id").alias("daily_active_users"),
        F.avg("total_events").alias("avg_events_per_user"),
        F.avg("engagement_score").alias("avg_engagement"),
    )
    return totals.orderBy(F.desc("date"), "segment")


def segments_by_score(segments: DataFrame) -> DataFrame:
    return segments.orderBy(F.desc("engagement_score"), "segment")
