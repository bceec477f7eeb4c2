"""Report queries over the results of the plans."""

from __future__ import annotations

from catalogue.plans import SEGMENTS, products, rounded_segments, segments, user_daily
from catalogue.registry import half_up, query
from sluiceway.plans import reports
from sluiceway.sources.inventory import row_counts


@query(
    "b1_top_users",
    """
    SELECT user_id, name, segment, CAST(sum(engagement_score) AS BIGINT) AS total_engagement FROM user_daily
    GROUP BY ALL ORDER BY total_engagement DESC, user_id LIMIT 10
    """,
    ["user_daily"],
)
def b1(spark, folder):
    return reports.top_users(user_daily(spark, folder))


@query(
    "b2_revenue_by_segment",
    "SELECT segment, round(sum(total_revenue), 2) AS revenue, count(DISTINCT user_id) AS users FROM user_daily "
    "GROUP BY segment",
    ["user_daily"],
)
def b2(spark, folder):
    return reports.revenue_by_segment(user_daily(spark, folder))


@query(
    "b3_daily_active_users",
    'SELECT "date", count(DISTINCT user_id) AS active_users, round(sum(total_revenue), 2) AS revenue FROM user_daily '
    'GROUP BY "date"',
    ["user_daily"],
)
def b3(spark, folder):
    return reports.daily_active_users(user_daily(spark, folder))


@query(
    "b4_purchasing_users",
    """
    SELECT user_id, name, segment, CAST(sum(purchases) AS BIGINT) AS total_purchases,
           round(sum(total_revenue), 2) AS revenue
    FROM user_daily WHERE purchases > 0 GROUP BY ALL
    """,
    ["user_daily"],
)
def b4(spark, folder):
    return reports.purchasing_users(user_daily(spark, folder))


@query(
    "b5_top_products",
    """
    SELECT product_id, product_name, category, round(total_revenue, 2) AS total_revenue, transaction_count
    FROM product_performance ORDER BY round(total_revenue, 2) DESC, product_id LIMIT 10
    """,
    ["product_performance"],
)
def b5(spark, folder):
    return reports.top_products(products(spark, folder))


@query(
    "b6_best_converting",
    """
    SELECT product_id, product_name, category, click_to_cart_rate, cart_to_purchase_rate,
           round(total_revenue, 2) AS total_revenue
    FROM product_performance WHERE clicks > 0 ORDER BY cart_to_purchase_rate DESC, product_id LIMIT 10
    """,
    ["product_performance"],
)
def b6(spark, folder):
    return reports.best_converting(products(spark, folder))


@query(
    "b7_category_performance",
    """
    SELECT category, count(*) AS num_products, round(sum(total_revenue), 2) AS category_revenue,
           round(avg(click_to_cart_rate), 8) AS avg_conversion
    FROM product_performance GROUP BY category
    """,
    ["product_performance"],
)
def b7(spark, folder):
    return reports.category_performance(products(spark, folder))


@query(
    "b8_low_performers",
    """
    SELECT product_id, product_name, category, unique_viewers, clicks, round(total_revenue, 2) AS total_revenue
    FROM product_performance WHERE unique_viewers > 10 AND total_revenue < 500000
    """,
    ["product_performance"],
)
def b8(spark, folder):
    """Products of the test tables earn more than those the default limits are made for."""
    return reports.low_performers(products(spark, folder), max_revenue=500_000)


@query(
    "b9_segment_comparison",
    f"""
    SELECT segment, total_users, {half_up('avg_revenue_per_user')} AS avg_revenue,
           {half_up('avg_purchases_per_user')} AS avg_purchases, round(engagement_score, 2) AS engagement
    FROM segment_performance
    """,
    ["segment_performance"],
)
def b9(spark, folder):
    return reports.segment_comparison(segments(spark, folder))


@query(
    "b10_revenue_per_user",
    f"""
    SELECT segment, printf('$%.2f', {half_up('avg_revenue_per_user')}) AS avg_revenue_per_user,
           printf('$%.2f', round(total_revenue, 2)) AS total_revenue, total_users
    FROM segment_performance
    """,
    ["segment_performance"],
)
def b10(spark, folder):
    return reports.revenue_per_user(segments(spark, folder))


@query(
    "b11_segment_by_category",
    """
    SELECT u.segment, p.category, count(DISTINCT u.user_id) AS users, round(sum(u.total_revenue), 2) AS revenue
    FROM user_daily u CROSS JOIN product_performance p GROUP BY ALL
    ORDER BY sum(u.total_revenue) DESC, u.segment, p.category LIMIT 20
    """,
    ["user_daily", "product_performance"],
)
def b11(spark, folder):
    return reports.segment_by_category(user_daily(spark, folder), products(spark, folder))


@query(
    "b12_segment_users",
    f"""
    SELECT s.segment, s.total_users, {half_up('s.avg_revenue_per_user')} AS segment_avg_revenue, u.user_id, u.name,
           round(sum(u.total_revenue), 2) AS user_revenue
    FROM segment_performance s JOIN user_daily u ON u.segment = s.segment
    GROUP BY s.segment, s.total_users, s.avg_revenue_per_user, u.user_id, u.name
    ORDER BY user_revenue DESC, u.user_id LIMIT 20
    """,
    ["user_daily", "segment_performance"],
)
def b12(spark, folder):
    return reports.segment_users(segments(spark, folder), user_daily(spark, folder))


@query(
    "b13_lifetime_value",
    f"""
    SELECT segment, count(DISTINCT user_id) AS customers, round(sum(paid), 2) AS total_revenue,
           {half_up('avg(paid)')} AS avg_customer_value, {half_up('quantile_cont(paid, 0.5)')} AS median_customer_value
    FROM (SELECT user_id, segment, sum(total_revenue) AS paid FROM user_daily GROUP BY ALL) GROUP BY segment
    """,
    ["user_daily"],
)
def b13(spark, folder):
    return reports.lifetime_value(user_daily(spark, folder))


@query(
    "b14_product_mix",
    f"""
    SELECT category, count(*) AS products, round(sum(total_revenue), 2) AS revenue,
           {half_up('sum(total_revenue) * 100 / sum(sum(total_revenue)) OVER ()')} AS revenue_pct,
           round(avg(cart_to_purchase_rate), 8) AS avg_conversion
    FROM product_performance GROUP BY category
    """,
    ["product_performance"],
)
def b14(spark, folder):
    return reports.product_mix(products(spark, folder))


@query(
    "b15_engagement_trend",
    """
    SELECT "date", segment, count(DISTINCT user_id) AS daily_active_users,
           avg(total_events) AS avg_events_per_user, avg(engagement_score) AS avg_engagement
    FROM user_daily GROUP BY ALL
    """,
    ["user_daily"],
)
def b15(spark, folder):
    return reports.engagement_trend(user_daily(spark, folder))


@query(
    "b16_row_counts",
    """
    SELECT 'user_daily' AS table_name, count(*) AS rows FROM user_daily
    UNION ALL SELECT 'product_performance', count(*) FROM product_performance
    UNION ALL SELECT 'segment_performance', count(*) FROM segment_performance
    """,
    ["user_daily", "product_performance", "segment_performance"],
)
def b16(spark, folder):
    results = {"user_daily": user_daily, "product_performance": products, "segment_performance": segments}
    return row_counts({name: make(spark, folder) for name, make in results.items()})


@query("b17_segments_by_score", SEGMENTS, ["segment_performance"])
def b17(spark, folder):
    return reports.segments_by_score(rounded_segments(spark, folder))
