"""Joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.projections import step
from catalogue.registry import query
from sluiceway import entities as e
from sluiceway.operators import joins
from sluiceway.plans import product_performance, segment_performance, user_engagement
from sluiceway.plans.steps import apply_step

USER_TOTALS = """
    activity AS (SELECT user_id, count(*) AS events FROM user_events GROUP BY user_id),
    spending AS (SELECT user_id, count(*) AS sales, round(sum(total_amount), 2) AS paid
                 FROM transactions GROUP BY user_id)
"""


def joined(sql: str) -> str:
    """SQL over the two totals; they go behind the tables that the registry puts in front."""
    return f"SELECT * FROM (WITH {USER_TOTALS} {sql})"


def totals(spark, folder):
    activity = e.user_events(spark, folder).groupBy("user_id").agg(F.count(F.lit(1)).alias("events"))
    spending = e.transactions(spark, folder).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("sales"), F.round(F.sum("total_amount"), 2).alias("paid")
    )
    return {"activity": activity, "spending": spending}


def join_step(spark, frames, how=None, on="user_id"):
    wanted = step("join", list(frames), on=on)
    if how:
        wanted["how"] = how
    return apply_step(spark, frames, wanted)


@query(
    "j1_join_inner",
    "SELECT user_id, event_id, event_type, segment, country FROM user_events JOIN user_profiles USING (user_id)",
    ["user_events", "user_profiles"],
)
def inner(spark, folder):
    """No ``how``: inner is the default."""
    events = e.user_events(spark, folder).select("user_id", "event_id", "event_type")
    profiles = e.user_profiles(spark, folder).select("user_id", "segment", "country")
    return join_step(spark, {"events": events, "profiles": profiles})


@query(
    "j2_join_left",
    joined("SELECT user_id, sales, paid, events FROM spending LEFT JOIN activity USING (user_id)"),
    ["user_events", "transactions"],
)
def left(spark, folder):
    both = totals(spark, folder)
    return join_step(spark, {"spending": both["spending"], "activity": both["activity"]}, "left")


@query(
    "j3_join_right",
    joined("SELECT user_id, events, sales, paid FROM activity RIGHT JOIN spending USING (user_id)"),
    ["user_events", "transactions"],
)
def right(spark, folder):
    return join_step(spark, totals(spark, folder), "right")


@query(
    "j4_join_outer",
    joined("SELECT user_id, events, sales, paid FROM activity FULL JOIN spending USING (user_id)"),
    ["user_events", "transactions"],
)
def outer(spark, folder):
    return join_step(spark, totals(spark, folder), "outer")


@query(
    "j4_split_outer",
    """
    SELECT product_id, event_id, event_type, category, price
    FROM user_events FULL JOIN products USING (product_id)
    """,
    ["user_events", "products"],
)
def split_outer(spark, folder):
    """Events without a product and products without events both stay."""
    events = e.user_events(spark, folder).select("product_id", "event_id", "event_type")
    products = e.products(spark, folder).select("product_id", "category", "price")
    return joins.split_outer(events, products, "product_id")


@query(
    "j5_join_left_semi",
    "SELECT user_id, name, segment FROM user_profiles WHERE user_id IN (SELECT user_id FROM user_events)",
    ["user_events", "user_profiles"],
)
def left_semi(spark, folder):
    profiles = e.user_profiles(spark, folder).select("user_id", "name", "segment")
    return join_step(spark, {"profiles": profiles, "events": e.user_events(spark, folder)}, "left_semi")


@query(
    "j5_join_left_anti",
    "SELECT user_id, name, segment FROM user_profiles WHERE user_id NOT IN (SELECT user_id FROM user_events)",
    ["user_events", "user_profiles"],
)
def left_anti(spark, folder):
    profiles = e.user_profiles(spark, folder).select("user_id", "name", "segment")
    return join_step(spark, {"profiles": profiles, "events": e.user_events(spark, folder)}, "left_anti")


@query(
    "j6_join_composite",
    """
    SELECT user_id, product_id, events, sales
    FROM (SELECT user_id, product_id, count(*) AS events FROM user_events GROUP BY ALL)
    JOIN (SELECT user_id, product_id, count(*) AS sales FROM transactions GROUP BY ALL) USING (user_id, product_id)
    """,
    ["user_events", "transactions"],
)
def composite(spark, folder):
    keys = ["user_id", "product_id"]
    events = e.user_events(spark, folder).groupBy(*keys).agg(F.count(F.lit(1)).alias("events"))
    sales = e.transactions(spark, folder).groupBy(*keys).agg(F.count(F.lit(1)).alias("sales"))
    return join_step(spark, {"events": events, "sales": sales}, "inner", keys)


@query(
    "j8_differing_keys",
    "SELECT c_custkey, c_name, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey",
)
def differing_keys(spark, folder):
    customer, nation = e.table(spark, folder, "customer"), e.table(spark, folder, "nation")
    found = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"], "left")
    return found.select("c_custkey", "c_name", "n_name")


@query(
    "j9_join_totals",
    """
    SELECT p.product_id, category, coalesce(sold, 0) AS sold, coalesce(times, 0) AS times
    FROM products p LEFT JOIN (SELECT product_id, sum(quantity) AS sold, count(*) AS times
                               FROM transactions WHERE status = 'completed' GROUP BY product_id) t
         ON t.product_id = p.product_id
    """,
    ["products", "transactions"],
)
def join_totals(spark, folder):
    products = e.products(spark, folder).select("product_id", "category")
    completed = e.transactions(spark, folder).where("status = 'completed'")
    sums = {"sold": F.sum("quantity"), "times": F.count(F.lit(1))}
    return joins.join_totals(products, completed, "product_id", sums, dict.fromkeys(sums, 0))


@query(
    "j10_star",
    """
    SELECT order_id, line, t.user_id, t.product_id, quantity, status, segment, country, category
    FROM transactions t LEFT JOIN user_profiles u ON u.user_id = t.user_id
                        LEFT JOIN products p ON p.product_id = t.product_id
    """,
    ["transactions", "user_profiles", "products"],
)
def star(spark, folder):
    users = e.user_profiles(spark, folder).select("user_id", "segment", "country")
    products = e.products(spark, folder).select("product_id", "category")
    sales = e.transactions(spark, folder).drop("total_amount")
    return joins.star(sales, [(users, "user_id"), (products, "product_id")])


@query(
    "j11_cross_totals",
    """
    SELECT country, category, count(DISTINCT user_id) AS users, round(sum(total_revenue), 2) AS revenue
    FROM user_daily CROSS JOIN products GROUP BY country, category
    ORDER BY sum(total_revenue) DESC, country, category LIMIT 25
    """,
    ["user_daily", "products"],
)
def cross_totals(spark, folder):
    daily = user_engagement.user_daily(e.user_events(spark, folder), e.user_profiles(spark, folder))
    products = e.products(spark, folder)
    pairs = joins.top_cross_totals(daily, products, "country", "category", "user_id", "total_revenue", 25)
    return pairs.withColumn("revenue", F.round("revenue", 2))


@query(
    "j12_group_column",
    """
    SELECT s.segment, s.total_users, u.user_id, u.country, u.total_events
    FROM segment_performance s JOIN per_user u ON u.segment = s.segment
    """,
    ["segment_performance"],
)
def group_column(spark, folder):
    frames = [read(spark, folder) for read in (e.user_profiles, e.user_events, e.transactions)]
    segments = segment_performance.segment_performance(*frames).select("segment", "total_users")
    users = segment_performance.per_user(*frames).select("segment", "user_id", "country", "total_events")
    return users.join(segments, "segment")


@query(
    "j13_broadcast",
    "SELECT s_suppkey, s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey",
)
def broadcast(spark, folder):
    nation = e.table(spark, folder, "nation").withColumnRenamed("n_nationkey", "s_nationkey")
    found = e.table(spark, folder, "supplier").join(joins.broadcast_if_small(nation), "s_nationkey")
    return found.select("s_suppkey", "s_name", "n_name")


@query(
    "j9_event_totals",
    "SELECT product_id, unique_viewers, clicks, add_to_carts, purchases_from_events FROM product_performance",
    ["product_performance"],
)
def product_viewers(spark, folder):
    seen = product_performance.event_totals(e.products(spark, folder), e.user_events(spark, folder))
    return seen.select("product_id", "unique_viewers", "clicks", "add_to_carts", "purchases_from_events")
