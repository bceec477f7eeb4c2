"""Steps, projections, filters and scalar functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue.registry import half_up, query
from catalogue.scans import path
from sluiceway import entities as e
from sluiceway.functions import columns as c
from sluiceway.operators import filters
from sluiceway.plans import user_engagement
from sluiceway.plans.runner import build
from sluiceway.plans.steps import apply_step


def step(kind: str, inputs: list[str], **rest) -> dict:
    return {"name": kind, "type": kind, "inputs": inputs, "output": "result", **rest}


@query(
    "p1_filter_step",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000",
)
def filter_step(spark, folder):
    frames = {"orders": e.table(spark, folder, "orders")}
    wanted = step("filter", ["orders"], condition="o_orderstatus = 'F' AND o_totalprice > 100000")
    return apply_step(spark, frames, wanted).select("o_orderkey", "o_totalprice")


@query(
    "p2_sql_step",
    "SELECT segment, country, count(*) AS events FROM user_events JOIN user_profiles USING (user_id) GROUP BY ALL",
    ["user_events", "user_profiles"],
)
def sql_step(spark, folder):
    """The query names a frame that is not among the inputs of the step, which is allowed."""
    frames = {"user_events": e.user_events(spark, folder), "user_profiles": e.user_profiles(spark, folder)}
    text = """
        SELECT segment, country, count(*) AS events
        FROM user_events JOIN user_profiles USING (user_id) GROUP BY segment, country
    """
    return apply_step(spark, frames, step("sql", ["user_events"], sql=text))


@query(
    "p3_python_step",
    'SELECT user_id, "date", total_events FROM daily_metrics WHERE total_events >= 4',
    ["daily_metrics"],
)
def python_step(spark, folder):
    frames = {"daily": user_engagement.daily_metrics(e.user_events(spark, folder))}
    function = "sluiceway.operators.filters.active_users"
    wanted = step("python", ["daily"], function=function, params={"min_events": 4})
    return apply_step(spark, frames, wanted).select("user_id", "date", "total_events")


@query(
    "p4_active_users",
    'SELECT user_id, "date", total_events, clicks FROM daily_metrics WHERE total_events >= 5',
    ["daily_metrics"],
)
def active_users(spark, folder):
    daily = user_engagement.daily_metrics(e.user_events(spark, folder))
    return filters.active_users(daily).select("user_id", "date", "total_events", "clicks")


@query(
    "p5_threshold",
    """
    SELECT 'greater' AS test, l_orderkey, l_quantity FROM lineitem WHERE l_quantity > 25
    UNION ALL SELECT 'less', l_orderkey, l_quantity FROM lineitem WHERE l_quantity < 25
    UNION ALL SELECT 'same', l_orderkey, l_quantity FROM lineitem WHERE l_quantity = 25
    """,
)
def threshold(spark, folder):
    lines = e.table(spark, folder, "lineitem").select("l_orderkey", "l_quantity")
    parts = [
        filters.by_threshold(lines, "l_quantity", 25.0, word).withColumn("test", F.lit(word))
        for word in ("greater", "less", "same")
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "p6_date_range",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS \"date\" FROM orders "
    "WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1997-06-30'",
)
def date_range(spark, folder):
    orders = e.table(spark, folder, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("date"))
    return filters.by_date_range(orders, "1996-01-01", "1997-06-30")


@query(
    "p7_projection",
    """
    SELECT n.*, r_name, n_nationkey + 1 AS next_key, upper(n_name) || '/' || lower(r_name) AS label
    FROM nation n JOIN region r ON r_regionkey = n_regionkey
    """,
)
def projection(spark, folder):
    frames = {name: e.table(spark, folder, name) for name in ("nation", "region")}
    text = """
        SELECT n.*, r.r_name, n.n_nationkey + 1 AS next_key, concat(upper(n_name), '/', lower(r_name)) AS label
        FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey
    """
    return apply_step(spark, frames, step("sql", ["nation", "region"], sql=text))


@query(
    "p8_case_classes",
    """
    SELECT user_id, purchases, round(revenue, 2) AS revenue,
           CASE WHEN purchases > 10 AND revenue > 1000 THEN 'VIP'
                WHEN purchases > 5 OR revenue > 500 THEN 'Active' ELSE 'Casual' END AS segment
    FROM (SELECT user_id, count(*) AS purchases, sum(revenue) AS revenue FROM user_events
          WHERE event_type = 'purchase' GROUP BY user_id)
    """,
    ["user_events"],
)
def case_classes(spark, folder):
    bought = e.user_events(spark, folder).where("event_type = 'purchase'").groupBy("user_id")
    totals = bought.agg(F.count(F.lit(1)).alias("purchases"), F.sum("revenue").alias("revenue"))
    classed = totals.withColumn("segment", c.customer_class())
    return classed.withColumn("revenue", F.round("revenue", 2))


@query(
    "p9_safe_ratio",
    """
    SELECT user_id, "date", page_views AS visits, purchases,
           CASE WHEN page_views > 0 THEN round(purchases / page_views, 6) ELSE 0.0 END AS conversion_rate
    FROM daily_metrics
    """,
    ["daily_metrics"],
)
def safe_ratio(spark, folder):
    daily = user_engagement.daily_metrics(e.user_events(spark, folder))
    visits = daily.select("user_id", "date", F.col("page_views").alias("visits"), "purchases")
    rated = c.with_conversion_rate(visits)
    return rated.withColumn("conversion_rate", F.round("conversion_rate", 6))


@query(
    "p10_timestamp_features",
    """
    SELECT event_id, CAST("timestamp" AS DATE) AS "date", CAST(hour("timestamp") AS INTEGER) AS hour,
           CAST(dayofweek("timestamp") + 1 AS INTEGER) AS day_of_week FROM user_events
    """,
    ["user_events"],
)
def timestamp_features(spark, folder):
    featured = c.with_timestamp_features(e.user_events(spark, folder))
    return featured.select("event_id", "date", "hour", "day_of_week")


@query("p11_no_steps", "SELECT * FROM supplier")
def no_steps(spark, folder):
    names = ["supplier", "nation"]
    sources = [{"name": name, "type": "parquet", "path": path(folder, name)} for name in names]
    result, _ = build(spark, {"sources": sources})
    return result


@query("p12_sample_keys")
def sample_keys(spark, folder):
    return filters.sample(e.user_events(spark, folder), 0.1, "user_id")


@query(
    "p12_sample_of_size",
    """
    SELECT event_id, user_id, event_type FROM user_events WHERE user_id IN (
        SELECT user_id FROM (SELECT DISTINCT user_id FROM user_events WHERE user_id IS NOT NULL)
        ORDER BY md5('42:' || CAST(user_id AS VARCHAR)), user_id LIMIT 100)
    """,
    ["user_events"],
)
def sample_of_size(spark, folder):
    """All events of a hundred users."""
    return filters.sample_of_size(e.user_events(spark, folder).select("event_id", "user_id", "event_type"), 100, "user_id")


@query("p12_sample_rows")
def sample_rows(spark, folder):
    return filters.sample(e.table(spark, folder, "lineitem"), 0.1)


@query("f1_to_date", "SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def to_date(spark, folder):
    return e.table(spark, folder, "events").select("event_id", F.to_date("ts").alias("day"))


@query(
    "f2_minutes",
    """
    SELECT user_id, round((CAST(floor(epoch(max(ts))) AS BIGINT) - CAST(floor(epoch(min(ts))) AS BIGINT)) / 60.0, 4)
           AS minutes FROM events GROUP BY user_id
    """,
)
def minutes(spark, folder):
    spans = e.table(spark, folder, "events").groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return spans.select("user_id", F.round(c.minutes_between("a", "b"), 4).alias("minutes"))


@query(
    "f3_datediff",
    "SELECT l_orderkey, l_linenumber, l_partkey, "
    "CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INTEGER) AS days "
    "FROM lineitem JOIN orders ON o_orderkey = l_orderkey",
)
def datediff(spark, folder):
    """The start day is text, as sign-up days are in user files."""
    text = F.date_format("o_orderdate", "yyyy-MM-dd").alias("ordered")
    orders = e.table(spark, folder, "orders").select(F.col("o_orderkey").alias("l_orderkey"), text)
    lines = e.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    joined = lines.join(orders, "l_orderkey")
    days = c.days_between("ordered", F.to_date("l_shipdate")).alias("days")
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", days)


@query(
    "f4_hour_weekday",
    "SELECT CAST(hour(ts) AS INTEGER) AS hour, CAST(dayofweek(ts) + 1 AS INTEGER) AS weekday, count(*) AS n "
    "FROM events GROUP BY ALL",
)
def hour_weekday(spark, folder):
    keys = [F.hour("ts").alias("hour"), F.dayofweek("ts").alias("weekday")]
    return e.table(spark, folder, "events").groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


@query(
    "f5_coalesce",
    "SELECT event_id, coalesce(product_id, -1) AS product_id, coalesce(revenue, 0) AS revenue FROM user_events",
    ["user_events"],
)
def coalesce(spark, folder):
    filled = {"product_id": F.lit(-1), "revenue": F.lit(0.0)}
    columns = [F.coalesce(F.col(name), other).alias(name) for name, other in filled.items()]
    return e.user_events(spark, folder).select("event_id", *columns)


@query("f6_round", f"SELECT p_partkey, {half_up('p_retailprice / 7')} AS share FROM part")
def rounded(spark, folder):
    return e.table(spark, folder, "part").select("p_partkey", F.round(F.col("p_retailprice") / 7, 2).alias("share"))


@query("f7_dollars", "SELECT o_orderkey, printf('$%.2f', round(o_totalprice, 2)) AS price FROM orders")
def dollars(spark, folder):
    return e.table(spark, folder, "orders").select("o_orderkey", c.dollars(F.col("o_totalprice")).alias("price"))


@query(
    "f8_engagement_score",
    'SELECT user_id, "date", page_views * 1 + clicks * 2 + purchases * 10 AS score FROM daily_metrics',
    ["daily_metrics"],
)
def engagement_score(spark, folder):
    daily = user_engagement.daily_metrics(e.user_events(spark, folder))
    return daily.select("user_id", "date", c.weighted(user_engagement.SCORE).alias("score"))


@query(
    "f9_weighted_score",
    """
    SELECT user_id, round(total_events * 0.3::DOUBLE + purchase_count * 0.4::DOUBLE
                          + total_spent_events * 0.3::DOUBLE / 100, 8) AS score FROM per_user
    """,
    ["per_user"],
)
def weighted_score(spark, folder):
    from sluiceway.plans.segment_performance import per_user

    users = per_user(*(read(spark, folder) for read in (e.user_profiles, e.user_events, e.transactions)))
    weights = {"total_events": 0.3, "purchase_count": 0.4, "total_spent_events": 0.003}
    return users.select("user_id", F.round(c.weighted(weights), 8).alias("score"))


@query(
    "f10_case_when",
    "SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity >= 40 THEN 'large' "
    "WHEN l_quantity >= 15 THEN 'medium' ELSE 'small' END AS size FROM lineitem",
)
def case_when(spark, folder):
    size = F.when(F.col("l_quantity") >= 40, "large").when(F.col("l_quantity") >= 15, "medium").otherwise("small")
    return e.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", size.alias("size"))


@query(
    "f11_predicates",
    "SELECT event_id FROM user_events WHERE (product_id IS NOT NULL AND product_id < 50) "
    "OR (revenue IS NULL AND event_type = 'search')",
    ["user_events"],
)
def predicates(spark, folder):
    cheap = F.col("product_id").isNotNull() & (F.col("product_id") < 50)
    searched = F.col("revenue").isNull() & (F.col("event_type") == "search")
    return e.user_events(spark, folder).where(cheap | searched).select("event_id")


@query(
    "f12_conversion_rates",
    "SELECT product_id, click_to_cart_rate, cart_to_purchase_rate, avg_revenue_per_unit FROM product_performance",
    ["product_performance"],
)
def conversion_rates(spark, folder):
    from sluiceway.plans.product_performance import product_performance

    frames = (read(spark, folder) for read in (e.products, e.user_events, e.transactions))
    return product_performance(*frames).select(
        "product_id", "click_to_cart_rate", "cart_to_purchase_rate", "avg_revenue_per_unit"
    )
