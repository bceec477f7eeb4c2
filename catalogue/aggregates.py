"""Aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.projections import step
from catalogue.registry import half_up, query
from sluiceway import entities as e
from sluiceway import storage
from sluiceway.operators import aggregates as a
from sluiceway.plans import reports, segment_performance, user_engagement
from sluiceway.plans.steps import apply_step


def daily(spark, folder):
    return user_engagement.user_daily(e.user_events(spark, folder), e.user_profiles(spark, folder))


@query(
    "a1_aggregate_step",
    """
    SELECT l_returnflag, l_linestatus, round(sum(l_extendedprice), 2) AS l_extendedprice_sum,
           round(avg(l_discount), 6) AS l_discount_avg, count(l_orderkey) AS l_orderkey_count,
           min(l_shipdate) AS l_shipdate_min, max(l_quantity) AS l_quantity_max
    FROM lineitem GROUP BY ALL
    """,
)
def aggregate_step(spark, folder):
    wanted = step(
        "aggregate",
        ["lineitem"],
        group_by=["l_returnflag", "l_linestatus"],
        aggregations={
            "l_extendedprice": "sum",
            "l_discount": "avg",
            "l_orderkey": "count",
            "l_shipdate": "min",
            "l_quantity": "max",
        },
    )
    found = apply_step(spark, {"lineitem": e.table(spark, folder, "lineitem")}, wanted)
    return found.withColumns(
        {
            "l_extendedprice_sum": F.round("l_extendedprice_sum", 2),
            "l_discount_avg": F.round("l_discount_avg", 6),
        }
    )


def single(number: int, function: str, column: str, digits: int | None) -> None:
    """One query per function of the step, over a nullable column of all events."""
    output = f"{column}_{function}"
    number_of = f"{function}({column})" if digits is None else f"round({function}({column}), {digits})"

    @query(
        f"a{number}_{function}",
        f"SELECT user_id, {number_of} AS {output} FROM user_events GROUP BY user_id",
        ["user_events"],
    )
    def aggregate(spark, folder):
        frames = {"events": e.user_events(spark, folder)}
        wanted = step("aggregate", ["events"], group_by=["user_id"], aggregations={column: function})
        found = apply_step(spark, frames, wanted)
        return found if digits is None else found.withColumn(output, F.round(output, digits))


single(2, "sum", "revenue", 2)
single(3, "avg", "product_id", None)
single(4, "count", "revenue", None)
single(5, "min", "revenue", None)
single(6, "max", "revenue", None)


@query(
    "a7_global",
    "SELECT count(o_orderkey) AS o_orderkey_count, round(sum(o_totalprice), 2) AS o_totalprice_sum, "
    "max(o_orderdate) AS o_orderdate_max FROM orders",
)
def whole_table(spark, folder):
    wanted = step("aggregate", ["orders"], aggregations={"o_orderkey": "count", "o_totalprice": "sum", "o_orderdate": "max"})
    found = apply_step(spark, {"orders": e.table(spark, folder, "orders")}, wanted)
    return found.withColumn("o_totalprice_sum", F.round("o_totalprice_sum", 2))


@query("a9_count_rows", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def count_rows(spark, folder):
    return e.table(spark, folder, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("a10_distinct", "SELECT event_type, count(DISTINCT user_id) AS users FROM events GROUP BY event_type")
def distinct(spark, folder):
    events = e.table(spark, folder, "events")
    return events.groupBy("event_type").agg(a.distinct_count(events, "user_id").alias("users"))


@query(
    "a11_distinct_expression",
    "SELECT user_id, count(DISTINCT CAST(ts AS DATE)) AS active_days FROM events GROUP BY user_id",
)
def distinct_expression(spark, folder):
    events = e.table(spark, folder, "events")
    return events.groupBy("user_id").agg(a.distinct_count(events, F.to_date("ts")).alias("active_days"))


@query(
    "a12_conditional_count",
    """
    SELECT user_id, CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS clicks,
           CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS purchases
    FROM user_events GROUP BY user_id
    """,
    ["user_events"],
)
def conditional_count(spark, folder):
    kind = F.col("event_type")
    return e.user_events(spark, folder).groupBy("user_id").agg(
        F.count_if(kind == "click").alias("clicks"), F.count_if(kind == "purchase").alias("purchases")
    )


@query(
    "a13_conditional_sum",
    """
    SELECT user_id, round(sum(CASE WHEN event_type = 'purchase' THEN revenue ELSE 0 END), 2) AS paid
    FROM user_events GROUP BY user_id
    """,
    ["user_events"],
)
def conditional_sum(spark, folder):
    paid = F.when(F.col("event_type") == "purchase", F.col("revenue")).otherwise(F.lit(0.0))
    return e.user_events(spark, folder).groupBy("user_id").agg(F.round(F.sum(paid), 2).alias("paid"))


@query(
    "a14_count_case",
    """
    SELECT product_id, count(CASE WHEN event_type = 'click' THEN 1 END) AS clicks,
           count(CASE WHEN event_type = 'add_to_cart' THEN 1 END) AS carts
    FROM user_events GROUP BY product_id
    """,
    ["user_events"],
)
def count_case(spark, folder):
    def times(kind):
        return F.count(F.when(F.col("event_type") == kind, 1))

    counts = [times("click").alias("clicks"), times("add_to_cart").alias("carts")]
    return e.user_events(spark, folder).groupBy("product_id").agg(*counts)


@query(
    "a15_first_last",
    "SELECT user_id, min(ts) AS first_event_time, max(ts) AS last_event_time FROM events GROUP BY user_id",
)
def first_last(spark, folder):
    times = [F.min("ts").alias("first_event_time"), F.max("ts").alias("last_event_time")]
    return e.table(spark, folder, "events").groupBy("user_id").agg(*times)


@query(
    "a16_stddev",
    "SELECT user_id, round(stddev_samp(value), 4) AS spread FROM events GROUP BY user_id",
)
def stddev(spark, folder):
    return e.table(spark, folder, "events").groupBy("user_id").agg(F.round(F.stddev("value"), 4).alias("spread"))


@query("a17_approx_percentile")
def approx_percentile(spark, folder):
    lines = e.table(spark, folder, "lineitem")
    return lines.groupBy("l_returnflag").agg(F.percentile_approx("l_extendedprice", 0.5).alias("median_price"))


@query(
    "a17_quantile_sketch",
    "SELECT l_returnflag, count(*) AS rows, true AS within_bound FROM lineitem GROUP BY l_returnflag",
)
def quantile_sketch(spark, folder):
    """Medians from stored sketches of every month, and whether their ranks hold."""
    lines = e.table(spark, folder, "lineitem").select("l_returnflag", "l_shipdate", "l_extendedprice")
    month = F.trunc("l_shipdate", "month").alias("month")
    sketches = storage.stored(a.quantile_sketches(lines, ["l_returnflag", month], "l_extendedprice"))
    medians = a.sketched_quantile(sketches, ["l_returnflag"], 0.5, "median_price")
    return a.with_rank_check(lines, medians, ["l_returnflag"], "l_extendedprice", "median_price", 0.5)


@query(
    "a18_exact_percentile",
    "SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.5), 4) AS median_price FROM lineitem "
    "GROUP BY l_returnflag",
)
def exact_percentile(spark, folder):
    lines = e.table(spark, folder, "lineitem")
    found = a.exact_percentile(lines, ["l_returnflag"], "l_extendedprice", 0.5, "median_price")
    return found.withColumn("median_price", F.round("median_price", 4))


@query(
    "a19_collect_values",
    """
    SELECT user_id, "date", (place - 1) // 100000 AS chunk, string_agg(k, ',' ORDER BY k) AS products
    FROM (SELECT user_id, CAST(ts AS DATE) AS "date", lpad(json_extract_string(props, '$.k'), 6, '0') AS k,
                 row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY k, event_id) AS place
          FROM events)
    GROUP BY ALL
    """,
)
def collect_values(spark, folder):
    events = e.table(spark, folder, "events").select(
        "event_id",
        "user_id",
        F.to_date("ts").alias("date"),
        F.lpad(F.get_json_object("props", "$.k"), 6, "0").alias("k"),
    )
    found = a.collect_values(events, ["user_id", "date"], "k", "event_id", 100_000, "products")
    return found.withColumn("products", F.array_join("products", ","))


@query(
    "a20_approx_distinct",
    """
    SELECT user_id, CAST(ts AS DATE) AS "date", count(DISTINCT event_type) AS unique_event_types
    FROM events GROUP BY ALL
    """,
)
def approx_distinct(spark, folder):
    keys = ["user_id", F.to_date("ts").alias("date")]
    kinds = F.approx_count_distinct("event_type").alias("unique_event_types")
    return e.table(spark, folder, "events").groupBy(*keys).agg(kinds)


@query(
    "a21_pivot",
    """
    SELECT user_id, CAST("timestamp" AS DATE) AS "date",
           nullif(count(*) FILTER (WHERE event_type = 'page_view'), 0) AS page_view,
           nullif(count(*) FILTER (WHERE event_type = 'click'), 0) AS click,
           nullif(count(*) FILTER (WHERE event_type = 'purchase'), 0) AS purchase
    FROM user_events GROUP BY ALL
    """,
    ["user_events"],
)
def pivot(spark, folder):
    dated = e.user_events(spark, folder).withColumn("date", F.to_date("timestamp"))
    return a.pivot_counts(dated, ["user_id", "date"], "event_type", ["page_view", "click", "purchase"])


@query(
    "a22_two_levels",
    """
    SELECT segment, count(*) AS users, avg(total_events) AS mean_events,
           CAST(sum(purchase_count) AS BIGINT) AS purchases FROM per_user GROUP BY segment
    """,
    ["per_user"],
)
def two_levels(spark, folder):
    frames = [read(spark, folder) for read in (e.user_profiles, e.user_events, e.transactions)]
    return segment_performance.per_user(*frames).groupBy("segment").agg(
        F.count(F.lit(1)).alias("users"),
        F.avg("total_events").alias("mean_events"),
        F.sum("purchase_count").alias("purchases"),
    )


@query(
    "a23_segment_day",
    """
    SELECT segment, "date", count(user_id) AS active_users, CAST(sum(total_events) AS BIGINT) AS total_events,
           CAST(sum(page_views) AS BIGINT) AS total_page_views, CAST(sum(clicks) AS BIGINT) AS total_clicks,
           CAST(sum(purchases) AS BIGINT) AS total_purchases,
           avg(engagement_score) AS avg_engagement_score,
           round(avg(session_duration_minutes), 8) AS avg_session_duration
    FROM user_daily GROUP BY ALL
    """,
    ["user_daily"],
)
def segment_day(spark, folder):
    found = user_engagement.by_segment_and_day(daily(spark, folder))
    return found.withColumn("avg_session_duration", F.round("avg_session_duration", 8))


@query(
    "a24_share_of_total",
    f"""
    SELECT o_orderpriority, round(sum(o_totalprice), 2) AS price,
           {half_up('sum(o_totalprice) * 100 / sum(sum(o_totalprice)) OVER ()')} AS share
    FROM orders GROUP BY o_orderpriority
    """,
)
def share_of_total(spark, folder):
    sums = e.table(spark, folder, "orders").groupBy("o_orderpriority").agg(F.sum("o_totalprice").alias("price"))
    return a.with_share_of_total(sums, "price", "share").withColumn("price", F.round("price", 2))


@query(
    "a18_percentile_of_totals",
    f"""
    SELECT segment, {half_up('quantile_cont(paid, 0.5)')} AS median_customer_value
    FROM (SELECT user_id, segment, sum(total_revenue) AS paid FROM user_daily GROUP BY ALL) GROUP BY segment
    """,
    ["user_daily"],
)
def percentile_of_totals(spark, folder):
    return reports.lifetime_value(daily(spark, folder)).select("segment", "median_customer_value")
