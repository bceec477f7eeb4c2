"""Window functions, sorting and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import query
from sluiceway import entities as e
from sluiceway.operators import aggregates, ranking


@query(
    "n1_row_number",
    "SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS event_rank "
    "FROM events",
)
def row_number(spark, folder):
    events = e.table(spark, folder, "events").select("event_id", "user_id", "ts")
    return ranking.number_newest_first(events, ["user_id"], "ts", "event_id").drop("ts")


@query(
    "n1_row_number_ranges",
    "SELECT l_orderkey, l_partkey, l_suppkey, l_returnflag, row_number() OVER (PARTITION BY l_returnflag "
    "ORDER BY l_extendedprice DESC, l_orderkey DESC, l_partkey DESC, l_suppkey DESC) AS place "
    "FROM lineitem",
)
def row_number_ranges(spark, folder):
    """Three keys hold all rows, so each is numbered range by range."""
    lines = e.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_extendedprice"
    )
    tied = lines.withColumn("tie", F.struct("l_orderkey", "l_partkey", "l_suppkey"))
    found = ranking.number_newest_first(
        tied, ["l_returnflag"], "l_extendedprice", "tie", "place", rows_per_task=10_000
    )
    return found.drop("tie", "l_extendedprice")


@query(
    "n2_latest",
    """
    SELECT user_id, event_type, event_id, ts, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1
    """,
)
def latest(spark, folder):
    events = e.table(spark, folder, "events").drop("props")
    return ranking.latest(events, ["user_id", "event_type"], [F.desc("ts"), F.desc("event_id")])


@query(
    "n3_window_over_aggregate",
    """
    SELECT p_type, round(sum(p_retailprice), 2) AS price, round(sum(sum(p_retailprice)) OVER (), 2) AS total
    FROM part GROUP BY p_type
    """,
)
def window_over_aggregate(spark, folder):
    sums = e.table(spark, folder, "part").groupBy("p_type").agg(F.sum("p_retailprice").alias("price"))
    found = aggregates.with_column_total(sums, "price", "total")
    return found.withColumns({"price": F.round("price", 2), "total": F.round("total", 2)})


@query(
    "t1_sort",
    """
    SELECT user_id, "date", total_events, clicks FROM daily_metrics ORDER BY "date" DESC, total_events DESC, user_id
    """,
    ["daily_metrics"],
)
def sort(spark, folder):
    from sluiceway.plans.user_engagement import daily_metrics

    wanted = daily_metrics(e.user_events(spark, folder)).select("user_id", "date", "total_events", "clicks")
    return wanted.orderBy(F.desc("date"), F.desc("total_events"), "user_id")


@query(
    "t2_top_k",
    """
    SELECT o_custkey, round(sum(o_totalprice), 2) AS paid FROM orders GROUP BY o_custkey
    ORDER BY paid DESC, o_custkey LIMIT 10
    """,
)
def top_k(spark, folder):
    sums = e.table(spark, folder, "orders").groupBy("o_custkey").agg(F.round(F.sum("o_totalprice"), 2).alias("paid"))
    return ranking.top(sums, 10, F.desc("paid"), F.asc("o_custkey"))


@query("t3_limit_rows", "SELECT least(5, count(*)) AS rows, least(5, count(*)) AS known, 5 AS asked FROM orders")
def limit_rows(spark, folder):
    """What holds of any five rows: their number, and that the table has them."""
    orders = e.table(spark, folder, "orders")
    five = orders.limit(5).select("o_orderkey", "o_totalprice")
    known = five.join(orders.select("o_orderkey", "o_totalprice"), ["o_orderkey", "o_totalprice"], "left_semi")
    counts = five.select(F.lit(1).alias("rows"), F.lit(0).alias("known"))
    counts = counts.unionByName(known.select(F.lit(0).alias("rows"), F.lit(1).alias("known")))
    return counts.agg(F.sum("rows").alias("rows"), F.sum("known").alias("known")).withColumn("asked", F.lit(5))


@query("t3_limit")
def limit(spark, folder):
    return e.table(spark, folder, "orders").limit(5)
