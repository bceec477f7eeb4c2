"""Business entities read from the star-schema test tables.

``user_events``, ``user_profiles``, ``products`` and ``transactions`` are what the plans work on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Event names of the tables and the names the plans know them by.
EVENT_NAMES = {
    "view": "page_view",
    "signup": "add_to_cart",
    "error": "search",
    "click": "click",
    "purchase": "purchase",
}

# The events, by their name in the tables, that carry a product.
PRODUCT_EVENTS = ["click", "signup", "purchase"]

# Order status letters and the names of the transaction states.
STATUS_NAMES = {"F": "completed", "O": "pending"}

# Columns of the tables. A known schema saves reading a footer each time a plan is built.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def as_user_events(events: DataFrame) -> DataFrame:
    """Events in business terms; works the same on a batch or a streaming frame."""
    kind = F.col("event_type")
    renamed = kind
    for old, new in EVENT_NAMES.items():
        if old != new:
            renamed = F.when(kind == old, new).otherwise(renamed)
    product = F.get_json_object("props", "$.k").cast("bigint")
    return events.select(
        "event_id",
        "user_id",
        renamed.alias("event_type"),
        F.when(kind.isin(PRODUCT_EVENTS), product).alias("product_id"),
        F.col("ts").alias("timestamp"),
        F.when(kind == "purchase", F.col("value")).alias("revenue"),
    )


def user_events(spark: SparkSession, folder: str) -> DataFrame:
    return as_user_events(table(spark, folder, "events"))


def as_user_profiles(customer: DataFrame, nation: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per customer; the day of the first order stands for the sign-up day."""
    signups = orders.groupBy(F.col("o_custkey").alias("user_id")).agg(
        F.min(F.to_date("o_orderdate")).alias("signup_date")
    )
    countries = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"))
    key = F.col("c_custkey")
    users = customer.join(countries, "c_nationkey", "left").select(
        key.alias("user_id"),
        F.col("c_name").alias("name"),
        F.concat(F.lit("user"), key.cast("string"), F.lit("@example.com")).alias("email"),
        (F.lit(18) + F.pmod(key, F.lit(48))).cast("int").alias("age"),
        F.col("c_mktsegment").alias("segment"),
        "country",
    )
    return users.join(signups, "user_id", "left")


def user_profiles(spark: SparkSession, folder: str) -> DataFrame:
    return as_user_profiles(*(table(spark, folder, name) for name in ("customer", "nation", "orders")))


def as_products(part: DataFrame) -> DataFrame:
    return part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("price"),
    )


def products(spark: SparkSession, folder: str) -> DataFrame:
    return as_products(table(spark, folder, "part"))


def as_transactions(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per line, with buyer and status of its order."""
    status = F.col("o_orderstatus")
    named = F.when(status == "F", STATUS_NAMES["F"]).when(status == "O", STATUS_NAMES["O"]).otherwise("cancelled")
    buyers = orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user_id"), named.alias("status"))
    lines = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice")
    return lines.join(buyers, "l_orderkey").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line"),
        "user_id",
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("total_amount"),
        "status",
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    return as_transactions(table(spark, folder, "lineitem"), table(spark, folder, "orders"))
