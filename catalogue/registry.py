"""Registry of queries and of the common table expressions their SQL twins share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

def half_up(expression: str, digits: int = 2) -> str:
    """SQL that rounds half up as Spark does, on decimals; DuckDB rounds doubles in binary."""
    return f"CAST(round(CAST({expression} AS DECIMAL(38, 8)), {digits}) AS DOUBLE)"


CLICKS = "count(*) FILTER (WHERE e.event_type = 'click')"
CARTS = "count(*) FILTER (WHERE e.event_type = 'add_to_cart')"
SOLD = "coalesce(max(t.times), 0)"

# Name -> (names it reads, SQL).
TABLES: dict[str, tuple[tuple[str, ...], str]] = {
    "user_events": (
        (),
        """
        SELECT event_id, user_id, kind AS event_type,
               CASE WHEN kind IN ('click', 'add_to_cart', 'purchase')
                    THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS product_id,
               ts AS "timestamp",
               CASE WHEN kind = 'purchase' THEN value END AS revenue
        FROM (SELECT *, CASE event_type WHEN 'view' THEN 'page_view' WHEN 'signup' THEN 'add_to_cart'
                                        WHEN 'error' THEN 'search' ELSE event_type END AS kind
              FROM events)
        """,
    ),
    "user_profiles": (
        (),
        """
        SELECT c_custkey AS user_id, c_name AS name,
               'user' || CAST(c_custkey AS VARCHAR) || '@example.com' AS email,
               CAST(18 + c_custkey % 48 AS INTEGER) AS age,
               c_mktsegment AS segment, n_name AS country, signup_date
        FROM customer
        LEFT JOIN nation ON n_nationkey = c_nationkey
        LEFT JOIN (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS signup_date FROM orders GROUP BY 1)
               ON o_custkey = c_custkey
        """,
    ),
    "products": (
        (),
        "SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_retailprice AS price FROM part",
    ),
    "transactions": (
        (),
        """
        SELECT l_orderkey AS order_id, l_linenumber AS line, o_custkey AS user_id, l_partkey AS product_id,
               l_quantity AS quantity, l_extendedprice AS total_amount,
               CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'cancelled' END AS status
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey
        """,
    ),
    "daily_metrics": (
        ("user_events",),
        """
        SELECT user_id, CAST("timestamp" AS DATE) AS "date", count(*) AS total_events,
               count(DISTINCT event_type) AS unique_event_types,
               count(*) FILTER (WHERE event_type = 'page_view') AS page_views,
               count(*) FILTER (WHERE event_type = 'click') AS clicks,
               count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
               sum(CASE WHEN event_type = 'purchase' THEN revenue ELSE 0 END) AS total_revenue,
               min("timestamp") AS first_event_time, max("timestamp") AS last_event_time,
               CAST(floor(epoch(max("timestamp"))) - floor(epoch(min("timestamp"))) AS BIGINT) / 60.0
                   AS session_duration_minutes
        FROM user_events GROUP BY ALL
        """,
    ),
    "user_daily": (
        ("daily_metrics", "user_profiles"),
        """
        SELECT m.*, p.name, p.email, p.segment, p.country, p.signup_date,
               CAST(date_diff('day', p.signup_date, m."date") AS INTEGER) AS days_since_signup,
               page_views + 2 * clicks + 10 * purchases AS engagement_score
        FROM daily_metrics m LEFT JOIN user_profiles p ON p.user_id = m.user_id
        """,
    ),
    "product_performance": (
        ("user_events", "products", "transactions"),
        f"""
        SELECT p.product_id, p.product_name, p.category, p.price,
               count(DISTINCT e.user_id) AS unique_viewers,
               count(*) FILTER (WHERE e.event_type = 'click') AS clicks,
               count(*) FILTER (WHERE e.event_type = 'add_to_cart') AS add_to_carts,
               count(*) FILTER (WHERE e.event_type = 'purchase') AS purchases_from_events,
               coalesce(max(t.sold), 0) AS total_quantity_sold,
               coalesce(max(t.paid), 0) AS total_revenue,
               coalesce(max(t.times), 0) AS transaction_count,
               CASE WHEN {CLICKS} > 0 THEN {half_up(f'{CARTS} * 100::DOUBLE / {CLICKS}')} ELSE 0 END AS click_to_cart_rate,
               CASE WHEN {CARTS} > 0 THEN {half_up(f'{SOLD} * 100::DOUBLE / {CARTS}')} ELSE 0 END AS cart_to_purchase_rate,
               CASE WHEN max(t.sold) > 0 THEN {half_up('max(t.paid) / max(t.sold)')} ELSE 0 END AS avg_revenue_per_unit
        FROM products p
        LEFT JOIN user_events e ON e.product_id = p.product_id
        LEFT JOIN (SELECT product_id, sum(quantity) AS sold, sum(total_amount) AS paid, count(*) AS times
                   FROM transactions WHERE status = 'completed' GROUP BY product_id) t
               ON t.product_id = p.product_id
        GROUP BY p.product_id, p.product_name, p.category, p.price
        """,
    ),
    "per_user": (
        ("user_events", "user_profiles", "transactions"),
        """
        SELECT p.user_id, p.name, p.segment, p.country, p.age,
               coalesce(a.total_events, 0) AS total_events, coalesce(a.active_days, 0) AS active_days,
               coalesce(a.purchase_count, 0) AS purchase_count, coalesce(a.spent, 0) AS total_spent_events,
               coalesce(t.times, 0) AS transaction_count, coalesce(t.paid, 0) AS transaction_revenue,
               coalesce(t.mean, 0) AS avg_transaction_value
        FROM user_profiles p
        LEFT JOIN (SELECT user_id, count(*) AS total_events, count(DISTINCT CAST("timestamp" AS DATE)) AS active_days,
                          count(*) FILTER (WHERE event_type = 'purchase') AS purchase_count,
                          sum(CASE WHEN event_type = 'purchase' THEN revenue ELSE 0 END) AS spent
                   FROM user_events GROUP BY user_id) a ON a.user_id = p.user_id
        LEFT JOIN (SELECT user_id, count(*) AS times, sum(total_amount) AS paid, avg(total_amount) AS mean
                   FROM transactions WHERE status = 'completed' GROUP BY user_id) t ON t.user_id = p.user_id
        """,
    ),
    "segment_performance": (
        ("per_user",),
        f'''
        SELECT segment, count(DISTINCT user_id) AS total_users,
               CAST(sum(total_events) AS BIGINT) AS total_events, avg(total_events) AS avg_events_per_user,
               CAST(sum(active_days) AS BIGINT) AS total_active_days, avg(active_days) AS avg_active_days_per_user,
               CAST(sum(purchase_count) AS BIGINT) AS total_purchases, avg(purchase_count) AS avg_purchases_per_user,
               sum(transaction_revenue) AS total_revenue, avg(transaction_revenue) AS avg_revenue_per_user,
               avg(avg_transaction_value) AS avg_transaction_value,
               {half_up("""avg(total_events) * 0.3::DOUBLE + avg(purchase_count) * 0.4::DOUBLE
                        + avg(transaction_revenue) * 0.3::DOUBLE / 100""")} AS engagement_score
        FROM per_user GROUP BY segment
        ''',
    ),
}


def with_tables(sql: str, *names: str) -> str:
    """The query behind the common table expressions it names, in an order that resolves them."""
    found: list[str] = []

    def visit(name: str) -> None:
        needs, _ = TABLES[name]
        for other in needs:
            visit(other)
        if name not in found:
            found.append(name)

    for name in names:
        visit(name)
    if not found:
        return sql
    return "WITH " + ",\n".join(f"{name} AS ({TABLES[name][1]})" for name in found) + "\n" + sql


def query(name: str, sql: str | None = None, tables: tuple[str, ...] | list[str] = ()):
    """Registers a query; without ``sql`` it is only checked for its rows."""

    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = with_tables(sql, *tables)
        return function

    return add
