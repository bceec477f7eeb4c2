"""Sources, sample data and sinks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue.registry import query
from sluiceway import entities as e
from sluiceway import storage
from sluiceway.plans import product_performance, runner, segment_performance, user_engagement
from sluiceway.sinks import layout, merge, writer
from sluiceway.sources import inventory, synthetic
from sluiceway.sources.readers import read_source, read_sources, source_mode

ALL = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}.parquet"


@query("s1_parquet_scan", "SELECT event_id, user_id, value FROM events WHERE event_type = 'click'")
def parquet_scan(spark, folder):
    source = {"name": "events", "type": "parquet", "path": path(folder, "events"), "options": {"mergeSchema": "true"}}
    return read_source(spark, source).where("event_type = 'click'").select("event_id", "user_id", "value")


@query(
    "s2_csv_scan",
    "SELECT event_type, count(*) AS n, count(props) AS with_props, CAST(sum(user_id) AS BIGINT) AS users, "
    "round(sum(value), 2) AS total FROM events GROUP BY event_type",
)
def csv_scan(spark, folder):
    stored = storage.new_folder(spark, "csv")
    e.table(spark, folder, "events").write.option("header", True).csv(stored)
    read = read_source(spark, {"name": "events", "type": "csv", "path": stored})
    return read.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("props").alias("with_props"),
        F.sum("user_id").cast("bigint").alias("users"),
        F.round(F.sum("value"), 2).alias("total"),
    )


@query(
    "s3_json_scan",
    "SELECT o_orderstatus, count(*) AS n, max(o_orderkey) AS last_key, round(sum(o_totalprice), 2) AS total "
    "FROM orders GROUP BY o_orderstatus",
)
def json_scan(spark, folder):
    stored = storage.new_folder(spark, "json")
    e.table(spark, folder, "orders").write.json(stored)
    read = read_source(spark, {"name": "orders", "type": "json", "path": stored})
    return read.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"),
        F.max("o_orderkey").alias("last_key"),
        F.round(F.sum("o_totalprice"), 2).alias("total"),
    )


@query(
    "s6_multi_source",
    "SELECT c_mktsegment, count(*) AS n, round(sum(o_totalprice), 2) AS total "
    "FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_mktsegment",
)
def multi_source(spark, folder):
    names = ["customer", "orders"]
    frames = read_sources(spark, [{"name": n, "type": "parquet", "path": path(folder, n)} for n in names])
    joined = frames["orders"].join(frames["customer"], F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )


@query(
    "s10_batch_dimension",
    "SELECT p_type, count(*) AS n, max(p_size) AS largest FROM part GROUP BY p_type",
)
def batch_dimension(spark, folder):
    source = {"name": "products", "type": "parquet", "path": path(folder, "part")}
    assert source_mode(source) == "batch"
    return read_source(spark, source).groupBy("p_type").agg(
        F.count(F.lit(1)).alias("n"), F.max("p_size").alias("largest")
    )


@query(
    "s11_dataset_counts",
    " UNION ALL ".join(f"SELECT '{n}' AS dataset, count(*) AS rows, true AS found FROM {n}" for n in ALL)
    + " UNION ALL SELECT 'nowhere', NULL, false",
)
def dataset_counts(spark, folder):
    return inventory.dataset_counts(spark, {n: path(folder, n) for n in [*ALL, "nowhere"]})


PROFILED = {
    "customer": [
        ("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"),
        ("c_acctbal", "double"), ("c_mktsegment", "string"),
    ],
    "orders": [
        ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
        ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"), ("o_orderpriority", "string"),
    ],
}


@query(
    "s12_column_profile",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS rows, '{c}' AS column_name, '{kind}' AS data_type, "
        f"count(*) - count({c}) AS nulls, CAST(min({c}) AS VARCHAR) AS min_value, "
        f"CAST(max({c}) AS VARCHAR) AS max_value FROM {t}"
        for t, columns in PROFILED.items()
        for c, kind in columns
    ),
)
def column_profile(spark, folder):
    customer, orders = (inventory.column_profile(e.table(spark, folder, t), t) for t in PROFILED)
    return customer.unionByName(orders)


@query(
    "s12_table_overview",
    """
    SELECT 'customer' AS table_name, count(*) AS rows, 5 AS columns,
           'c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment' AS first_columns FROM customer
    UNION ALL SELECT 'orders', count(*), 6, 'o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate' FROM orders
    UNION ALL SELECT 'nation', count(*), 3, 'n_nationkey, n_name, n_regionkey' FROM nation
    """,
)
def table_overview(spark, folder):
    return inventory.table_overview({t: e.table(spark, folder, t) for t in ("customer", "orders", "nation")})


@query("s12_distinct_estimates")
def distinct_estimates(spark, folder):
    return inventory.distinct_estimates(e.table(spark, folder, "events"), "events")


EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")


@query(
    "s12_distinct_sketches",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values, true AS within_bound FROM events" for c in EVENT_COLUMNS
    ),
)
def distinct_sketches(spark, folder):
    """Sketches per day are stored, merged to those of the table, and held against exact counts."""
    events = e.table(spark, folder, "events")
    sketches = storage.stored(inventory.distinct_sketches(events, EVENT_COLUMNS, [F.to_date("ts").alias("day")]))
    estimates = inventory.merged_estimates(sketches)
    exact = events.agg(*[F.count_distinct(c).alias(c) for c in EVENT_COLUMNS])
    exact = exact.unpivot([], list(EVENT_COLUMNS), "column_name", "distinct_values")
    off = F.abs(F.col("estimate") - F.col("distinct_values"))
    within = off <= F.greatest(F.lit(1.0), F.col("distinct_values") * inventory.ERROR)
    return exact.join(estimates, "column_name").select("column_name", "distinct_values", within.alias("within_bound"))


def drawn(id: str, stream: int, n: int) -> str:
    """SQL of ``synthetic.draw``."""
    beyond = f"({id} // {synthetic.FOLD}) % {synthetic.FOLD} * {synthetic.SHIFT + stream * synthetic.STEP}"
    folded = f"(({id} % {synthetic.FOLD} + {1 + stream * synthetic.STRIDE} + {beyond}) % {synthetic.MODULUS})"
    once = f"(({folded} * {synthetic.MULTIPLIER}) % {synthetic.MODULUS})"
    return f"((({once} * {synthetic.MULTIPLIER}) % {synthetic.MODULUS}) // 1024 % {n})"


def picked(words: list[str], place: str) -> str:
    return f"([{', '.join(repr(word) for word in words)}])[CAST({place} AS INTEGER) + 1]"


def moment(seconds: str) -> str:
    return f"TIMESTAMP '{synthetic.FIRST_DAY} 00:00:00' + to_seconds({seconds})"


def _draw_of(id: str):
    return lambda stream, n: drawn(id, stream, n)


d = _draw_of("event_id")


@query(
    "s13_sample_events",
    f"""
    SELECT event_id, user_id, kind AS event_type,
           CASE WHEN kind IN ('click', 'add_to_cart', 'purchase') THEN product END AS product_id,
           happened AS "timestamp", CASE WHEN kind = 'purchase' THEN paid END AS revenue
    FROM (SELECT event_id, {d(1, 100)} + 1 AS user_id,
                 {picked(synthetic.EVENT_TYPES, d(2, 5))} AS kind, {d(5, 50)} + 1 AS product,
                 {moment(f'{d(3, 30)} * 86400 + {d(4, 86400)}')} AS happened,
                 CAST({d(6, 49001)} + 1000 AS DOUBLE) / 100 AS paid
          FROM events)
    """,
)
def sample_events(spark, folder):
    return synthetic.sample_events(e.table(spark, folder, "events").select("event_id"), "event_id")


d = _draw_of("c_custkey")
first, last = picked(synthetic.FIRST_NAMES, d(11, 10)), picked(synthetic.LAST_NAMES, d(12, 10))


@query(
    "s14_sample_profiles",
    f"""
    SELECT c_custkey AS user_id, {first} || ' ' || {last} AS name,
           lower({first}) || '.' || lower({last}) || c_custkey || '@example.com' AS email,
           {d(13, 48)} + 18 AS age, {picked(synthetic.SEGMENTS, d(14, 3))} AS segment,
           {picked(synthetic.COUNTRIES, d(15, 10))} AS country,
           strftime(DATE '{synthetic.FIRST_SIGNUP}' + CAST({d(16, 731)} AS INTEGER), '%Y-%m-%d') AS signup_date
    FROM customer
    """,
)
def sample_profiles(spark, folder):
    return synthetic.sample_profiles(e.table(spark, folder, "customer").select("c_custkey"), "c_custkey")


d = _draw_of("p_partkey")


@query(
    "s14_sample_products",
    f"""
    SELECT p_partkey AS product_id,
           {picked(synthetic.ADJECTIVES, d(22, 8))} || ' ' || {picked(synthetic.NOUNS, d(23, 8))} || ' ' || p_partkey
               AS product_name,
           {picked(synthetic.CATEGORIES, d(21, 8))} AS category,
           CAST({d(24, 99001)} + 999 AS DOUBLE) / 100 AS price, {d(25, 1001)} AS stock_quantity,
           CAST({d(26, 21)} + 30 AS DOUBLE) / 10 AS rating
    FROM part
    """,
)
def sample_products(spark, folder):
    return synthetic.sample_products(e.table(spark, folder, "part").select("p_partkey"), "p_partkey")


d = _draw_of("o_orderkey")


@query(
    "s14_sample_transactions",
    f"""
    SELECT transaction_id, user_id, product_id, quantity, CAST(cents AS DOUBLE) / 100 AS unit_price,
           CAST(cents * quantity AS DOUBLE) / 100 AS total_amount, payment_method, status, transaction_date
    FROM (SELECT o_orderkey AS transaction_id, {d(31, 100)} + 1 AS user_id, {d(32, 50)} + 1 AS product_id,
                 {d(33, 5)} + 1 AS quantity, {d(34, 99001)} + 999 AS cents,
                 {picked(synthetic.PAYMENT_METHODS, d(35, 5))} AS payment_method,
                 CASE WHEN {d(36, 100)} >= 95 THEN {picked(synthetic.STATUSES, d(37, 4))} ELSE 'completed' END AS status,
                 {moment(f'{d(38, 30)} * 86400 + {d(39, 1440)} * 60')} AS transaction_date
          FROM orders)
    """,
)
def sample_transactions(spark, folder):
    return synthetic.sample_transactions(e.table(spark, folder, "orders").select("o_orderkey"), "o_orderkey")


@query(
    "w1_partitioned_write",
    'SELECT "date", count(*) AS users, CAST(sum(total_events) AS BIGINT) AS events FROM daily_metrics GROUP BY "date"',
    ["daily_metrics"],
)
def partitioned_write(spark, folder):
    target = {"type": "parquet", "mode": "overwrite", "partition_by": ["date"]}
    target["path"] = storage.new_folder(spark, "daily")
    writer.write(user_engagement.daily_metrics(e.user_events(spark, folder)), target)
    stored = spark.read.parquet(target["path"])
    return stored.groupBy("date").agg(F.count(F.lit(1)).alias("users"), F.sum("total_events").alias("events"))


@query(
    "w1_append_write",
    "SELECT event_type, 2 * count(*) AS n, round(2 * sum(value), 2) AS total FROM events GROUP BY event_type",
)
def append_write(spark, folder):
    target = {"type": "parquet", "path": storage.new_folder(spark, "events")}
    events = e.table(spark, folder, "events").select("event_id", "event_type", "value")
    writer.write(events, {**target, "mode": "overwrite"})
    writer.write(events, {**target, "mode": "append"})
    stored = spark.read.parquet(target["path"])
    return stored.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total")
    )


MERGED = """
    SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'F' THEN 'kept' ELSE 'sent' END AS origin,
           CASE o_orderstatus WHEN 'F' THEN o_totalprice ELSE round(o_totalprice * 2, 2) END AS o_totalprice
    FROM orders
"""


def merge_sides(spark, folder):
    """Stored orders without the partly shipped ones, and newer prices of all that are not final."""
    orders = e.table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    stored = orders.where("o_orderstatus != 'P'").withColumn("origin", F.lit("kept"))
    newer = orders.where("o_orderstatus != 'F'").withColumns(
        {"o_totalprice": F.round(F.col("o_totalprice") * 2, 2), "origin": F.lit("sent")}
    )
    return stored, newer


@query("w5_merge_rows", MERGED)
def merge_rows(spark, folder):
    return merge.upsert(*merge_sides(spark, folder), ["o_orderkey"])


@query("w5_merge_folder", MERGED)
def merge_folder(spark, folder):
    stored, newer = merge_sides(spark, folder)
    target = {"type": "parquet", "path": storage.new_folder(spark, "orders"), "mode": "merge"}
    target |= {"merge_keys": ["o_orderkey", "o_orderstatus"], "partition_by": ["o_orderstatus"]}
    writer.write(stored, target)
    writer.write(newer, target)
    return spark.read.parquet(target["path"]).select("o_orderkey", "o_orderstatus", "origin", "o_totalprice")


@query(
    "w9_clustered_files",
    """
    SELECT count(*) AS rows, min(l_partkey) AS lowest, max(l_partkey) AS highest, true AS several_files, 0 AS overlapping
    FROM lineitem
    """,
)
def clustered_files(spark, folder):
    """Lines written in ranges of their part; the ranges of the written files, which may only meet at their ends."""
    lines = e.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    written = storage.new_folder(spark, "clustered")
    layout.clustered(lines, ["l_partkey", "l_orderkey"], 16).write.parquet(written)
    ranges = layout.file_ranges(spark.read.parquet(written), "l_partkey")
    return layout.overlaps(ranges).select(
        "rows", "lowest", "highest", (F.col("files") > 1).alias("several_files"), "overlapping"
    )


@query(
    "w11_csv_export",
    "SELECT segment, count(*) AS users FROM user_profiles GROUP BY segment",
    ["user_profiles"],
)
def csv_export(spark, folder):
    stored = storage.new_folder(spark, "export")
    writer.export_csv(e.user_profiles(spark, folder), stored)
    profiles = read_source(spark, {"name": "profiles", "type": "csv", "path": stored})
    return profiles.groupBy("segment").agg(F.count(F.lit(1)).alias("users"))


@query(
    "g1_run_spec",
    """
    SELECT user_id, "date", total_events, unique_event_types, page_views, clicks, purchases, first_event_time,
           last_event_time, round(session_duration_minutes, 4) AS session_duration_minutes, name, segment, signup_date,
           days_since_signup, engagement_score
    FROM user_daily WHERE total_events >= 3
    """,
    ["user_daily"],
)
def run_spec(spark, folder):
    """The whole run: read, five steps, four rules, gated write; then the target is read back."""
    target = storage.new_folder(spark, "target")
    outcome = runner.run(spark, engagement_spec(folder, target))
    assert outcome.status == "success", outcome.error
    minutes = F.round("session_duration_minutes", 4)
    return spark.read.parquet(target).withColumn("session_duration_minutes", minutes)


@query(
    "s7_source_rows",
    " UNION ALL ".join(f"SELECT '{t}' AS source, count(*) AS rows FROM {t}" for t in ("events", "customer", "nation", "orders")),
)
def source_rows(spark, folder):
    """Rows read of each source, counted by the one job that writes the result."""
    spec = engagement_spec(folder, storage.new_folder(spark, "target"))
    outcome = runner.run(spark, {**spec, "count_sources": True})
    assert outcome.status == "success", outcome.error
    return spark.createDataFrame(list(outcome.metrics["source_rows"].items()), "source string, rows bigint")


def engagement_spec(folder, target):
    """The engagement spec over the tables, with two steps in front that make its sources of them."""
    none = {"type": "parquet", "path": "made by a step"}
    spec = user_engagement.spec(none, none, target)
    names = ["events", "customer", "nation", "orders"]
    made = [
        adapter("events", "as_user_events", ["events"]),
        adapter("user_profiles", "as_user_profiles", ["customer", "nation", "orders"]),
        {
            "name": "profile_columns",
            "type": "sql",
            "inputs": ["user_profiles"],
            "output": "user_profiles",
            "sql": "SELECT user_id, name, segment, signup_date FROM user_profiles",
        },
    ]
    sources = [
        {"name": name, "type": "parquet", "path": path(folder, name), "schema": e.SCHEMAS[name]} for name in names
    ]
    return {**spec, "sources": sources, "transformations": [*made, *spec["transformations"]]}


def made_spec(spec, folder):
    """A spec with steps in front that make its named sources of the tables."""
    inputs = {
        "events": ["events"], "products": ["part"], "transactions": ["lineitem", "orders"],
        "user_profiles": ["customer", "nation", "orders"],
    }
    functions = {"events": "as_user_events"}
    wanted = [source["name"] for source in spec["sources"]]
    tables = list(dict.fromkeys(table for name in wanted for table in inputs[name]))
    made = [adapter(name, functions.get(name, f"as_{name}"), inputs[name]) for name in wanted]
    sources = [{"name": t, "type": "parquet", "path": path(folder, t), "schema": e.SCHEMAS[t]} for t in tables]
    return {**spec, "sources": sources, "transformations": [*made, *spec["transformations"]]}


def performance_specs(folder, target):
    none = {"type": "parquet", "path": "made by a step"}
    return {
        plan.__name__.rpartition(".")[2]: made_spec(plan.spec(none, none, none, f"{target}/{n}"), folder)
        for n, plan in enumerate((product_performance, segment_performance))
    }


def run_performance(spark, folder, name):
    spec = performance_specs(folder, storage.new_folder(spark, "target"))[name]
    outcome = runner.run(spark, spec)
    assert outcome.status == "success", outcome.error
    return spark.read.parquet(spec["target"]["path"])


@query(
    "g2_run_product_spec",
    "SELECT * REPLACE (round(total_revenue, 2) AS total_revenue) FROM product_performance",
    ["product_performance"],
)
def run_product_spec(spark, folder):
    found = run_performance(spark, folder, "product_performance")
    return found.withColumn("total_revenue", F.round("total_revenue", 2))


@query(
    "g3_run_segment_spec",
    "SELECT * REPLACE (round(total_revenue, 2) AS total_revenue, round(avg_revenue_per_user, 6) AS avg_revenue_per_user, "
    "round(avg_transaction_value, 6) AS avg_transaction_value) FROM segment_performance",
    ["segment_performance"],
)
def run_segment_spec(spark, folder):
    digits = {"total_revenue": 2, "avg_revenue_per_user": 6, "avg_transaction_value": 6}
    found = run_performance(spark, folder, "segment_performance")
    return found.withColumns({name: F.round(name, n) for name, n in digits.items()})


def daily_spec(folder, target):
    none = {"type": "parquet", "path": "made by a step"}
    return made_spec(user_engagement.daily_spec(none, none, target), folder)


@query(
    "e2_run_daily_spec",
    "SELECT * REPLACE (round(total_revenue, 2) AS total_revenue, "
    "round(session_duration_minutes, 4) AS session_duration_minutes) FROM user_daily",
    ["user_daily"],
)
def run_daily_spec(spark, folder):
    spec = daily_spec(folder, storage.new_folder(spark, "target"))
    outcome = runner.run(spark, spec)
    assert outcome.status == "success", outcome.error
    digits = {"total_revenue": 2, "session_duration_minutes": 4}
    return spark.read.parquet(spec["target"]["path"]).withColumns({name: F.round(name, n) for name, n in digits.items()})


@query(
    "g2_run_all_specs",
    """
    SELECT 'user_daily' AS name, 'success' AS status, (SELECT count(*) FROM user_daily) AS rows
    UNION ALL SELECT 'product_performance', 'success', (SELECT count(*) FROM product_performance)
    UNION ALL SELECT 'segment_performance', 'success', (SELECT count(*) FROM segment_performance)
    """,
    ["user_daily", "product_performance", "segment_performance"],
)
def run_all_specs(spark, folder):
    """The three specs, one after the other, and what became of each; rows are those its target holds."""
    target = storage.new_folder(spark, "targets")
    specs = {"user_daily": daily_spec(folder, f"{target}/daily"), **performance_specs(folder, target)}
    outcomes, counts = runner.run_many(spark, list(specs.values()))
    assert counts == {"total": 3, "succeeded": 3, "failed": 0}, [o.error for o in outcomes]
    found = [
        spark.read.parquet(spec["target"]["path"])
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(F.lit(name).alias("name"), F.lit(outcome.status).alias("status"), "rows")
        for (name, spec), outcome in zip(specs.items(), outcomes)
    ]
    return reduce(DataFrame.unionByName, found)


def adapter(output, function, inputs):
    function = f"sluiceway.entities.{function}"
    return {"name": output, "type": "python", "inputs": inputs, "output": output, "function": function}
