"""Structured Streaming queries: each runs its stream over the whole table and reads the sink back."""

from __future__ import annotations

from math import ceil

from pyspark.sql import functions as F

from catalogue.registry import query
from catalogue.scans import adapter, path
from sluiceway import entities as e
from sluiceway import storage
from sluiceway.plans import user_engagement
from sluiceway.quality.expectations import keep_valid
from sluiceway.sources.readers import read_stream
from sluiceway.streaming import engagement, late, runner, sinks
from sluiceway.streaming.snapshots import Snapshots

SECONDS = None
#: Micro-batches that a table is dealt over, and rows of a file; a batch has one file until it has more rows than that.
BATCHES, FILE_ROWS = 6, 1_000_000


def stream(spark, folder, name):
    return read_stream(spark, {"name": name, "type": "parquet", "path": path(folder, name)})


def in_files(spark, folder, name, time):
    """Source of a table whose days come in files of no order, as many a trigger as make it ``BATCHES`` triggers.

    Days are dealt over batches, each whole in one file or, above ``FILE_ROWS`` rows a batch, over its several files
    by a hash of the row. One task writes one file, without a sort, so no task grows with the table.
    """
    rows = e.table(spark, folder, name)
    files = max(1, ceil(rows.count() / (BATCHES * FILE_ROWS)))
    batch = F.pmod(F.xxhash64(F.to_date(time)), F.lit(BATCHES))
    file = batch * files + F.pmod(F.xxhash64(*rows.columns), F.lit(files))
    dealt = storage.new_folder(spark, f"files-{name}")
    rows.repartitionById(BATCHES * files, file.cast("int")).write.parquet(dealt)
    return {"name": name, "type": "parquet", "path": dealt, "schema": rows.schema, "options": {"maxFilesPerTrigger": str(files)}}


def dealt(spark, folder, name, time):
    """Stream over the files of a table, in several micro-batches."""
    return read_stream(spark, in_files(spark, folder, name, time))


def target_in(spark, folder, **settings):
    return sinks.StreamTarget(
        path=f"{folder}/table", checkpoint=f"{folder}/checkpoint", state_partitions=spark.sparkContext.defaultParallelism, **settings
    )


def run(frame, spark, **settings):
    """Runs a stream into a new folder and reads that back."""
    target = target_in(spark, storage.new_folder(spark, "stream"), **settings)
    sinks.run(frame, target, SECONDS)
    return sinks.read(spark, target, frame.schema)


def snapshot(spark, name, frame):
    """A dimension, computed once for all micro-batches."""
    return Snapshots(spark, storage.new_folder(spark, "snapshots")).take(name, frame)


@query("r1_stream_ingest", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def ingest(spark, folder):
    return run(stream(spark, folder, "events"), spark)


DAILY = """
    SELECT user_id, "date", total_events, unique_event_types, page_views, clicks, purchases,
           round(total_revenue, 2) AS total_revenue, first_event_time, last_event_time,
           round(session_duration_minutes, 4) AS session_duration_minutes
    FROM daily_metrics
"""


def daily_stream(spark, folder):
    events = e.as_user_events(dealt(spark, folder, "events", "ts"))
    return user_engagement.daily_metrics(events, revenue=True)


def rounded(df):
    digits = {"total_revenue": 2, "session_duration_minutes": 4}
    return df.withColumns({name: F.round(name, n) for name, n in digits.items()})


UPDATE = {"output_mode": "update", "keys": ("user_id", "date"), "partition_by": ("date",)}


@query("r4_stateful_daily_metrics", DAILY, ["daily_metrics"])
def stateful(spark, folder):
    return rounded(run(daily_stream(spark, folder), spark, **UPDATE))


@query(
    "r5_approx_distinct",
    'SELECT user_id, "date", unique_event_types FROM daily_metrics',
    ["daily_metrics"],
)
def approx(spark, folder):
    types = daily_stream(spark, folder).select("user_id", "date", "unique_event_types")
    return run(types, spark, **UPDATE)


@query(
    "r6_stream_projection",
    """
    SELECT event_id, user_id, CAST("timestamp" AS DATE) AS "date", coalesce(revenue, 0) AS revenue
    FROM user_events WHERE event_type <> 'search'
    """,
    ["user_events"],
)
def projection(spark, folder):
    events = e.as_user_events(stream(spark, folder, "events")).where("event_type != 'search'")
    wanted = events.select(
        "event_id", "user_id", F.to_date("timestamp").alias("date"), F.coalesce("revenue", F.lit(0.0)).alias("revenue")
    )
    return run(wanted, spark)


@query(
    "r7_stream_static_join",
    """
    SELECT event_id, user_id, event_type, segment, country
    FROM user_events LEFT JOIN user_profiles USING (user_id)
    """,
    ["user_events", "user_profiles"],
)
def static_join(spark, folder):
    events = e.as_user_events(dealt(spark, folder, "events", "ts")).select("event_id", "user_id", "event_type")
    profiles = snapshot(spark, "profiles", e.user_profiles(spark, folder).select("user_id", "segment", "country"))
    return run(events.join(profiles, "user_id", "left"), spark)


@query(
    "r8_final_view",
    """
    SELECT user_id, "date", total_events, engagement_score FROM user_daily
    WHERE user_id IS NOT NULL AND total_events >= 2 AND engagement_score BETWEEN 0 AND 20
    """,
    ["user_daily"],
)
def view(spark, folder):
    profiles = snapshot(spark, "profiles", e.user_profiles(spark, folder))
    enriched = user_engagement.enrich(daily_stream(spark, folder), profiles)
    stored = run(enriched.select("user_id", "date", "total_events", "engagement_score"), spark, **UPDATE)
    rules = [
        {"name": "user", "type": "null_check", "column": "user_id"},
        {"name": "events", "type": "range_check", "column": "total_events", "min_value": 2},
        {"name": "score", "type": "range_check", "column": "engagement_score", "min_value": 0, "max_value": 20},
    ]
    return keep_valid(stored, rules)


@query(
    "r9_closed_windows",
    """
    SELECT user_id, CAST("timestamp" AS DATE) AS "date", count(*) AS total_events,
           count(*) FILTER (WHERE event_type = 'purchase') AS purchases
    FROM user_events
    WHERE CAST("timestamp" AS DATE) + INTERVAL 1 DAY
          <= (SELECT max(date_trunc('milliseconds', "timestamp")) FROM user_events) - INTERVAL 1 HOUR
    GROUP BY ALL
    """,
    ["user_events"],
)
def closed_windows(spark, folder):
    """Windows the watermark has closed, over files in no order; the last, open day is still in the state."""
    events = e.as_user_events(dealt(spark, folder, "events", "ts")).select("user_id", "event_type", "timestamp")
    folder = storage.new_folder(spark, "windows")
    split = late.Split(spark, f"{folder}/events", "timestamp", "1 hour", engagement.window_end())
    closed = late.run([(split, events)], engagement.windowed_metrics, target_in(spark, folder), SECONDS)
    return engagement.settled_windows(closed, split)


@query(
    "r14_stream_stream_join",
    """
    SELECT o_orderkey, o_custkey, o_orderdate, l_linenumber, l_partkey, l_suppkey, l_quantity, l_shipdate
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    WHERE l_shipdate BETWEEN o_orderdate AND o_orderdate + INTERVAL 365 DAY
    """,
)
def stream_join(spark, folder):
    """Both tables come in files of no order. Orders are unique by key, so each line has at most one match.

    State holds a year of either table, so it is kept on disk.
    """
    orders = dealt(spark, folder, "orders", "o_orderdate").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = dealt(spark, folder, "lineitem", "l_shipdate").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"
    )
    folder = storage.new_folder(spark, "joined")
    one = late.Split(spark, f"{folder}/orders", "o_orderdate", "1 day")
    many = late.Split(spark, f"{folder}/lines", "l_shipdate", "1 day")
    match = ("o_orderkey", "o_orderdate", "l_shipdate", "365 DAYS")
    stored = late.run(
        [(one, orders), (many, lines)],
        lambda a, b: engagement.join_in_range(a, b, *match, "1 day"),
        target_in(spark, folder, rocksdb=True),
        SECONDS,
    )
    stored = engagement.settled_join(stored, one, many, *match)
    times = {name: F.col(name).cast("timestamp_ntz") for name in ("o_orderdate", "l_shipdate")}
    return stored.withColumns(times)


@query(
    "e6_streaming_user_engagement",
    "SELECT * REPLACE (round(total_revenue, 2) AS total_revenue, "
    "round(session_duration_minutes, 4) AS session_duration_minutes) FROM user_daily",
    ["user_daily"],
)
def streaming_engagement(spark, folder):
    """The spec as streaming tables with a batch view: the last step runs over the stored table."""
    batch = [
        {"name": name, "type": "parquet", "path": path(folder, name), "mode": "batch"}
        for name in ("customer", "nation", "orders")
    ]
    profiles = adapter("user_profiles", "as_user_profiles", [source["name"] for source in batch])
    spec = {
        "pipeline": {"name": "streaming_user_engagement"},
        "sources": [in_files(spark, folder, "events", "ts"), *batch],
        "transformations": [adapter("events", "as_user_events", ["events"]), profiles, *user_engagement.SQL_STEPS],
        "streaming": {
            "keys": ["user_id", "date"],
            "partition_by": ["date"],
            "state_partitions": spark.sparkContext.defaultParallelism,
        },
        "validation": {"rules": user_engagement.RULES},
    }
    return rounded(runner.run(spark, spec, seconds=SECONDS).view)
