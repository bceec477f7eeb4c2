import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sluiceway.errors import SinkError, SpecError
from sluiceway.plans import user_engagement
from sluiceway.plans.steps import apply_step
from sluiceway.sources.readers import read_stream
from sluiceway.streaming import engagement, runner, sinks

SCHEMA = "user_id int, event_type string, timestamp timestamp"
SECONDS = 120


def put(spark, folder, rows):
    frame = spark.createDataFrame(rows, "user_id int, event_type string, timestamp string")
    frame.withColumn("timestamp", F.col("timestamp").cast("timestamp")).coalesce(1).write.mode("append").parquet(str(folder))


def events(spark, folder):
    return read_stream(spark, {"name": "events", "type": "parquet", "path": str(folder), "schema": SCHEMA})


FIRST = [(1, "click", "2024-01-01 10:00:00"), (1, "page_view", "2024-01-01 11:00:00"), (2, "click", "2024-01-01 10:00:00")]
SECOND = [(1, "purchase", "2024-01-01 12:00:00"), (1, "click", "2024-01-02 09:00:00")]


def update_target(tmp_path, **rest):
    settings = {"output_mode": "update", "keys": ("user_id", "date"), "partition_by": ("date",)}
    return sinks.StreamTarget(path=f"{tmp_path}/table", checkpoint=f"{tmp_path}/checkpoint", **{**settings, **rest})


def stored(spark, target):
    found = sinks.read(spark, target).select("user_id", F.col("date").cast("string"), "total_events", "purchases")
    return {tuple(row) for row in found.collect()}


AFTER_FIRST = {(1, "2024-01-01", 2, 0), (2, "2024-01-01", 1, 0)}
AFTER_SECOND = {(1, "2024-01-01", 3, 1), (2, "2024-01-01", 1, 0), (1, "2024-01-02", 1, 0)}


@pytest.mark.parametrize("partition_by", [("date",), ()])
def test_incremental_runs_read_only_new_files(spark, tmp_path, partition_by):
    put(spark, tmp_path / "in", FIRST)
    target = update_target(tmp_path, partition_by=partition_by)
    sinks.run(user_engagement.daily_metrics(events(spark, tmp_path / "in")), target, SECONDS)
    assert stored(spark, target) == AFTER_FIRST
    put(spark, tmp_path / "in", SECOND)
    query = sinks.start(user_engagement.daily_metrics(events(spark, tmp_path / "in")), target)
    sinks.finish(query, SECONDS)
    assert sum(progress["numInputRows"] for progress in query.recentProgress) == 2
    assert stored(spark, target) == AFTER_SECOND


def test_state_partitions_are_those_of_the_target(spark, tmp_path):
    put(spark, tmp_path / "in", FIRST)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    target = update_target(tmp_path, state_partitions=3)
    query = sinks.start(user_engagement.daily_metrics(events(spark, tmp_path / "in")), target)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    sinks.finish(query, SECONDS)
    assert query.lastProgress["stateOperators"][0]["numShufflePartitions"] == 3
    assert stored(spark, target) == AFTER_FIRST


def test_full_refresh_starts_over(spark, tmp_path):
    put(spark, tmp_path / "in", FIRST)
    target = update_target(tmp_path)
    stream = user_engagement.daily_metrics(events(spark, tmp_path / "in"))
    sinks.run(stream, target, SECONDS)
    put(spark, tmp_path / "in", SECOND)
    sinks.refresh(stream, target, SECONDS)
    assert stored(spark, target) == AFTER_SECOND


def test_a_batch_delivered_again_changes_nothing(spark, tmp_path):
    put(spark, tmp_path / "in", FIRST)
    target = update_target(tmp_path)
    batch = user_engagement.daily_metrics(spark.read.parquet(f"{tmp_path}/in"))
    for _ in range(2):
        sinks._upsert_into(target)(batch, 0)
    assert stored(spark, target) == AFTER_FIRST


def test_continuous_run(spark, tmp_path):
    put(spark, tmp_path / "in", FIRST)
    target = update_target(tmp_path, continuous=True, interval="100 milliseconds")
    query = sinks.start(user_engagement.daily_metrics(events(spark, tmp_path / "in")), target)
    try:
        query.processAllAvailable()
        assert query.isActive
        put(spark, tmp_path / "in", SECOND)
        query.processAllAvailable()
    finally:
        query.stop()
    assert stored(spark, target) == AFTER_SECOND


def test_distinct_counts_are_approximate_on_streams_only(spark, tmp_path):
    put(spark, tmp_path / "in", FIRST)
    stream, batch = events(spark, tmp_path / "in"), spark.read.parquet(f"{tmp_path}/in")
    assert "approx_count_distinct" in user_engagement.daily_metrics(stream)._jdf.queryExecution().analyzed().toString()
    assert "approx_count_distinct" not in user_engagement.daily_metrics(batch)._jdf.queryExecution().analyzed().toString()
    for name, approximate in [("stream", True), ("batch", False)]:
        text = f"SELECT count(DISTINCT event_type) AS n FROM {name}"
        step = {"name": "s", "type": "sql", "inputs": [name], "output": "o", "sql": text}
        step["streaming_sql"] = text.replace("count(DISTINCT event_type)", "approx_count_distinct(event_type)")
        plan = apply_step(spark, {"stream": stream, "batch": batch}, step)._jdf.queryExecution().analyzed().toString()
        assert ("approx_count_distinct" in plan) == approximate


def test_append_mode_gives_closed_windows_only(spark, tmp_path):
    put(spark, tmp_path / "in", FIRST + SECOND)
    target = sinks.StreamTarget(path=f"{tmp_path}/table", checkpoint=f"{tmp_path}/checkpoint")
    sinks.run(engagement.windowed_metrics(events(spark, tmp_path / "in")), target, SECONDS)
    assert stored(spark, target) == {(1, "2024-01-01", 3, 1), (2, "2024-01-01", 1, 0)}


LATE = [(2, "click", "2024-01-05 09:00:00")], [(2, "click", "2024-01-09 09:00:00")], [(1, "click", "2024-01-01 09:00:00")]


@pytest.mark.parametrize("delay, late", [("1 hour", True), ("10 days", False)])
def test_late_rows_of_later_batches_are_reported(spark, tmp_path, delay, late):
    for n, rows in enumerate(LATE):
        put(spark, tmp_path / "in", rows)
        for file in (tmp_path / "in").glob("part-*.parquet"):
            if not file.name.startswith("part-batch"):
                moved = file.rename(file.with_name(f"part-batch{n}.parquet"))
                os.utime(moved, (1_700_000_000 + n, 1_700_000_000 + n))
    source = {"name": "events", "type": "parquet", "path": str(tmp_path / "in"), "schema": SCHEMA, "options": {"maxFilesPerTrigger": 1}}

    def run(name, **settings):
        target = sinks.StreamTarget(path=f"{tmp_path}/{name}", checkpoint=f"{tmp_path}/{name}-checkpoint", **settings)
        return sinks.run(engagement.windowed_metrics(read_stream(spark, source), delay=delay), target, SECONDS)

    if late:
        with pytest.raises(SinkError, match="1 rows"):
            run("strict")
    assert run("allowed", drop_late=True) == int(late)


def test_append_mode_without_watermark_is_rejected(spark, tmp_path):
    put(spark, tmp_path / "in", FIRST)
    target = sinks.StreamTarget(path=f"{tmp_path}/table", checkpoint=f"{tmp_path}/checkpoint")
    with pytest.raises(AnalysisException):
        sinks.run(user_engagement.daily_metrics(events(spark, tmp_path / "in")), target, SECONDS)


@pytest.mark.parametrize("salts", [1, 5])
def test_stream_join_equals_batch_join(spark, tmp_path, salts):
    orders = spark.sql("SELECT id AS k, timestamp'2024-01-01' + make_dt_interval(0, id) AS ordered FROM range(20)")
    shipped = "timestamp'2024-01-01' + make_dt_interval(0, CAST(id % 30 AS int)) AS shipped"
    lines = spark.sql(f"SELECT if(id % 3 = 0, 7, id % 25) AS k, id AS line, {shipped} FROM range(90)")
    orders.write.parquet(f"{tmp_path}/orders")
    lines.write.parquet(f"{tmp_path}/lines")

    def joined(read):
        return engagement.join_in_range(
            read("orders", orders.schema), read("lines", lines.schema), "k", "ordered", "shipped", "6 HOURS", salts=salts
        )

    batch = joined(lambda name, schema: spark.read.schema(schema).parquet(f"{tmp_path}/{name}"))
    stream = joined(lambda name, schema: spark.readStream.schema(schema).parquet(f"{tmp_path}/{name}"))
    target = sinks.StreamTarget(path=f"{tmp_path}/table", checkpoint=f"{tmp_path}/checkpoint")
    sinks.run(stream, target, SECONDS)
    found = spark.read.schema(stream.schema).parquet(target.path)
    wanted = lines.join(orders, "k").where("shipped BETWEEN ordered AND ordered + INTERVAL 6 HOURS")
    columns = ["k", "line", "ordered", "shipped"]
    assert found.columns == batch.columns
    for frame in (found, batch):
        assert sorted(map(tuple, frame.select(*columns).collect())) == sorted(map(tuple, wanted.select(*columns).collect()))
    assert found.count() > 10


def test_targets_are_checked():
    with pytest.raises(SpecError, match="output mode"):
        sinks.StreamTarget(path="a", checkpoint="b", output_mode="complete")
    with pytest.raises(SpecError, match="key"):
        sinks.StreamTarget(path="a", checkpoint="b", output_mode="update")


def sql_step(name, inputs, text):
    return {"name": name, "type": "sql", "inputs": inputs, "output": name, "sql": text}


@pytest.fixture
def spec(spark, tmp_path):
    put(spark, tmp_path / "in", FIRST)
    profiles = spark.createDataFrame([(1, "free"), (3, "premium")], "user_id int, segment string")
    profiles.write.parquet(f"{tmp_path}/profiles")
    return {
        "pipeline": {"name": "engagement"},
        "sources": [
            {"name": "events", "type": "parquet", "path": f"{tmp_path}/in"},
            {"name": "user_profiles", "type": "parquet", "path": f"{tmp_path}/profiles"},
        ],
        "transformations": [
            sql_step("daily", ["events"], "SELECT user_id, to_date(timestamp) AS date, count(*) AS n, approx_count_distinct(event_type) AS kinds FROM events GROUP BY ALL"),
            sql_step("named", ["daily", "user_profiles"], "SELECT d.*, p.segment FROM daily d LEFT JOIN user_profiles p ON p.user_id = d.user_id"),
            sql_step("final", ["named"], "SELECT *, n * 10 AS score FROM named"),
        ],
        "streaming": {"keys": ["user_id", "date"], "partition_by": ["date"], "watermark": {"column": "timestamp", "delay": "10 days"}},
        "validation": {"rules": [{"name": "score", "type": "range_check", "column": "score", "min_value": 15}]},
        "target": {"type": "parquet", "path": f"{tmp_path}/out", "mode": "overwrite"},
    }


def test_kinds_of_tables(spec):
    assert runner.table_kinds(spec) == {
        "events": "stream", "user_profiles": "batch", "daily": "stream", "named": "stream", "final": "batch"
    }
    spec["transformations"].insert(0, sql_step("lookup", ["user_profiles"], "SELECT * FROM user_profiles"))
    spec["transformations"].insert(1, sql_step("segments", ["user_profiles"], "SELECT * FROM user_profiles"))
    spec["transformations"].insert(2, sql_step("with_lookup", ["events", "lookup"], "SELECT 1"))
    spec["transformations"].insert(3, sql_step("mixed", ["events", "segments"], "SELECT 1"))
    kinds = runner.table_kinds(spec)
    assert [kinds[n] for n in ("lookup", "segments", "with_lookup", "mixed")] == ["batch", "batch", "stream", "batch"]


def test_steps_on_streams_and_other_batch_tables_read_stored_streams(spark, spec, tmp_path):
    spec["transformations"] = [
        sql_step("segments", ["user_profiles"], "SELECT segment, min(user_id) AS user_id FROM user_profiles GROUP BY segment"),
        sql_step("clicks", ["events"], "SELECT * FROM events WHERE event_type = 'click'"),
        sql_step("mixed", ["clicks", "segments"], "SELECT c.*, segment FROM clicks c LEFT JOIN segments USING (user_id)"),
        sql_step("final", ["mixed"], "SELECT segment, count(*) AS n FROM mixed GROUP BY segment"),
    ]
    del spec["validation"], spec["streaming"]["keys"]
    result = runner.run(spark, spec, f"{tmp_path}/streams", SECONDS)
    assert {tuple(row) for row in result.view.collect()} == {("free", 1), (None, 1)}
    assert list(result.tables) == ["clicks"]


def test_streaming_spec_runs_incrementally(spark, spec, tmp_path):
    folder = f"{tmp_path}/streams"

    def run():
        result = runner.run(spark, spec, folder, SECONDS)
        columns = ["user_id", F.col("date").cast("string"), "n", "kinds", "segment", "score"]
        view = {tuple(row) for row in result.view.select(*columns).collect()}
        written = {tuple(row) for row in spark.read.parquet(spec["target"]["path"]).select(*columns).collect()}
        assert view == written
        return view

    assert run() == {(1, "2024-01-01", 2, 2, "free", 20)}
    put(spark, tmp_path / "in", [*SECOND, (2, "click", "2024-01-01 23:00:00")])
    assert run() == {(1, "2024-01-01", 3, 3, "free", 30), (2, "2024-01-01", 2, 1, None, 20)}


def test_streaming_spec_without_steps_stores_the_source(spark, spec, tmp_path):
    plain = {"pipeline": spec["pipeline"], "sources": spec["sources"], "transformations": []}
    result = runner.run(spark, plain, f"{tmp_path}/streams", SECONDS)
    assert result.view.count() == 3 and result.kinds == {"events": "stream", "user_profiles": "batch"}


def test_continuous_spec_is_started_not_run(spark, spec):
    spec["streaming"]["continuous"] = True
    with pytest.raises(SpecError, match="continuous"):
        runner.run(spark, spec)
