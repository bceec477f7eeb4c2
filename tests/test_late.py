"""Files in any order: late rows go to the side table and into the result."""

import os
import random

import pytest
from pyspark.sql import functions as F

from sluiceway.errors import SinkError
from sluiceway.sources.readers import read_stream
from sluiceway.streaming import engagement, late, sinks

SECONDS = 120
EVENTS = "user_id int, event_type string, timestamp timestamp"


def ordered(spark, frame, folder, time, order):
    """A source of one file per day of a frame, read one at a time in the given order of the days."""
    days = sorted(r[0] for r in frame.select(F.to_date(time).cast("string")).distinct().collect())
    for n, day in enumerate(order(days)):
        frame.where(F.to_date(time) == F.lit(day)).coalesce(1).write.parquet(f"{folder}/{day}")
        (file,) = [f for f in (folder / day).iterdir() if f.name.endswith(".parquet")]
        os.utime(file, (1_700_000_000 + n, 1_700_000_000 + n))
    options = {"maxFilesPerTrigger": "1", "recursiveFileLookup": "true"}
    return {"name": folder.name, "type": "parquet", "path": str(folder), "schema": frame.schema, "options": options}


def shuffled(seed):
    return lambda days: random.Random(seed).sample(days, len(days))


def events(spark):
    time = "timestamp'2024-01-01 05:00:00' + make_dt_interval(0, CAST(id * 7 % 190 AS int)) AS timestamp"
    return spark.sql(f"SELECT CAST(id % 5 AS int) AS user_id, if(id % 3 = 0, 'purchase', 'click') AS event_type, {time} FROM range(200)")


def target(folder):
    return sinks.StreamTarget(path=f"{folder}/table", checkpoint=f"{folder}/checkpoint", state_partitions=2)


@pytest.mark.parametrize("order", [sorted, lambda days: days[::-1], shuffled(1), shuffled(2)])
def test_windows_hold_every_row_in_any_order(spark, tmp_path, order):
    frame = events(spark)
    source = ordered(spark, frame, tmp_path / "in", "timestamp", order)
    split = late.Split(spark, f"{tmp_path}/split", "timestamp", "1 hour", engagement.window_end())
    closed = late.run([(split, read_stream(spark, source))], engagement.windowed_metrics, target(tmp_path), SECONDS)
    found = {tuple(r) for r in engagement.settled_windows(closed, split).collect()}
    end = frame.agg(F.max("timestamp")).first()[0]
    days = frame.groupBy("user_id", F.to_date("timestamp").alias("date")).agg(
        F.count("*").alias("n"), F.count_if(F.col("event_type") == "purchase").alias("p")
    )
    last = F.col("date").cast("timestamp") + F.expr("INTERVAL 1 DAY") <= F.lit(end) - F.expr("INTERVAL 1 HOUR")
    assert found == {tuple(r) for r in days.where(last).collect()}
    assert len(found) > 20
    parted = split.late().count(), split.accepted_so_far().count()
    assert sum(parted) == 200
    assert (parted[0] == 0) == (order is sorted)
    assert spark.read.parquet(split.rows).select("_batch").distinct().count() >= 6


def test_a_batch_parted_again_is_parted_alike(spark, tmp_path):
    split = late.Split(spark, f"{tmp_path}/split", "timestamp", "1 hour")
    frame = events(spark)
    split.schema = frame.schema
    early, later = frame.where("timestamp < '2024-01-03'"), frame.where("timestamp >= '2024-01-03'")
    split._take(later, 0)
    for _ in range(2):
        split._take(early, 1)
        assert split.late().count() == early.count() and split.accepted_so_far().count() == later.count()
    split._take(later, 0)
    assert split.late().count() == early.count() and split.accepted_so_far().count() == later.count()


def test_rows_without_a_time_and_empty_batches(spark, tmp_path):
    split = late.Split(spark, f"{tmp_path}/split", "timestamp", "1 hour")
    split.schema = events(spark).schema
    split._take(spark.createDataFrame([], EVENTS), 0)
    split._take(spark.createDataFrame([(1, "click", None)], EVENTS), 1)
    split._take(events(spark).limit(3), 2)
    assert split.late().count() == 0 and split.accepted_so_far().count() == 4


def orders_and_lines(spark):
    orders = spark.sql("SELECT id AS k, timestamp'2024-01-01' + make_dt_interval(0, CAST(id * 5 AS int)) AS ordered FROM range(40)")
    shipped = "timestamp'2024-01-01' + make_dt_interval(0, CAST(id * 11 % 250 AS int)) AS shipped"
    return orders, spark.sql(f"SELECT if(id % 4 = 0, 7, id % 45) AS k, id AS line, {shipped} FROM range(400)")


MATCH = ("k", "ordered", "shipped", "30 HOURS")


@pytest.mark.parametrize("seed", [1, 2])
def test_stream_join_has_every_match_in_any_order(spark, tmp_path, seed):
    orders, lines = orders_and_lines(spark)
    one_source = ordered(spark, orders, tmp_path / "orders", "ordered", shuffled(seed))
    many_source = ordered(spark, lines, tmp_path / "lines", "shipped", shuffled(seed + 10))
    one = late.Split(spark, f"{tmp_path}/one", "ordered", "1 hour")
    many = late.Split(spark, f"{tmp_path}/many", "shipped", "1 hour")
    streams = [(one, read_stream(spark, one_source)), (many, read_stream(spark, many_source))]
    stored = late.run(streams, lambda a, b: engagement.join_in_range(a, b, *MATCH), target(tmp_path), SECONDS)
    found = engagement.settled_join(stored, one, many, *MATCH)
    wanted = engagement.join_in_range(orders, lines, *MATCH)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, wanted.collect()))
    assert one.late().count() and many.late().count() and found.count() > stored.count()


def test_a_plain_stream_join_reports_what_it_loses(spark, tmp_path):
    orders, lines = orders_and_lines(spark)
    read = {}
    for name, frame, time in (("orders", orders, "ordered"), ("lines", lines, "shipped")):
        read[name] = read_stream(spark, ordered(spark, frame, tmp_path / name, time, lambda days: days[::-1]))
    with pytest.raises(SinkError, match="later than the watermark"):
        sinks.run(engagement.join_in_range(read["orders"], read["lines"], *MATCH), target(tmp_path), SECONDS)


def test_dealing_a_table_sorts_in_no_task_and_keeps_days_in_batches(spark, tmp_path, monkeypatch):
    from catalogue import streams

    frame = events(spark).selectExpr("CAST(hash(timestamp) AS bigint) AS event_id", "timestamp AS ts", "CAST(user_id AS bigint) AS user_id")
    frame = frame.selectExpr("*", "'click' AS event_type", "1.5D AS value", "'{}' AS props")
    frame.write.parquet(f"{tmp_path}/events.parquet")
    for rows, files in ((200, 1), (10, 4)):
        monkeypatch.setattr(streams, "FILE_ROWS", rows)
        source = streams.in_files(spark, str(tmp_path), "events", "ts")
        found = spark.read.parquet(source["path"])
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, frame.collect()))
        assert source["options"] == {"maxFilesPerTrigger": str(files)} and "_place" not in found.columns
        found = found.withColumn("file", F.input_file_name())
        in_file = found.groupBy("file").count().collect()
        of_day = found.groupBy(F.to_date("ts"), "file").count().groupBy("to_date(ts)").count().collect()
        assert len(in_file) <= streams.BATCHES * files and max(r[1] for r in of_day) <= files
        assert files == 1 or max(r[1] for r in in_file) < max(r[1] for r in frame.groupBy(F.to_date("ts")).count().collect())


def test_rows_are_parted_without_a_sort(spark, tmp_path, monkeypatch):
    written = []
    split = late.Split(spark, f"{tmp_path}/split", "timestamp", "1 hour")
    split.schema = events(spark).schema
    split._take(events(spark).where("timestamp >= '2024-01-03'"), 0)
    move = late.storage.move
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    monkeypatch.setattr(late.storage, "move", lambda *names: written.append(spark.conf.get(setting)) or move(*names))
    monkeypatch.setattr(late, "session_settings", lambda session, values: written.append(values) or kept(session, values))
    from sluiceway.settings import session_settings as kept

    split._take(events(spark).repartition(2), 1)
    assert written == [{setting: "2"}, "0"]
    assert split.late().count() and split.late().count() + split.accepted_so_far().count() > 200
