"""The change log behind update streams, and snapshots of static sides."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from sluiceway.plans import user_engagement
from sluiceway.sources.readers import read_stream
from sluiceway.streaming import runner, sinks
from sluiceway.streaming.changes import ChangeLog
from sluiceway.streaming.snapshots import Snapshots

SCHEMA = "k string, part string, v int"
SECONDS = 120


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA).coalesce(1)


def content(frame):
    return sorted((tuple(r) for r in frame.select("k", "part", "v").collect()), key=repr)


def files(path):
    return {os.path.join(folder, name) for folder, _, names in os.walk(path) for name in names if name.endswith(".parquet")}


@pytest.mark.parametrize("partition_by", [[], ["part"]])
def test_newest_version_of_each_key(spark, tmp_path, partition_by):
    log = ChangeLog(spark, str(tmp_path / "log"), ["k", "part"], partition_by)
    schema = rows(spark, ("", "", 0)).schema
    want = {}

    def append(*values):
        log.append(rows(spark, *values))
        want.update({(k, p): v for k, p, v in values})
        assert content(log.read(schema)) == sorted(((k, p, v) for (k, p), v in want.items()), key=repr)

    append(("a", "01", 1), ("b", "1", 1), (None, "01", 1), ("n", None, 1))
    append(("a", "01", 2), ("c", "2", 2), (None, "01", 2))
    assert log.compact() == 2 and log.versions() == []
    append(("b", "1", 3), ("n", None, 3))
    before = files(log.base)
    untouched = {f for f in before if "part=2" in f}
    append(("a", "01", 4), (None, "01", 4), ("d", "3", 4))
    assert files(log.base) == before
    log.compact()
    if partition_by:
        assert untouched and untouched <= files(log.base)
    assert content(log.read(schema)) == sorted(((k, p, v) for (k, p), v in want.items()), key=repr)
    assert log.compact() == 0


def test_a_write_costs_what_it_writes(spark, tmp_path, jobs):
    log = ChangeLog(spark, str(tmp_path / "log"), ["k", "part"], ["part"])
    log.append(spark.range(40_000).selectExpr("CAST(id AS string) AS k", "CAST(id % 400 AS string) AS part", "1 AS v"))
    log.compact()
    base = files(log.base)
    written = []
    writes = [lambda n=n: log.append(rows(spark, (str(n), str(n), 2))) for n in range(3)]
    for write in writes:
        before = files(log.path)
        ran = jobs(write)
        written.append((len(files(log.path) - before), ran))
    assert set(written) == {(1, 1)}
    assert files(log.base) == base
    assert log.read().where("v = 2").count() == 3 and log.read().count() == 40_000


def test_a_broken_off_write_or_compaction_is_not_seen(spark, tmp_path, monkeypatch):
    log = ChangeLog(spark, str(tmp_path / "log"), ["k", "part"])
    log.append(rows(spark, ("a", "x", 1)))
    log.append(rows(spark, ("a", "x", 2), ("b", "x", 2)))
    shutil.copytree(f"{log.changes}/_version=0", f"{log.path}/_staged_of_a_crash")
    monkeypatch.setattr("sluiceway.streaming.changes.storage.remove", lambda *_: None)
    log.compact()  # the versions stay, as if the driver had died before they were removed
    monkeypatch.undo()
    assert log.versions() == [0, 1]
    assert content(log.read()) == [("a", "x", 2), ("b", "x", 2)]
    log.compact()
    assert content(log.read()) == [("a", "x", 2), ("b", "x", 2)]


def in_files(spark, folder, batches):
    """One file for each batch of ``(user, type, time)``, read one at a time in that order."""
    schema = "user_id int, event_type string, timestamp timestamp"
    for n, batch in enumerate(batches):
        frame = spark.createDataFrame(batch, "user_id int, event_type string, timestamp string")
        frame.withColumn("timestamp", F.col("timestamp").cast("timestamp")).coalesce(1).write.parquet(f"{folder}/{n}")
        (file,) = [f for f in (folder / str(n)).iterdir() if f.name.endswith(".parquet")]
        os.utime(file, (1_700_000_000 + n, 1_700_000_000 + n))
    options = {"maxFilesPerTrigger": "1", "recursiveFileLookup": "true"}
    return {"name": "events", "type": "parquet", "path": str(folder), "schema": schema, "options": options}


BATCHES = [
    [(1, "click", "2024-01-01 10:00:00"), (2, "click", "2024-01-03 10:00:00")],
    [(1, "purchase", "2024-01-01 11:00:00")],
    [(1, "click", "2024-01-02 11:00:00"), (2, "page_view", "2024-01-03 09:00:00")],
    [(3, "click", "2024-01-01 00:00:00")],
]


def test_update_stream_of_several_batches(spark, tmp_path):
    source = in_files(spark, tmp_path / "in", BATCHES)
    target = sinks.StreamTarget(
        path=f"{tmp_path}/table", checkpoint=f"{tmp_path}/checkpoint", output_mode="update", keys=("user_id", "date"), partition_by=("date",)
    )
    sinks.run(user_engagement.daily_metrics(read_stream(spark, source)), target, SECONDS)

    def found():
        columns = ["user_id", F.col("date").cast("string"), "total_events", "purchases"]
        return {tuple(r) for r in sinks.read(spark, target).select(*columns).collect()}

    want = {(1, "2024-01-01", 2, 1), (2, "2024-01-03", 2, 0), (1, "2024-01-02", 1, 0), (3, "2024-01-01", 1, 0)}
    assert found() == want
    assert len(ChangeLog(spark, target.path, ["user_id", "date"]).versions()) == len(BATCHES)
    assert sinks.compact(spark, target) == len(BATCHES)
    assert found() == want
    assert sorted(name for name in os.listdir(f"{target.path}/base") if "=" in name) == [f"date=2024-01-0{n}" for n in (1, 2, 3)]


def test_continuous_streams_compact_by_themselves(spark, tmp_path):
    source = in_files(spark, tmp_path / "in", BATCHES)
    target = sinks.StreamTarget(
        path=f"{tmp_path}/table", checkpoint=f"{tmp_path}/checkpoint", output_mode="update", keys=("user_id", "date"),
        continuous=True, interval="100 milliseconds", compact_every=2,
    )
    query = sinks.start(user_engagement.daily_metrics(read_stream(spark, source)), target)
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert len(ChangeLog(spark, target.path, ["user_id", "date"]).versions()) < 2
    assert sinks.read(spark, target).count() == 4


def test_rocksdb_state(spark, tmp_path):
    source = in_files(spark, tmp_path / "in", BATCHES)
    target = sinks.StreamTarget(
        path=f"{tmp_path}/table", checkpoint=f"{tmp_path}/checkpoint", output_mode="update", keys=("user_id", "date"), rocksdb=True, state_partitions=2
    )
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting, None)
    query = sinks.start(user_engagement.daily_metrics(read_stream(spark, source)), target)
    assert spark.conf.get(setting, None) == before
    sinks.finish(query, SECONDS)
    assert "rocksdbGetCount" in query.lastProgress["stateOperators"][0]["customMetrics"]
    assert sinks.read(spark, target).count() == 4


def test_snapshots_are_computed_once(spark, tmp_path):
    source = in_files(spark, tmp_path / "in", BATCHES)
    spark.createDataFrame([(1, "a"), (2, "b"), (1, "c")], "user_id int, name string").write.parquet(f"{tmp_path}/names")
    dimension = spark.read.parquet(f"{tmp_path}/names").groupBy("user_id").agg(F.min("name").alias("name"))
    snapshots = Snapshots(spark, f"{tmp_path}/snapshots")
    taken = snapshots.take("names", dimension)
    shutil.rmtree(f"{tmp_path}/names")  # a micro-batch that computed it again would fail
    joined = read_stream(spark, source).join(taken, "user_id", "left").select("user_id", "name")
    target = sinks.StreamTarget(path=f"{tmp_path}/table", checkpoint=f"{tmp_path}/checkpoint")
    query = sinks.start(joined, target)
    sinks.finish(query, SECONDS)
    assert len(query.recentProgress) >= len(BATCHES)
    found = sorted(tuple(r) for r in spark.read.parquet(target.path).where("user_id < 3").collect())
    assert found == [(1, "a")] * 3 + [(2, "b")] * 2
    for n in (1, 2, 3):
        snapshots.take("names", spark.range(n))
    assert snapshots.versions("names") == [2, 3]


def test_a_spec_computes_its_dimensions_once(spark, tmp_path):
    source = in_files(spark, tmp_path / "in", BATCHES)
    spark.createDataFrame([(1, "a"), (2, "b")], "user_id int, name string").write.parquet(f"{tmp_path}/names")
    calls = spark.sparkContext.accumulator(0)

    def names(frame):
        def count(batches):
            calls.add(1)
            yield from batches

        return frame.coalesce(1).mapInPandas(count, frame.schema)

    spec = {
        "pipeline": {"name": "p"},
        "sources": [source, {"name": "people", "type": "parquet", "path": f"{tmp_path}/names", "mode": "batch"}],
        "transformations": [
            {"name": "names", "type": "python", "inputs": ["people"], "output": "lookup", "function": names},
            {"name": "join", "type": "join", "inputs": ["events", "lookup"], "output": "named", "on": "user_id", "how": "left"},
            {"name": "all", "type": "sql", "inputs": ["named"], "output": "final", "sql": "SELECT user_id, name FROM named"},
        ],
    }
    view = runner.run(spark, spec, f"{tmp_path}/streams", SECONDS).view
    assert sorted(tuple(r) for r in view.collect() if r.user_id < 3) == [(1, "a")] * 3 + [(2, "b")] * 2
    assert calls.value == 1
