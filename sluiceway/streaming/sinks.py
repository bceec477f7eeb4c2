"""Running streaming queries into Parquet folders."""

from __future__ import annotations

import time
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sluiceway import storage
from sluiceway.errors import SinkError, SpecError
from sluiceway.settings import session_settings
from sluiceway.streaming.changes import ChangeLog

OUTPUT_MODES = ("append", "update")
#: Seconds between looks at the progress of a query, which keeps its last hundred batches.
POLL = 5


@dataclass(frozen=True)
class StreamTarget:
    """Where a stream goes.

    ``append`` writes every row once into a plain folder. ``update`` writes changed rows as the next version of
    a change log on ``keys``, so a micro-batch costs what it changed; ``read`` gives the table either way, and
    ``compact`` moves the versions into a base that may be partitioned. A ``continuous`` stream compacts by
    itself after every ``compact_every`` versions. A stream that is not ``continuous`` reads what is there and ends. ``state_partitions`` is the number of state stores
    per operator, fixed by the first run; without it the session's number of shuffle partitions counts.
    Adaptive execution does not size them, so it should suit the cluster, such as its number of cores.
    ``rocksdb`` keeps state on the executors' disks in place of their memory.
    A run that loses rows behind the watermark ends with an error, unless ``drop_late`` allows it.
    """

    path: str
    checkpoint: str
    output_mode: str = "append"
    keys: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    continuous: bool = False
    interval: str = "30 seconds"
    state_partitions: int | None = None
    drop_late: bool = False
    rocksdb: bool = False
    compact_every: int = 100

    def __post_init__(self):
        if self.output_mode not in OUTPUT_MODES:
            raise SpecError(f"unknown output mode {self.output_mode!r}, use one of {OUTPUT_MODES}")
        if self.output_mode == "update" and not self.keys:
            raise SpecError("update mode needs the key columns of the rows it replaces")


def start(stream: DataFrame, target: StreamTarget) -> StreamingQuery:
    """Starts the query; the caller waits for it or stops it."""
    writer = stream.writeStream.outputMode(target.output_mode).option("checkpointLocation", target.checkpoint)
    if target.continuous:
        writer = writer.trigger(processingTime=target.interval)
    else:
        writer = writer.trigger(availableNow=True)
    if target.output_mode == "append":
        writer = writer.partitionBy(*target.partition_by).format("parquet").option("path", target.path)
    else:
        writer = writer.foreachBatch(_upsert_into(target))
    # A query keeps the settings it was started with.
    with session_settings(stream.sparkSession, _state_settings(target)):
        return writer.start()


def _state_settings(target: StreamTarget) -> dict[str, str]:
    settings = {}
    if target.state_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(target.state_partitions)
    if target.rocksdb:
        provider = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        settings["spark.sql.streaming.stateStore.providerClass"] = provider
        rocksdb = "spark.sql.streaming.stateStore.rocksdb"
        # One bound for all stores of an executor, whatever their number, and no space set aside for each.
        settings[f"{rocksdb}.boundedMemoryUsage"] = "true"
        settings[f"{rocksdb}.allowFAllocate"] = "false"
        # A commit uploads what a batch has changed and not the whole store.
        settings[f"{rocksdb}.changelogCheckpointing.enabled"] = "true"
    return settings


def finish(query: StreamingQuery, seconds: int | None = None) -> int:
    """Waits for a query that ends by itself; with a limit, one that does not end in time is stopped.

    Returns how many rows came later than the watermark and were dropped. Stateful operators that
    aggregate before the shuffle count rows of groups there, so the number is a lower bound.
    """
    lost: dict[int, int] = {}
    begin = time.monotonic()
    while True:
        left = POLL if seconds is None else min(POLL, seconds - (time.monotonic() - begin))
        ended = left > 0 and query.awaitTermination(left)
        _note_dropped(query, lost)
        if ended:
            return sum(lost.values())
        if left <= 0:
            query.stop()
            raise TimeoutError(f"the stream did not end within {seconds} seconds")


def _note_dropped(query: StreamingQuery, lost: dict[int, int]) -> None:
    """Late rows by batch, of the batches that a query still knows of."""
    for progress in query.recentProgress:
        number = sum(operator["numRowsDroppedByWatermark"] for operator in progress["stateOperators"])
        lost[progress["batchId"]] = max(lost.get(progress["batchId"], 0), number)


def dropped(query: StreamingQuery) -> int:
    """Late rows that the last hundred batches of a query dropped."""
    lost: dict[int, int] = {}
    _note_dropped(query, lost)
    return sum(lost.values())


def following(target: StreamTarget) -> StreamTarget:
    """The target of a query that takes rows as another one publishes them, until it is stopped."""
    return replace(target, continuous=True, interval="200 milliseconds")


def run(stream: DataFrame, target: StreamTarget, seconds: int | None = None) -> int:
    """Runs a query to its end; returns the number of late rows it dropped, if the target allows any."""
    late = finish(start(stream, target), seconds)
    if late and not target.drop_late:
        raise SinkError(f"{late} rows came later than the watermark and are not in {target.path}: choose a longer delay or set drop_late")
    return late


def _log(spark: SparkSession, target: StreamTarget) -> ChangeLog:
    return ChangeLog(spark, target.path, list(target.keys), list(target.partition_by))


def _upsert_into(target: StreamTarget):
    """One version of the change log for each micro-batch.

    A batch that is delivered again becomes a newer version of the same rows, so the table reads as if it
    had been delivered once.
    """

    def upsert(batch: DataFrame, batch_id: int) -> None:
        log = _log(batch.sparkSession, target)
        log.append(batch)
        if target.continuous and len(log.versions()) >= target.compact_every:
            log.compact()

    return upsert


def read(spark: SparkSession, target: StreamTarget, schema: T.StructType | None = None) -> DataFrame:
    """The table a stream has written so far."""
    if target.output_mode == "update":
        return _log(spark, target).read(schema)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(target.path)


def compact(spark: SparkSession, target: StreamTarget) -> int:
    """Moves the versions of an ``update`` target into its base; returns how many."""
    return _log(spark, target).compact()


def refresh(stream: DataFrame, target: StreamTarget, seconds: int | None = None) -> StreamTarget:
    """Rebuilds a target from all files of its sources, with state from scratch.

    The folder and its checkpoint are removed first; sources keep their files, so nothing is lost.
    """
    spark = stream.sparkSession
    for path in (target.checkpoint, target.path):
        if storage.exists(spark, path):
            storage.remove(spark, path)
    run(stream, target, seconds)
    return target
