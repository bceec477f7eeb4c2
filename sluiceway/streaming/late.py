"""Streams whose files come in any order: late rows go to a side table and are settled there.

Spark drops rows behind the watermark. Here a stateless query parts the rows of every micro-batch before that, by
the watermark that the batches before have set: rows that are still due go on to the stateful query, the
others to the side table. Rows that go on are never behind the watermark of the query that reads them, as its
watermark can only lag behind the one they were held against. What the side table holds is settled into the
result by a merge on its keys, so the result has every row whatever order the files came in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sluiceway import storage
from sluiceway.errors import SinkError
from sluiceway.settings import session_settings
from sluiceway.streaming import sinks


class Split:
    """Rows of a stream below ``folder``, those still due apart from late ones.

    ``due`` gives the time up to which a row is of use, such as the end of its window, and is ``time``
    itself where nothing is given; a row is late once the watermark has passed it. Each micro-batch is written in
    one job and published by one rename, so its reader sees all of it or nothing. A batch that is delivered
    again is parted by the same watermark and replaces itself.
    """

    def __init__(self, spark: SparkSession, folder: str, time: str, delay: str, due: Column | None = None):
        self.spark, self.folder, self.time, self.delay = spark, folder.rstrip("/"), time, delay
        self.due = F.col(time) if due is None else due
        self.rows, self.marks = f"{self.folder}/rows", f"{self.folder}/marks"
        self.schema: T.StructType | None = None

    def start(self, stream: DataFrame, continuous: bool = False, interval: str = "30 seconds") -> StreamingQuery:
        """Starts parting a stream; ``accepted`` and the side table can be read from then on."""
        self.schema = stream.schema
        storage.make_folder(self.spark, self.rows)
        writer = stream.writeStream.option("checkpointLocation", f"{self.folder}/checkpoint").foreachBatch(self._take)
        return (writer.trigger(processingTime=interval) if continuous else writer.trigger(availableNow=True)).start()

    def accepted(self) -> DataFrame:
        """Stream of the rows that are still due. It takes whole batches, so no limit on files may be put on it."""
        return self._due(self.spark.readStream)

    def accepted_so_far(self) -> DataFrame:
        return self._due(self.spark.read)

    def late(self) -> DataFrame:
        """The side table."""
        return self._read(self.spark.read).where("_late").select(*self.schema.names)

    def watermark(self) -> Column:
        """Latest time of all batches less the delay, in whole milliseconds as Spark has it; null without any time."""
        return self._behind(max((m for m in self._marks().values() if m is not None), default=None))

    def _due(self, reader) -> DataFrame:
        return self._read(reader).where("NOT _late").select(*self.schema.names)

    def _read(self, reader) -> DataFrame:
        own = [T.StructField("_batch", T.LongType()), T.StructField("_late", T.BooleanType())]
        return reader.schema(T.StructType([*self.schema.fields, *own])).parquet(self.rows)

    def _behind(self, mark: int | None) -> Column:
        if mark is None:
            return F.lit(None).cast("timestamp")
        return F.timestamp_millis(F.lit(mark)) - F.expr(f"INTERVAL {self.delay}")

    def _marks(self) -> dict[int, int | None]:
        """Latest time in milliseconds of every batch so far; one small row each."""
        if not storage.exists(self.spark, self.marks):
            return {}
        found = self.spark.read.schema("latest bigint, _batch bigint").parquet(self.marks)
        return {row["_batch"]: row["latest"] for row in found.collect()}

    def _take(self, batch: DataFrame, batch_id: int) -> None:
        before = [mark for number, mark in self._marks().items() if number < batch_id and mark is not None]
        late = F.coalesce(self.due.cast("timestamp") <= self._behind(max(before, default=None)), F.lit(False))
        seen = Observation()
        flagged = batch.withColumn("_late", late)
        latest = F.max(F.unix_millis(F.col(self.time).cast("timestamp")))
        staged = f"{self.folder}/_staged_{storage.unused()}"
        spark = batch.sparkSession
        # Both folders are open in every task, which else would sort all its rows by a flag.
        with session_settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": "2"}):
            flagged.observe(seen, latest.alias("latest")).write.partitionBy("_late").parquet(staged)
        mark = spark.createDataFrame([(seen.get["latest"],)], "latest bigint")
        mark.coalesce(1).write.mode("overwrite").parquet(f"{self.marks}/_batch={batch_id}")
        published = f"{self.rows}/_batch={batch_id}"
        storage.remove(spark, published)
        storage.move(spark, staged, published)


def run(splits: list[tuple[Split, DataFrame]], build: Callable[..., DataFrame], target: sinks.StreamTarget, seconds: int | None = None) -> DataFrame:
    """Parts streams to their end while the stateful query that ``build`` makes of them follows.

    ``build`` gets the accepted rows of each split. Returns what the query has written; the side tables
    are still to be settled. An error if the query dropped a row after all.
    """
    parting = [split.start(stream) for split, stream in splits]
    stateful = build(*(split.accepted() for split, _ in splits))
    following = sinks.start(stateful, sinks.following(target))
    try:
        for query in parting:
            sinks.finish(query, seconds)
        following.processAllAvailable()
        lost = sinks.dropped(following)
    finally:
        for query in [*parting, following]:
            query.stop()
    if lost:
        raise SinkError(f"{lost} rows that were still due were dropped on the way to {target.path}")
    return sinks.read(stateful.sparkSession, target, stateful.schema)
