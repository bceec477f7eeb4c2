"""Exact deduplication of a stream of documents: keyed state on disk, and whole texts compared on every hit.

Two streaming queries read files as they come. The first writes a small row for each document: its digest and
its locator, which is the file and the row in it. The second keeps state by digest, in RocksDB and without
expiry: how many documents have it, which one stays, and the locator of the content that came first. Each task
adds up its own documents of a digest before the shuffle, so one text may be any share of all rows.

A digest is only a hint. Documents whose digest has been seen are held, in whole, against the content
that came first, which is fetched by its locator; the copies of a text are dealt out over as many tasks
as they need, each with its own copy of that content. A text that differs in spite of its digest is grouped with its like by
the whole text. A run costs what it adds: texts that earlier runs have compared are not compared again.

Both queries checkpoint to the shared folder, so a lost executor or a broken-off run costs what was under way.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceway import storage
from sluiceway.llm.scratch import Scratch
from sluiceway.sources.readers import read_source, read_stream
from sluiceway.streaming import sinks

#: Copies of a text that one task compares.
COPIES = 1_000
#: Bytes of files that one micro-batch takes.
BATCH_BYTES = 64 * 1024**3
LOCATOR = ("file", "row")

#: The same rows for documents whose ids differ.
KEPT_SQL = f"""
    SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
           doc_id = max(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
    FROM (SELECT doc_id, translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS norm FROM documents)
    WINDOW same AS (PARTITION BY norm)
"""


def normalised(text: Column) -> Column:
    """A text in the form that decides equality: A to Z lower-cased and nothing else; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)


def _located(docs: DataFrame) -> DataFrame:
    meta = docs.metadataColumn("_metadata")
    return docs.select("doc_id", "text", meta["file_path"].alias("file"), meta["row_index"].alias("row"))


def _is(a: str, b: str) -> Column:
    """Whether two locators, structs that hold file and row, are the same."""
    return (F.col(f"{a}.file") == F.col(f"{b}.file")) & (F.col(f"{a}.row") == F.col(f"{b}.row"))


class Deduplicator:
    """State and results of one stream below ``folder``; call ``run`` whenever files may have come.

    ``digest_bytes`` shortens the digest that keys the state; results do not depend on it. Files are read
    once and must stay, as locators point into them.
    """

    def __init__(self, spark: SparkSession, path: str, folder: str, digest_bytes: int = 32, batch_bytes: int = BATCH_BYTES):
        self.spark, self.folder, self.digest_bytes = spark, folder.rstrip("/"), digest_bytes
        self.source = {"name": "documents", "type": "parquet", "path": path, "options": {"maxBytesPerTrigger": str(batch_bytes)}}
        self.arrivals = sinks.StreamTarget(path=f"{self.folder}/arrivals", checkpoint=f"{self.folder}/arrivals-checkpoint")
        self.groups = sinks.StreamTarget(
            path=f"{self.folder}/groups", checkpoint=f"{self.folder}/groups-checkpoint", output_mode="update", keys=("digest",), rocksdb=True
        )

    def run(self) -> DataFrame:
        """Takes in what has come and gives all documents so far: ``doc_id, keep_id, group_size, kept, text_sha256``."""
        schema = self._take_in()
        arrivals = self.spark.read.schema(schema).parquet(self.arrivals.path)
        groups = sinks.read(self.spark, self.groups)
        scratch = Scratch(self.spark, "dedup")
        # Plain tables on both sides, so adaptive execution can split a digest that very many documents have.
        groups = scratch.keep(groups, "groups")
        placed = scratch.keep(arrivals.join(groups, "digest"), "placed")
        self._compare(placed, scratch)
        mixed = self._mixed(placed, scratch)
        if mixed is None:
            return _described(placed)
        alone = placed.join(mixed.select("digest").distinct(), "digest", "left_anti")
        return _described(alone.drop("first")).unionByName(_described(mixed))

    def _take_in(self):
        docs = _located(read_stream(self.spark, self.source))
        sha = F.unhex(F.sha2(normalised(F.col("text")), 256))
        arrived = docs.select("doc_id", F.struct(*LOCATOR).alias("at"), sha.alias("sha"), F.current_timestamp().alias("arrived"))
        arrived = arrived.withColumn("digest", F.substring("sha", 1, self.digest_bytes))
        sinks.run(arrived, self.arrivals)
        seen = self.spark.readStream.schema(arrived.schema).parquet(self.arrivals.path)
        # The first content of a digest stays the first: a later batch has a later time.
        state = seen.groupBy("digest").agg(
            F.count(F.lit(1)).alias("size"),
            F.max(F.struct("doc_id", "at")).alias("keep"),
            F.min(F.struct("arrived", "at")).alias("first"),
        )
        sinks.run(state, self.groups)
        return arrived.schema

    def _compare(self, placed: DataFrame, scratch: Scratch) -> None:
        """Writes for every hit that no run has compared whether its whole text is that of its digest's first content."""
        hits = placed.where((F.col("size") > 1) & ~_is("at", "first.at")).select("at", F.col("first.at").alias("with"), "digest", "size")
        if storage.exists(self.spark, self.compared):
            hits = hits.join(self.spark.read.parquet(self.compared).select("at"), "at", "left_anti")
        hits = scratch.keep(hits, "hits")
        parts = F.ceil(F.col("size") / COPIES)
        firsts = hits.groupBy("with").agg(F.max(parts).alias("parts"))
        wanted = hits.select("at", "with", F.pmod(F.xxhash64("at"), parts).alias("part"), F.lit(0).alias("parts"))
        wanted = wanted.unionByName(firsts.select(F.col("with").alias("at"), "with", F.lit(-1).alias("part"), "parts"))
        texts = scratch.keep(self._fetched(wanted), "texts")
        first = texts.where("part < 0").select("with", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.col("text").alias("own"))
        pairs = texts.where("part >= 0").select("at", "with", "part", "text").join(first, ["with", "part"])
        same = F.when(F.col("text") == F.col("own"), True).otherwise(normalised(F.col("text")) == normalised(F.col("own")))
        staged = storage.sibling(self.compared, "staged")
        pairs.select("at", same.alias("same")).write.parquet(staged)
        done, asked = self.spark.read.parquet(staged).count(), hits.count()
        if done != asked:
            raise ValueError(f"{asked} hits, but {done} texts found by their locators: files of the source have changed")
        storage.make_folder(self.spark, self.compared)
        storage.move(self.spark, staged, f"{self.compared}/run={storage.unused()}")
        scratch.drop("texts")

    @property
    def compared(self) -> str:
        return f"{self.folder}/compared"

    def _fetched(self, wanted: DataFrame) -> DataFrame:
        """Rows with a locator ``at`` and the text found there; a null text is empty.

        The join is a shuffle at every size, as the number of wanted rows has no bound.
        """
        docs = _located(read_source(self.spark, self.source))
        texts = docs.select(F.struct(*LOCATOR).alias("at"), F.coalesce("text", F.lit("")).alias("text"))
        return wanted.hint("merge").join(texts, "at")

    def _mixed(self, placed: DataFrame, scratch: Scratch) -> DataFrame | None:
        """Documents of digests that stand for several texts, grouped by whole texts; None if there are none."""
        compared = self.spark.read.parquet(self.compared)
        differing = placed.join(compared.where("not same").select("at"), "at", "left_semi").select("digest").distinct()
        differing = scratch.keep(differing, "differing")
        if differing.isEmpty():
            return None
        rows = self._fetched(placed.join(differing, "digest").drop("size", "keep"))
        rows = scratch.keep(rows.withColumn("text", normalised(F.col("text"))), "mixed")
        groups = rows.groupBy("digest", "text").agg(F.count(F.lit(1)).alias("size"), F.max(F.struct("doc_id", "at")).alias("keep"))
        return rows.join(scratch.keep(groups, "mixed-groups"), ["digest", "text"]).drop("text")


def _described(placed: DataFrame) -> DataFrame:
    return placed.select(
        "doc_id",
        F.col("keep.doc_id").alias("keep_id"),
        F.col("size").alias("group_size"),
        _is("at", "keep.at").alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def deduplicated(spark: SparkSession, path: str, digest_bytes: int = 32) -> DataFrame:
    """Every document under a path with the one that stays of its equals: that with the largest ``doc_id``.

    Null texts are empty ones, and equal to them. Of rows that repeat an id with an equal text exactly one
    stays, the last by file and row; a null id is smaller than any. Texts of any length are compared whole. An empty table
    gives no rows; columns other than ``doc_id`` and ``text`` are not read.
    """
    return Deduplicator(spark, path, storage.new_folder(spark, "dedup-stream"), digest_bytes).run()
