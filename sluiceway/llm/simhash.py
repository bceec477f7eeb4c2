"""SimHash near-duplicates: fingerprints, pigeonhole blocks, Hamming check, connected groups.

Python computes fingerprints from Arrow batches, one text at a time in pieces of bounded size. All
that follows works on distinct fingerprints, so a text with very many copies is one row.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.components import connected
from sluiceway.llm.scratch import Scratch

WORDS = 3
SEED = 42
DISTANCE = 2
#: Words voted on at a time, which bounds the memory a long text takes.
PIECE = 50_000
#: Blocks a fingerprint is cut into. Close pairs agree on at least ``BLOCKS - DISTANCE`` of them.
BLOCKS = 4
#: Fingerprints of a block that are joined in pairs. Fuller blocks go by flipped bits, which is as exact.
PAIRED = 32


def fingerprint_of(text: str | None) -> int:
    """64-bit SimHash of a text, unsigned; 0 without a word.

    Only A-Z are lower-cased and only ASCII white space parts words, which is what ``bytes`` do.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < WORDS:
        words = [b" ".join(words)]
        width = 1
    else:
        width = WORDS
    hashed = partial(xxhash.xxh64_intdigest, seed=SEED)
    total = len(words) - width + 1
    votes = np.zeros(64, dtype=np.int64)
    for start in range(0, total, PIECE):
        part = words[start : start + PIECE + width - 1]
        shingles = map(b" ".join, zip(*[part[k:] for k in range(width)]))
        votes += votes_of(np.fromiter(map(hashed, shingles), dtype="<u8"))
    return majority(votes, total)


def votes_of(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of their 64 bits set."""
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def majority(votes: np.ndarray, total: int) -> int:
    """The fingerprint: a bit is set if more than half of the hashes have it."""
    return int(np.packbits(2 * votes > total, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, column: str = "fp") -> DataFrame:
    """The documents with their fingerprint as a signed 64-bit number."""

    @F.pandas_udf("bigint")
    def fingerprints(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = np.fromiter(map(fingerprint_of, texts), dtype=np.uint64, count=len(texts))
            yield pd.Series(found.view(np.int64))

    return docs.withColumn(column, fingerprints("text"))


def links(fingerprints: DataFrame, scratch: Scratch) -> DataFrame:
    """``a, b`` pairs of distinct fingerprints that connect all within ``DISTANCE`` bits of each other.

    Any two fingerprints that close agree on two of four blocks, so every choice of two blocks is a
    join key. Blocks with one fingerprint are dropped first. Up to ``PAIRED`` fingerprints of a block
    are joined and checked. Of fuller ones, two are close exactly if one value lies within one bit of
    both: each fingerprint is sent to itself and its 64 neighbours, and whatever meets there (65 at
    most) is linked to the smallest. That gives the same groups without pairs of a full block.
    """
    width = 64 // BLOCKS
    keys = [
        F.struct(F.lit(n).alias("choice"), F.col("fp").bitwiseAND(F.lit(_mask(chosen, width))).alias("bits"))
        for n, chosen in enumerate(combinations(range(BLOCKS), BLOCKS - DISTANCE))
    ]
    members = fingerprints.select("fp", F.explode(F.array(*keys)).alias("key")).select("fp", "key.*")
    full = members.groupBy("choice", "bits").agg(F.count("*").alias("size")).where("size > 1")
    full = scratch.keep(full, "blocks")
    met = scratch.keep(members.join(full, ["choice", "bits"]), "members")

    paired = met.where(F.col("size") <= PAIRED)
    pairs = paired.alias("x").join(paired.alias("y"), ["choice", "bits"]).where("x.fp < y.fp")
    pairs = pairs.select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))

    crowded = met.where(F.col("size") > PAIRED).select("fp").distinct()
    flips = [F.lit(0).cast("bigint"), *[F.lit(_signed(1 << k)) for k in range(64)]]
    spread = crowded.select("fp", F.explode(F.transform(F.array(*flips), lambda bit: F.col("fp").bitwiseXOR(bit))).alias("meet"))
    meeting = spread.groupBy("meet").agg(F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    stars = meeting.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a <> b")

    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE
    return pairs.unionByName(stars).where(close).distinct()


def _mask(chosen: tuple[int, ...], width: int) -> int:
    return _signed(sum(((1 << width) - 1) << (block * width) for block in chosen))


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def groups(rows: DataFrame, scratch: Scratch, further: DataFrame | None = None) -> DataFrame:
    """``doc_id, fp, group, component_id`` for rows of ``doc_id, fp``; ``further`` has links ``a, b`` beside those by bits."""
    distinct = scratch.keep(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    found = links(distinct.select("fp"), scratch)
    parts = connected(found if further is None else found.unionByName(further), scratch)
    parts = scratch.keep(parts.select(F.col("node").alias("fp"), F.col("component").alias("group")), "groups")
    labelled = distinct.join(parts, "fp", "left").withColumn("group", F.coalesce("group", "fp"))
    labelled = scratch.keep(labelled, "labelled")
    first = scratch.keep(labelled.groupBy("group").agg(F.min("first").alias("component_id")), "first")
    labels = scratch.keep(labelled.join(first, "group").select("fp", "group", "component_id"), "labels")
    for name in ("blocks", "members", "links", "half", "least", "distinct", "groups", "labelled", "first"):
        scratch.drop(name)
    return rows.join(labels, "fp").select("doc_id", "fp", "group", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, fp, group, component_id`` for every row of the documents.

    ``group`` is the smallest fingerprint of the connected group and ``component_id`` the smallest id
    in it. Null and empty texts have fingerprint 0. Null ids never are the smallest; a group of them
    alone has a null ``component_id``. Rows that repeat stay, with one result each. An empty table
    gives no rows, other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "simhash")
    return groups(scratch.keep(with_fingerprint(docs.select("doc_id", "text")).select("doc_id", "fp"), "rows"), scratch)


def hex_digits(column: str = "fp"):
    return F.lpad(F.lower(F.hex(column)), 16, "0")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The documents without near-duplicates: of each group the row with the smallest id stays.

    Rows that share that id keep the one of the smallest fingerprint, groups without ids one row.
    Which row stays is decided on ids and fingerprints; texts only move where they meet the rows that
    stay, by id, so a group with a third of all rows is spread. All columns are kept as they are.
    """
    scratch = Scratch(docs.sparkSession, "dedup")
    return first_of_groups(scratch.keep(with_fingerprint(docs, "_fp"), "rows"), docs.columns, scratch)


def first_of_groups(rows: DataFrame, columns: list[str], scratch: Scratch, further: DataFrame | None = None) -> DataFrame:
    """``columns`` of the row that stays of each group, from rows that have ``_fp`` too; ``further`` as in ``groups``."""
    found = groups(rows.select("doc_id", F.col("_fp").alias("fp")), scratch, further)
    stays = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    stays = stays.groupBy("group", F.col("component_id").alias("_first")).agg(F.min("fp").alias("_least")).drop("group")
    stays = scratch.keep(stays, "stays")
    kept = rows.join(stays, rows["doc_id"].eqNullSafe(stays["_first"]) & (rows["_fp"] == stays["_least"]))
    return kept.dropDuplicates(["doc_id", "_fp"]).select(*columns)
