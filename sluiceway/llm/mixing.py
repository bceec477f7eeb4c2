"""Mixing sources to target weights by systematic sampling, on DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.scratch import Scratch, with_extras_aside

SPACE = "\\x20\\x09-\\x0D"
WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
#: Expected copies are whole numbers of this share of a copy, so that their sums are exact.
PART = 1 << 24
SEED = "mix"


def size(text: Column) -> Column:
    """Words between ASCII white space; a null text has none."""
    # Only what begins a word is counted, so no array of words is made.
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """``source, n_docs, source_size, target`` for every source.

    Sources by code point, null last, take the weights in turn. A target stops at ``most`` times its
    source's size and the excess is shared anew, which ends at one common share per weight for all
    that have not stopped. Sources in the order in which they stop, that share follows from sums
    over those before. The windows see one row for each source, of which a mixture has a list.
    """
    per = sizes.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    in_turn = Window.orderBy(F.asc_nulls_last("source"))
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.row_number().over(in_turn) - 1, F.lit(len(weights))) + 1)
    per = per.withColumn("weight", weight).withColumn("most", most * F.col("source_size"))
    stopping = Window.orderBy(F.col("most") / F.col("weight"), F.asc_nulls_last("source"))
    before = stopping.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    per = per.withColumn("total", F.sum("source_size").over(everything))
    per = per.withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    per = per.withColumn("share", (F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0))) / F.col("open"))
    goes_on = F.col("share") * F.col("weight") <= F.col("most")
    share = F.min(F.when(goes_on, F.struct((F.col("most") / F.col("weight")).alias("at"), "share"))).over(everything)
    target = F.least(F.col("most").cast("double"), F.col("weight") * share["share"])
    return per.select("source", "n_docs", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def mixed(docs: DataFrame) -> DataFrame:
    """The documents with ``_size``, ``_source_size``, ``_target`` and ``_copies`` that the mix takes.

    Every document of a source expects target / size copies. Within a source they stand in order of
    size class and then of a digest of their ids; expected copies are summed up along it from a
    random offset, and a document is taken once for each whole number its stretch crosses. A source
    is cut into size classes and those into about as many cells as a cell has rows, so that a source
    with a third of all rows is summed in three short steps and never in one task. Null texts and
    texts without a word have size 0; documents that share id and size are alike, whichever of them
    is taken. A null source is a source. An empty table gives no rows. All columns are kept.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    rows = docs.withColumn("_size", size(F.col("text")))
    per = scratch.keep(targets(rows.select("source", F.col("_size").alias("size"))), "targets")
    rate = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size") * PART)).otherwise(0)
    offset = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(SEED), "source")), 1, 6), 16, 10).cast("bigint")
    per = per.select(
        F.col("source").alias("_source"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target"),
        rate.cast("bigint").alias("_rate"), F.ceil(F.sqrt("n_docs")).cast("int").alias("_cells"), offset.alias("_offset"),
    )
    rows = rows.join(per, rows["source"].eqNullSafe(per["_source"]))
    digits = F.bin("_size")
    rows = rows.withColumn("_class", F.length(digits) * 8 + F.conv(F.substring(digits, 1, 3), 2, 10).cast("int"))
    rows = rows.withColumn("_digest", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = rows.withColumn("_cell", F.floor(F.conv(F.substring("_digest", 1, 8), 16, 10).cast("bigint") * F.col("_cells") / F.lit(1 << 32)))

    cells = rows.groupBy("_source", "_class", "_cell").agg(F.sum("_rate").alias("_sum"))
    classes = cells.groupBy("_source", "_class").agg(F.sum("_sum").alias("_sum"))
    up_to = [Window.unboundedPreceding, -1]
    by_class = Window.partitionBy("_source").orderBy("_class").rowsBetween(*up_to)
    by_cell = Window.partitionBy("_source", "_class").orderBy("_cell").rowsBetween(*up_to)
    classes = scratch.keep(classes.withColumn("_before_class", F.coalesce(F.sum("_sum").over(by_class), F.lit(0))).drop("_sum"), "classes")
    cells = scratch.keep(cells.withColumn("_before_cell", F.coalesce(F.sum("_sum").over(by_cell), F.lit(0))).drop("_sum"), "cells")
    starts = scratch.keep(_matched(cells, classes, ["_source", "_class"]), "starts")

    placed = _matched(rows, starts, ["_source", "_class", "_cell"])
    within = Window.partitionBy("_source", "_class", "_cell").orderBy("_digest", "doc_id", "_size").rowsBetween(*up_to)
    start = F.col("_offset") + F.col("_before_class") + F.col("_before_cell") + F.coalesce(F.sum("_rate").over(within), F.lit(0))
    placed = placed.withColumn("_start", start)
    crossed = F.floor((F.col("_start") + F.col("_rate")) / F.lit(PART)) - F.floor(F.col("_start") / F.lit(PART))
    return placed.withColumn("_copies", crossed.cast("bigint")).select(*docs.columns, "_size", "_source_size", "_target", "_copies")


def _matched(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join in which a null source matches itself."""
    renamed = right.select(*[F.col(k).alias(f"r{k}") for k in keys], *[c for c in right.columns if c not in keys])
    same = [F.col(k).eqNullSafe(F.col(f"r{k}")) for k in keys]
    return left.join(renamed, same).drop(*[f"r{k}" for k in keys])


def mixture(docs: DataFrame) -> DataFrame:
    """What the mix takes of each document, in words with repeats."""
    return mixed(docs.select("doc_id", "text", "source")).select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_copies") * F.col("_size")).alias("taken"),
    )


def copies(docs: DataFrame) -> DataFrame:
    """Each document as often as the mix takes it, with its own columns, whatever these are called."""
    return with_extras_aside(docs, _copies)


def _copies(docs: DataFrame) -> DataFrame:
    taken = mixed(docs).where("_copies > 0")
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))


#: The same rows in SQL: one window over a source in place of three steps.
MIXTURE_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^{SPACE}]+')), 0)::BIGINT AS size FROM documents
), per AS (
  SELECT source, count(*) AS n_docs, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight,
    {MOST_COPIES} * source_size AS most, sum(source_size) OVER ()::BIGINT AS total FROM per
), shared AS (
  SELECT *, (total - coalesce(sum(most) OVER before, 0)::BIGINT)::DOUBLE
    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS share
  FROM weighed WINDOW before AS (ORDER BY most::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size, least(most::DOUBLE,
    weight * (SELECT arg_min(share, most::DOUBLE / weight) FROM shared WHERE share * weight <= most)) AS target,
    ceil(sqrt(n_docs))::BIGINT AS cells,
    ('0x' || substr(md5(concat_ws(':', '{SEED}', source)), 1, 6))::BIGINT AS start
  FROM shared
), rated AS (
  SELECT s.*, t.source_size, t.target, t.start, CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size * {PART}) ELSE 0 END::BIGINT AS rate,
    length(bin(s.size)) * 8 + (CASE substr(bin(s.size), 1, 3) WHEN '0' THEN 0 WHEN '1' THEN 1 WHEN '10' THEN 2 WHEN '11' THEN 3
      WHEN '100' THEN 4 WHEN '101' THEN 5 WHEN '110' THEN 6 ELSE 7 END) AS class,
    md5(coalesce(doc_id::VARCHAR, '')) AS digest,
    floor((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT * t.cells) / 4294967296.0)::BIGINT AS cell
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), summed AS (
  SELECT *, start + sum(rate) OVER (PARTITION BY source ORDER BY class, cell, digest, doc_id, size ROWS UNBOUNDED PRECEDING)::BIGINT AS upto FROM rated
)
SELECT doc_id, size, source_size, target, (upto // {PART} - (upto - rate) // {PART}) * size AS taken FROM summed
"""
