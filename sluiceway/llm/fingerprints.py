"""Document fingerprints: bottom-k sketches of word shingles, on DataFrame functions alone.

A sketch is the ascending array of the ``SKETCH`` smallest distinct 64-bit hashes of a text's
shingles of five words. It is the whole set where a text has fewer. Sketches of parts merge into
the sketch of the whole, and two of them estimate resemblance, containment and the number of
distinct shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceway.llm.scratch import task_count

WORDS = 5
SKETCH = 128
SPACE = "[\\x20\\x09-\\x0D]+"
#: Range blocks for each shuffle partition when documents are put in order.
BLOCKS_PER_PARTITION = 8


def sketch(text: Column, words: int = WORDS, size: int = SKETCH) -> Column:
    """Sketch of a text; null and texts without a word give an empty array.

    Words lie between the ASCII white space. A text with fewer words than a shingle has one shingle,
    the whole sequence. Every word is hashed once and shingles hash the hashes of their words.
    """
    found = F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda word: word != "")
    return _smallest(_shingles(F.transform(found, lambda word: F.xxhash64(word)), words), size)


def _shingles(hashes: Column, words: int) -> Column:
    # The lambda binds the array once; a column used several times would be computed each time.
    def windows(array: Column) -> Column:
        count = F.size(array) - (words - 1)
        rolled = F.transform(
            F.slice(array, 1, F.greatest(count, F.lit(0))),
            lambda first, i: F.xxhash64(first, *[F.get(array, i + k) for k in range(1, words)]),
        )
        short = F.array(F.aggregate(array, F.lit(0).cast("bigint"), lambda so_far, h: F.xxhash64(so_far, h)))
        return F.when(F.size(array) == 0, array).when(count < 1, short).otherwise(rolled)

    return F.transform(F.array(hashes), windows)[0]


def _smallest(hashes: Column, size: int) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, size)


def merged(a: Column, b: Column, size: int = SKETCH) -> Column:
    """Sketch of two texts together."""
    return _smallest(F.concat(a, b), size)


def resemblance(a: Column, b: Column, size: int = SKETCH) -> Column:
    """Estimated share of common shingles among all of both, 0 to 1; two empty texts are alike (1)."""
    together = F.slice(F.sort_array(F.array_union(a, b)), 1, size)
    shared = F.size(F.array_intersect(together, F.array_intersect(a, b)))
    return F.when(F.size(together) == 0, F.lit(1.0)).otherwise(shared / F.size(together))


def distinct_shingles(a: Column, size: int = SKETCH) -> Column:
    """Number of distinct shingles: exact below ``size``, else estimated from the largest hash kept."""
    share = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < size, F.size(a).cast("double")).otherwise((size - 1) / share)


def containment(a: Column, b: Column, size: int = SKETCH) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has too, 0 to 1; an empty ``a`` gives 1."""
    alike, of_a, of_b = resemblance(a, b, size), distinct_shingles(a, size), distinct_shingles(b, size)
    both = alike / (1 + alike) * (of_a + of_b)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), both / of_a))


def encoded(a: Column) -> Column:
    """A sketch as text, 16 hex digits for each hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def merge_parts(parts: DataFrame, keys: list[str], column: str = "sketch", size: int = SKETCH) -> DataFrame:
    """One sketch per key from many: hashes are made distinct, ranked per task, then ranked per key.

    The first ranking keeps ``size`` hashes of a key in each task, so a key with a third of all rows
    costs its last task only that many from each. Keys whose sketches are all empty or null get an
    empty one.
    """
    flat = parts.select(*keys, F.explode_outer(column).alias("_hash")).distinct()
    ranked = flat.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(F.asc_nulls_last("_hash"))))
    return ranked.where(F.col("_rank") <= size).groupBy(*keys).agg(F.sort_array(F.collect_set("_hash")).alias(column))


def with_next(docs: DataFrame, order: str, bring) -> DataFrame:
    """Rows with the columns ``bring(docs)`` names, and ``next`` holding those of the row that follows.

    Rows follow each other by ascending ``order``, ties by text; the first follows the last. A null
    ``order`` has no place: its ``next`` is null. Rows go to range blocks whose bounds are values of
    the column; a row on a bound is sent to the block before it as well, as its last row's successor,
    so one shuffle does and no block waits for another.
    """
    blocks = BLOCKS_PER_PARTITION * task_count(docs.sparkSession)
    shares = [i / blocks for i in range(blocks)]
    placed = docs.where(F.col(order).isNotNull())
    found = placed.agg(F.percentile_approx(order, shares, 20 * blocks), F.min(order), F.max(order)).first()
    bounds = sorted({*(found[0] or []), *([] if found[1] is None else [found[1]])})
    loose = bring(docs.where(F.col(order).isNull()))
    if not bounds:
        return loose.withColumn("next", F.lit(None).cast(loose.schema))
    block = _block(F.col(order), bounds)
    wraps = F.when(F.col(order) == bounds[0], F.array(F.struct(F.lit(len(bounds)).alias("block"), F.lit(1).alias("ghost"))))
    before = F.when(
        F.array_contains(_outer(bounds), F.col(order)) & (F.col(order) > bounds[0]),
        F.array(F.struct((block - 1).alias("block"), F.lit(1).alias("ghost"))),
    )
    own = F.array(F.struct(block.alias("block"), F.lit(0).alias("ghost")))
    none = F.array().cast("array<struct<block:int,ghost:int>>")
    sent = placed.withColumn("_to", F.explode(F.concat(own, F.coalesce(before, wraps, none)))).select("*", "_to.*").drop("_to")
    sent = bring(sent.repartition("block"), "block", "ghost")
    names = [c for c in sent.columns if c not in ("block", "ghost")]
    ordered = Window.partitionBy("block").orderBy("ghost", order, *[c for c in names if c == "text"])
    sent = sent.withColumn("next", F.lead(F.struct(*names)).over(ordered)).where("ghost = 0").drop("block", "ghost")
    return sent.unionByName(loose.withColumn("next", F.lit(None).cast(sent.schema["next"].dataType)))


def _outer(bounds: list) -> Column:
    return F.array(*[F.lit(b).cast("bigint") for b in bounds])


def _block(value: Column, bounds: list) -> Column:
    """Number of bounds up to a value, counted first over every ``step``-th bound and then within that span."""
    step = max(1, round(len(bounds) ** 0.5))
    coarse = _outer(bounds[::step])
    spans = F.array(*[_outer(bounds[i : i + step]) for i in range(0, len(bounds), step)])
    at = F.size(F.filter(coarse, lambda bound: bound <= value))
    return ((at - 1) * step + F.size(F.filter(F.get(spans, at - 1), lambda bound: bound <= value))).cast("int")


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Every document's sketch, that of its edited text, and how alike they and the next document are.

    The edited text keeps the front of a text and takes its last half from the front of the next one.
    Null texts are empty. A document without an id has no next one: its edited text is only cut, and
    ``near_next`` compares it with an empty text. Repeated ids follow each other by text. An empty
    table gives no rows; other columns of the input are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def bring(rows: DataFrame, *also: str) -> DataFrame:
        return rows.select("doc_id", "text", sketch(F.col("text")).alias("sketch"), *also)

    rows = with_next(docs, "doc_id", bring)
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("n_chars", F.char_length("text").cast("bigint"))
    follows = F.coalesce(F.col("next.text"), F.lit(""))
    edited = F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring(follows, F.lit(1), half))
    rows = rows.withColumn("edited", edited).withColumn("edited_sketch", sketch(F.col("edited")))
    next_sketch = F.coalesce(F.col("next.sketch"), F.array().cast("array<bigint>"))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        encoded(F.col("sketch")).alias("fingerprint"),
        encoded(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), next_sketch).alias("near_next"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("kept_share"),
        distinct_shingles(F.col("sketch")).alias("distinct_shingles"),
    )
