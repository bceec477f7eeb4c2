"""Quality by n-gram perplexity: modified Kneser-Ney over four characters, per language.

The n-grams are runs of four UTF-16 units, upper and lower case apart, so one 64-bit number names an
n-gram without collisions and holds its prefix and suffix in its bits. Spark counts them over all
documents and derives the lower orders and discounts. The model is a pair of arrays for each
language, n-gram numbers in order and their log probabilities.

No text vouches for itself: n-grams that only one text of a language and its copies hold, told by the
least and the greatest digest of the texts that hold them, score as if they had not been counted.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.scratch import Scratch, with_extras_aside

ORDER = 4
UNIT = 16
#: Characters taken together in a task, and n-grams a task gathers before it sends them on.
PIECE = 1_000_000
GATHERED = 2_000_000
#: Most n-grams (16 bytes each) that are sent to every executor; a larger model is joined instead.
MOST_SENT = 12_000_000
#: Bands around the middle log perplexity of a language, in spreads. A spread is the distance from the lower
#: quarter to the middle, on which bad texts have no bearing, and this share of the middle at least.
LOWER, UPPER = 8.0, 16.0
LEAST_SPREAD = 0.06
FEWEST_WORDS = 50
MOST_REPEATED = 50
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """N-gram numbers of some texts one after the other, and how many each text has."""
    units = [np.frombuffer(text.encode("utf-16-le", "surrogatepass"), "<u2") for text in texts]
    sizes = np.fromiter(map(len, units), np.int64, len(units))
    joined = np.concatenate(units) if units else np.empty(0, "<u2")
    if len(joined) < ORDER:
        return np.empty(0, np.int64), np.zeros(len(texts), np.int64)
    wide = joined.astype(np.uint64)
    numbers = np.zeros(len(wide) - ORDER + 1, np.uint64)
    for k in range(ORDER):
        numbers |= wide[k : k + len(numbers)] << np.uint64(UNIT * (ORDER - 1 - k))
    owner = np.repeat(np.arange(len(units), dtype=np.int32), sizes)
    inside = owner[: len(numbers)] == owner[ORDER - 1 :]
    return numbers[inside].view(np.int64), np.maximum(sizes - ORDER + 1, 0)


def _pieces(frame: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """Rows of one language at a time, about ``PIECE`` characters."""
    for _, part in frame.groupby("lang", sort=False, dropna=False):
        filled = part["text"].str.len().cumsum() // PIECE
        for _, piece in part.groupby(filled, sort=False):
            yield piece


def _summed(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Numbers in order, each once, with their counts summed and the least and greatest digest of their texts."""
    numbers, weights, low, high = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(numbers)
    numbers = numbers[order]
    first = np.flatnonzero(np.r_[True, numbers[1:] != numbers[:-1]])
    return numbers[first], np.add.reduceat(weights[order], first), np.minimum.reduceat(low[order], first), np.maximum.reduceat(high[order], first)


def _count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    gathered: dict[str, list[tuple[np.ndarray, ...]]] = {}
    held = 0

    def rows():
        for lang, parts in gathered.items():
            found = _summed(parts)
            for at in range(0, len(found[0]), 100_000):
                yield pd.DataFrame({"lang": lang, **{name: column[at : at + 100_000] for name, column in zip(("ngram", "n", "low", "high"), found)}})

    for frame in frames:
        for piece in _pieces(frame):
            texts = piece["text"].tolist()
            numbers, sizes = ngrams(texts)
            if not len(numbers):
                continue
            digests = [zlib.crc32(text.encode("utf-8", "surrogatepass")) for text in texts]
            digests = np.repeat(np.array(digests, np.uint32).view(np.int32), sizes)
            parts = gathered.setdefault(piece["lang"].iloc[0], [])
            parts.append(_summed([(numbers, np.ones(len(numbers), np.int64), digests, digests)]))
            held += len(parts[-1][0])
            if held > GATHERED:
                gathered = {lang: [_summed(parts)] for lang, parts in gathered.items()}
                held = sum(len(parts[0][0]) for parts in gathered.values())
                if held > GATHERED // 2:
                    yield from rows()
                    gathered, held = {}, 0
    yield from rows()


def _text() -> Column:
    return F.coalesce("text", F.lit("")).alias("text")


def _lang() -> Column:
    """Documents without a language form one of their own."""
    return F.coalesce("lang", F.lit("")).alias("lang")


def counted(docs: DataFrame) -> DataFrame:
    """``lang, ngram, n, low, high``: how often each n-gram occurs, and the least and greatest digest of the
    texts that hold it; gathered in the tasks before the shuffle."""
    found = docs.select(_text(), _lang()).mapInPandas(_count, "lang string, ngram bigint, n bigint, low int, high int")
    return found.groupBy("lang", "ngram").agg(F.sum("n").alias("n"), *_digests())


def _digests() -> list[Column]:
    return [F.min("low").alias("low"), F.max("high").alias("high")]


def kneser_ney(counts: DataFrame, scratch: Scratch) -> DataFrame:
    """``lang, ngram, p, logp``: the interpolated modified Kneser-Ney probability, and the natural log for scoring.

    Below the highest order, a count is the number of different units that precede an n-gram.
    Discounts come from the counts of counts of each order and language; where those are too few,
    they are 0.5, 1 and 1.5. The score of an n-gram that only one text holds leaves its count out: what the
    context spares for new units goes to the shorter n-gram, and all of it if that text alone has the context.
    """
    orders = {ORDER: scratch.keep(counts, f"count{ORDER}")}
    for order in range(ORDER - 1, 0, -1):
        shorter = F.col("ngram").bitwiseAND(F.lit((1 << (UNIT * order)) - 1))
        fewer = orders[order + 1].groupBy("lang", shorter.alias("ngram")).agg(F.count("*").alias("n"), *_digests())
        orders[order] = scratch.keep(fewer, f"count{order}")
    units = orders[1].groupBy("lang").agg(F.count("*").alias("units"))
    even = (1 / F.col("units")).alias("p")
    below = scratch.keep(units.select("lang", F.lit(0).cast("bigint").alias("ngram"), even, even.alias("left_out")), "p0")
    for order in range(1, ORDER + 1):
        below = scratch.keep(_order(orders[order], below, order, scratch), f"p{order}")
        scratch.drop(f"p{order - 1}")
        scratch.drop(f"count{order}")
    return below.select("lang", "ngram", "p", F.log("left_out").alias("logp"))


def _order(counts: DataFrame, below: DataFrame, order: int, scratch: Scratch) -> DataFrame:
    of = [F.sum(F.when(F.col("n") == k, 1).otherwise(0)).cast("double") for k in (1, 2, 3, 4)]
    found = counts.groupBy("lang").agg(*[c.alias(f"n{k}") for k, c in enumerate(of, 1)])
    usual = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    discounts = found.select(
        "lang",
        *[
            F.coalesce(
                F.when((F.col(f"n{k}") > 0) & (F.col(f"n{k + 1}") > 0), F.greatest(F.lit(0.05), F.least(F.lit(k - 0.05), k - (k + 1) * usual * F.col(f"n{k + 1}") / F.col(f"n{k}")))),
                F.lit(k / 2),
            ).alias(f"d{k}")
            for k in (1, 2, 3)
        ],
    )
    # One row for each language; written, so that Spark knows its size and need not deal rows by language.
    discounts = scratch.keep(discounts, "discounts")
    discount = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    rows = counts.join(discounts, "lang").select(
        "lang", "ngram", "n", "low", "high", discount.alias("d"), F.shiftrightunsigned("ngram", UNIT).alias("prefix"),
        F.col("ngram").bitwiseAND(F.lit((1 << (UNIT * (order - 1))) - 1)).alias("suffix"),
    )
    contexts = rows.groupBy("lang", "prefix").agg(
        F.sum("n").alias("total"), F.sum("d").alias("left"), (F.min("low") == F.max("high")).alias("single")
    )
    lower = below.select("lang", F.col("ngram").alias("suffix"), F.col("p").alias("below"), F.col("left_out").alias("below_out"))
    p = (F.col("n") - F.col("d") + F.col("left") * F.col("below")) / F.col("total")
    spared = F.when(F.col("single"), F.col("below_out")).otherwise(F.col("left") * F.col("below_out") / F.col("total"))
    left_out = F.when(F.col("low") == F.col("high"), spared).otherwise(p)
    return rows.join(contexts, ["lang", "prefix"]).join(lower, ["lang", "suffix"]).select("lang", "ngram", p.alias("p"), left_out.alias("left_out"))


def _base(text: str) -> tuple[int, int, int, int, int]:
    """Words, their characters, symbols, repeated lines and words in repeated windows of three."""
    words = text.encode("utf-8", "surrogatepass").split()
    letters = len(text) - sum(map(text.count, BLANKS))
    symbols = sum(map(text.count, SYMBOLS))
    seen, again = set(), 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            again += line in seen
            seen.add(line)
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        often = Counter(windows)
        last = -1
        for at, window in enumerate(windows):
            if often[window] > 1:
                repeated += at + 3 - max(at, last)
                last = at + 3
    return len(words), letters, symbols, again, repeated


_COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_ngrams", "log_loss"]
_KIND = "struct<" + ",".join(f"{name}:{'double' if name == 'log_loss' else 'bigint'}" for name in _COLUMNS) + ">"


#: A model without n-grams, for a language that was not there when they were counted.
_UNKNOWN = (np.zeros(1, np.int64), np.full(1, np.log(0.5)))


def _measured(frame: pd.DataFrame, model: dict[str, tuple[np.ndarray, np.ndarray]]) -> pd.DataFrame:
    frame = frame.reset_index(drop=True)
    parts = []
    for piece in _pieces(frame):
        texts = piece["text"].tolist()
        part = pd.DataFrame([_base(text) for text in texts], columns=_COLUMNS[:5], index=piece.index)
        numbers, sizes = ngrams(texts)
        loss = np.zeros(len(texts))
        if len(numbers) and model:
            known, logp = model.get(piece["lang"].iloc[0], _UNKNOWN)
            some = np.flatnonzero(sizes)
            starts = np.r_[0, np.cumsum(sizes[some])[:-1]]
            at = np.minimum(np.searchsorted(known, numbers), len(known) - 1)
            found = np.where(known[at] == numbers, logp[at], logp.min())
            loss[some] = -np.add.reduceat(found, starts)
        parts.append(part.assign(n_ngrams=sizes, log_loss=loss))
    return pd.concat(parts).sort_index() if parts else pd.DataFrame(columns=_COLUMNS)


def _with_measures(docs: DataFrame, sent) -> DataFrame:
    @F.pandas_udf(_KIND)
    def measure(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for text, lang in batches:
            yield _measured(pd.DataFrame({"text": text, "lang": lang}), sent.value if sent else {})

    return docs.withColumn("_m", measure(_text(), _lang()))


def _arrays(model: DataFrame) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """The model, whose size was checked, as arrays in the order of the n-gram numbers."""
    rows = model.toArrow().to_pandas().sort_values(["lang", "ngram"])
    return {lang: (part["ngram"].to_numpy(), part["logp"].to_numpy()) for lang, part in rows.groupby("lang")}


def measured(docs: DataFrame, scratch: Scratch, most_sent: int = MOST_SENT) -> DataFrame:
    """The documents with a struct ``_m`` of their base counts, ``n_ngrams`` and ``log_loss`` in all.

    A model of up to ``most_sent`` n-grams goes to the executors as arrays. For a larger one the
    n-grams of each document are counted, joined with the model and summed up, with the same result.
    The frame is read twice; where it gives other rows the second time, as after a limit, an n-gram that was
    not counted is taken for the rarest of its language.
    """
    model = scratch.keep(kneser_ney(counted(docs), scratch).select("lang", "ngram", "logp"), "model")
    scratch.drop(f"p{ORDER}")
    if model.count() <= most_sent:
        return _with_measures(docs, docs.sparkSession.sparkContext.broadcast(_arrays(model)))
    rows = scratch.keep(_with_measures(docs, None).withColumn("_row", F.monotonically_increasing_id()), "rows")

    def own(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row, lang, text in zip(frame["_row"], frame["lang"], frame["text"]):
                numbers, _ = ngrams([text])
                known, often = np.unique(numbers, return_counts=True)
                yield pd.DataFrame({"_row": row, "lang": lang, "ngram": known, "often": often})

    found = rows.select("_row", _lang(), _text()).mapInPandas(own, "_row bigint, lang string, ngram bigint, often bigint")
    least = scratch.keep(model.groupBy("lang").agg(F.min("logp").alias("least")), "least")
    found = found.join(model, ["lang", "ngram"], "left").join(least, "lang", "left")
    logp = F.coalesce("logp", "least", F.lit(float(_UNKNOWN[1][0])))
    losses = found.groupBy("_row").agg((-F.sum(F.col("often") * logp)).alias("_loss"))
    filled = F.col("_m").withField("log_loss", F.coalesce("_loss", F.lit(0.0)))
    return rows.join(losses, "_row", "left").withColumn("_m", filled).drop("_row", "_loss")


def judged(docs: DataFrame, lower: float = LOWER, upper: float = UPPER) -> DataFrame:
    """The documents with a struct ``_m``: base counts, ``base_failed``, ``log_perplexity`` and ``kept``.

    A document is kept if the base counts pass and its log perplexity is at most ``lower`` spreads below
    and ``upper`` above the middle one of its language, both taken among documents that pass the base counts. Null texts are empty and fail; a null language is one of its own;
    repeated rows are judged each, and copies do not make their own n-grams likely; texts shorter than an
    n-gram have no perplexity and are judged by the base counts. Very long texts are read whole. If a
    language has one text only, nothing else vouches for it and it is its own middle. An empty table
    gives no rows. All columns are kept.
    """
    scratch = Scratch(docs.sparkSession, "perplexity")
    rows = scratch.keep(measured(docs, scratch), "measured")
    per = F.when(F.col("_m.n_ngrams") > 0, F.col("_m.log_loss") / F.col("_m.n_ngrams"))
    failed = (F.col("_m.n_words") < FEWEST_WORDS) | (100 * F.col("_m.n_repeat_words") > MOST_REPEATED * F.col("_m.n_words"))
    fair = rows.where(~failed).select(_lang().alias("_lang"), per.alias("_per"))
    quarters = fair.groupBy("_lang").agg(F.percentile_approx("_per", [0.25, 0.5], 10_000).alias("_at"))
    middle = F.col("_at")[1]
    bands = quarters.select("_lang", middle.alias("_middle"), F.greatest(middle - F.col("_at")[0], LEAST_SPREAD * middle).alias("_spread"))
    bands = scratch.keep(bands, "bands")
    off = (per - F.col("_middle")) / F.col("_spread")
    inside = F.coalesce(off.between(-lower, upper), F.lit(True))
    verdict = F.col("_m").withField("log_perplexity", per).withField("base_failed", failed).withField("kept", ~failed & inside)
    joined = rows.withColumn("_lang", _lang()).join(bands, "_lang", "left")
    return joined.withColumn("_m", verdict).select(*docs.columns, "_m")


def verdicts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the verdict of every row with what it rests on."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "log_perplexity"]
    return judged(docs.select("doc_id", "text", "lang")).select("doc_id", *[f"_m.{name}" for name in names])


def passed(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with their own columns, whatever these are called."""
    return with_extras_aside(docs, lambda rows: judged(rows).where("_m.kept"))
