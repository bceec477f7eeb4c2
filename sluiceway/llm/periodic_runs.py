"""Periodic runs of words: a difference-cover index answers extensions, a harmonic grid finds the runs.

Only suffixes at sampled places are sorted. Two places are moved on together, by fewer words than the
cover's modulus, until both are sampled; from there on the least common prefix of the sorted suffixes
between them tells how far they agree. For every period, pairs of places one period apart are looked at
once in a period, so a text of n words has about n log n pairs, nearly all of which differ at once.

Every row is worked on alone. Python takes texts from Arrow batches and lays those of up to ``CHUNK`` words
end to end, with a word between them that occurs once, so that short texts share their numpy calls. A very
long text is a chunk of its own and takes memory in proportion to its words; a lost executor costs its
tasks, which give the same rows again.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Least number of words in a run; a run also has at least two periods.
LEAST = 12
#: Difference cover: every difference modulo ``MODULUS`` is that of two members of ``COVER``.
MODULUS = 31
COVER = (0, 1, 3, 8, 12, 18)
#: Words that are worked on together, and pairs of places looked at together.
CHUNK = 200_000
PAIRS = 1_000_000

_shift = {(a - b) % MODULUS: a for a in COVER for b in COVER}
#: For a difference of two places modulo MODULUS, the member of the cover the further one is moved to.
_MEET = np.array([_shift[d] for d in range(MODULUS)], np.int64)
_SAMPLED = np.isin(np.arange(MODULUS), COVER)


class Extensions:
    """How far two places of a sequence of numbers agree.

    The last number must occur once. Only places whose residue is in the cover are sorted.
    """

    def __init__(self, numbers: np.ndarray):
        self.numbers = numbers
        places = np.arange(len(numbers))
        self.places = places[_SAMPLED[places % MODULUS]]
        self.of = np.full(len(numbers), -1, np.int64)
        self.of[self.places] = np.arange(len(self.places))
        self._sort()

    def _sort(self) -> None:
        """Ranks of sampled suffixes by doubling, then the prefixes neighbours share and their table of minima."""
        count, size = len(self.places), len(self.numbers)
        padded = np.zeros(size + MODULUS, ">u4")
        padded[:size] = self.numbers + 1
        windows = np.lib.stride_tricks.sliding_window_view(padded, MODULUS)[self.places]
        blocks = np.ascontiguousarray(windows).view(np.dtype((np.void, 4 * MODULUS))).ravel()
        _, ranks = np.unique(blocks, return_inverse=True)
        ranks = ranks.astype(np.int64)
        levels, step = [ranks], MODULUS
        while ranks.max(initial=0) + 1 < count:
            pair = ranks * (count + 1) + self._following(ranks, step)
            _, ranks = np.unique(pair, return_inverse=True)
            levels.append(ranks)
            step *= 2
        self.rank = ranks
        order = np.empty(count, np.int64)
        order[ranks] = np.arange(count)
        self.minima = [self._neighbours(order, levels)]
        width = 1
        while 2 * width <= len(self.minima[0]):
            last = self.minima[-1]
            self.minima.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def _following(self, ranks: np.ndarray, step: int) -> np.ndarray:
        """Rank, from 1, of the suffix ``step`` words on, which is sampled as well; 0 behind the end."""
        ahead = self.places + step
        inside = ahead < len(self.numbers)
        found = np.zeros(len(ranks), np.int64)
        found[inside] = ranks[self.of[ahead[inside]]] + 1
        return found

    def _neighbours(self, order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Words that each sampled suffix shares with the next one in order."""
        size = len(self.numbers)
        a, b = self.places[order[:-1]], self.places[order[1:]]
        shared = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            x, y = a + shared, b + shared
            inside = np.maximum(x, y) < size
            same = inside.copy()
            same[inside] = levels[k][self.of[x[inside]]] == levels[k][self.of[y[inside]]]
            shared += np.where(same, MODULUS << k, 0)
        return shared + self._compared(a + shared, b + shared, np.full(len(a), MODULUS))

    def _compared(self, a: np.ndarray, b: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """Words that agree one by one, up to a number for each pair."""
        agreed, numbers, size = np.zeros(len(a), np.int64), self.numbers, len(self.numbers)
        left = np.arange(len(a))
        for k in range(int(upto.max(initial=0))):
            left = left[(upto[left] > k) & (np.maximum(a[left], b[left]) + k < size)]
            left = left[numbers[a[left] + k] == numbers[b[left] + k]]
            if not len(left):
                break
            agreed[left] = k + 1
        return agreed

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Number of words from ``a`` and from ``b`` on that agree; the two of a pair are different places."""
        meet = (_MEET[(a - b) % MODULUS] - a) % MODULUS
        agreed = self._compared(a, b, meet)
        on = np.flatnonzero(agreed == meet)
        on = on[np.maximum(a[on], b[on]) + meet[on] < len(self.numbers)]
        if len(on):
            x = self.rank[self.of[a[on] + meet[on]]]
            y = self.rank[self.of[b[on] + meet[on]]]
            low, high = np.minimum(x, y), np.maximum(x, y)
            level = np.frexp((high - low).astype(np.float64))[1] - 1
            for k in np.unique(level):
                some = level == k
                table = self.minima[k]
                least = np.minimum(table[low[some]], table[high[some] - (1 << int(k))])
                agreed[on[some]] += least
        return agreed


class _Lazy:
    """Extensions that are built when a pair first agrees on a word."""

    def __init__(self, numbers: np.ndarray):
        self.numbers, self.built = numbers, None

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        agreed = np.zeros(len(a), np.int64)
        some = np.flatnonzero(self.numbers[a] == self.numbers[b])
        if len(some):
            self.built = self.built or Extensions(self.numbers)
            agreed[some] = self.built(a[some], b[some])
        return agreed


def _grid(starts: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Place, period and text of every pair: places 0, p, 2p and so on of each text, for every period p."""
    for text, (start, size) in enumerate(zip(starts.tolist(), sizes.tolist())):
        if size >= LEAST:
            periods = np.arange(1, size // 2 + 1)
            numbers = (size - 1) // periods
            ends = np.cumsum(numbers)
            begin = 0
            while begin < len(periods):
                done = ends[begin - 1] if begin else 0
                stop = max(int(np.searchsorted(ends, done + PAIRS, "right")), begin + 1)
                some = numbers[begin:stop]
                nth = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
                p = np.repeat(periods[begin:stop], some)
                yield start + nth * p, p, np.full(len(p), text)
                begin = stop


def _gathered(parts: Iterator[tuple[np.ndarray, ...]]) -> Iterator[tuple[np.ndarray, ...]]:
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size >= PAIRS:
            yield tuple(map(np.concatenate, zip(*held)))
            held, size = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


def runs(numbers: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pd.DataFrame:
    """``text, start, period, length`` of all runs in texts laid end to end, by text, start and period.

    ``numbers`` are the words, each text followed by a number that occurs once. Starts count from the
    text's first word.
    """
    ahead = _Lazy(numbers)
    back = _Lazy(numbers[::-1])
    last = len(numbers) - 1
    found = []
    for place, period, text in _gathered(_grid(starts, sizes)):
        first = starts[text]
        begins = numbers[place] == numbers[place + period]
        before = place > first
        before[before] = numbers[place[before] - 1] == numbers[place[before] + period[before] - 1]
        some = np.flatnonzero(begins | before)
        place, period, text = place[some], period[some], text[some]
        forth = ahead(place, place + period)
        # What stands before a text's first word is the single word that ends the text before it.
        behind = np.zeros(len(place), np.int64)
        inner = np.flatnonzero(place > starts[text])
        behind[inner] = back(last - place[inner] + 1, last - (place[inner] + period[inner]) + 1)
        # Of the places a run holds, the first one counts; it has less than a period behind it.
        good = (behind < period) & (forth + behind >= np.maximum(period, LEAST - period))
        found.append(np.stack([text, place - behind - starts[text], period, period + forth + behind], 1)[good])
    rows = np.concatenate(found) if found else np.zeros((0, 4), np.int64)
    frame = pd.DataFrame(rows, columns=["text", "start", "period", "length"])
    # The same stretch is found again at multiples of its smallest period.
    frame = frame.sort_values(["text", "start", "length", "period"]).drop_duplicates(["text", "start", "length"])
    return frame.sort_values(["text", "start", "period"], ignore_index=True)


def edited(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The words, those of every tenth document by the CRC of its id made periodic; a null id is never one.

    With h the CRC, g = h // 10 and n words, word i from a = g % n on becomes word a + (i - a) % p
    of the text, where p = 1 + (n - a) // (3 + g % 8).
    """
    if doc_id is None or not words:
        return words
    digest = zlib.crc32(str(doc_id).encode())
    if digest % 10:
        return words
    group, count = digest // 10, len(words)
    at = group % count
    period = 1 + (count - at) // (3 + group % 8)
    return words[:at] + [words[at + k % period] for k in range(count - at)]


COLUMNS = {
    "n_runs": "bigint", "start": "bigint", "length": "bigint", "period": "bigint", "exponent_milli": "bigint",
    "runs_sha256": "string", "collapsed_sha256": "string",
}


def _sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def described(texts: list[list[bytes]]) -> list[tuple]:
    """The columns of ``COLUMNS`` for each text, given as its words."""
    sizes = np.array([len(words) for words in texts], np.int64)
    starts = np.cumsum(sizes + 1) - sizes - 1
    codes, distinct = pd.factorize(np.array([word for words in texts for word in words], dtype=object))
    numbers = np.empty(len(codes) + len(texts), np.int64)
    ends = starts + sizes
    inside = np.ones(len(numbers), bool)
    inside[ends] = False
    numbers[inside] = codes
    numbers[ends] = len(distinct) + np.arange(len(texts))
    found = runs(numbers, starts, sizes)
    bounds = np.searchsorted(found["text"].to_numpy(), np.arange(len(texts) + 1))
    table = found[["start", "length", "period"]].to_numpy()
    results = []
    for k, words in enumerate(texts):
        own = table[bounds[k] : bounds[k + 1]]
        if not len(own):
            results.append((0, None, None, None, None, _sha256(b""), _sha256(b" ".join(words))))
            continue
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, own[:, 0] + own[:, 2], 1)
        np.add.at(change, own[:, 0] + own[:, 1], -1)
        kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
        start, length, period = own[np.lexsort((own[:, 2], own[:, 0], -own[:, 1]))[0]].tolist()
        listed = "".join(f"{s},{n},{p}\n" for s, n, p in own.tolist()).encode()
        collapsed = b" ".join([words[i] for i in kept.tolist()])
        results.append((len(own), start, length, period, 1000 * length // period, _sha256(listed), _sha256(collapsed)))
    return results


def _words(text: str | None) -> list[bytes]:
    # Bytes are parted at exactly the six ASCII characters of white space.
    return (text or "").encode("utf-8", "surrogatepass").split()


def _chunks(rows: Iterator[list[bytes]]) -> Iterator[list[list[bytes]]]:
    held, size = [], 0
    for words in rows:
        if held and size + len(words) > CHUNK:
            yield held
            held, size = [], 0
        held.append(words)
        size += len(words) + 1
    if held:
        yield held


def periodic(docs: DataFrame, edit: bool = False) -> DataFrame:
    """``doc_id`` and ``COLUMNS`` of every document; with ``edit``, of its words as ``edited`` gives them.

    A run is a stretch of at least ``LEAST`` words and two periods that cannot be made longer. Null and
    empty texts have no words and no runs, and the digests of the empty text. Very long texts are taken
    whole. Repeated rows give repeated results, an empty table none; equally long runs are decided by
    start and period; columns other than ``doc_id`` and ``text`` are not read.
    """
    kind = "struct<" + ",".join(f"{name}:{type_}" for name, type_ in COLUMNS.items()) + ">"

    @F.pandas_udf(kind)
    def describe(ids: pd.Series, texts: pd.Series) -> pd.DataFrame:
        # Ids come as text: numbers with nulls among them would become floating.
        rows = (edited(_words(t), None if i is None or not edit else int(i)) for i, t in zip(ids, texts))
        results = [result for chunk in _chunks(rows) for result in described(chunk)]
        frame = pd.DataFrame(results, columns=list(COLUMNS), dtype=object)
        return frame.astype({name: "Int64" for name, type_ in COLUMNS.items() if type_ == "bigint"})

    found = docs.select("doc_id", describe(F.col("doc_id").cast("string"), F.col("text")).alias("runs"))
    return found.select("doc_id", "runs.*")
