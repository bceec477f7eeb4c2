"""Token counts by section: whole documents are encoded once and token spans joined with sections.

The vocabulary is a byte-level one, so the tokens of a text lie end to end over its bytes and their
spans follow from their lengths. Spans are mapped to characters and met with the sections of the
same document by binary search, so nothing of a document is compared with all of another.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes encoded at a time; texts are cut where a line starts, which no token of the pattern looks behind.
PIECE = 1_000_000
MOST, FIRST = "most", "first"

_loaded: dict[int, tuple[tiktoken.Encoding, np.ndarray]] = {}


class Encoder:
    """Encoder of a rank file, sent to tasks as the file's bytes, whose size documents do not change."""

    def __init__(self, docs: DataFrame, path: str, pattern: str):
        with open(path, "rb") as file:
            data = file.read()
        self.id, self.pattern = hash((data, pattern)), pattern
        self.sent = docs.sparkSession.sparkContext.broadcast(data)

    def loaded(self) -> tuple[tiktoken.Encoding, np.ndarray]:
        if self.id not in _loaded:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in self.sent.value.splitlines() if line)}
            sizes = np.zeros(max(ranks.values()) + 1, np.int64)
            for token, rank in ranks.items():
                sizes[rank] = len(token)
            _loaded.clear()
            _loaded[self.id] = tiktoken.Encoding("spans", pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={}), sizes
        return _loaded[self.id]


def lines(text: str) -> list[tuple[int, int]]:
    """Start and end, in characters, of every line with the line end that closes it; an empty text has one empty line."""
    found, at = [], 0
    while (end := text.find("\n", at)) >= 0:
        found.append((at, end + 1))
        at = end + 1
    return found + [(at, len(text))] if at < len(text) or not found else found


def token_ends(text: str, encoding: tiktoken.Encoding, sizes: np.ndarray) -> np.ndarray:
    """Ends of all tokens of a text, in bytes."""
    return np.cumsum(sizes[encoding.encode_to_numpy(text, disallowed_special=())])


def allotted(starts: np.ndarray, ends: np.ndarray, tokens: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and those of them that reach over its bounds.

    ``starts`` and ``ends`` are the sections in order and without overlap, ``tokens`` the ends of
    tokens that begin at 0, all in one unit. ``first`` gives a token to the section that holds its
    first unit. ``most`` gives it to the section that holds most of it, among equals to the
    earliest. A token that no section holds any of, or whose first unit is in none, counts nowhere.
    """
    begin = np.r_[0, tokens[:-1]] if len(tokens) else tokens
    own, crossing = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    if not len(starts) or not len(tokens):
        return own, crossing
    low = np.searchsorted(ends, begin, "right")
    high = np.searchsorted(starts, tokens, "left") - 1
    inside = (low <= high) & (low < len(starts))
    chosen = np.where(inside, np.minimum(low, len(starts) - 1), -1)
    if rule == FIRST:
        chosen[inside & (starts[np.maximum(chosen, 0)] > begin)] = -1
    else:
        for k in np.flatnonzero(inside & (high > low)):
            some = np.arange(low[k], high[k] + 1)
            held = np.minimum(ends[some], tokens[k]) - np.maximum(starts[some], begin[k])
            chosen[k] = some[np.argmax(held)]
    known = chosen >= 0
    at = chosen[known]
    np.add.at(own, at, 1)
    np.add.at(crossing, at[(starts[at] > begin[known]) | (ends[at] < tokens[known])], 1)
    return own, crossing


def _sections(text: str, bounds: list[tuple[int, int]], encoding, sizes, rule: str) -> list[dict]:
    data = text.encode("utf-8", "replace")
    tokens = token_ends(data.decode("utf-8"), encoding, sizes)
    limits = np.array(bounds, np.int64).reshape(-1, 2)
    if len(data) != len(text):
        # Byte at which each character starts, and the end of the text.
        raw = np.frombuffer(data, np.uint8)
        limits_in_bytes = np.r_[np.flatnonzero((raw & 0xC0) != 0x80), len(raw)][limits]
    else:
        limits_in_bytes = limits
    own, crossing = allotted(limits_in_bytes[:, 0], limits_in_bytes[:, 1], tokens, rule)
    return [
        {"section": k, "start": start, "length": end - start, "n_tokens": n, "n_crossing": c}
        for k, ((start, end), n, c) in enumerate(zip(limits.tolist(), own.tolist(), crossing.tolist()))
    ]


def attributed(docs: DataFrame, path: str, pattern: str, sections: Callable[[str], list[tuple[int, int]]] = lines, rule: str = MOST) -> DataFrame:
    """The documents, one row for each section: ``section, start, length`` in characters, ``n_tokens, n_crossing``.

    ``sections`` gives the bounds of a text in order and without overlap. A token over a bound goes to
    one section, by ``rule``, so the counts of a document add up to its tokens where its sections
    cover it. Null texts are empty; repeated rows are counted each; an empty table gives no rows.
    """
    if rule not in (MOST, FIRST):
        raise ValueError(f"unknown rule {rule}")
    encoder = Encoder(docs, path, pattern)
    kind = "array<struct<section:bigint,start:bigint,length:bigint,n_tokens:bigint,n_crossing:bigint>>"

    @F.pandas_udf(kind)
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoding, sizes = encoder.loaded()
        for texts in batches:
            yield pd.Series([_sections(text or "", sections(text or ""), encoding, sizes, rule) for text in texts])

    return docs.select(*docs.columns, F.explode(count("text")).alias("_t"))


def by_line(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id`` and the tokens of each line of its text."""
    return attributed(docs.select("doc_id", "text"), path, pattern).select("doc_id", "_t.*")
