"""Byte-pair encoding and decoding: merges of a word are picked by a segment tree over pair ranks.

The vocabulary file is read on the driver and broadcast: its size is that of the file, whatever the
documents are. Words repeat, so a task keeps the codes of those it has met, up to ``WORDS_KEPT``.
"""

from __future__ import annotations

import gc
import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words whose codes a Python worker keeps; beyond that it forgets all and starts anew.
WORDS_KEPT = 130_000
#: Longer pieces are encoded each time, so that the words kept have a bounded size.
LONGEST_KEPT = 64
#: Characters of texts whose words are encoded together.
PIECE = 1_000_000
#: Letters of a word up to which words are merged side by side, and how many words at a time.
LONGEST_TOGETHER = 33
TOGETHER = 20_000
NO_RANK = 1 << 60
NONE = np.iinfo(np.int32).max

# Fixed value: the file's own pattern, read from it, uses this class of white space.
SPACES = regex.compile(r"\s+")
#: Controls that ``str.split`` takes for white space and the file's rule does not.
ODD_SPACES = regex.compile("[\x1c-\x1f]")


class PairTree:
    """Segment tree over the ranks of adjacent pairs; the root is the leftmost pair of lowest rank."""

    def __init__(self, ranks: list[int]):
        self.leaves = 1 << max(0, len(ranks) - 1).bit_length()
        low = [NO_RANK] * (2 * self.leaves)
        low[self.leaves : self.leaves + len(ranks)] = ranks
        for node in range(self.leaves - 1, 0, -1):
            low[node] = low[2 * node] if low[2 * node] <= low[2 * node + 1] else low[2 * node + 1]
        self.low = low

    def first(self) -> int:
        """Position of the leftmost lowest rank, -1 if no pair can be merged."""
        low = self.low
        if low[1] == NO_RANK:
            return -1
        node = 1
        while node < self.leaves:
            node *= 2
            if low[node] > low[node + 1]:
                node += 1
        return node - self.leaves

    def set(self, position: int, rank: int) -> None:
        low = self.low
        node = position + self.leaves
        low[node] = rank
        node //= 2
        while node:
            left, right = low[2 * node], low[2 * node + 1]
            least = left if left <= right else right
            if low[node] == least:
                break
            low[node] = least
            node //= 2


class Vocabulary:
    """Codes, merge ranks and text rules of a vocabulary file with word ends."""

    def __init__(self, description: dict):
        model = description["model"]
        self.codes: dict[str, int] = model["vocab"]
        self.texts = {code: text for text, code in self.codes.items()}
        pairs = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in model["merges"]]
        self.merges = {
            (self.codes[a], self.codes[b]): (rank, self.codes[a + b]) for rank, (a, b) in enumerate(pairs)
        }
        self.word_end: str = model.get("end_of_word_suffix") or ""
        split = description["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(split)
        self.special = {t["content"]: t["id"] for t in description["added_tokens"]}
        self.texts.update({code: text for text, code in self.special.items()})
        longest_first = sorted(self.special, key=len, reverse=True)
        self.controls = regex.compile("|".join(map(regex.escape, longest_first))) if longest_first else None
        self.inner = [self.codes.get(letter, -1) for letter in byte_letters()]
        self.last = [self.codes.get(letter + self.word_end, -1) for letter in byte_letters()]
        self.complete = min(self.inner + self.last) >= 0
        keys = np.fromiter((a * len(self.codes) + b for a, b in self.merges), np.int64, len(self.merges))
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], order.astype(np.int32)
        self.made = np.fromiter((code for _, code in self.merges.values()), np.int32, len(self.merges))
        self.kept: dict[str, tuple[int, str, str]] = {}
        self.kept_pieces: dict[str, tuple[int, str, str]] = {}

    def normal(self, text: str) -> str:
        """NFC, runs of white space as one space, lower case letter by letter."""
        if text.isascii():
            return SPACES.sub(" ", text).lower() if not text.isalnum() else text.lower()
        text = SPACES.sub(" ", unicodedata.normalize("NFC", text))
        # A whole-text lower() would pick the final form of sigma by its neighbours.
        return text.replace("Σ", "σ").lower()

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merge ranks of pairs of codes, ``NONE`` where there is none or a code is missing (-1)."""
        wanted = left.astype(np.int64) * len(self.codes) + right
        at = np.minimum(np.searchsorted(self.pair_keys, wanted), len(self.pair_keys) - 1)
        return np.where((self.pair_keys[at] == wanted) & (left >= 0) & (right >= 0), self.pair_ranks[at], NONE)

    def encode_pieces(self, pieces: list[str]) -> list[list[int]]:
        """Codes of many words; those of like length climb their segment trees side by side."""
        found: list[list[int]] = [[]] * len(pieces)
        alike: dict[int, list[tuple[int, list[int]]]] = {}
        for n, piece in enumerate(pieces):
            codes = self._letters(piece)
            if len(codes) < 2 or len(codes) > LONGEST_TOGETHER:
                found[n] = self._merged(codes)
            else:
                alike.setdefault(1 << (len(codes) - 2).bit_length(), []).append((n, codes))
        for leaves, words in alike.items():
            for start in range(0, len(words), TOGETHER):
                part = words[start : start + TOGETHER]
                for (n, _), codes in zip(part, self._side_by_side(leaves, [codes for _, codes in part])):
                    found[n] = codes
        return found

    def _side_by_side(self, leaves: int, words: list[list[int]]) -> list[list[int]]:
        width = leaves + 1
        codes = np.full((len(words), width + 1), -1, np.int32)
        for row, word in zip(codes, words):
            row[: len(word)] = word
        following = np.tile(np.arange(1, width + 2, dtype=np.int32), (len(words), 1))
        before = np.tile(np.arange(-1, width, dtype=np.int32), (len(words), 1))
        tree = np.full((len(words), 2 * leaves), NONE, np.int32)
        tree[:, leaves:] = self._ranks(codes[:, :leaves], codes[:, 1:width])
        for node in range(leaves - 1, 0, -1):
            np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1], out=tree[:, node])
        rows = np.flatnonzero(tree[:, 1] < NONE)
        while len(rows):
            node = np.ones(len(rows), np.int64)
            for _ in range(leaves.bit_length() - 1):
                node *= 2
                node += tree[rows, node] > tree[rows, node + 1]
            at = node - leaves
            right = following[rows, at]
            codes[rows, at] = self.made[tree[rows, 1]]
            codes[rows, right] = -1
            after = np.minimum(following[rows, right], width)
            following[rows, at] = after
            before[rows, after] = at
            left = np.maximum(before[rows, at], 0)
            here = codes[rows, at]
            # The last pair of a word has no code behind it, the first none before it.
            self._raise(tree, leaves, rows, right, np.full(len(rows), NONE, np.int32))
            self._raise(tree, leaves, rows, at, self._ranks(here, codes[rows, after]))
            first = before[rows, at] < 0
            self._raise(tree, leaves, rows[~first], left[~first], self._ranks(codes[rows, left], here)[~first])
            rows = rows[tree[rows, 1] < NONE]
        return [[code for code in row if code >= 0] for row in codes.tolist()]

    @staticmethod
    def _raise(tree: np.ndarray, leaves: int, rows: np.ndarray, at: np.ndarray, ranks: np.ndarray) -> None:
        """Sets one leaf of each row's tree and the least ranks above it."""
        inside = at < leaves
        rows, node = rows[inside], at[inside].astype(np.int64) + leaves
        tree[rows, node] = ranks[inside]
        while len(node) and node[0] > 1:
            node //= 2
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    def encode_piece(self, piece: str) -> list[int]:
        """Codes of one word; parts that the vocabulary lacks are left out."""
        return self._merged(self._letters(piece))

    def _letters(self, piece: str) -> list[int]:
        data = piece.encode("utf-8")
        codes = [self.inner[byte] for byte in data]
        codes[-1] = self.last[data[-1]]
        return codes if self.complete else [code for code in codes if code >= 0]

    def _merged(self, codes: list[int]) -> list[int]:
        if len(codes) < 2:
            return codes
        merges = self.merges
        none = (NO_RANK, -1)
        size = len(codes)
        tree = PairTree([merges.get(pair, none)[0] for pair in zip(codes, codes[1:])])
        following = list(range(1, size + 1))
        before = list(range(-1, size - 1))
        while (at := tree.first()) >= 0:
            right = following[at]
            codes[at] = merges[codes[at], codes[right]][1]
            codes[right] = -1
            after = following[right]
            following[at] = after
            if right < size - 1 or after < size:
                tree.set(right, NO_RANK)
            if after < size:
                before[after] = at
                tree.set(at, merges.get((codes[at], codes[after]), none)[0])
            else:
                tree.set(at, NO_RANK)
            if (left := before[at]) >= 0:
                tree.set(left, merges.get((codes[left], codes[at]), none)[0])
        return [code for code in codes if code >= 0]

    def forget(self) -> None:
        """Drops the words kept: the worker lives on after a task, and other tasks need its memory."""
        self.kept.clear()
        self.kept_pieces.clear()

    def encode(self, text: str | None) -> list[int]:
        """Codes of a text; control strings in it become their own codes."""
        found: list[int] = []
        for part, control in self._parts(text or ""):
            for piece in self.pieces.findall(self.normal(part)):
                found += self.encode_piece(piece)
            if control:
                found.append(self.special[control])
        return found

    def decode(self, codes: list[int]) -> str:
        """Texts of the codes with a space between them; the file names no decoder that joins them."""
        return " ".join(self.texts[code] for code in codes if code in self.texts)

    def digests(self, texts: list[str | None]) -> Iterator[tuple[int, str, str]]:
        """Number of codes of each text, and the digests of the codes and of the decoded text.

        Texts are taken together up to ``PIECE`` characters, and the words among them that were not
        met before are encoded at once.
        """
        some: list[list] = []
        size = 0
        for text in texts:
            parts = [(self._words(part), control) for part, control in self._parts(text or "")]
            some.append(parts)
            size += len(text or "")
            if size >= PIECE:
                yield from self._digests(some)
                some, size = [], 0
        yield from self._digests(some)

    @staticmethod
    def _words(text: str) -> list[str]:
        # No piece holds white space, and no rule of a word looks beyond it.
        return SPACES.split(text) if ODD_SPACES.search(text) else text.split()

    def _digests(self, some: list[list]) -> Iterator[tuple[int, str, str]]:
        if len(self.kept) > WORDS_KEPT:
            self.kept.clear()
        met = set().union(*[words for parts in some for words, _ in parts])
        self._learn([word for word in met if word not in self.kept])
        for parts in some:
            coded: list[tuple[int, str, str]] = []
            for words, control in parts:
                coded += map(self.kept.__getitem__, words)
                if control:
                    coded.append((1, str(self.special[control]), control))
            counts, numbers, decoded = zip(*coded) if coded else ((), (), ())
            if 0 in counts:
                numbers, decoded = filter(None, numbers), [text for n, text in zip(counts, decoded) if n]
            yield sum(counts), _sha256(" ".join(numbers)), _sha256(" ".join(decoded))
        for word in [word for word in met if len(word) > LONGEST_KEPT]:
            del self.kept[word]

    def _learn(self, words: list[str]) -> None:
        split = [[word] if word.isalpha() else self.pieces.findall(word) for word in map(self.normal, words)]
        coded = self.kept_pieces
        pieces = [piece for piece in {piece for found in split for piece in found} if piece not in coded]
        for piece, codes in zip(pieces, self.encode_pieces(pieces)):
            coded[piece] = (len(codes), " ".join(map(str, codes)), self.decode(codes))
        for word, found in zip(words, split):
            if len(found) == 1:
                self.kept[word] = coded[found[0]]
            else:
                parts = [coded[piece] for piece in found if coded[piece][0]]
                self.kept[word] = (sum([p[0] for p in parts]), " ".join([p[1] for p in parts]), " ".join([p[2] for p in parts]))
        if len(coded) > WORDS_KEPT:
            coded.clear()
        else:
            for piece in [piece for piece in pieces if len(piece) > LONGEST_KEPT]:
                del coded[piece]

    def _parts(self, text: str) -> Iterator[tuple[str, str]]:
        at = 0
        if self.controls is not None:
            for found in self.controls.finditer(text):
                yield text[at : found.start()], found.group()
                at = found.end()
        yield text[at:], ""


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where printable, else one from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(byte) if byte in plain else chr(next(others)) for byte in range(256)]


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


_loaded: dict[int, Vocabulary] = {}


def _vocabulary(sent) -> Vocabulary:
    """The vocabulary of a broadcast, built once in each Python worker."""
    if sent.id not in _loaded:
        _loaded.clear()
        _loaded[sent.id] = Vocabulary(json.loads(sent.value))
    return _loaded[sent.id]


class _Sent:
    """A broadcast with a name of its own, which survives being sent to a Python worker."""

    def __init__(self, docs: DataFrame, path: str):
        with open(path, encoding="utf-8") as file:
            text = file.read()
        self.id = hash(text)
        self.broadcast = docs.sparkSession.sparkContext.broadcast(text)

    @property
    def value(self) -> str:
        return self.broadcast.value


def digests(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` for every document.

    Null and empty texts have no codes and the digests of the empty text. Repeated rows are encoded
    each; an empty table gives no rows; other columns are ignored.
    """
    sent = _Sent(docs, path)
    kind = "struct<n_tokens:bigint,ids_sha256:string,decoded_sha256:string>"

    @F.pandas_udf(kind)
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        vocabulary = _vocabulary(sent)
        # Words kept are plain tuples without cycles; looking through them for some takes a quarter of the time.
        gc.disable()
        try:
            for texts in batches:
                rows = list(vocabulary.digests(texts))
                yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
        finally:
            vocabulary.forget()
            gc.enable()

    return docs.select("doc_id", digest("text").alias("codes")).select("doc_id", "codes.*")


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """The documents with ``ids array<int>`` in place of other work; null texts give an empty array."""
    sent = _Sent(docs, path)

    @F.pandas_udf("array<int>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocabulary = _vocabulary(sent)
        for texts in batches:
            yield pd.Series([vocabulary.encode(text) for text in texts])

    return docs.withColumn("ids", encode("text"))


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """Rows with ``ids`` and their text in ``decoded``; codes the file lacks are left out."""
    sent = _Sent(rows, path)

    @F.pandas_udf("string")
    def decode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocabulary = _vocabulary(sent)
        for ids in batches:
            yield pd.Series([vocabulary.decode([] if codes is None else [int(c) for c in codes]) for codes in ids])

    return rows.withColumn("decoded", decode("ids"))
