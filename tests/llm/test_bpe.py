"""Codes and decoded text against the tokenizers library."""

import hashlib
import json
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sluiceway.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
LETTERS = "abcdeéàßΣσςİıǅ٣१'’ \t\n\x0b\x1c\x85<|>endoftext😀👍🏽中文字한국어é̀ﬁ½²_#-.0123'sS'T K Å"


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(7)
    made = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 80))) for _ in range(1500)]
    odd = [None, "", " ", "a<|endoftext|>b <|startoftext|><|ENDOFTEXT|>", "ΑΣ ΟΔΟΣ", "a" * 70, "ab" * 3000, "\x00\x01", "don't we'll"]
    return made + odd


def expected(library, text):
    found = library.encode(text or "", add_special_tokens=False)
    return found.ids, library.decode(found.ids, skip_special_tokens=False)


def test_both_ways_of_merging(library, texts):
    vocabulary = bpe.Vocabulary(json.load(open(PATH)))
    for text, digest in zip(texts, vocabulary.digests(texts)):
        ids, decoded = expected(library, text)
        assert vocabulary.encode(text) == ids
        assert vocabulary.decode(ids) == decoded
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), decoded)]
        assert digest == (len(ids), *sha)


def test_words_are_forgotten(library, texts, monkeypatch):
    monkeypatch.setattr(bpe, "WORDS_KEPT", 50)
    monkeypatch.setattr(bpe, "PIECE", 300)
    vocabulary = bpe.Vocabulary(json.load(open(PATH)))
    counts = [count for count, _, _ in vocabulary.digests(texts)]
    assert counts == [len(expected(library, text)[0]) for text in texts]


def test_tree_gives_the_leftmost_lowest():
    rng = random.Random(4)
    for size in (1, 2, 3, 5, 16, 17):
        ranks = [rng.choice([1, 2, 3, bpe.NO_RANK]) for _ in range(size)]
        tree = bpe.PairTree(list(ranks))
        for _ in range(60):
            low = min(ranks)
            assert tree.first() == (-1 if low == bpe.NO_RANK else ranks.index(low))
            at = rng.randrange(size)
            ranks[at] = rng.choice([1, 2, 3, bpe.NO_RANK])
            tree.set(at, ranks[at])


def test_frames(spark, documents, library, texts):
    docs = documents(list(enumerate(texts)) + [(0, texts[0])])
    rows = bpe.digests(docs, PATH).collect()
    assert len(rows) == len(texts) + 1
    for row in rows:
        assert row.n_tokens == len(expected(library, texts[row.doc_id])[0])
    back = bpe.decoded(bpe.encoded(docs, PATH), PATH).select("doc_id", "ids", "decoded").collect()
    for row in back:
        assert (row.ids, row.decoded) == expected(library, texts[row.doc_id])
    assert bpe.digests(documents([]), PATH).count() == 0
