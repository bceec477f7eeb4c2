"""Runs of words against a brute force over all periods, and the index against comparing word by word."""

import hashlib
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from sluiceway.llm import periodic_runs


def brute(words):
    """``(start, length, period)`` of every run: for each period the longest stretches that agree with themselves moved on."""
    found = {}
    for p in range(1, len(words) // 2 + 1):
        i = 0
        while i + p < len(words):
            k = i
            while k + p < len(words) and words[k] == words[k + p]:
                k += 1
            if k - i + p >= max(12, 2 * p):
                found.setdefault((i, k - i + p), p)
            i = k + 1
    return sorted((s, n, p) for (s, n), p in found.items())


def wanted(doc_id, text, edit=True):
    words = [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]
    h = zlib.crc32(str(doc_id).encode())
    if edit and doc_id is not None and h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    dropped = {i for s, n, p in runs for i in range(s + p, s + n)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    digest = lambda t: hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest()
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in sorted(runs, key=lambda r: (r[0], r[2])))
    collapsed = " ".join(w for i, w in enumerate(words) if i not in dropped)
    one = (None,) * 4 if best is None else (best[0], best[1], best[2], 1000 * best[1] // best[2])
    return (doc_id, len(runs), *one, digest(listed), digest(collapsed))


def made(rng, n):
    """A text of few words with repeated pieces in it."""
    words = [rng.choice("abc") for _ in range(n)]
    for _ in range(rng.randrange(4)):
        piece = [rng.choice("abcde") for _ in range(rng.randrange(1, 9))] * rng.randrange(1, 12)
        at = rng.randrange(len(words) + 1)
        words[at:at] = piece
    return rng.choice([" ", "\n", " \t"]).join(words)


def test_cover_has_all_differences():
    cover, modulus = periodic_runs.COVER, periodic_runs.MODULUS
    assert {(a - b) % modulus for a in cover for b in cover} == set(range(modulus))


def test_extensions_compare_word_by_word():
    rng = random.Random(1)
    for n in (2, 30, 31, 62, 400):
        numbers = np.array([rng.randrange(2) for _ in range(n)] * 3 + [9])
        extend = periodic_runs.Extensions(numbers)
        a, b = (np.array(x) for x in zip(*[(i, j) for i in range(0, len(numbers), 5) for j in range(len(numbers)) if i != j]))
        got = extend(a, b)
        for i, j, k in list(zip(a, b, got))[:: max(1, len(a) // 3000)]:
            m = 0
            while max(i, j) + m < len(numbers) and numbers[i + m] == numbers[j + m]:
                m += 1
            assert k == m


def test_runs_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [(k, made(rng, rng.randrange(0, 90))) for k in range(400)]
    rows += [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "a " * 11), (1004, "a " * 12), (1005, "é b " * 7), (1005, "é b " * 7)]
    rows += [(None, "x y " * 9), (1006, "  " * 30), (1007, "a b c " * 4), (1008, " ".join(map(str, range(50))))]
    rows += [(2000 + k, " ".join([str(i) for i in range(30)] * k)) for k in range(1, 4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    docs = docs.withColumn("runs", F.lit("x")).withColumn("start", F.lit(7))
    names = ["doc_id", *periodic_runs.COLUMNS]
    found = periodic_runs.periodic(docs, edit=True)
    assert found.columns == names
    order = lambda rows: sorted(rows, key=repr)
    got = [(r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in found.collect()]
    assert order(got) == order(wanted(*row) for row in rows)
    plain = [tuple(r[n] for n in ("doc_id", "n_runs", "runs_sha256")) for r in periodic_runs.periodic(docs).collect()]
    assert order(plain) == order((w[0], w[1], w[6]) for w in (wanted(*row, edit=False) for row in rows))
    assert periodic_runs.periodic(docs.limit(0)).count() == 0


def test_a_very_long_text(monkeypatch):
    rng = random.Random(3)
    words = [str(rng.randrange(40)).encode() for _ in range(9_000)]
    words[500:500] = words[:3_000] * 3
    monkeypatch.setattr(periodic_runs, "PAIRS", 5_000)
    (result,) = periodic_runs.described([words])
    runs = brute([w.decode() for w in words])
    assert result[0] == len(runs)
    assert result[1:4] == max(runs, key=lambda r: r[1])


def test_given_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    small = {r.doc_id: r.text for r in docs.collect() if len(r.text or "") < 6_000}
    got = {r.doc_id: tuple(r) for r in periodic_runs.periodic(docs, edit=True).collect() if r.doc_id in small}
    for doc_id, text in small.items():
        want = wanted(doc_id, text)
        r = got[doc_id]
        assert (r[0], r[1], r[2], r[3], r[4], r[5], r[6], r[7]) == want
