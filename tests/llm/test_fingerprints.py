"""Sketches against exact sets of shingles."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from sluiceway.llm import fingerprints as fp


def shingles(text):
    words = (text or "").replace("\t", " ").replace("\n", " ").split(" ")
    words = [w for w in words if w]
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def words(n, seed):
    rng = random.Random(seed)
    return " ".join(rng.choice("abcdefghij") + str(rng.randrange(300)) for _ in range(n))


TEXTS = [None, "", " \n", "one", "one", "a b c d", "a b c d e", "a b c d e f", words(90, 1), words(90, 1) + " end", words(900, 2), "x " * 400, "é\tß\nz 😀 q r s"]


def test_edited_pairs_follow_each_other(spark, documents):
    docs = documents([(10 * i, t) for i, t in enumerate(TEXTS)])
    got = {r.doc_id: r for r in fp.edited_pairs(docs.withColumn("sketch", F.lit(1)).withColumn("next", F.lit(2))).collect()}
    assert len(got) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        text, following = text or "", TEXTS[(i + 1) % len(TEXTS)] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        row = got[10 * i]
        assert row.n_chars == len(text)
        assert row.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for other, near in ((edited, row.near_edited), (following, row.near_next)):
            a, b = shingles(text), shingles(other)
            exact = len(a & b) / len(a | b) if a | b else 1.0
            assert near == pytest.approx(exact, abs=1e-12 if len(a | b) <= fp.SKETCH else 0.15)
    assert got[30].fingerprint == got[40].fingerprint != ""
    assert got[0].fingerprint == got[10].fingerprint == ""


def test_order_over_many_blocks(spark, documents):
    ids = random.Random(3).sample(range(-(10**12), 10**12), 700)
    docs = documents([(i, f"w{i}") for i in ids]).repartition(7)
    ordered = sorted(ids)
    follower = dict(zip(ordered, ordered[1:] + ordered[:1]))
    rows = fp.with_next(docs, "doc_id", lambda d, *also: d.select("doc_id", "text", *also)).collect()
    assert {r.doc_id: r.next.doc_id for r in rows} == follower


def test_odd_tables(spark, documents):
    assert fp.edited_pairs(documents([])).count() == 0
    alone = fp.edited_pairs(documents([(1, "a b c d e f")])).collect()
    assert [r.near_next for r in alone] == [1.0]
    loose = fp.edited_pairs(documents([(None, "a b"), (None, "a b"), (None, None)])).collect()
    assert len(loose) == 3
    repeated = fp.edited_pairs(documents([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (2, "d")])).collect()
    assert sorted(str(r.doc_id) for r in repeated) == ["1", "1", "1", "2", "None"]


def test_estimates(spark):
    a, b = words(3000, 5), words(3000, 6)
    mixed = a + " " + b
    row = spark.createDataFrame([(a, b, mixed)], "a string, b string, m string")
    sa, sb, sm = (fp.sketch(F.col(c)) for c in "abm")
    got = row.select(
        fp.distinct_shingles(sm).alias("n"),
        fp.containment(sa, sm).alias("inside"),
        fp.resemblance(sa, sm).alias("near"),
        (fp.merged(sa, sb) == sm).alias("same"),
    ).first()
    assert got.n == pytest.approx(len(shingles(mixed)), rel=0.3)
    assert got.inside > 0.75
    assert got.near == pytest.approx(0.5, abs=0.15)


def test_parts_merge_to_the_whole(spark):
    parts = spark.createDataFrame([(k % 2, words(60, k)) for k in range(40)] + [(2, None)], "key int, text string")
    whole = fp.merge_parts(parts.select("key", fp.sketch(F.col("text")).alias("sketch")), ["key"])
    got = {r.key: r.sketch for r in whole.collect()}
    rows = parts.select("key", F.explode_outer(fp.sketch(F.col("text"), size=10**6)).alias("h")).distinct().collect()
    for key in (0, 1):
        assert got[key] == sorted(r.h for r in rows if r.key == key)[: fp.SKETCH]
    assert got[2] == []
