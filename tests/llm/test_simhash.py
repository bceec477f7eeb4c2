"""Fingerprints and groups against a brute force over all pairs."""

import random

import xxhash

from sluiceway.llm import simhash


def brute_fingerprint(text):
    found, word = [], b""
    for byte in (text or "").encode() + b" ":
        if byte in b" \t\n\x0b\x0c\r":
            found += [word] if word else []
            word = b""
        else:
            word += bytes([byte + 32 if 65 <= byte <= 90 else byte])
    if not found:
        return 0
    grams = [b" ".join(found[i : i + 3]) for i in range(max(1, len(found) - 2))]
    hashes = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def groups(pairs):
    """Smallest id reachable for each row, by plain search over all pairs."""
    left, result = set(range(len(pairs))), {}
    while left:
        stack, seen = [left.pop()], set()
        while stack:
            at = stack.pop()
            seen.add(at)
            near = {j for j in left if (pairs[at][1] ^ pairs[j][1]).bit_count() <= 2}
            left -= near
            stack += near
        ids = [pairs[k][0] for k in seen if pairs[k][0] is not None]
        for k in seen:
            result[k] = min(ids, default=None)
    return result


TEXTS = [None, "", "  ", "One", "one", "É b", "é B", "a b c", "a b c a b c", "Żółć\x0bx\x1cy z q", "w " * 300]


def test_fingerprint_is_exact():
    rng = random.Random(0)
    texts = TEXTS + [" ".join(rng.choice("ABCdef") * rng.randint(1, 3) for _ in range(rng.randint(0, 90))) for _ in range(200)]
    for text in texts:
        assert simhash.fingerprint_of(text) == brute_fingerprint(text)
    long = " ".join(str(k * k % 9973) for k in range(2 * simhash.PIECE + 5))
    assert simhash.fingerprint_of(long) == brute_fingerprint(long)


def check(docs, rows):
    pairs = [(i, brute_fingerprint(t)) for i, t in rows]
    wanted = groups(pairs)
    expect = sorted((str(i), f"{f:016x}", str(wanted[k])) for k, (i, f) in enumerate(pairs))
    found = simhash.near_duplicates(docs).select("doc_id", simhash.hex_digits().alias("h"), "component_id").collect()
    assert sorted((str(r.doc_id), r.h, str(r.component_id)) for r in found) == expect


def test_groups_of_texts(spark, documents):
    rng = random.Random(1)
    base = [str(rng.randrange(10**6)) for _ in range(200)]
    rows = [(100 + k, t) for k, t in enumerate(TEXTS)]
    for k in range(60):
        edited = list(base)
        for _ in range(k % 4):
            edited[rng.randrange(200)] = "z"
        rows.append((k, " ".join(edited)))
    rows += [(5, rows[-1][1]), (None, "lonely text here"), (None, "lonely text here"), (7, None)]
    check(documents(rows), rows)


def test_crowded_blocks(spark, monkeypatch):
    """A ball of fingerprints around one value, linked by flipped bits, and the same by pairs."""
    from pyspark.sql import functions as F

    rng = random.Random(2)
    values = {0x0F0F << 40}
    for _ in range(300):
        start = rng.choice(sorted(values))
        values.add(start ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64) if rng.random() < 0.4 else 0))
    rows = [(n, v) for n, v in enumerate(sorted(values))]
    wanted = groups(rows)
    frame = spark.createDataFrame([(simhash._signed(v),) for _, v in rows], "fp bigint")
    for paired in (2, 32, 10**6):
        monkeypatch.setattr(simhash, "PAIRED", paired)
        scratch = simhash.Scratch(spark, "test")
        parts = simhash.connected(simhash.links(frame, scratch), scratch).collect()
        label = {simhash._signed(v): simhash._signed(v) for _, v in rows} | {r.node: r.component for r in parts}
        for k, (_, v) in enumerate(rows):
            for j, (_, w) in enumerate(rows):
                same = label[simhash._signed(v)] == label[simhash._signed(w)]
                assert same == (wanted[k] == wanted[j])


def test_one_of_each(spark, documents):
    rows = [(3, "a b c d"), (1, "a b c d"), (1, "a b c d"), (9, None), (8, ""), (None, "q r s t"), (None, "q r s t"), (4, "u v w x y")]
    kept = simhash.one_of_each(documents(rows))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("1", "a b c d"), ("4", "u v w x y"), ("8", ""), ("None", "q r s t")]
    assert simhash.one_of_each(documents([])).count() == 0
