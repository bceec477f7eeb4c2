"""Perplexity, toxicity and token spans against brute force."""

import math
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken

from sluiceway.llm import perplexity, token_spans, toxicity
from sluiceway.llm.scratch import Scratch

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")


def brute_losses(texts):
    """Log loss of each text under modified Kneser-Ney of order 4, straight from the formulas.

    An n-gram that one distinct text holds alone scores by what remains when that text is not counted.
    """
    grams = [[t[i : i + 4] for i in range(len(t) - 3)] for t in texts]
    counts, holders = {4: Counter(g for gs in grams for g in gs)}, {4: defaultdict(set)}
    for t, gs in zip(texts, grams):
        for g in gs:
            holders[4][g].add(t)
    for n in (3, 2, 1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
        holders[n] = defaultdict(set)
        for g, held in holders[n + 1].items():
            holders[n][g[1:]] |= held
    p = {"": 1 / len(counts[1])}
    q = dict(p)
    for n in (1, 2, 3, 4):
        of = Counter(counts[n].values())
        d = {}
        for k in (1, 2, 3):
            if of[k] and of[k + 1]:
                y = of[1] / (of[1] + 2 * of[2])
                d[k] = min(k - 0.05, max(0.05, k - (k + 1) * y * of[k + 1] / of[k]))
            else:
                d[k] = k / 2
        total, left, around = defaultdict(int), defaultdict(float), defaultdict(set)
        for g, c in counts[n].items():
            total[g[:-1]] += c
            left[g[:-1]] += d[min(c, 3)]
            around[g[:-1]] |= holders[n][g]
        above = {g: (c - d[min(c, 3)] + left[g[:-1]] * p[g[1:]]) / total[g[:-1]] for g, c in counts[n].items()}
        spared = {g: q[g[1:]] * (1 if len(around[g[:-1]]) == 1 else left[g[:-1]] / total[g[:-1]]) for g in counts[n]}
        p, q = above, {g: spared[g] if len(holders[n][g]) == 1 else above[g] for g in above}
    return [-sum(math.log(q[g]) for g in gs) for gs in grams]


def some_texts(n, seed=0):
    rng = random.Random(seed)
    return [" ".join(rng.choice(["the", "hen", "ate", "ten", "Äpfel", "in", "a"]) for _ in range(rng.randrange(0, 80))) for _ in range(n)]


def test_kneser_ney_and_both_ways_of_scoring(spark, documents):
    texts = some_texts(30) + ["", "a", "abc", "zebra xylophone zebra", "zebra xylophone zebra", "😀😀", None]
    docs = documents(list(enumerate(texts)))
    wanted = brute_losses(texts[:-2])
    for most_sent in (10**6, 0):
        rows = perplexity.measured(docs, Scratch(spark, "test"), most_sent).collect()
        got = {r.doc_id: r._m for r in rows}
        assert len(got) == len(texts)
        # The pair of surrogates adds one n-gram to the model, so scores agree up to its weight.
        for i, loss in enumerate(wanted):
            assert got[i].log_loss == pytest.approx(loss, rel=0.02, abs=1e-6)


def test_base_counts_and_bands(spark, documents):
    line = " ".join(f"w{k}" for k in range(60))
    texts = [line, line + "\n" + line + "\n\n", "x " * 80, "a|b #1 " * 30, None, "", "one two", line + "\x0bq"]
    rows = {r.doc_id: r for r in perplexity.verdicts(documents(list(enumerate(texts)))).collect()}
    assert (rows[0].n_words, rows[0].n_dup_lines, rows[0].n_repeat_words, rows[0].base_failed) == (60, 0, 0, False)
    assert (rows[1].n_words, rows[1].n_dup_lines, rows[1].n_repeat_words, rows[1].base_failed) == (120, 1, 120, True)
    assert (rows[2].n_repeat_words, rows[2].word_chars, rows[2].kept) == (80, 80, False)
    assert rows[3].n_symbols == 60
    assert all(rows[k].base_failed and not rows[k].kept for k in (4, 5, 6))
    assert rows[7].n_words == 61
    normal = some_texts(40, 3)
    odd = "".join(chr(0x4E00 + k) for k in range(3000))
    docs = documents([(k, t + " " + line) for k, t in enumerate(normal)] + [(99, " ".join(odd[k : k + 5] for k in range(0, 3000, 5)))])
    kept = {r.doc_id for r in perplexity.passed(docs).collect()}
    assert set(range(40)) <= kept
    assert perplexity.passed(documents([])).count() == 0
    assert perplexity.passed(documents([(1, line)], lang=None)).columns == docs.columns


def test_gibberish_goes_and_documents_stay(spark):
    """Random letters, letters out of order and copies of either, planted into the documents of four languages."""
    rng = random.Random(1)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    known = defaultdict(list)
    for row in docs.collect():
        known[row.lang] += (row.text or "").split()
    letters = "abcdefghijklmnopqrstuvwxyz"
    planted = []
    for k in range(40):
        lang = ("en", "de", "fr", "es")[k % 4]
        random_letters = ["".join(rng.choices(letters, k=rng.randrange(2, 11))) for _ in range(200)]
        shuffled = ["".join(rng.sample(w, len(w))) for w in rng.choices(known[lang], k=200)]
        planted += [(10_000 + k, " ".join(random_letters), lang), (20_000 + k, " ".join(shuffled), lang)]
    copied = [(30_000 + k, *planted[k % 8][1:]) for k in range(40)]
    both = docs.unionByName(spark.createDataFrame(planted + copied, docs.schema))
    found = perplexity.verdicts(both).collect()
    gibberish = [r.kept for r in found if r.doc_id >= 10_000]
    clean = [r.kept for r in found if r.doc_id < 10_000 and not r.base_failed]
    assert len(gibberish) == 120 and sum(gibberish) <= 0.1 * len(gibberish)
    assert len(clean) > 800 and sum(clean) >= 0.99 * len(clean)


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = _next(row, i, x, b)
    return row[-1]


def _next(row, i, x, b):
    new = [i]
    for j, y in enumerate(b, 1):
        new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
    return new


def test_automaton_is_levenshtein():
    rng = random.Random(5)
    terms = [("idiot", True), ("scum", True), ("worthless", True), ("idle", False), ("worst", True)]
    lexicon = toxicity.Lexicon(terms)
    words = [w for w, _ in terms] + ["idleness", "idlx", "scumm"]
    for _ in range(3000):
        word = list(rng.choice(terms)[0])
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(word) + 1)
            word[at : at + rng.randrange(2)] = rng.choice(["", "x", "i", "o"])
        words.append("".join(word))
    for word in words:
        exact = any((w == word) if whole else word.startswith(w) for w, whole in terms)
        near = any(whole and len(w) >= toxicity.EDITABLE and levenshtein(w, word) <= 1 for w, whole in terms)
        assert lexicon.match(word) == (2 if exact else 1 if near else 0), word


def test_context_and_scores(spark, documents):
    lexicon = toxicity.Lexicon([("idiot", True)])
    abuse, near = toxicity.features("you idiot", lexicon), toxicity.features("you idoit idiott", lexicon)
    quoted = toxicity.features('she wrote "idiot" there', lexicon)
    assert abuse[0] > quoted[0] > 0 and abuse[2] == 0 < quoted[2]
    assert near[0] == 0 < near[1]
    rng = random.Random(1)
    rows, marks = [], []
    for k in range(400):
        toxic = k % 4 == 0
        words = [f"w{rng.randrange(500)}" for _ in range(30)] + ["scumbag", "moron"] * toxic
        rng.shuffle(words)
        rows.append((k, " ".join(words)))
        marks.append((k, 1, int(toxic)))
    labels = spark.createDataFrame(marks + [(None, 1, 1), (7, 1, None)], "doc_id bigint, quality int, toxic int")
    docs = documents(rows + [(1000, "w1 moron scumbag"), (1001, ""), (1002, None), (None, "moron scumbag")])
    found = toxicity.predictions(docs, labels).collect()
    by_id = {r.doc_id: r for r in found}
    assert all(0 <= r.score <= 1 for r in found) and len(found) == 404
    assert all(by_id[k].predicted == (k % 4 == 0) for k in range(400))
    assert by_id[1000].predicted == 1 and by_id[1001].predicted == 0 and by_id[1001].score == by_id[1002].score
    # Labels of held-out rows change nothing.
    turned = [(i, q, 1 - t if by_id[i].held_out else t) for i, q, t in marks]
    again = toxicity.predictions(docs, spark.createDataFrame(turned, "doc_id bigint, quality int, toxic int")).collect()
    assert sorted(r.score for r in again) == sorted(r.score for r in found)
    assert toxicity.clean(docs, labels.limit(0)).count() == 404
    assert toxicity.predictions(documents([]), labels).count() == 0


def test_quoted_terms_count_one_at_most():
    lexicon = toxicity.Lexicon([("idiot", True), ("moron", True), ("scumbag", True)])
    one = toxicity.weighed([toxicity.features("you idiot", lexicon)])[0, 0]
    report = 'he wrote "idiot" and "moron" there, and they called us "scumbag" or "scumbog" for long. '
    for times in (1, 5, 2_000):
        assert 0 < toxicity.weighed([toxicity.features(report * times, lexicon)])[0, 0] <= one
    # What is said outright beside a quotation counts in full.
    mixed = report + "w " * 20 + "you idiot you moron " + "w " * 20 + report
    assert toxicity.weighed([toxicity.features(mixed, lexicon)])[0, 0] > one


def test_token_spans(spark, documents):
    encoding = tiktoken.Encoding(
        "t", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks={__import__("base64").b64decode(a): int(b) for a, b in map(bytes.split, open(BYTE_BPE, "rb"))},
    )
    texts = ["", None, "one line", "a b\nc d\n\n\n  é ß\n", "\n", "x \n y", "😀\n😀 ok", "tail\n\nend"]
    rows = token_spans.by_line(documents(list(enumerate(texts))), BYTE_BPE, public_tokenizers.PATTERN).collect()
    for k, text in enumerate(texts):
        text = text or ""
        mine = sorted((r.section, r.start, r.length, r.n_tokens) for r in rows if r.doc_id == k)
        assert sum(n for *_, n in mine) == len(encoding.encode_ordinary(text))
        assert "".join(text[s : s + n] for _, s, n, _ in mine) == text
        owner = [i for i, s, n, _ in mine for _ in text[s : s + n].encode()]
        at, wanted = 0, Counter()
        for token in encoding.encode_ordinary(text):
            size = len(encoding.decode_single_token_bytes(token))
            held = Counter(owner[at : at + size])
            wanted[min(held, key=lambda s: (-held[s], s))] += 1
            at += size
        assert [n for *_, n in mine] == [wanted[i] for i, *_ in mine]
    with pytest.raises(ValueError):
        token_spans.attributed(documents([]), BYTE_BPE, public_tokenizers.PATTERN, rule="?")
