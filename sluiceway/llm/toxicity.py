"""Toxicity from a lexicon: misspellings by Levenshtein automata on a trie, scored by context.

Terms are learned from labelled documents: words, and beginnings of words where many endings occur.
An automaton that accepts the trie's terms with up to one edit is built state by state while words
are read. What a document says counts less inside quotation or after words of reporting.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.scratch import with_extras_aside

#: Most labelled documents of either label that the terms and the classifier are fitted on.
FIT_ROWS = 6_000
#: Letters of the shortest and the longest beginning of a word.
SHORTEST, LONGEST = 4, 8
#: A term occurs in this share of the toxic sample at least, and this many times as often as in the clean one.
LEAST_SHARE, LEAST_RATIO = 0.005, 15.0
#: Least log likelihood ratio of a term's labels against those of the sample, so that chance makes no term.
LEAST_EVIDENCE = 12.0
#: Terms from this length on are matched with one edit.
EDITABLE = 5
#: What a misspelled term counts, as a share of a term. Labels that hold no misspellings cannot teach it.
NEAR = 0.7
#: A form this often in words of clean rows of the sample is no misspelling, unless it marks toxic ones as a term does.
ORDINARY = 2
#: Words looked at on either side of a hit, what a quoted hit counts, and what all of a text's count together at
#: most, so that a report of many terms says no more than one term outright.
WINDOW = 6
QUOTED, MOST_QUOTED = 0.3, 1.0
THRESHOLD = 0.3
#: States kept of the automaton, and words known to hold no term, before a worker starts anew.
MOST_STATES, WORDS_KEPT = 50_000, 100_000

# Words that report what others say, and marks that open or close a quotation.
REPORTING = {"said", "says", "called", "calls", "wrote", "quote", "quoted", "word", "term", "insult", "slur", "sagte", "nannte", "wort",
             "zitat", "dit", "appelé", "mot", "terme", "dijo", "llamó", "palabra", "término"}
MARKS = "\"“”„«»‘’"
#: Digits and signs between letters stay in a word, which also is read as the pieces beside them.
WORD = re.compile(r"[^\W\d_]+(?:[\d_@$!*#€|+]{1,2}[^\W\d_]+)*")
PIECE = re.compile(r"[^\W\d_]+")


class Lexicon:
    """Terms and, of each, whether it is a whole word or the beginning of one.

    A state of the automaton is a set of (trie node, edits so far). States that follow from one
    another are kept, so that a letter of a text costs one look-up. ``ordinary`` forms are no misspellings.
    """

    def __init__(self, terms: list[tuple[str, bool]], ordinary: Iterable[str] = ()):
        self.ordinary = frozenset(ordinary)
        self.children: list[dict[str, int]] = [{}]
        self.whole: list[bool] = [False]
        self.begins: list[bool] = [False]
        self.editable: list[bool] = [False]
        for term, whole in terms:
            node = 0
            path = []
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    for values in (self.whole, self.begins, self.editable):
                        values.append(False)
                    self.children.append({})
                node = self.children[node][letter]
                path.append(node)
            if whole:
                self.whole[node] = True
            else:
                self.begins[node] = True
            if len(term) >= EDITABLE:
                for node in (0, *path):
                    self.editable[node] = True
        self._restart()
        self.clean: set[str] = set()

    def _restart(self) -> None:
        self.numbers: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.moves: list[dict[str, int]] = []
        self.results: list[int] = []
        self.begun: list[bool] = []
        self.nearly: list[set[str]] = []
        self.start = self._number(self._closed({(0, 0)}))

    def _closed(self, state: set[tuple[int, int]]) -> frozenset:
        """With the letters of terms that a misspelling leaves out."""
        for node, edits in list(state):
            if edits == 0:
                state |= {(child, 1) for child in self.children[node].values() if self.editable[child]}
        return frozenset((node, edits) for node, edits in state if not (edits and (node, 0) in state))

    def _number(self, state: frozenset) -> int:
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
            self.moves.append({})
            self.nearly.append(set())
            exact = any(edits == 0 and self.whole[node] for node, edits in state)
            near = any(edits == 1 and self.whole[node] and self.editable[node] for node, edits in state)
            self.results.append(2 if exact else 1 if near else 0)
            self.begun.append(any(edits == 0 and self.begins[node] for node, edits in state))
        return self.numbers[state]

    def _move(self, number: int, letter: str) -> int:
        following = set()
        for node, edits in self.states[number]:
            child = self.children[node].get(letter)
            if child is not None:
                following.add((child, edits))
                if edits and self.begins[child] and self.editable[child]:
                    self.nearly[number].add(letter)
            if edits == 0:
                if self.editable[node]:
                    following.add((node, 1))  # a letter too many
                following |= {(other, 1) for other in self.children[node].values() if self.editable[other]}
        found = self._number(self._closed(following)) if following else -1
        self.moves[number][letter] = found
        return found

    def match(self, word: str) -> int:
        """2 for a term or a word that begins like one, 1 for either with one edit, else 0.

        The edit of a beginning lies before its last letter, since any letter may follow a shorter one.
        """
        exact, forms = self.forms(word)
        return 2 if exact else int(bool(forms))

    def forms(self, word: str) -> tuple[bool, set[str]]:
        """Whether a word matches exactly; if not, what in it is a misspelled term: all of it or how it begins."""
        state, found = self.start, set()
        for at, letter in enumerate(word, 1):
            if (following := self.moves[state].get(letter)) is None:
                following = self._move(state, letter)
            if following < 0:
                return False, found
            if letter in self.nearly[state]:
                found.add(word[:at])
            state = following
            if self.begun[state]:
                return True, set()
        if self.results[state] == 2:
            return True, set()
        return False, found | {word} if self.results[state] else found

    def _read(self, word: str) -> int:
        """How a word or one of its pieces matches."""
        read = [self.forms(part) for part in {word, *PIECE.findall(word)}]
        return 2 if any(exact for exact, _ in read) else int(any(forms - self.ordinary for _, forms in read))

    def hits(self, words: list[str]) -> dict[str, int]:
        """Words that match, and how."""
        if len(self.states) > MOST_STATES:
            self._restart()
        if len(self.clean) > WORDS_KEPT:
            self.clean.clear()
        found = {}
        for word in set(words) - self.clean:
            if how := self._read(word):
                found[word] = how
            elif len(word) <= 32:
                self.clean.add(word)
        return found


def features(text: str | None, lexicon: Lexicon) -> tuple[float, float, float]:
    """Exact and misspelled abuse and quoted terms in a text, each damped by a logarithm."""
    text = (text or "").lower()
    found = lexicon.hits(WORD.findall(text))
    if not found:
        return 0.0, 0.0, 0.0
    spans = [(m.group(), m.start()) for m in WORD.finditer(text)]
    marks = np.array([m.start() for m in re.finditer(f"[{MARKS}]", text)], np.int64)
    outright, cited = [0.0, 0.0], [0.0, 0.0]
    for k, (word, start) in enumerate(spans):
        if how := found.get(word):
            first = spans[max(0, k - WINDOW)][1]
            last, tail = spans[min(len(spans) - 1, k + WINDOW)]
            before = np.searchsorted(marks, start) - np.searchsorted(marks, first)
            after = np.searchsorted(marks, last and tail + len(last)) - np.searchsorted(marks, start)
            quotes = (before > 0 and after > 0) or any(other in REPORTING for other, _ in spans[max(0, k - WINDOW) : k])
            (cited if quotes else outright)[how == 1] += 1.0
    # Exact quoted terms take their part of what quoted ones may count first.
    exact = min(QUOTED * cited[0], MOST_QUOTED)
    near = min(QUOTED * cited[1], MOST_QUOTED - exact)
    return math.log1p(outright[0] + exact), math.log1p(outright[1] + near), math.log1p(sum(cited))


def weighed(found: list[tuple[float, float, float]]) -> np.ndarray:
    """Abuse and quotation for each text; a misspelled term is ``NEAR`` of a term, in one damped sum."""
    exact, near, quoted = np.array(found, float).reshape(len(found), 3).T
    return np.c_[np.log1p(np.expm1(exact) + NEAR * np.expm1(near)), quoted]


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from; a row without an id is none of them."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text, toxic`` of at most ``FIT_ROWS`` labelled documents of either label, by a digest of their ids."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.select("doc_id", "toxic").distinct()

    def some(label: int) -> DataFrame:
        return known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS)

    chosen = some(0).unionByName(some(1))
    # At most twice FIT_ROWS rows of two numbers, whatever the tables hold.
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id").select("text", "toxic")


def learned_terms(rows: DataFrame, n_clean: int, n_toxic: int) -> list[tuple[str, bool]]:
    """Words and beginnings of words that mark the toxic rows of a sample."""
    if not n_clean or not n_toxic:
        return []
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("(\\p{L}+)"), 1))
    words = rows.select("toxic", F.monotonically_increasing_id().alias("row"), F.explode(words).alias("word"))
    starts = F.transform(F.sequence(F.lit(SHORTEST), F.lit(LONGEST)), lambda n: F.when(F.char_length("word") > n, F.substring("word", F.lit(1), n)))
    tagged = F.concat(F.array(F.struct(F.col("word").alias("term"), F.lit(True).alias("whole"))), F.transform(F.array_compact(starts), lambda s: F.struct(s.alias("term"), F.lit(False).alias("whole"))))
    terms = words.select("toxic", "row", F.explode(tagged).alias("t")).select("toxic", "row", "t.term", "t.whole")
    # A word begins a row's terms once; a beginning that several of its words share counts once too.
    once = terms.where("whole").unionByName(terms.where("not whole").distinct())
    counts = once.groupBy("term", "whole").agg(F.sum("toxic").alias("n"), F.sum(1 - F.col("toxic")).alias("m"))
    ratio = (F.col("n") / n_toxic) / ((F.col("m") + 0.5) / n_clean)
    both, toxic_share = F.col("n") + F.col("m"), n_toxic / (n_toxic + n_clean)
    evidence = F.col("n") * F.log(F.col("n") / (both * toxic_share))
    evidence += F.when(F.col("m") > 0, F.col("m") * F.log(F.col("m") / (both * (1 - toxic_share)))).otherwise(0)
    counts = counts.where((F.col("n") > 0) & (evidence >= LEAST_EVIDENCE))
    counts = counts.where((F.col("n") >= max(3, LEAST_SHARE * n_toxic)) & (ratio >= LEAST_RATIO) & (F.char_length("term") >= 3))
    # All terms that pass; the sample bounds them, as each is in several of its rows.
    best = counts.select("term", "whole", "n").collect()
    words = {r.term: r.n for r in best if r.whole}
    begins = {r.term: r.n for r in best if not r.whole}
    longest: dict[str, int] = {}
    for term, n in {**begins, **words}.items():
        for size in range(SHORTEST, min(len(term), LONGEST + 1)):
            longest[term[:size]] = max(longest.get(term[:size], 0), n)
    chosen: list[tuple[str, bool]] = []
    begun: set[str] = set()
    for term in sorted({*words, *begins}, key=lambda t: (len(t), t)):
        if any(term[:size] in begun for size in range(SHORTEST, LONGEST + 1)):
            continue
        if term in begins and longest.get(term, 0) < 0.9 * begins[term] and words.get(term, 0) < 0.9 * begins[term]:
            begun.add(term)
            chosen.append((term, False))
        elif term in words:
            chosen.append((term, True))
    return chosen


def _fit(x: np.ndarray, y: np.ndarray, share: float) -> np.ndarray:
    """Ridge logistic regression by Newton steps, its intercept moved to the share of toxic labels among all."""
    x = np.c_[np.ones(len(x)), x]
    beta = np.zeros(x.shape[1])
    ridge = np.diag([1e-6] + [0.05] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge, x.T @ (y - p) - ridge @ beta)
        beta += step
        if np.abs(step).max() < 1e-9:
            break
    in_sample = y.mean()
    beta[0] += math.log(share / (1 - share)) - math.log(in_sample / (1 - in_sample))
    # More abuse never lowers a score; quotation alone never raises it.
    return np.r_[beta[0], max(beta[1], 1.0), min(beta[2], 0.0)]


def ordinary_forms(rows: DataFrame, n_clean: int, n_toxic: int, terms: list[tuple[str, bool]]) -> list[str]:
    """Words and beginnings of the clean rows of a sample that look like misspelled terms and are none."""

    def resembling(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = Lexicon(terms)
        for frame in frames:
            found = [(form, n, m) for word, n, m in zip(frame["word"], frame["n"], frame["m"]) for form in lexicon.forms(word)[1]]
            yield pd.DataFrame(found, columns=["form", "n", "m"])

    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit("(\\p{L}+)"), 1))
    words = rows.select("toxic", F.explode(words).alias("word"))
    words = words.groupBy("word").agg(F.sum("toxic").alias("n"), F.sum(1 - F.col("toxic")).alias("m"))
    forms = words.mapInPandas(resembling, "form string, n bigint, m bigint").groupBy("form").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    ratio = (F.col("n") / n_toxic) / ((F.col("m") + 0.5) / n_clean)
    return sorted(r.form for r in forms.where((F.col("m") >= ORDINARY) & (ratio < LEAST_RATIO)).collect())


def fitted(docs: DataFrame, labels: DataFrame) -> tuple[list[tuple[str, bool]], list[str], list[float]]:
    """Terms, ordinary forms like them, and weights; without labels of both kinds there are no terms and the score is their share, 0 without any."""
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    total, toxic = usable.agg(F.count("*"), F.sum("toxic")).first()
    rows = sample(docs, labels)
    by_label = {r.toxic: r["count"] for r in rows.groupBy("toxic").count().collect()}
    terms = learned_terms(rows, by_label.get(0, 0), by_label.get(1, 0))
    share = (toxic or 0) / total if total else 0.0
    if not terms:
        return [], [], [math.log((share + 1e-6) / (1 - share + 1e-6)), 0.0, 0.0]
    ordinary = ordinary_forms(rows, by_label.get(0, 0), by_label.get(1, 0), terms)

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = Lexicon(terms, ordinary)
        for frame in frames:
            found = [features(text, lexicon) for text in frame["text"]]
            yield pd.DataFrame(found, columns=["exact", "near", "quoted"]).assign(toxic=frame["toxic"].to_numpy())

    seen = rows.mapInPandas(measure, "exact double, near double, quoted double, toxic int").toPandas()
    seen = seen.sort_values(list(seen.columns))
    x = weighed(seen[["exact", "near", "quoted"]].to_numpy())
    return terms, ordinary, _fit(x, seen["toxic"].to_numpy(float), share).tolist()


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents with ``_score``, 0 to 1.

    Only labels of rows that are not held out are learned from, and only the text makes a score. Null
    texts are empty, and an empty text scores as one without a term; very long texts are read whole. Quoted
    terms alone, however many, score at most as one outright. Equal texts score alike; an empty
    table gives no rows; labels without a document, of null id or other than 0 and 1 are left out.
    All columns are kept.
    """
    terms, ordinary, weights = fitted(docs, labels)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        lexicon = Lexicon(terms, ordinary)
        beta = np.array(weights)
        for texts in batches:
            x = weighed([features(text, lexicon) for text in texts])
            yield pd.Series(1 / (1 + np.exp(-np.clip(beta[0] + x @ beta[1:], -30, 30))))

    return docs.withColumn("_score", score("text"))


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    found = scored(docs.select("doc_id", "text"), labels)
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("_score").alias("score"),
        (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents below the threshold, with their own columns, whatever these are called."""
    return with_extras_aside(docs, lambda rows: scored(rows, labels).where(F.col("_score") < THRESHOLD))
