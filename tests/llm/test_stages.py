"""Every stage of the pipeline on documents with odd columns and rows, and on planted cases."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from sluiceway.llm import near_copies, perplexity

#: Names that the operators use for columns of their own.
CLASHING = ["_m", "_score", "_fp", "_sig", "_s", "_size", "_copies", "_target", "_row", "_lang", "_middle", "_copy", "_extra", "fp", "first", "a.b", "kept"]
FOLDER = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """``doc_id, text`` of plain documents, exact and near copies, empty, null and very long ones."""
    rng = random.Random(1)
    plain = [(k, words(rng, 120)) for k in range(30)]
    near = [(100 + k, plain[k][1].replace(plain[k][1].split()[5], "changed", 1)) for k in range(5)]
    copies = [(200 + k, plain[9][1]) for k in range(40)]
    odd = [(300, None), (301, ""), (302, " \n"), (None, words(rng, 90)), (303, "one"), (304, words(rng, 60_000)), (305, plain[20][1]), (305, plain[20][1])]
    return plain + near + copies + odd


def documents(spark, rows, clashing=True):
    frame = spark.createDataFrame(
        [(i, t, None if i == 4 else "en", None if i == 3 else f"s{(i or 0) % 3}", None) for i, t in rows],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )
    return frame.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in CLASHING}) if clashing else frame


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_keep_columns_of_any_name(spark, rows, name):
    docs = documents(spark, rows)
    found = STAGES[name](spark, docs, FOLDER)
    assert found.columns == docs.columns and dict(found.dtypes) == dict(docs.dtypes)
    plain = STAGES[name](spark, documents(spark, rows, clashing=False), FOLDER)
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    order = lambda frame: sorted(map(repr, frame.select(*columns).collect()))
    kept = found.collect()
    assert order(found) == order(plain) and kept
    for row in kept:
        assert all(row[c] == (None if row["doc_id"] is None else f"{c}{row['doc_id']}") for c in CLASHING)
    assert STAGES[name](spark, docs.limit(0), FOLDER).count() == 0


def test_last_stage_ignores_other_columns(spark, rows):
    assert STAGES["bpe"](spark, documents(spark, rows), FOLDER).count() == len(rows)


def test_planted_copies_go_and_plain_documents_stay(spark, rows):
    found = {r.doc_id for r in STAGES["simhash_near_dedup"](spark, documents(spark, rows), FOLDER).collect()}
    groups, texts = {}, {i: t for i, t in rows if i is not None}
    for i in sorted(texts):
        same = [j for j in groups if near_copies.resemblance(texts[j], texts[i]) >= 0.8]
        if not same:
            groups[i] = texts[i]
    assert found - {None} == set(groups)


def test_rows_that_change_between_reads_are_judged(spark):
    """A limit may give other rows when the texts are scored than when their n-grams are counted."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(7)
    for most_sent in (perplexity.MOST_SENT, 0):
        scratch = perplexity.Scratch(spark, "test")
        measured = perplexity.measured(docs.select("doc_id", "text", "lang").limit(20), scratch, most_sent)
        assert measured.count() == 20 and measured.where("_m.n_ngrams > 0 AND NOT _m.log_loss > 0").count() == 0
    assert perplexity.passed(docs.limit(20)).count() <= 20


def test_unknown_ngrams_are_taken_for_the_rarest():
    import numpy as np
    import pandas as pd

    numbers, _ = perplexity.ngrams(["abcdefgh"])
    known = np.unique(numbers)
    model = {"en": (known, -np.arange(1.0, len(known) + 1))}
    frame = pd.DataFrame({"text": ["abcdefgh", "zzzzzzzz"], "lang": ["en", "en"]})
    loss = perplexity._measured(frame, model)["log_loss"].tolist()
    _, sizes = perplexity.ngrams(["zzzzzzzz"])
    assert loss[0] == pytest.approx(sum(range(1, len(known) + 1))) and loss[1] == pytest.approx(len(known) * int(sizes[0]))
    assert perplexity._measured(frame.assign(lang="xx"), model)["log_loss"].gt(0).all()
