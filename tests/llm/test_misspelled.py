"""Misspelled terms count towards the verdict."""

import random

from sluiceway.llm import toxicity


def test_beginnings_and_signs_match_with_one_edit():
    lexicon = toxicity.Lexicon([("scumb", False), ("idiot", True)], ["idiom"])
    assert lexicon.hits(["scumbags", "scunbags", "scmbags", "scum", "id1ot", "idi*ot", "idiom", "x1idiot", "well"]) == {
        "scumbags": 2, "scunbags": 1, "scmbags": 1, "id1ot": 1, "idi*ot": 1, "x1idiot": 2,
    }
    assert toxicity.WORD.findall("an id1ot, l'idiot! w12 a_b") == ["an", "id1ot", "l", "idiot", "w", "a_b"]


def test_documents_of_misspelled_terms_are_rejected(spark, documents):
    rng = random.Random(1)
    rows, marks = [], []
    for k in range(400):
        toxic = k % 4 == 0
        words = [f"w{rng.randrange(500)}" for _ in range(30)] + ["scumbag", "moron"] * toxic + ["moran"] * (k % 4 == 1)
        rng.shuffle(words)
        rows.append((k, " ".join(words)))
        marks.append((k, 1, int(toxic)))
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int")
    wrong = "w1 scumbg w2 sc0mbag w3 mooron w4 scumbaag moro0n w5 w6 mor0n"
    docs = documents(rows + [(1000, wrong), (1001, "w1 moran w2 moran w3 moran moran moran")])
    kept = {r.doc_id for r in toxicity.clean(docs, labels).collect()}
    assert kept == {k for k in range(400) if k % 4} | {1001}
