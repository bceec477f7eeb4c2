"""URL rules, mixing, reply trees, page text and the pipeline, against SQL twins and small cases."""

import random

import duckdb
import pytest

import corpus_pipeline
from sluiceway.llm import mixing, reply_trees, style_tree, url_rules
from sluiceway.llm.queries import QUERIES
from sluiceway.llm.scratch import Scratch


def twin(frame, sql, **tables):
    connection = duckdb.connect()
    for name, table in tables.items():
        connection.register(f"{name}_frame", table.toPandas())
        columns = ", ".join(f'CAST("{n}" AS {"BIGINT" if k == "bigint" else "VARCHAR"}) AS "{n}"' for n, k in table.dtypes)
        connection.execute(f"CREATE TABLE {name} AS SELECT {columns} FROM {name}_frame")
    wanted = connection.execute(f"SELECT {', '.join(frame.columns)} FROM ({sql})").fetchall()
    assert sorted(map(repr, (tuple(r) for r in frame.collect()))) == sorted(map(repr, wanted))


def test_url_rules_and_aliases(spark):
    canonical = '<link href="{}" rel="canonical">'
    rows = [
        (1, "http://WWW.Example.com/en/x", None), (2, "http://a.example.com/en/x?q#f", ""), (3, "https://b.net/es/", None),
        (4, "https://c.org/p", canonical.format("https://b.net/es/")), (5, "https://d.org/q", '<META HTTP-EQUIV="refresh" content="0; url=//c.org/p">'),
        (6, "https://e.org/q/r", canonical.format("s?a=1&amp;b=2")), (7, "https://e.org/q/s?a=1&b=2", canonical.format("/t")),
        (8, "https://e.org/t", canonical.format("http://x.com/ok")), (9, "https://f.org/", canonical.format("https://b.net/fr/y")),
        (10, "https://f.org/", canonical.format("http://z.com/")), (11, None, canonical.format("https://b.net/es/")), (12, "no url", None), (12, "no url", None),
        (13, "http://com", None), (14, "http://notcom/", None), (15, "http:///en/", None),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = url_rules.verdicts(pages)
    twin(found, url_rules.VERDICTS_SQL, pages=pages)
    got = {r.page_id: (r.rule, r.verdict) for r in found.collect()}
    assert got[1] == ("www.example.com/en/", "allow") and got[2] == ("example.com/en/", "block")
    assert got[4] == (None, "block") and got[5] == (None, "block")
    assert got[6] == (None, "allow") and got[9] == (None, "allow") and got[11] == (None, "allow")
    assert url_rules.verdicts(pages.limit(0)).count() == 0
    rules = spark.createDataFrame([(a, h, p) for a, h, p in url_rules.RULES], "action string, host string, path string")
    urls = found.select("host", "path")
    joined = {(r.host, r.path): r.rule for r in url_rules.matched_rules(urls, rules).collect()}
    assert all(joined.get((r.host, r.path)) == r.rule for r in found.collect())


def test_mixing(spark):
    rng = random.Random(2)
    rows = [(k, " ".join("w" * rng.randrange(1, 60)), rng.choice(["a", "b", "c", "é", None]) if k > 300 else "hot") for k in range(600)]
    rows += [(5, "w w", "hot"), (5, "w w", "hot"), (None, "w\x0bw", "a"), (700, None, "only null"), (701, "w", "tiny")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    twin(mixing.mixture(docs), mixing.MIXTURE_SQL, documents=docs)
    found = mixing.mixture(docs).collect()
    assert all(r.taken <= 3 * r.size for r in found)
    assert sum(r.taken for r in found) == pytest.approx(sum(r.size for r in found), rel=0.05)
    assert mixing.mixture(docs.limit(0)).count() == 0
    assert mixing.copies(docs).columns == docs.columns


def test_conversations_read_back(spark):
    rows = [
        (1, 0, "user", "a\\b </s> [INST] <s> [/INST] \\[INST]"), (1, 1, "assistant", "</s>[\\INST]\n"), (1, 2, "us</s>er", None),
        (2, 5, None, ""), (2, 5, "assistant", "x"), (2, 9, "assistant", "😀"), (3, 0, "assistant", None),
    ]
    rows += [(4, k, "user" if k % 2 else "assistant", f"t{k}") for k in range(70)]
    conversations = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    twin(reply_trees.digests(conversations), reply_trees.DIGESTS_SQL, conversations=conversations)
    assert reply_trees.digests(conversations.limit(0)).count() == 1


def test_branches(spark):
    rows = [("t", 1, None, "user", "root", 0), ("t", 2, 1, "assistant", "low", 1), ("t", 3, 1, "assistant", "high", 5), ("t", 4, 3, "user", "leaf", 1), ("t", 5, 2, "user", "end", 9), ("u", 1, 7, "user", "alone", 0)]
    messages = spark.createDataFrame(rows, "tree string, node bigint, parent bigint, role string, text string, score bigint")
    best = reply_trees.read_back(reply_trees.formatted(messages)).collect()
    assert {r.tree: [t.text for t in r.turns] for r in best} == {"t": ["root", "low", "end"], "u": ["alone"]}
    assert {r.tree: r.learned for r in best} == {"t": ["low"], "u": []}
    assert reply_trees.formatted(messages, branches=2).count() == 3
    circle = spark.createDataFrame([("t", 1, 2), ("t", 2, 1)], "tree string, node bigint, parent bigint")
    with pytest.raises(ValueError):
        reply_trees.paths(circle, Scratch(spark, "test"))


def test_page_text(spark):
    def page(body, notice="Read our terms"):
        return f"<html><head><title>t</title><script>x='</p>'</script></head><body><nav><ul><li>menu</li></ul></nav><div class='box'>{notice}</div>{body}<footer>f</footer>"

    articles = [f"<article><h1>Title {k} &amp; more&am</h1><p>One <b>bold</b>\n\ttext {k}<p>Two<br>lines &lt;x&gt;</p><div class='ad'>buy</div><aside>by</aside><form>f</form></article>" for k in range(12)]
    rows = [(k, "https://h.org/a", page(a)) for k, a in enumerate(articles)]
    rows += [(50 + k, "https://plain.org/a", page(f"<div><p>Plain {k}</p></div>")) for k in range(12)]
    rows += [(90, None, None), (91, "x", ""), (92, "x", "bare text"), (92, "x", "bare text"), (93, "x", page("<section id='comments'><p>first!</p></section><p>kept</p>", ""))]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r for r in style_tree.extracted(pages).collect()}
    for k in range(12):
        assert got[k].text == f"Title {k} & more&am\nOne bold text {k}\nTwo lines <x>"
        assert got[50 + k].text == f"Plain {k}"
        assert got[k].n_chars == len(got[k].text)
    assert got[90].text == got[91].text == "" and got[92].text == "bare text" and got[93].text == "kept"
    assert style_tree.extracted(pages.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op1_fingerprints", "op5_url_rules", "op6_mixing", "op8_reply_trees"])
def test_native_operators_run_no_python(spark, name):
    found = QUERIES[name](spark, "/root/testdata/sf0.001")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


def test_pipeline(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and rows[0].asDict().keys() == {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "toxicity", "simhash_near_dedup", "mixing", "bpe"]
