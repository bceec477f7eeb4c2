"""The style tree against plain sums over all pages, and template blocks that no name gives away."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sluiceway.llm import style_tree
from sluiceway.llm.scratch import Scratch
from sluiceway.llm.url_rules import host


def frame(spark, htmls, url="https://h.org/a"):
    return spark.createDataFrame([(k, url, html) for k, html in enumerate(htmls)], "page_id bigint, url string, html string")


def merged(pages):
    rows = style_tree.with_blocks(pages).withColumns({"_host": host(F.col("url")), "_row": F.col("page_id")})
    return style_tree.tree_of(rows)


def plain_tree(htmls):
    """Importance of nodes, and importance and presentation of branches, by path, from distinct pages."""
    pages = []
    for html in htmls:
        parser = style_tree._parsed(html)
        pages.append(tuple((path, branch, text) for (path, _, _, text), branch in zip(parser.found, parser.branches) if branch is not None))
    pages = set(pages)
    having, holding, forms = Counter(), defaultdict(Counter), defaultdict(list)
    for page in pages:
        having.update({path for path, _, _ in page})
        for path, _, text in {(path, "", text) for path, _, text in page}:
            holding[path][text] += 1
        for branch in {branch for _, branch, _ in page if branch}:
            forms[branch].append(tuple(path for path, b, _ in page if b == branch))
    entropy = lambda counts, n: -sum(c / n * math.log(c / n, n) for c in counts) if n > 1 else 1.0
    per_content = {p: [1 - math.log(c, having[p]) if having[p] > 1 else 1.0 for c in held.values()] for p, held in holding.items()}
    branches = {}
    for branch, shown in forms.items():
        presentation = entropy(Counter(shown).values(), len(shown))
        share = style_tree.DAMPING ** (sum(map(len, shown)) / len(shown))
        below = {path for page in pages for path, b, _ in page if b == branch}
        contents = [value for path in below for value in per_content[path]]
        branches[branch] = (round(presentation, 6), round((1 - share) * presentation + share * sum(contents) / len(contents), 6))
    return {p: round(sum(v) / len(v), 6) for p, v in per_content.items()}, branches


def test_importance_of_all_nodes_and_branches(spark):
    rng = random.Random(3)

    def page(k):
        cards = "".join(f"<div class='card'><p>{rng.randrange(9)}</p>{'<b>more</b>' * rng.randrange(2)}</div>" for _ in range(rng.randrange(4)))
        menu = "".join(f"<li>{rng.randrange(6)}</li>" for _ in range(rng.choice([3, 3, 4])))
        return f"<head><title>t{k}</title></head><body><nav><ul>{menu}</ul></nav>{cards}<article><p>{k}</p><section>{rng.randrange(3)}</section></article></body>"

    htmls = [page(k // 2) for k in range(60)] + [page(0)] * 3
    htmls += [htmls[0]] * 5 + ["", "<div>alone</div>"]
    blocks, forms = merged(frame(spark, htmls))
    nodes = style_tree.nodes_of(blocks)
    found_nodes = sorted((round(r.importance, 6)) for r in nodes.collect())
    found = sorted((round(r.presentation, 6), round(r.importance, 6)) for r in style_tree.branches_of(forms, nodes).collect())
    wanted_nodes, wanted = plain_tree(htmls)
    assert found_nodes == pytest.approx(sorted(wanted_nodes.values()), abs=2e-6)
    assert [x for pair in found for x in pair] == pytest.approx([x for pair in sorted(wanted.values()) for x in pair], abs=2e-6)


@pytest.mark.parametrize("variants", [1, 3, 10])
def test_rotating_blocks_without_telling_names_go(spark, variants):
    """Also inside the article and among its paragraphs, where no rule acts."""
    htmls = [
        f"<body><div class='x7'><a href='/'>Offer {k % variants}</a></div><article><h1>Head {k}</h1><p>Text {k}</p><div class='q'><p>Buy {k // 3 % variants}</p></div>"
        f"<p>More {k}</p><p>Shared by a few {k // 4}</p></article><section><ul><li>Home</li><li>Item {k % variants}</li></ul></section></body>"
        for k in range(200)
    ]
    got = {r.page_id: r.text for r in style_tree.extracted(frame(spark, htmls)).collect()}
    assert got == {k: f"Head {k}\nText {k}\nMore {k}\nShared by a few {k // 4}" for k in range(200)}
    plain = [html.replace("<article>", "<div>").replace("</article>", "</div>") for html in htmls]
    got = {r.page_id: r.text for r in style_tree.extracted(frame(spark, plain)).collect()}
    assert got == {k: f"Head {k}\nText {k}\nMore {k}\nShared by a few {k // 4}" for k in range(200)}


def test_articles_of_a_site_of_copies_stay(spark):
    """Of 300 pages 290 hold one of three articles, in containers that all pages share."""
    htmls = [f"<body><div class='text'><p>Article {k if k < 10 else k % 3}</p><p>End {k if k < 10 else k % 3}</p></div><div class='f'>Offer {k % 7}</div></body>" for k in range(300)]
    got = {r.page_id: r.text for r in style_tree.extracted(frame(spark, htmls)).collect()}
    assert all(got[k].startswith(f"Article {k if k < 10 else k % 3}\nEnd ") for k in range(300))


def test_odd_pages(spark):
    """Null, empty, very long and deep pages, unclosed elements, and extra columns of the operator's own names."""
    long = "<article>" + "".join(f"<p>word {k}</p>" for k in range(30_000)) + "</article>"
    deep = "<div>" * 400 + "end" + "</div>" * 400
    pages = frame(spark, [None, "", long, long, deep, "<div><p>open", "<td>cell</td>"])
    pages = pages.withColumns({c: F.lit(1) for c in ("_row", "_host", "_blocks", "_forms", "_found", "node", "text", "n_chars")})
    got = {r.page_id: r for r in style_tree.extracted(pages).collect()}
    assert got[0].text == got[1].text == "" and got[2].text == got[3].text == "\n".join(f"word {k}" for k in range(30_000))
    assert (got[4].text, got[5].text, got[6].text) == ("end", "open", "cell") and got[4].n_chars == 3
    assert style_tree.templates(*merged(pages.limit(0)), Scratch(spark, "test")).count() == 0
