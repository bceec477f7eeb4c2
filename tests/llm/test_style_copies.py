"""Copies of a page and the size of a host change nothing in its style tree."""

import pytest

from sluiceway.llm import style_tree


def texts(spark, htmls):
    pages = spark.createDataFrame([(k, "https://h.org/a", html) for k, html in enumerate(htmls)], "page_id bigint, url string, html string")
    return {r.page_id: r.text for r in style_tree.extracted(pages).collect()}


def test_copies_do_not_make_a_template(spark):
    def page(k):
        return f"<h1>Head {k}</h1><div><span class='x'>Terms</span></div>" + "".join(f"<p>Text {k} {j}</p>" for j in range(20))

    got = texts(spark, [page(0)] * 300 + [page(k) for k in range(1, 101)])
    for row, k in ((0, 0), (299, 0), (300, 1), (399, 100)):
        assert got[row] == "\n".join([f"Head {k}", *[f"Text {k} {j}" for j in range(20)]])


@pytest.mark.parametrize("n", [10, 600])
def test_repeated_cells_stay_on_hosts_of_any_size(spark, n):
    got = texts(spark, [f"<h1>Head {k}</h1><table><tr><td>{'yes' if k % 2 else 'no'}</td></tr></table><div class='box'>Read our terms</div><p>Text {k}</p>" for k in range(n)])
    assert got == {k: f"Head {k}\n{'yes' if k % 2 else 'no'}\nText {k}" for k in range(n)}
