"""Names of elements that hold the article do not set it aside."""

import pytest

from sluiceway.llm import style_tree

ARTICLE = "<h1>Head</h1><p>" + "some words of the article " * 4 + "</p>"


def kept(html):
    found = [block for block in style_tree.blocks_of(html) if not block[1]]
    return [text.split()[0] for _, _, _, text in [block for block in found if block[2]] or found]


@pytest.mark.parametrize("around", [
    "<div class='layout no-sidebar'>{}</div>", "<main class='with-sidebar'>{}</main>", "<div id='page' class='has-header'>{}</div>",
    "<div class='post hidden-xs'>{}</div>", "<div class='search-result'>{}</div>", "<div class='search'>{}</div>",
    "<div class='sidebar'><article>{}</article></div>", "<main class='search'>{}</main>", "<article><div class='notice'>{}</div></article>",
])
def test_names_around_the_article(around):
    assert kept("<html><body><nav>menu</nav>" + around.format(ARTICLE) + "<div class='ad'>buy</div></body>") == ["Head", "some"]


def test_names_inside_the_article():
    html = f"<article><div class='article-header'><h1>Title</h1></div>{ARTICLE}<div class='box ad'>buy</div></article>"
    assert kept(html) == ["Title", "Head", "some"]
