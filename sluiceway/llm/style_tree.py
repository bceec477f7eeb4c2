"""HTML extraction by site style trees: branches that a site's pages share are taken from them.

Python turns a page into blocks, each with the path of elements that leads to it. Spark merges the
paths of a host's distinct pages into one tree. Its nodes are paths, its branches the containers that
hold blocks. How blocks of a branch follow each other is its presentation, what they say its content;
the entropy of both over the pages is the branch's importance, and branches of low importance go.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.scratch import Scratch
from sluiceway.llm.url_rules import host

#: A node is a template's if its contents are each held by more than this share of the distinct pages
#: that have the node, on average, and it was seen in this many of them at least.
TEMPLATE_SHARE = 0.7
LEAST_PAGES = 8
#: A branch is of low importance below this share of the most important node of its host.
LOW = 0.75
#: Weight that each block below a branch leaves to content; the rest of the weight is presentation's.
DAMPING = 0.9

# Elements whose presentation says that they are not the article, and names of such.
ASIDE = {"nav", "footer", "aside", "form", "script", "style", "noscript", "template", "iframe", "object", "svg", "canvas", "button",
         "select", "textarea", "input", "label", "head", "title", "dialog", "menu", "audio", "video", "embed", "datalist"}
ASIDE_NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner",
               "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal", "overlay", "newsletter", "subscribe",
               "signup", "login", "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "header",
               "masthead", "toolbar", "comment", "comments", "respond", "disqus", "share", "sharing", "social", "related", "widget",
               "pagination", "pager", "search", "complementary", "contentinfo", "hidden"}
MAIN = {"article", "main"}
CONTAINERS = {"div", "section", "aside", "nav", "header", "footer", "form", "menu", "center", "details", "fieldset", "dialog"}
NOT_SHOWN = {"head", "title", "script", "style", "noscript", "template"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
          "kbd", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "ruby", "rt", "rp"}
#: An opening element of the key ends an open one of the values.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: An element that holds more than this share of what its page could give never stands aside for its name.
MOST = 0.8


ROOT = ("", "", False, False, (), "")


class Blocks(HTMLParser):
    """Blocks of a page in order: path, whether it stands aside, whether in the main element, text.

    ``named`` gives for each block the elements around it that only their name sets aside, and
    ``holders`` those of them that hold a main element. ``branches`` gives the path of the innermost
    container of each block, empty right inside the body or a main element, None if it is not shown.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, str, bool, bool, tuple[int, ...], str | None]] = []
        self.branches: list[str | None] = []
        self.named: list[tuple[int, ...]] = []
        self.holders: set[int] = set()
        self.elements = 0
        self.found: list[tuple[str, bool, bool, str]] = []
        self.words: list[str] = []

    def _end_block(self) -> None:
        text = " ".join("".join(self.words).split())
        self.words = []
        if text:
            _, path, aside, main, names, branch = self.stack[-1] if self.stack else ROOT
            self.named.append(names)
            self.branches.append(branch)
            self.found.append((path, aside, main, text))

    def _close(self, at: int) -> None:
        if any(tag not in INLINE for tag, *_ in self.stack[at:]):
            self._end_block()
        del self.stack[at:]

    def _last(self, tags: set[str], until: set[str]) -> int:
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at][0] in tags:
                return at
            if self.stack[at][0] in until:
                return -1
        return -1

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("br", "wbr", "img"):
            self.words.append(" " if tag == "br" else "")
            return
        if tag not in INLINE:
            if (at := self._last({"p"}, {"table", "td", "button", *ASIDE, *MAIN})) >= 0:
                self._close(at)
            if tag in ENDS and (at := self._last(ENDS[tag], {"ul", "ol", "dl", "table", "select"})) >= 0:
                self._close(at)
            self._end_block()
        if tag in VOID:
            return
        _, path, aside, main, names, branch = self.stack[-1] if self.stack else ROOT
        if tag in INLINE and not any(name in ("class", "id", "role", "hidden", "style") for name, _ in attrs):
            self.stack.append((tag, path, aside, main, names, branch))
            return
        named = " ".join(sorted(value for name, value in attrs if value and name in ("class", "id", "role"))).lower()
        hidden = any(name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "style" and value and "display:none" in value.replace(" ", "").lower()) for name, value in attrs)
        own = tag in ASIDE or hidden
        if tag in MAIN:
            self.holders.update(names)
        elif tag not in ("html", "body") and (not ASIDE_NAMES.isdisjoint(named.split()) or (tag == "header" and not main)):
            self.elements += 1
            names = (*names, self.elements)
        path = f"{path}/{tag}" + (f"[{named}]" if named else "")
        if tag in NOT_SHOWN:
            branch = None
        elif branch is not None and (tag in CONTAINERS or tag in MAIN):
            branch = path if tag in CONTAINERS else ""
        self.stack.append((tag, path, aside or (own and tag not in ("html", "body")), main or tag in MAIN, names, branch))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.stack and self.stack[-1][0] == tag and tag in ("svg", "path"):
            self._close(len(self.stack) - 1)

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            return
        until = set() if tag not in INLINE and tag != "p" else {"article", "main", "body", "div", "section", "td"}
        if (at := self._last({tag}, until)) >= 0:
            self._close(at)
        elif tag not in INLINE:
            self._end_block()

    def handle_data(self, data: str) -> None:
        self.words.append(data)


def _parsed(html: str | None) -> Blocks:
    parser = Blocks()
    parser.feed(html or "")
    parser.close()
    parser._end_block()
    return parser


def blocks_of(html: str | None) -> list[tuple[str, bool, bool, str]]:
    return _judged(_parsed(html))


def _judged(parser: Blocks) -> list[tuple[str, bool, bool, str]]:
    # Names set aside what is neither around a main element nor most of the text that could be kept.
    scope = [k for k, block in enumerate(parser.found) if not block[1]]
    scope = [k for k in scope if parser.found[k][2]] or scope
    sizes: dict[int, int] = {}
    for k in scope:
        for element in parser.named[k]:
            sizes[element] = sizes.get(element, 0) + len(parser.found[k][3])
    most = MOST * sum(len(parser.found[k][3]) for k in scope)
    exempt = parser.holders | {element for element, size in sizes.items() if size > most}
    return [(path, aside or any(element not in exempt for element in names), main, text) for (path, aside, main, text), names in zip(parser.found, parser.named)]


def _number(text: str) -> int:
    return int.from_bytes(xxhash.xxh64_digest(text.encode("utf-8", "surrogatepass")), "big", signed=True)


def leaves(html: str | None) -> tuple[list[dict], list[dict]]:
    """Shown blocks of a page, and the form of each branch.

    A block has the numbers of its path (``node``), branch (null if none) and content, and its text if
    rules on tags and names let it stay: those of the main element where a page has one, else all that
    do not stand aside. A form is the number of the paths of a branch's blocks in order, with their count.
    """
    parser = _parsed(html)
    found = _judged(parser)
    scoped = any(main and not aside for _, aside, main, _ in found)
    blocks, below = [], {}
    for (path, aside, main, text), branch in zip(found, parser.branches):
        if branch is None:
            continue
        stays = not aside and (main or not scoped)
        blocks.append({"node": _number(path), "branch": _number(branch) if branch else None, "content": _number(text), "text": text if stays else None})
        if branch:
            below.setdefault(blocks[-1]["branch"], []).append(blocks[-1]["node"])
    return blocks, [{"branch": branch, "form": _number(repr(nodes)), "blocks": len(nodes)} for branch, nodes in below.items()]


def with_blocks(pages: DataFrame) -> DataFrame:
    """The pages with ``_blocks`` and ``_forms`` as ``leaves`` gives them."""
    blocks = "array<struct<node:bigint,branch:bigint,content:bigint,text:string>>"

    @F.pandas_udf(f"struct<blocks:{blocks},forms:array<struct<branch:bigint,form:bigint,blocks:int>>>")
    def split(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for htmls in batches:
            rows = [leaves(html) for html in htmls]
            yield pd.DataFrame({"blocks": [blocks for blocks, _ in rows], "forms": [forms for _, forms in rows]})

    found = pages.withColumn("_found", split("html"))
    return found.withColumns({"_blocks": F.col("_found.blocks"), "_forms": F.col("_found.forms")}).drop("_found")


def _relative(entropy: Column, pages: str) -> Column:
    """An entropy as share of the largest that so many pages can have; one page is as varied as can be."""
    return F.when(F.col(pages) > 1, entropy / F.ln(pages)).otherwise(1.0)


def nodes_of(blocks: DataFrame) -> DataFrame:
    """``host, branch, node, pages, kinds, held, importance`` of each node, from ``host, page, branch, node, content``.

    A content that ``n`` of a node's ``pages`` hold has entropy ``ln n / ln pages`` over them: 1 if all
    of them hold it, 0 if one does. The node's importance is one minus the mean of its ``kinds`` of contents.
    Each content counts once for each distinct page, so copies of a page weigh as one.
    """
    contents = blocks.select("host", "page", "branch", "node", "content").distinct()
    contents = contents.groupBy("host", "branch", "node", "content").agg(F.count("*").alias("n"))
    squared = F.col("n").cast("double") * F.col("n")
    nodes = contents.groupBy("host", "branch", "node").agg(
        (F.sum(squared) / F.sum("n")).alias("held"), F.count("*").alias("kinds"), F.avg(F.ln("n")).alias("spread")
    )
    pages = blocks.select("page", "node").distinct().groupBy("node").agg(F.count("*").alias("pages"))
    importance = _relative(F.ln("pages") - F.col("spread"), "pages")
    return nodes.join(pages, "node").withColumn("importance", F.round(importance, 9)).drop("spread")


def branches_of(forms: DataFrame, nodes: DataFrame) -> DataFrame:
    """``host, branch, pages, presentation, importance, highest`` of each branch, from ``host, page, branch, form, blocks``.

    Presentation is the entropy of a branch's forms over its pages: 0 if all pages show the same
    sequence of blocks, 1 if each shows its own. With ``b`` blocks on average, importance is content
    times ``DAMPING`` to the power of ``b``, plus presentation for the rest of the weight; content is
    the mean over all kinds of contents of the branch's nodes. ``highest`` is that of its nodes.
    """
    shown = forms.select("host", "page", "branch", "form", "blocks").distinct()
    shown = shown.groupBy("host", "branch", "form", "blocks").agg(F.count("*").alias("n"))
    per = shown.groupBy("host", "branch").agg(
        F.sum("n").alias("pages"), F.sum(F.col("n") * F.ln("n")).alias("spread"), (F.sum(F.col("n") * F.col("blocks")) / F.sum("n")).alias("blocks")
    )
    below = nodes.where("branch IS NOT NULL").groupBy("branch").agg(
        (F.sum(F.col("importance") * F.col("kinds")) / F.sum("kinds")).alias("content"), F.max("importance").alias("highest")
    )
    share = F.pow(F.lit(DAMPING), F.col("blocks"))
    per = per.withColumn("presentation", _relative(F.ln("pages") - F.col("spread") / F.col("pages"), "pages")).join(below, "branch")
    importance = F.round((1 - share) * F.col("presentation") + share * F.col("content"), 9)
    return per.select("host", "branch", "pages", F.round("presentation", 9).alias("presentation"), importance.alias("importance"), "highest")


def templates(blocks: DataFrame, forms: DataFrame, scratch: Scratch) -> DataFrame:
    """``node`` of what the template of a host repeats.

    The nodes of a branch go if the branch and each of them are below ``LOW`` times the most important
    node of the host, which therefore always stays. Nodes outside of branches, such as paragraphs right
    inside the body, and others go if most of their pages hold the same there; not so on a host all of
    whose nodes do. What was seen in fewer than ``LEAST_PAGES`` distinct pages stays.
    """
    nodes = nodes_of(blocks).withColumn("shared", (F.col("pages") >= LEAST_PAGES) & (F.col("held") > TEMPLATE_SHARE * F.col("pages")))
    nodes = scratch.keep(nodes, "nodes")
    best = F.max(F.when(F.col("pages") >= LEAST_PAGES, F.col("importance")))
    hosts = nodes.groupBy(F.col("host").alias("_host")).agg((LOW * best).alias("limit"), F.min("shared").alias("all"))
    hosts = scratch.keep(hosts, "hosts")
    branches = branches_of(forms, nodes).join(hosts, F.col("host") == F.col("_host"))
    low = branches.where((F.col("pages") >= LEAST_PAGES) & (F.col("importance") < F.col("limit")) & (F.col("highest") < F.col("limit")))
    noisy = nodes.select("branch", "node").join(low.select("branch"), "branch").select("node")
    shared = nodes.where("shared").join(hosts.where("not all"), F.col("host") == F.col("_host"), "left_semi").select("node")
    return noisy.unionByName(shared).distinct()


def tree_of(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Blocks and forms of pages with ``_row, _host, _blocks, _forms``, for the style tree.

    Hosts, pages, nodes, branches and contents are digests. A page is known by its host and blocks.
    """
    page = F.xxhash64("_host", F.col("_blocks.node"), F.col("_blocks.content"))
    common = [F.col("_row"), F.xxhash64("_host").alias("host"), page.alias("page")]
    listed = rows.select(*common, F.posexplode("_blocks").alias("at", "block"))
    branch = F.when(F.col("block.branch").isNotNull(), F.xxhash64("host", "block.branch")).alias("branch")
    blocks = listed.select("_row", "host", "page", "at", F.xxhash64("host", "block.node").alias("node"), branch, "block.content", F.col("block.text").isNotNull().alias("stays"))
    forms = rows.select(*common, F.explode("_forms").alias("shown"))
    return blocks, forms.select("host", "page", F.xxhash64("host", "shown.branch").alias("branch"), "shown.form", "shown.blocks")


def extracted(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page.

    Blocks of low branches of the host's style tree are left out, and those that rules on tags and names
    set aside; what remains is joined by line ends. The tree is built from all shown blocks. A null html
    is empty and gives an empty text, a null URL belongs to the empty host. A very long page is parsed
    whole by one worker. Repeated rows are extracted each and count once in the tree; an empty table gives
    no rows; other columns are ignored.
    """
    scratch = Scratch(pages.sparkSession, "styles")
    rows = with_blocks(pages.select("page_id", "url", "html")).drop("html")
    rows = rows.withColumns({"_host": host(F.col("url")), "_row": F.monotonically_increasing_id()})
    rows = scratch.keep(rows, "blocks")
    blocks, forms = tree_of(rows)
    low = scratch.keep(templates(blocks, forms, scratch), "low")
    dropped = blocks.where("stays").select("_row", "at", "node").join(low, "node")
    dropped = scratch.keep(dropped.groupBy("_row").agg(F.collect_set("at").alias("_dropped")), "dropped")
    joined = rows.join(dropped, "_row", "left").withColumn("_dropped", F.coalesce("_dropped", F.array().cast("array<int>")))
    places = F.filter(F.transform("_blocks", lambda block, at: F.when(block["text"].isNotNull(), at)), F.isnotnull)
    kept = F.transform(F.array_except(places, "_dropped"), lambda at: F.col("_blocks")[at]["text"])
    return joined.select("page_id", "url", F.array_join(kept, "\n").alias("text")).withColumn("n_chars", F.char_length("text").cast("bigint"))
