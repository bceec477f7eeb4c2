"""URL rules and the decisions that redirects and canonical links carry to aliases; DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceway.llm.components import connected
from sluiceway.llm.scratch import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Action, host and path of the rules that pages are judged by.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.char_length(url)))


def host(url: Column) -> Column:
    """What stands between ``://`` and the path, A-Z lower-cased; empty without one."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def node(url: Column) -> Column:
    """One name for a URL however it is written: host, path and query; null without a host."""
    behind = F.regexp_extract(_rest(url), "^[^/?#]*([^#]*)", 1)
    return F.when(F.rlike(_rest(url), F.lit("^[^/?#]")), F.concat(host(url), behind))


def matching(host_of: Column, path_of: Column, rules: list[tuple[str, str, str]] = RULES) -> Column:
    """``struct<length,rule,action>`` of the longest rule that fits, null if none does.

    For a list of rules that is written down; a table of rules is joined by ``matched_rules``.
    """
    listed = [
        F.when(
            ((host_of == where) | F.endswith(host_of, F.lit(f".{where}"))) & F.startswith(path_of, F.lit(start)),
            F.struct(F.lit(len(where + start)).alias("length"), F.lit(where + start).alias("rule"), F.lit(action).alias("action")),
        )
        for action, where, start in rules
    ]
    return F.array_max(F.array(*listed))


def matched_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, path, rule, action`` of the longest rule for every distinct host and path that has one.

    ``rules`` has ``action, host, path`` and may be of any size: hosts are joined by each of their
    suffixes, so no rule meets a host it cannot fit.
    """
    known = urls.select("host", "path").where("host <> ''").distinct()
    labels = F.split("host", "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    wanted = known.withColumn("_suffix", F.explode(suffixes))
    fits = rules.select("action", F.col("host").alias("_suffix"), F.col("path").alias("_start")).where("_suffix is not null and _start is not null")
    met = wanted.join(fits, "_suffix").where(F.startswith("path", "_start"))
    rule = F.concat("_suffix", "_start")
    longest = F.max(F.struct(F.char_length(rule).alias("length"), rule.alias("rule"), "action"))
    return met.groupBy("host", "path").agg(longest.alias("_best")).select("host", "path", "_best.rule", "_best.action")


def page_links(pages: DataFrame) -> DataFrame:
    """``source, target`` URLs that a page itself calls the same: its canonical link and its redirect."""
    html = F.coalesce("html", F.lit(""))

    def first(tag: str, marked: str, value: str) -> Column:
        tags = F.filter(F.regexp_extract_all(html, F.lit(f"(?i)(<{tag}\\b[^>]*>)"), 1), lambda t: F.rlike(t, F.lit(f"(?i){marked}")))
        return F.regexp_extract(F.get(tags, 0), f"(?i){value}", 1)

    canonical = first("link", "\\brel\\s*=\\s*[\"']?canonical", "\\bhref\\s*=\\s*[\"']?([^\"'\\s>]+)")
    redirect = first("meta", "http-equiv\\s*=\\s*[\"']?refresh", "\\burl\\s*=\\s*[\"']?([^\"'\\s>]+)")
    found = pages.where(F.col("url").isNotNull()).select("url", F.explode(F.array(canonical, redirect)).alias("to"))
    found = found.where("to is not null and to <> ''").withColumn("to", F.replace("to", F.lit("&amp;"), F.lit("&")))
    found = found.withColumns({"_host": host(F.col("url")), "_path": path(F.col("url"))})
    scheme = F.substring_index("url", "://", 1)
    site = F.concat(scheme, F.lit("://"), F.col("_host"))
    folder = F.regexp_extract("_path", "^(.*/)", 1)
    resolved = (
        F.when(F.contains("to", F.lit("://")), F.col("to"))
        .when(F.startswith("to", F.lit("//")), F.concat(scheme, F.lit(":"), F.col("to")))
        .when(F.startswith("to", F.lit("/")), F.concat(site, F.col("to")))
        .otherwise(F.concat(site, F.when(folder == "", F.lit("/")).otherwise(folder), F.col("to")))
    )
    return found.select(F.col("url").alias("source"), resolved.alias("target"))


def judged(pages: DataFrame, links: DataFrame | None = None, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    """The pages with a struct ``_u``: ``host``, ``path``, ``rule`` and ``verdict``.

    A page's own rule decides. A page without one takes the decision of its aliases, the URLs that
    redirects and canonical links connect with it over any number of steps: allow if a rule allows
    one of them, else block if a rule blocks one, else allow. ``links`` adds ``source, target`` URLs,
    such as a crawl's redirects, to those the pages hold; targets need no page of their own. A null
    URL, or one without ``://``, has an empty host and path, no alias and no rule, and is allowed.
    Repeated rows are judged alike; an empty table gives no rows. All columns are kept.
    """
    scratch = Scratch(pages.sparkSession, "urls")
    found = page_links(pages)
    if links is not None:
        found = found.unionByName(links.select("source", "target"))
    found = scratch.keep(found, "found")
    # The host, path and name of a URL follow from its name, so edges need no more than names.
    edges = found.select(node(F.col("source")).alias("a"), node(F.col("target")).alias("b"))
    parts = scratch.keep(connected(edges, scratch), "parts")
    named = F.concat(F.lit("x://"), F.col("node"))
    decided = parts.withColumns({"_host": host(named), "_path": path(named)})
    decided = decided.withColumn("_action", matching(F.col("_host"), F.col("_path"), rules)["action"])
    by_part = decided.groupBy("component").agg(
        F.max(F.when(F.col("_action") == "allow", 1)).alias("_allowed"), F.max(F.when(F.col("_action") == "block", 1)).alias("_blocked")
    )
    by_part = scratch.keep(by_part, "by_part")
    inherited = F.when(F.col("_allowed") == 1, "allow").when(F.col("_blocked") == 1, "block")
    aliases = parts.join(by_part, "component").select(F.col("node").alias("_node"), inherited.alias("_inherited"))
    aliases = scratch.keep(aliases.where("_inherited is not null"), "aliases")

    rule = matching(F.col("_host"), F.col("_path"), rules)
    rows = pages.withColumns({"_host": host(F.col("url")), "_path": path(F.col("url")), "_node": node(F.col("url"))})
    rows = rows.withColumn("_rule", rule).join(aliases, "_node", "left")
    verdict = F.coalesce("_rule.action", "_inherited", F.lit("allow"))
    judged = F.struct(F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule.rule").alias("rule"), verdict.alias("verdict"))
    return rows.withColumn("_u", judged).select(*pages.columns, "_u")


def verdicts(pages: DataFrame) -> DataFrame:
    return judged(pages.select("page_id", "url", "html")).select("page_id", "_u.*")


_HOST = "coalesce(translate(regexp_extract({0}, '^([^/?#]*)', 1), '" + UPPER + "', '" + LOWER + "'), '')"
_PATH = "coalesce(regexp_extract({0}, '^[^/?#]*([^?#]*)', 1), '')"
_REST = "CASE WHEN instr({0}, '://') > 0 THEN substr({0}, instr({0}, '://') + 3) END"

VERDICTS_SQL = f"""
WITH RECURSIVE rules(action, h, p) AS (VALUES {", ".join(map(str, RULES))}),
parsed AS (
  SELECT page_id, url, html, {_HOST.format("rest")} AS host, {_PATH.format("rest")} AS path,
    CASE WHEN {_HOST.format("rest")} <> '' THEN {_HOST.format("rest")} || {_PATH.format("rest")} || coalesce(regexp_extract(rest, '^[^?#]*([^#]*)', 1), '') END AS node
  FROM (SELECT *, {_REST.format("url")} AS rest FROM pages)
), named AS (
  SELECT node, host, split_part(url, '://', 1) AS scheme, path, replace(unnest([
    regexp_extract(list_filter(regexp_extract_all(coalesce(html, ''), '(?i)<link\\b[^>]*>'), lambda t: regexp_matches(t, '(?i)\\brel\\s*=\\s*["'']?canonical'))[1], '(?i)\\bhref\\s*=\\s*["'']?([^"''\\s>]+)', 1),
    regexp_extract(list_filter(regexp_extract_all(coalesce(html, ''), '(?i)<meta\\b[^>]*>'), lambda t: regexp_matches(t, '(?i)http-equiv\\s*=\\s*["'']?refresh'))[1], '(?i)\\burl\\s*=\\s*["'']?([^"''\\s>]+)', 1)
  ]), '&amp;', '&') AS target FROM parsed
), resolved AS (
  SELECT node AS a, CASE WHEN contains(target, '://') THEN target WHEN starts_with(target, '//') THEN scheme || ':' || target
    WHEN starts_with(target, '/') THEN scheme || '://' || host || target
    ELSE scheme || '://' || host || CASE WHEN regexp_extract(path, '^(.*/)', 1) = '' THEN '/' ELSE regexp_extract(path, '^(.*/)', 1) END || target END AS url
  FROM named WHERE coalesce(target, '') <> ''
), edges AS (
  SELECT a, {_HOST.format("rest")} || {_PATH.format("rest")} || coalesce(regexp_extract(rest, '^[^?#]*([^#]*)', 1), '') AS b
  FROM (SELECT a, {_REST.format("url")} AS rest FROM resolved) WHERE a IS NOT NULL AND {_HOST.format("rest")} <> ''
), both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
reached(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reached r JOIN both_ways e ON r.b = e.a),
decided AS (
  SELECT r.a AS node, bool_or(best = 'allow') AS allowed, bool_or(best = 'block') AS blocked FROM (
    SELECT a, (SELECT arg_max(action, length(h || p)) FROM rules WHERE (regexp_extract(b, '^([^/?#]*)', 1) = h
      OR ends_with(regexp_extract(b, '^([^/?#]*)', 1), '.' || h)) AND starts_with(regexp_extract(b, '^[^/?#]*([^?#]*)', 1), p)) AS best
    FROM reached) r GROUP BY r.a
), ruled AS (
  SELECT page_id, host, path, node,
    (SELECT arg_max(struct_pack(r := h || p, a := action), length(h || p)) FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)) AS best
  FROM parsed
)
SELECT page_id, host, path, best.r AS rule,
  coalesce(best.a, CASE WHEN allowed THEN 'allow' WHEN blocked THEN 'block' END, 'allow') AS verdict
FROM ruled LEFT JOIN decided USING (node)
"""
