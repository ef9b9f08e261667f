"""URL filters with redirect equivalence, in DataFrame functions only.

Rules name a host (with all its subdomains) and a path prefix; the longest rule that fits a
url decides it. Urls that reach the same page are aliases: a url and its plain form (no
scheme, ``www.``/``m.``, query, fragment, ``.html`` or final slash), a page and the target of
its canonical link, a page and the target of its redirect; sources and targets need not be pages. Distributed connected components
over these edges give the groups of aliases, and a url without a rule of its own takes
"block" from its group if a member is blocked by a rule and none is allowed by one: an
explicit allow, its own or an alias's, has precedence. All others are allowed.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then
up to ``?``, ``#`` or the end. Longest: most host labels first, then the longest path.

Links: every canonical link and refresh of a page counts, up to the closing quote; relative ones stand
against the page's folder (a ``<base>`` is not read).

Defined results: null urls and those without ``://`` have empty host and path, no rule and no
aliases, and are allowed. Repeated rows are judged each. Any number of pages may share a url,
a host or a target. No rules, no edges or no pages: everything allowed, or an empty result.
Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import narrow, small_enough, stored
from tillcast.llm.graph import components

#: (verdict, host, path)
DEFAULT_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

#: A tag ends at the first ``>`` outside a quoted value; quotes count only right after ``=``.
TAGS = r"""(?i)<(?:link|meta)\b(?:[^>=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|=\s*+[^\s>"'][^\s>]*+|=)*+>"""
CANONICAL = r"""(?i)^<link\b.*(?<![\w-])rel\s*=\s*["']?canonical\b"""
REFRESH = r"""(?i)^<meta\b.*(?<![\w-])http-equiv\s*=\s*["']?refresh\b"""
VALUE = r"""(?i)(?<![\w-])%s\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*))"""
#: In the content of a refresh: up to the closing quote if there is one, else to the end.
REFRESH_URL = r"""(?is)\burl\s*=\s*(?:"([^"]*)|'([^']*)|([^\s"'].*))"""
BARE_REFRESH_URL = r"""(?i)\burl\s*=\s*["']?([^"'\s>]+)"""  # content without quotes, but with a space


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def plain_form(url: Column) -> Column:
    """What every alias of a url by its writing has in common; null without a host."""
    host = F.regexp_replace(url_host(url), r"^(www|m)\.", "")
    path = F.regexp_replace(F.regexp_replace(url_path(url), r"\.html?$", ""), r"/+$", "")
    return F.when(host != "", F.concat(F.lit("//"), host, path))


def own_rule(host: Column, path: Column, rules: Iterable[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. Duplicate rules: the first stands."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # stable sort: of two that fit one url, the longer host or path is checked first
    for kind, h, p in reversed(sorted(dict.fromkeys(rules), key=lambda r: (len(r[1]), len(r[2])))):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(rule.isNull() & fits, F.lit(h + p)).otherwise(rule), F.when(rule.isNull() & fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def without_dots(path: Column) -> Column:
    """A path from the root without the segments ``.`` and ``..``."""
    steps = F.split(path, "/", -1)
    kept = F.aggregate(steps, F.array().cast("array<string>"), lambda acc, x: F.when(x == ".", acc).when(
        x == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(1)))).otherwise(F.concat(acc, F.array(x))))
    whole = F.concat(F.array_join(kept, "/"), F.when(path.rlike(r"/\.\.?$"), F.lit("/")).otherwise(F.lit("")))
    return F.when(path.rlike(r"/\.\.?(/|$)"), F.when(whole.startswith("/"), whole).otherwise(F.concat(F.lit("/"), whole))).otherwise(path)


def resolve(target: Column, url: Column) -> Column:
    """Absolute form of a link found on a page; null for schemes without ``//`` and on pages without a host."""
    target = F.replace(target, F.lit("&amp;"), F.lit("&"))
    root = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_replace(url_path(url), r"[^/]*$", "")
    own, rest = F.regexp_extract(target, r"(?s)^([^?#]*)", 1), F.regexp_extract(target, r"(?s)^[^?#]*(.*)$", 1)
    below = F.concat(F.when(own.startswith("/"), F.lit("")).when(folder == "", F.lit("/")).otherwise(folder), own)
    return (F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), target)
            .when(target.startswith("//"), F.concat(F.lit("http:"), target))
            .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:") | (root == ""), F.lit(None))
            .when(target.startswith("#"), F.concat(F.regexp_replace(url, r"(?s)#.*$", ""), target))
            .when(target.startswith("?"), F.concat(root, url_path(url), target))
            .otherwise(F.concat(root, without_dots(below), rest)))


def _any_group(text: Column, pattern: str) -> Column:
    """The one of three groups that matched, else the empty text."""
    return F.trim(F.concat(*[F.regexp_extract(text, pattern, i) for i in (1, 2, 3)]))


def page_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(url, target) of all canonical links and redirects stated in the pages."""
    found = narrow(pages, url=url_col, html=html_col).select("url", F.explode(F.regexp_extract_all("html", F.lit(TAGS), F.lit(0))).alias("tag"))
    tag = F.regexp_replace("tag", r"\s", " ")
    content = _any_group(_any_group(tag, VALUE % "content"), REFRESH_URL)
    target = (F.when(tag.rlike(CANONICAL), _any_group(tag, VALUE % "href"))
              .when(tag.rlike(REFRESH), F.when(content != "", content).otherwise(F.regexp_extract(tag, BARE_REFRESH_URL, 1))))
    return (found.select("url", target.alias("target")).where("target <> ''")
            .select("url", resolve(F.col("target"), F.col("url")).alias("target")).where("target is not null"))


def judge_urls(pages: DataFrame, edges: DataFrame, rules: Iterable[tuple[str, str, str]] = DEFAULT_RULES,
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: the id, host, path, rule, verdict. ``edges``: (url, target) of redirects."""
    rules = tuple(rules)
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    made = narrow(pages, row_id=id_col, url=url_col).select("row_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = own_rule(F.col("host"), F.col("path"), rules)
    made = stored(made.withColumns({"rule": rule, "own": verdict}), "urls")

    links = edges.select("url", "target").unionByName(edges.select(F.col("target").alias("url"), plain_form(F.col("target")).alias("target"))).unionByName(
        edges.select("url", plain_form(F.col("url")).alias("target"))).unionByName(  # a source need not be a page
        made.select("url", plain_form(F.col("url")).alias("target"))).where("url like '%://%' and target is not null")
    groups = stored(components(links, "url", "target"), "aliases")
    # every member counts, pages or not; plain forms have no host, so no rule fits them
    decided = groups.select("component", own_rule(url_host(F.col("node")), url_path(F.col("node")), rules)[1].alias("own")).where("own is not null")
    blocked = stored(decided.groupBy("component").agg(F.bool_or(F.col("own") == "allow").alias("allowed"), F.bool_or(F.col("own") == "block").alias("blocked"))
                     .where("blocked and not allowed").select("component"), "blocked")
    blocked = F.broadcast(blocked) if small_enough(blocked) else blocked  # else one that Spark can split
    taken = stored(groups.join(blocked, "component", "left_semi").select(F.col("node")), "taken")
    taken = F.broadcast(taken) if small_enough(taken) else taken
    out = made.join(taken, F.col("url") == F.col("node"), "left")  # a hot url is one row of ``taken``
    inherited = F.when(F.col("node").isNotNull(), F.lit("block")).otherwise(F.lit("allow"))
    return out.select(F.col("row_id").alias(id_col), "host", "path", "rule", F.coalesce("own", inherited).alias("verdict"))
