"""URL rules, and redirect equivalence for the urls that no rule names.

Every url is judged by the longest rule that fits it. Urls without a rule take
the decision of their aliases: redirects, canonical links and refreshes make
edges between pages, connected components over them (distributed, see
:func:`tollgate.llm.common.components`) are the aliases of one resource, and a
block on any of them blocks the others, unless an allow rule names one of the
component: an explicit allow takes precedence. All else is allowed.

A node is a url without scheme and fragment, its host in lower case (A-Z); an
empty path counts as ``/`` for the node only. Link targets are read as a browser
does: character references decoded, relative ones resolved against the page's
url, ``.`` and ``..`` segments too; ``canonical`` may stand anywhere in ``rel``.
Pages' own urls are taken as they are.

Defined cases: a null url, or one without ``://``, has empty host and path, no
rule and no aliases, and is allowed; null html has no links; pages with one
url share a node and their links; links that point nowhere known still connect
the pages that have them; of two rules equally long, allow wins, then the
smaller; repeated rows are judged each; extra columns are ignored; an empty
table gives no rows; urls and html of any length are read whole, a page at a time.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tollgate.llm.common import Written, components

#: Rule lists up to this length are matched in place, longer ones by a join.
IN_PLACE = 256

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``host`` with all its subdomains, and paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @staticmethod
    def parse(verdict: str, text: str) -> "Rule":
        host, slash, path = text.partition("/")
        return Rule(verdict, host, slash + path)

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """The url's node; null without ``://``."""
    path = path_of(url)
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)?", 1)
    return F.when(url.contains("://"), F.concat(host_of(url), F.when(path == "", "/").otherwise(path), query))


def fits(host: Column, path: Column, rule_host: Column, rule_path: Column) -> Column:
    return ((host == rule_host) | host.endswith(F.concat(F.lit("."), rule_host))) & path.startswith(rule_path)


def judge(df: DataFrame, rules: list[Rule], host: str = "host", path: str = "path") -> DataFrame:
    """Add ``rule`` and ``rule_verdict`` of the longest rule that fits; nulls if none."""
    if not rules:
        return df.withColumns({"rule": F.lit(None).cast("string"), "rule_verdict": F.lit(None).cast("string")})
    if len(rules) <= IN_PLACE:
        # In falling order of precedence: the first that fits is the one.
        ranked = sorted(set(rules), key=lambda r: (-len(r.text), r.verdict, r.text))
        hit = lambda r: fits(F.col(host), F.col(path), F.lit(r.host), F.lit(r.path))
        return df.withColumns({
            "rule": F.coalesce(*(F.when(hit(r), r.text) for r in ranked)),
            "rule_verdict": F.coalesce(*(F.when(hit(r), r.verdict) for r in ranked)),
        })
    table = df.sparkSession.createDataFrame([(r.verdict, r.host, r.path) for r in set(rules)], "rv string, rh string, rp string")
    urls = df.select(F.col(host).alias("h"), F.col(path).alias("p")).distinct()
    labels = F.split("h", "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    best = urls.select("h", "p", F.explode(suffixes).alias("rh"))
    text = F.concat("rh", "rp")
    rank = F.struct((-F.length(text)).alias("n"), F.col("rv").alias("rule_verdict"), text.alias("rule"))
    best = best.join(table, "rh").filter(F.col("p").startswith(F.col("rp"))).groupBy("h", "p").agg(F.min(rank).alias("best"))
    best = Written(best.select("h", "p", "best.rule", "best.rule_verdict"), "rules").df
    return df.join(best, (F.col(host) == best.h) & (F.col(path) == best.p), "left").drop("h", "p")


def without_dots(path: str) -> str:
    """An absolute path with ``.`` and ``..`` segments resolved."""
    out: list[str] = []
    parts = path.split("/")
    for i, part in enumerate(parts):
        if part not in (".", ".."):
            out.append(part)
            continue
        if part == ".." and len(out) > 1:
            out.pop()
        if i == len(parts) - 1:
            out.append("")
    return "/".join(out)


def resolve(base: str, href: str) -> str | None:
    """The target of a link as written in html, as a url; None if it has another
    scheme. ``base`` has ``://``."""
    href = html.unescape(href).strip()
    scheme, _, rest = base.partition("://")
    host, path, query = re.match(r"(?s)([^/?#]*)([^?#]*)(\?[^#]*)?", rest).groups()
    if re.match(r"(?i)[a-z][a-z0-9+.-]*:", href):
        if not re.match(r"(?i)[a-z][a-z0-9+.-]*://", href):
            return None
        scheme, _, rest = href.partition("://")
        host, path, query = re.match(r"(?s)([^/?#]*)([^?#]*)(\?[^#]*)?", rest).groups()
    elif href.startswith("//"):
        host, path, query = re.match(r"(?s)([^/?#]*)([^?#]*)(\?[^#]*)?", href[2:]).groups()
    else:
        own, own_query = re.match(r"(?s)([^?#]*)(\?[^#]*)?", href).groups()
        if not own:  # the page itself, or its path with another query
            return f"{scheme}://{host}{path}{query if own_query is None else own_query}" if query or own_query else f"{scheme}://{host}{path}"
        path, query = own if own.startswith("/") else (path[:path.rfind("/") + 1] or "/") + own, own_query
    return f"{scheme}://{host}{without_dots(path)}{query or ''}"


def attribute(tag: Column, name: str) -> Column:
    """An attribute's value as written, without its quotes; empty if absent."""
    value = F.regexp_extract(tag, rf"(?is)\s{name}\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)", 1)
    return F.regexp_replace(value, "^[\"']|[\"']$", "")


def page_links(page: Column) -> Column:
    """Targets of a page's canonical links and refreshes, as written."""
    tags = lambda name: F.regexp_extract_all(page, F.lit(rf"(?is)<{name}\s(?:\"[^\"]*\"|'[^']*'|[^>\"'])*>"), 0)
    words = lambda v: F.split(F.lower(F.trim(v)), r"\s+")
    links = F.filter(tags("link"), lambda t: F.array_contains(words(attribute(t, "rel")), "canonical"))
    moves = F.filter(tags("meta"), lambda t: F.lower(F.trim(attribute(t, "http-equiv"))) == "refresh")
    href = F.concat(
        F.transform(links, lambda t: attribute(t, "href")),
        F.transform(moves, lambda t: F.regexp_extract(attribute(t, "content"), r"(?is)url\s*=\s*[\"']?([^\"'\s]*)", 1)))
    return F.filter(href, lambda h: h != "")


def alias_edges(pages: DataFrame, url_col: str, html_col: str, redirects: DataFrame | None) -> DataFrame:
    """Edges (a, b) between nodes; ``redirects`` has columns ``src`` and ``dst``, urls."""
    links = pages.select(F.col(f"`{url_col}`").alias("u"), F.explode(page_links(F.col(f"`{html_col}`"))).alias("href"))

    @F.pandas_udf("string")
    def target(base: pd.Series, href: pd.Series) -> pd.Series:
        return pd.Series([resolve(u, h) for u, h in zip(base, href)], dtype=object)

    links = links.filter(F.col("u").contains("://"))
    edges = links.select(node_of(F.col("u")).alias("a"), node_of(target("u", "href")).alias("b"))
    if redirects is not None:
        edges = edges.unionByName(redirects.select(node_of(F.col("src")).alias("a"), node_of(F.col("dst")).alias("b")))
    return edges.filter("a is not null and b is not null")


def verdicts(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
             redirects: DataFrame | None = None) -> DataFrame:
    """Rows (page_id, host, path, rule, verdict, alias_of): ``alias_of`` is the
    smallest node of the page's component, null for pages without aliases."""
    comp = components(alias_edges(pages, url_col, html_col, redirects), "aliases").df
    as_url = F.concat(F.lit("x://"), F.col("node"))
    named = judge(comp.select("node", "root", host_of(as_url).alias("host"), path_of(as_url).alias("path")), rules)
    roots = named.groupBy("root").agg(
        F.max((F.col("rule_verdict") == "allow").cast("int")).alias("allowed"), F.max((F.col("rule_verdict") == "block").cast("int")).alias("blocked"))
    passed = Written(comp.join(roots, "root").select(
        "node", F.col("root").alias("alias_of"), ((F.coalesce("blocked", F.lit(0)) == 1) & (F.coalesce("allowed", F.lit(0)) == 0)).alias("tainted")), "decisions").df
    url = F.col(f"`{url_col}`")
    own = judge(pages.select(F.col(f"`{id_col}`").alias("page_id"), host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("own")), rules)
    return own.join(passed, own.own == passed.node, "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("rule_verdict", F.when(F.col("tainted"), "block"), F.lit("allow")).alias("verdict"), "alias_of")
