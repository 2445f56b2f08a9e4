"""URL filter with redirect equivalence.

Explicit rules decide first: the longest rule that fits an url. An url without one takes
the decision of its aliases: urls that redirect, canonical links or the canonical form of
the address connect. Components of these edges are found in a distributed way. Pages, link
targets and both ends of known redirects vote by the rules, whether they are pages or not;
within a component an explicit allow goes before an explicit block, and without either the
url is allowed. A canonical form is only a way to connect and has no vote.

Defined cases: null or an url without ``://`` has empty host and path, no rule, no alias
and is allowed; the query and the fragment never matter; repeated pages are judged each;
pages without ``html`` have no links; an empty table gives an empty result.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, functions as F

from helixspan.llm.components import connected_components
from helixspan.llm.texts import pick
from helixspan.session import hand_over

#: Verdict and rule, a host followed by the start of a path.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)
ADDRESS = r"(?s)\A.*?://([^/?#]*)([^?#]*)"
CANONICAL = r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>"""
HREF = r"""(?is)(?<![\w-])href\s*=\s*["']?([^"'\s>]+)"""
REFRESH = r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""
REFRESH_URL = r"""(?is)\burl\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    host = F.coalesce(F.regexp_extract(url, ADDRESS, 1), F.lit(""))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, ADDRESS, 2), F.lit(""))


def by_rules(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null without one.

    A few rules are conditions in the plan; ties of length go to allow, then by text.
    """
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    order = sorted(rules, key=lambda r: (-len(r[1]), r[0] != "allow", r[1]), reverse=True)
    for decision, text in order:
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def canonical_form(host: Column, path: Column) -> Column:
    """Address without www. or m., an index page, the ending .html and closing slashes."""
    site = F.regexp_replace(host, r"\A(www|m)\.(?=[^.]+\.)", "")
    page = F.regexp_replace(path, r"(/index)?\.html?\z", "")
    return F.concat(site, F.regexp_replace(page, r"/+\z", ""))


def link_address(target: Column, host: Column) -> Column:
    """Node of a link's target; a path on the same host counts, other relative links don't."""
    absolute = F.concat(host_of(target), path_of(target))
    return F.when(target.contains("://"), absolute).when(
        target.startswith("/") & ~target.startswith("//"),
        F.concat(host, F.regexp_extract(target, r"\A([^?#]*)", 1)),
    )


def filter_urls(pages: DataFrame, rules=RULES, redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict for every page.

    ``redirects`` may add known redirects as columns src and dst.
    """
    has_html = "html" in pages.columns
    taken = pick(pages, "page_id", "url", *["html"] * has_html)
    html = F.col("html") if has_html else F.lit(None).cast("string")
    parts = taken.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
        F.regexp_extract(F.regexp_extract(html, CANONICAL, 0), HREF, 1).alias("canonical"),
        F.regexp_extract(F.regexp_extract(html, REFRESH, 0), REFRESH_URL, 1).alias("refresh"),
    )
    host, path = F.col("host"), F.col("path")
    rule, verdict = by_rules(host, path, rules)
    node = F.when(host != "", F.concat(host, path))
    judged = hand_over(
        parts.select(
            "page_id",
            "host",
            "path",
            rule.alias("rule"),
            verdict.alias("said"),
            node.alias("node"),
            F.array_compact(F.array(F.when(node.isNotNull(), canonical_form(host, path)))).alias("forms"),
            F.array_compact(
                F.array(link_address(F.col("canonical"), host), link_address(F.col("refresh"), host))
            ).alias("links"),
        ),
        "pages",
    )
    edges = judged.select(F.col("node").alias("src"), F.explode(F.concat("forms", "links")).alias("dst"))
    ends = judged.select(F.explode("links").alias("node"))
    if redirects is not None:
        known = [F.concat(host_of(F.col(c)), path_of(F.col(c))).alias(c) for c in ("src", "dst")]
        known = hand_over(pick(redirects, "src", "dst").select(*known), "redirects")
        edges = edges.unionByName(known)
        ends = ends.unionByName(known.select(F.explode(F.array("src", "dst")).alias("node")))
    edges = edges.where((F.col("dst") != "") & (F.col("src") != "") & (F.col("src") != F.col("dst")))
    groups = connected_components(edges, "src", "dst")
    # A node is a host and a path, and only the path has slashes.
    parts_of_node = [F.regexp_extract("node", r"(?s)\A([^/]*)(.*)", i) for i in (1, 2)]
    by_ends = ends.where("node IS NOT NULL").distinct()
    by_ends = by_ends.select("node", by_rules(*parts_of_node, rules)[1].alias("said"))
    said = judged.select("node", "said").unionByName(by_ends).where("said IS NOT NULL")
    votes = said.groupBy("node").agg(F.min("said").alias("said"))
    decided = (
        votes.join(groups, "node")
        .groupBy("component")
        .agg(F.min("said").alias("decision"))  # allow sorts before block
    )
    decided = hand_over(decided, "decided")
    by_node = hand_over(groups.join(decided, "component").select("node", "decision"), "decisions")
    return judged.join(by_node, "node", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("said", "decision", F.lit("allow")).alias("verdict"),
    )
