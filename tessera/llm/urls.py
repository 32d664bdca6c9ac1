"""URL filters with redirect equivalence.

Rules block or allow a host, with its subdomains, under a path prefix; the
longest rule that fits decides.  Urls that no rule fits follow their aliases:
urls joined by redirects, canonical links and the dropping of tracking
parameters, over any number of steps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import lower_ascii
from tessera.llm.components import connected_components

# Fixed values: (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

# Query parameters that do not name another page.
TRACKING = r"(utm_[a-z]+|ref|gclid|fbclid)=[^&]*"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def url_host(url: Column) -> Column:
    """From the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return F.coalesce(lower_ascii(F.regexp_extract(_rest(url), r"(?s)^[^/?#]*", 0)), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def url_node(url: Column) -> Column:
    """A url without scheme and fragment, host in lower case; null without ``://``."""
    query = F.regexp_extract(_rest(url), r"(?s)^[^?#]*(\?[^#]*)", 1)
    return F.when(F.instr(url, "://") > 0, F.concat(url_host(url), url_path(url), query))


def canonical_node(node: Column) -> Column:
    """The node without tracking parameters and without a slash at its end
    (a host's root keeps its own)."""
    bare = F.regexp_replace(node, rf"(?<=[?&]){TRACKING}(&|$)", "")
    bare = F.regexp_replace(bare, r"[?&]+$", "")
    return F.regexp_replace(bare, r"(?s)^([^/]+/.*[^/])/$", "$1")


def _html_target(html: Column, tag: str, mark: str, value: str) -> Column:
    """The url that the first ``tag`` with ``mark`` carries, or null."""
    el = F.regexp_extract(html, rf"(?is)<{tag}\b[^>]*\b{mark}[^>]*>", 0)
    got = F.regexp_extract(el, value, 1)
    return F.when(got != "", got)


def link_edges(pages: DataFrame) -> DataFrame:
    """(src, dst): aliases named by the pages.

    ``<link rel=canonical>``, ``<meta http-equiv=refresh>`` (absolute urls,
    ``//host`` and ``/path`` forms) and the url's own canonical form.
    """
    html = F.coalesce("html", F.lit(""))
    canonical = _html_target(html, "link", r"rel\s*=\s*[\"']?canonical", r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)")
    refresh = _html_target(html, "meta", r"http-equiv\s*=\s*[\"']?refresh", r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)")
    # The urls first, one row each; the node expressions then stand once in the plan.
    named = pages.filter(F.instr("url", "://") > 0).select("url", F.explode(F.array(F.col("url"), canonical, refresh)).alias("to"))
    to, url = F.col("to"), F.col("url")
    absolute = (
        F.when(to.startswith("//"), F.concat(F.lit("http:"), to))
        .when(to.startswith("/"), F.concat(F.lit("http://"), url_host(url), to))
        .otherwise(to)
    )
    e = named.filter("to is not null").select(url_node(url).alias("src"), absolute.alias("to"))
    e = e.filter(F.instr("to", "://") > 0).select("src", canonical_node(url_node(F.col("to"))).alias("dst"))
    return e.filter("src <> dst").distinct()


def rule_table(spark, rules=RULES) -> DataFrame:
    return spark.createDataFrame([tuple(r) for r in rules], "verdict string, rule_host string, rule_path string")


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, rule_verdict) for the distinct (host, path) pairs that a rule fits.

    A rule is found by equality on its host, among the host's suffixes, and on
    its path, among the path's prefixes.  Only prefixes as long as some rule of
    that host are made, so a url costs as many rows as its domain has unlike
    path lengths, never as many as it has rules.  The longest rule (host and
    path together) wins; equal lengths go to the longer host, rules that are
    both blocked and allowed are blocked.  Rules with a null fit nothing.
    """
    rules = rules.dropna(subset=["rule_host", "rule_path", "verdict"])
    lengths = rules.select("rule_host", F.length("rule_path").alias("n")).distinct()
    pairs = urls.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    by_host = pairs.select("host").distinct().select("host", F.explode(suffix).alias("rule_host")).join(lengths, "rule_host")
    asked = pairs.join(by_host, "host").filter(F.length("path") >= F.col("n"))
    asked = asked.select("host", "path", "rule_host", F.substr("path", F.lit(1), F.col("n")).alias("rule_path"))
    rule = F.concat("rule_host", "rule_path")
    best = F.max(F.struct(F.length(rule).alias("n"), F.length("rule_host").alias("h"), rule.alias("rule"), "verdict"))
    m = asked.join(rules, ["rule_host", "rule_path"]).groupBy("host", "path").agg(best.alias("r"))
    return m.select("host", "path", F.col("r.rule").alias("rule"), F.col("r.verdict").alias("rule_verdict"))


def judge_urls(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict for every row of ``pages``.

    A fitting rule decides.  Otherwise a page is blocked if a rule blocks any
    of its aliases and none is expressly allowed; else it is allowed.  Link
    targets count as aliases whether or not they are pages.  A null url, or
    one without ``://``, has empty host and path and no aliases.  Repeated
    rows are judged alike; an empty table gives no rows.
    """
    p = pages.select("page_id", "url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"), url_node(F.col("url")).alias("node"))
    edges = link_edges(pages)
    comp = connected_components(edges, "src", "dst")
    node_host, node_path = F.regexp_extract("node", r"(?s)^[^/?#]*", 0), F.regexp_extract("node", r"(?s)^[^/?#]*([^?#]*)", 1)
    nodes = comp.select("node", "component", node_host.alias("host"), node_path.alias("path"))
    matched = match_rules(p.select("host", "path").unionAll(nodes.select("host", "path")), rules)
    groups = (
        nodes.join(matched, ["host", "path"])
        .groupBy("component")
        .agg(F.max(F.col("rule_verdict") == "block").alias("blocked"), F.max(F.col("rule_verdict") == "allow").alias("allowed"))
        .filter("blocked and not allowed")
        .select("component")
    )
    aliased = nodes.join(groups, "component").select("node", "component")
    j = p.join(matched, ["host", "path"], "left").join(aliased, "node", "left")
    verdict = F.coalesce("rule_verdict", F.when(F.col("component").isNotNull(), F.lit("block")).otherwise(F.lit("allow")))
    return j.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
