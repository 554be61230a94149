"""URL filters with redirect equivalence.

Rules (action, host, path) fit a host and its subdomains where the path begins with the rule's; the
longest rule wins. A page that no rule fits takes the verdict of its aliases: pages are joined to what
they redirect to, by a table of redirects, by a canonical link or refresh in their HTML, and by writings
of one address that servers redirect (scheme, www, fragment, tracking parameters, closing slash or
.html). In a connected component of such edges an explicit allow goes before any block; without either,
the page is allowed.

Scale: hosts are matched to rules by equi-joins on their suffixes; the components use minimum labels and
joins only, never a gathered neighbourhood.

Edge cases: a null url or one without "://" has an empty host and path, fits no rule, has no aliases and
is allowed; null HTML has no links, very long HTML and urls are whole; pages with equal urls are aliases; of rules of one
length an allow goes first; every input row, repeated or not, gives a row; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrina.llm.components import connected_components
from vitrina.llm.tables import saved

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_QUERY = r"(?s)^.*?://[^?#]*(\?[^#]*)?"
_TRACKING = r"(?i)(?<=[?&])(?:utm_[a-z]+|gclid|fbclid)=[^&]*&?"
_CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*\bhref\s*=\s*["']?([^"'\s>]+)"""
_REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\burl\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: str | Column) -> Column:
    u = F.col(url) if isinstance(url, str) else url
    return F.translate(F.coalesce(F.regexp_extract(u, _PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: str | Column) -> Column:
    u = F.col(url) if isinstance(url, str) else url
    return F.coalesce(F.regexp_extract(u, _PARTS, 2), F.lit(""))


def normal_form(url: str | Column) -> Column:
    """One writing for addresses that differ in what servers redirect; null without "://"."""
    u = F.col(url) if isinstance(url, str) else url
    query = F.regexp_replace(F.regexp_replace(F.coalesce(F.regexp_extract(u, _QUERY, 1), F.lit("")), _TRACKING, ""), r"[?&]+$", "")
    path = F.regexp_replace(path_of(u), r"(?:/|/index\.html?|\.html?)$", "")
    return F.when(u.contains("://"), F.concat(F.lit("//"), F.regexp_replace(host_of(u), r"^www\.|:(?:80|443)$", ""), path, query))


def alias_edges(pages: DataFrame, redirects: DataFrame | None = None) -> DataFrame:
    """Edges (a, b) between urls and between urls and normal forms."""
    html = F.coalesce(F.col("html"), F.lit(""))
    linked = pages.select("url", F.when(html.contains("canonical"), F.regexp_extract(html, _CANONICAL, 1)).alias("canonical"), F.when(html.rlike("(?i)refresh"), F.regexp_extract(html, _REFRESH, 1)).alias("refresh"))
    targets = linked.select("url", F.explode(F.array("canonical", "refresh")).alias("to")).filter("to is not null and to <> ''")
    targets = targets.withColumn("to", F.when(F.col("to").startswith("/") & ~F.col("to").startswith("//"), F.concat(F.regexp_extract("url", r"(?s)^(.*?://[^/?#]*)", 1), "to")).otherwise(F.col("to")))
    edges = targets.select(F.col("url").alias("a"), F.col("to").alias("b"))
    if redirects is not None:
        edges = edges.unionByName(redirects.select(F.col("source").alias("a"), F.col("target").alias("b")))
    urls = pages.select("url").unionByName(edges.select(F.explode(F.array("a", "b")).alias("url"))).distinct()
    return edges.unionByName(urls.select(F.col("url").alias("a"), normal_form("url").alias("b"))).filter("a is not null and b is not null")


def fitting_rule(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct (host, path) of urls with the longest rule that fits: rule and action."""
    keys = urls.select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = keys.select("host", "path", F.explode(suffixes).alias("rule_host")).join(rules.select("action", F.col("host").alias("rule_host"), F.col("path").alias("rule_path")), "rule_host").filter(F.col("path").startswith(F.col("rule_path")))
    rule = F.concat("rule_host", "rule_path")
    return fits.groupBy("host", "path").agg(F.max_by(F.struct(rule.alias("rule"), "action"), F.struct(F.length(rule), F.col("action") == "allow")).alias("best")).select("host", "path", "best.*")


def url_verdicts(pages: DataFrame, rules: Iterable[tuple[str, str, str]], redirects: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule (null if none fits), verdict, and whether an alias decided it."""
    spark = pages.sparkSession
    table = spark.createDataFrame(list(rules), "action string, host string, path string")
    parsed = saved(pages.select("page_id", "url", host_of("url").alias("host"), path_of("url").alias("path")))
    none = "url is null or not contains(url, '://')"  # these fit no rule, and would all meet in one task of a join
    whole = parsed.filter(f"not ({none})")
    known = whole.join(fitting_rule(whole, table), ["host", "path"], "left").select(*parsed.columns, "rule", "action")
    ruled = saved(known.unionByName(parsed.filter(none).select("*", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("action"))))
    groups = connected_components(alias_edges(pages, redirects), "a", "b", 2 * parsed.count())
    decided = ruled.filter("action is not null").select("url", "action").distinct().join(groups, F.col("url") == F.col("node")).groupBy("component").agg(F.max(F.col("action") == "allow").alias("allowed"))
    open_ = ruled.filter("action is null and url is not null").select("url").distinct().join(groups, F.col("url") == F.col("node")).join(decided, "component").select("url", "allowed")
    verdict = F.coalesce("action", F.when(F.col("allowed"), "allow").when(~F.col("allowed"), "block"), F.lit("allow"))
    told = ruled.filter("url is not null").join(open_, "url", "left").unionByName(ruled.filter("url is null").withColumn("allowed", F.lit(None).cast("boolean")))
    return told.select("page_id", "host", "path", "rule", verdict.alias("verdict"), (F.col("action").isNull() & F.col("allowed").isNotNull()).alias("by_alias"))
