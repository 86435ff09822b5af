"""URL filter whose decisions spread over redirects and canonical links.

A url's own rule, the longest that fits, always decides. All other urls ask the group of addresses that
name the same page: connected components over redirects and canonical links. A group with a blocked address is blocked,
unless one of its addresses is allowed by a rule: an explicit allow takes precedence over any propagated block.

Addresses are compared by ``address``: host, path and query without the parts that only track a visitor. So
two spellings of one address are one node, and no edge is needed. Everything is DataFrame code; only
addresses move, never a page's html, and groups are found by ``components``, whose hot keys are split.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from faqspark.llm.components import components
from faqspark.llm.rule_cascade import CAPITALS
from faqspark.llm.store import Saved

ALLOW, BLOCK = "allow", "block"
#: Query parameters that name a visit and not a page.
TRACKING = r"(?i)^(?:utm_[^=]*|gclid|fbclid|ref)(?:=|$)"
#: Tags that may name another address, and what tells a canonical link and a redirect among them.
TAG = r"(?i)<(?:link|meta)\b[^>]*>"
CANONICAL = r"""(?i)^<link\b.*\srel\s*=\s*["']?canonical["'\s/>]"""
REFRESH = r"""(?i)^<meta\b.*\shttp-equiv\s*=\s*["']?refresh["'\s/>]"""
HREF = r"""(?i)\shref\s*=\s*["']?([^"'\s>]*)"""
REFRESH_URL = r"""(?i)[\s;"']url\s*=\s*["']?\s*([^"'\s>]*)"""
COMMENT = r"(?s)<!--.*?-->"


@dataclass(frozen=True)
class UrlRule:
    """``action`` for urls of ``host`` and its subdomains whose path starts with ``path``."""

    action: str
    host: str
    path: str = "/"

    def __post_init__(self):
        if self.action not in (ALLOW, BLOCK):
            raise ValueError(f"unknown action {self.action!r}")

    @property
    def name(self) -> str:
        return self.host + self.path


#: Rules of the registered query.
RULES = (
    UrlRule(ALLOW, "org", "/"), UrlRule(BLOCK, "example.org", "/es/"), UrlRule(BLOCK, "example.org", "/en/1"),
    UrlRule(ALLOW, "com", "/fr/"), UrlRule(BLOCK, "com", "/de/"),
)


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty without one, and for null."""
    return F.when(F.contains(url, F.lit("://")), F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    """Up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), CAPITALS, CAPITALS.lower())


def path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def address(url: Column) -> Column:
    """Host, path without slashes at its end, and the query's parameters in order, without those that only track.

    Scheme, fragment and default ports are left out. Null for a url without host.
    """
    query = F.regexp_extract(_after_scheme(url), r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    name = F.regexp_replace(host(url), r":(?:80|443)$", "")
    full = F.concat(name, F.regexp_replace(path(url), "/+$", ""), F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))
    return F.when(name != "", full)


def resolved(target: Column, url: Column) -> Column:
    """A link's target as a whole url, seen from the page at ``url``; segments ``..`` are kept. Null for an empty one."""
    base = F.concat(F.lit("http://"), host(url))
    folder = F.regexp_extract(path(url), r"^(?:.*/)?", 0)
    bare = F.regexp_replace(F.trim(target), "(?i)&amp;", "&")
    return (
        F.when(bare == "", None)
        .when(bare.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), bare)
        .when(bare.startswith("//"), F.concat(F.lit("http:"), bare))
        .when(bare.startswith("/"), F.concat(base, bare))
        .otherwise(F.concat(base, F.when(folder == "", "/").otherwise(folder), F.regexp_replace(bare, r"^\./", ""))))


def links(pages: DataFrame) -> DataFrame:
    """(source, target) urls of canonical links and redirecting ``meta`` tags of pages (url, html), outside comments."""
    html = F.when(F.col("html").rlike("(?i)canonical|http-equiv"), F.regexp_replace("html", COMMENT, ""))
    flat = F.transform(F.regexp_extract_all(html, F.lit(TAG), F.lit(0)), lambda tag: F.regexp_replace(tag, r"\s+", " "))
    named = F.transform(flat, lambda tag: F.when(tag.rlike(CANONICAL), F.regexp_extract(tag, HREF, 1)).when(
        tag.rlike(REFRESH), F.regexp_extract(tag, REFRESH_URL, 1)))
    found = pages.select(F.col("url").alias("source"), F.explode(F.array_compact(named)).alias("target"))
    return found.select("source", resolved(F.col("target"), F.col("source")).alias("target")).where("source IS NOT NULL AND target IS NOT NULL")


def with_rule(urls: DataFrame, rules: Sequence[UrlRule]) -> DataFrame:
    """``urls`` (url, ...) with host, path, and the name and action of the rule that decides: rule, action, null if none fits.

    The longest rule that fits decides, of equally long ones that of the longer host.
    """
    parsed = urls.withColumns({"host": host(F.col("url")), "path": path(F.col("url"))})
    out = F.struct(F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("action"))
    for rule in sorted(rules, key=lambda r: (len(r.name), len(r.host))):
        name = rule.host.translate(str.maketrans(CAPITALS, CAPITALS.lower()))
        fits = ((F.col("host") == name) | F.endswith("host", F.lit(f".{name}"))) & F.startswith("path", F.lit(rule.path))
        out = F.when(fits, F.struct(F.lit(rule.name).alias("name"), F.lit(rule.action).alias("action"))).otherwise(out)
    return parsed.withColumn("found", out).withColumns({"rule": F.col("found.name"), "action": F.col("found.action")}).drop("found")


def decisions(addresses: DataFrame, groups: DataFrame) -> DataFrame:
    """(address, blocked) of addresses in groups that a rule blocks and none allows.

    ``addresses`` (address, action) has a row per url, ``groups`` (id, component_id) those that links name.
    Actions are folded per address before they meet the groups, and per group before addresses are looked up.
    """
    flags = (F.bool_or(F.col("action") == ALLOW), F.bool_or(F.col("action") == BLOCK))
    known = addresses.where("address IS NOT NULL")
    folded = known.groupBy("address").agg(*(f.alias(n) for f, n in zip(flags, ("allow", "block"))))
    placed = folded.join(groups, F.col("address") == F.col("id"), "left").select(
        "address", F.coalesce("component_id", "address").alias("group"), "allow", "block")
    # Of one address in a group the flags are known already; larger groups are folded too.
    bad = placed.where("allow OR block").groupBy("group").agg(F.bool_or("allow").alias("allow"), F.bool_or("block").alias("block"))
    bad = bad.where("block AND NOT coalesce(allow, false)").select(F.col("group").alias("bad"))
    return placed.join(bad, F.col("group") == F.col("bad"), "left_semi").select("address")


def url_verdicts(pages: DataFrame, rules: Sequence[UrlRule] = RULES, *, redirects: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of ``pages`` (page_id, url, html).

    ``redirects`` (source, target) are further urls that lead to each other. ``rule`` is null where none fits; then the
    verdict is that of the url's group, allow without one. Null urls and those without ``://`` have empty host and path
    and are allowed. Repeated rows get equal verdicts; further columns are left alone, missing html means no links.
    """
    rows = pages.select("page_id", "url")
    edges = links(pages)
    if redirects is not None:
        edges = edges.unionByName(redirects.select("source", "target").where("source IS NOT NULL AND target IS NOT NULL"))
    edges = Saved(edges.select("source", "target", address(F.col("source")).alias("a"), address(F.col("target")).alias("b")).where("a IS NOT NULL AND b IS NOT NULL"), "url-edges")
    groups = components(edges.df.select("a", "b"))
    named = edges.df.select(F.explode(F.array("source", "target")).alias("url"))
    urls = with_rule(rows.select("url").unionByName(named), rules)
    bad = decisions(urls.select(address(F.col("url")).alias("address"), "action"), groups).withColumnRenamed("address", "bad")
    judged = with_rule(rows, rules).withColumn("address", F.when(F.col("action").isNull(), address(F.col("url"))))
    return judged.join(bad, F.col("address") == F.col("bad"), "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("action", F.when(F.col("bad").isNotNull(), BLOCK).otherwise(ALLOW)).alias("verdict"))


def without_blocked(pages: DataFrame, rules: Sequence[UrlRule] = RULES, *, redirects: DataFrame | None = None) -> DataFrame:
    """The rows of ``pages`` that are not blocked, all columns kept, whatever their names."""
    own = [f"c{k}" for k in range(len(pages.columns))]
    plain = pages.toDF(*own)
    at = {c: F.col(o) for c, o in zip(pages.columns, own)}
    verdict = url_verdicts(plain.select(F.struct(*own).alias("page_id"), at["url"].alias("url"), at["html"].alias("html")), rules, redirects=redirects)
    return verdict.where(F.col("verdict") != BLOCK).select(*[F.col(f"page_id.{o}").alias(c) for o, c in zip(own, pages.columns)])
