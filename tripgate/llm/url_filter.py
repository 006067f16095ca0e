"""URL filters by rules and redirect equivalence.

A rule (host, path, verdict) fits its host and all of that host's subdomains where the url's path starts with the
rule's; of the rules that fit, the longest (host and path together) decides, then the one with the longer host, then
an allowing one. Urls without a rule take the decision of their aliases: a page names other urls as its own by
``<link rel=canonical>`` and ``<meta http-equiv=refresh>``, and a table of redirects can add more. The connected
components of these links are classes of aliases, found in rounds of grouped minima over written tables. A url
without a rule is blocked where a rule blocks any url of its class, crawled or not; a rule that allows a url comes
before what its class says. Everything else is allowed.

The rules are a short list (``MAX_RULES``) and part of the plan, so judging them moves no rows. Only pages that name
another url reach the shuffles; a hub that many pages name as canonical is pre-aggregated in each round.

Defined cases: a null url, or one without ``://``, has empty host and path, fits no rule, has no aliases and is
allowed; null or empty html names nothing; tags in comments and scripts don't count; an unclosed comment or script
runs to the end. Urls are aliases as written, but for upper case in scheme and host and for the fragment; ``..`` isn't
resolved and an empty path isn't ``/``. Repeated pages are judged each; columns other than those named aren't read.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripgate.llm.common import materialize, small
from tripgate.llm.components import components

ALLOW, BLOCK = "allow", "block"
MAX_RULES = 500
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: scheme, host, path and query of a url; the first ``://`` counts.
URL = r"(?s)^(.*?)://([^/?#]*)([^?#]*)(\?[^#]*)?"
#: Comments and scripts, whose tags name nothing.
HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)"
TAG = r"(?i)<(?:link|meta)\s[^<>]*>"


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str


def site(url: Column) -> tuple[Column, Column]:
    """(host with A-Z lower-cased, path); both empty for null or without ``://``."""
    host = F.translate(F.regexp_extract(url, URL, 2), _UPPER, _LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(url, URL, 3), F.lit(""))


def ruled(host: Column, path: Column, rules: Iterable[Rule]) -> Column:
    """Struct (rule, verdict) of the rule that decides; null where none fits."""
    order = sorted(rules, key=lambda r: (-len(r.host + r.path), -len(r.host), r.verdict != ALLOW))
    if len(order) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules, got {len(order)}")
    decided = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in reversed(order):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        decided = F.when(fits, F.struct(F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(decided)
    return decided


def node(url: Column) -> Column:
    """The url as an alias is known by; null where it has no ``://``."""
    scheme, host, path, query = (F.regexp_extract(url, URL, i) for i in (1, 2, 3, 4))
    return F.when(F.contains(url, F.lit("://")), F.concat(
        F.translate(scheme, _UPPER, _LOWER), F.lit("://"), F.translate(host, _UPPER, _LOWER), path, query))


def attribute(tag: Column, name: str) -> Column:
    """An attribute's value, in either kind of quotes or none; empty if it isn't there."""
    pattern = rf"(?i)[\s\"'/]{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))"
    return F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)])


def resolved(base: Column, target: Column) -> Column:
    """A reference as an absolute url; null for schemes without ``://`` (mailto and the like)."""
    origin = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    path = F.regexp_extract(base, URL, 3)
    folder = F.regexp_extract(path, r"(?s)^(.*/)", 1)
    return (F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), target)
            .when(target.startswith("//"), F.concat(F.regexp_extract(base, URL, 1), F.lit(":"), target))
            .when(target.startswith("/"), F.concat(origin, target))
            .when((target == "") | target.startswith("#"), base)
            .when(target.startswith("?"), F.concat(origin, path, target))
            .when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
            .otherwise(F.concat(origin, F.when(folder == "", "/").otherwise(folder), target)))


def page_links(pages: DataFrame) -> DataFrame:
    """(url, target): what pages name as their canonical form or send their reader to at once."""
    naming = pages.select("url", "html").where(F.contains("url", F.lit("://")) & F.col("html").rlike("(?i)canonical|refresh"))
    tags = naming.select("url", F.explode(F.regexp_extract_all(F.regexp_replace("html", HIDDEN, " "), F.lit(TAG), F.lit(0))).alias("tag"))
    canonical = F.array_contains(F.split(F.lower(attribute(F.col("tag"), "rel")), r"\s+"), "canonical") & F.col("tag").rlike("(?i)^<link")
    refresh = (F.lower(F.trim(attribute(F.col("tag"), "http-equiv"))) == "refresh") & F.col("tag").rlike("(?i)^<meta")
    sent_to = F.regexp_extract(attribute(F.col("tag"), "content"), r"(?i)^\s*[0-9.]*\s*[;,]?\s*url\s*=\s*['\"]?([^'\"\s]+)", 1)
    target = F.when(canonical, attribute(F.col("tag"), "href")).when(refresh & (sent_to != ""), sent_to)
    named = tags.select("url", _present(F.replace(F.trim(target), F.lit("&amp;"), F.lit("&")), "target"))
    return named.select("url", _present(resolved(F.col("url"), F.col("target")), "target"))


def _present(value: Column, name: str) -> Column:
    """Rows where ``value`` isn't null; as a generator, so that Catalyst doesn't copy the expression into each use."""
    return F.explode(F.array_compact(F.array(value))).alias(name)


def blocked_aliases(links: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``node``: the urls of classes of aliases that hold a url blocked by a rule; each once."""
    ends = materialize(links.select("target", _present(node(F.col("url")), "a")).select("a", _present(node(F.col("target")), "b"))
                       .where("a <> b").distinct(), "alias-links")
    names = ends.select(F.col("a").alias("node")).unionByName(ends.select(F.col("b").alias("node"))).distinct()
    host, path = site(F.col("node"))
    # numbers instead of hashes, so no two urls fall together; written once, so they stay as they are
    nodes = materialize(names.select("node", (ruled(host, path, rules)["verdict"].eqNullSafe(BLOCK)).alias("blocked"),
                                     F.monotonically_increasing_id().alias("id")), "alias-nodes")
    numbered = ends.join(nodes.select(F.col("node").alias("a"), F.col("id").alias("u")), "a").join(
        nodes.select(F.col("node").alias("b"), F.col("id").alias("v")), "b").select("u", "v")
    classes = nodes.join(components(numbered), "id")
    hit = classes.where("blocked").select("component_id").distinct()
    return classes.join(hit, "component_id", "left_semi").select("node")


def judge(pages: DataFrame, rules: Sequence[Rule], redirects: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of every row of ``pages(page_id, url, html)``.

    ``redirects(url, target)`` adds links of aliases, as a crawl's log holds them.
    """
    links = page_links(pages)
    if redirects is not None:
        links = links.unionByName(redirects.select("url", "target"))
    aliases = materialize(blocked_aliases(links, rules), "blocked-aliases")
    host, path = site(F.col("url"))
    read = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    judged = read.select("page_id", "host", "path", ruled(F.col("host"), F.col("path"), rules).alias("by"), node(F.col("url")).alias("_node"))
    size = aliases.agg(F.count(F.lit(1)), F.max(F.length("node"))).first()
    found = judged.join(small(aliases.withColumn("_alias", F.lit(True)), size[0], 4 * (size[1] or 0) + 16), judged["_node"] == aliases["node"], "left")
    verdict = F.coalesce(F.col("by")["verdict"], F.when(F.col("_alias"), BLOCK), F.lit(ALLOW))
    return found.select("page_id", "host", "path", F.col("by")["rule"].alias("rule"), verdict.alias("verdict"))
