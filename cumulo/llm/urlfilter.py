"""URL filters with redirect equivalence.

Rules (allow or block a host with its subdomains, under a path) judge urls
directly.  Urls are tied together by what names the same page: the canonical
form of a url, canonical links and redirects found in the pages.  Distributed
connected components over those links carry block decisions to the aliases
that have no rule of their own; an explicit allow takes precedence.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cumulo.llm.common import stage
from cumulo.llm.components import components

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Query parameters that don't change the page.
_TRACKING = r"(^|&)(utm_[a-z]+|ref|fbclid|gclid)=[^&]*"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else ''."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else ''."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """The form in which equivalent urls agree: host, path without closing
    slashes, query without tracking parameters; no scheme, no fragment.  Null
    without a host."""
    query = F.regexp_replace(F.regexp_extract(url, r"://[^?#]*\?([^#]*)", 1), _TRACKING, "")
    query = F.ltrim(query, F.lit("&"))
    name = host(url)
    return F.when(name != "", F.concat(
        name, F.rtrim(path(url), F.lit("/")), F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def rule_of(url: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Struct (``rule``, ``action``) of the longest rule that fits, else null.
    ``rules``: (action, host, path), a short list of literals."""
    h, p = host(url), path(url)
    found = F.lit(None).cast("struct<rule:string,action:string>")
    for action, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):
        fits = ((h == rule_host) | F.endswith(h, F.lit("." + rule_host))) & F.startswith(p, F.lit(rule_path))
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(action).alias("action"))).otherwise(found)
    return found


def _without_dots(path: Column) -> Column:
    """A path without ``.`` and ``..`` segments."""
    return F.array_join(F.aggregate(
        F.split(path, "/"), F.array().cast("array<string>"),
        lambda done, s: F.when(s == ".", done).when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1))))
        .otherwise(F.concat(done, F.array(s)))), "/")


def resolve(url: Column, link: Column) -> Column:
    """The absolute url of a link on the page ``url``; null for links to the page
    itself and other schemes' (``mailto:``).  ``&amp;`` is decoded."""
    link = F.replace(link, F.lit("&amp;"), F.lit("&"))
    scheme, own = F.regexp_extract(url, r"^([^/?#]*)://", 1), path(url)
    site = F.concat(scheme, F.lit("://"), host(url))
    rest, place = F.regexp_extract(link, r"[?#].*$", 0), F.regexp_extract(link, r"^[^?#]*", 0)
    folder = F.when(own == "", F.lit("/")).otherwise(F.regexp_replace(own, r"[^/]*$", ""))
    return (F.when((link == "") | F.startswith(link, F.lit("#")), F.lit(None).cast("string"))
            .when(F.startswith(link, F.lit("//")), F.concat(scheme, F.lit(":"), link))
            .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
            .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))
            .when(F.startswith(link, F.lit("?")), F.concat(site, own, link))
            .when(F.startswith(link, F.lit("/")), F.concat(site, _without_dots(place), rest))
            .otherwise(F.concat(site, _without_dots(F.concat(folder, place)), rest)))


def targets(url: Column, html: Column) -> Column:
    """Array of the absolute urls that a page names as its canonical link or
    redirects to; relative ones are resolved against the page's url."""
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<(?:link|meta)\s[^>]*>"), F.lit(0))
    canon = F.filter(tags, lambda t: t.rlike(r"(?is)^<link\s[^>]*rel\s*=\s*[\"']?canonical\b"))
    moved = F.filter(tags, lambda t: t.rlike(r"(?is)^<meta\s[^>]*http-equiv\s*=\s*[\"']?refresh\b"))
    found = F.concat(
        F.transform(canon, lambda t: F.regexp_extract(t, r"(?is)href\s*=\s*[\"']?([^\"'\s>]+)", 1)),
        F.transform(moved, lambda t: F.regexp_extract(t, r"(?is)url\s*=\s*[\"']?((?:&amp;|[^\"'\s>;])+)", 1)))
    return F.filter(F.transform(found, lambda t: resolve(url, t)), lambda t: host(t) != "")


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]], id_col: str = "page_id",
          url_col: str = "url", html_col: str = "html", extra_links: DataFrame | None = None) -> DataFrame:
    """``id_col``, ``host``, ``path``, ``rule``, ``verdict``, ``alias_of_block``.

    The longest fitting rule decides.  A url without a rule is blocked if an
    equivalent url is blocked and no equivalent url is explicitly allowed
    (``alias_of_block``); else it is allowed.  ``extra_links`` may hold more
    redirects as (``from_url``, ``to_url``).  Null urls and urls without
    ``://`` have an empty host and path, no rule and no aliases, and are
    allowed; null html has no links; repeated rows are judged alike; an empty
    table gives an empty result.
    """
    url = F.col("url")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    linked = (rows.filter(F.col("html").rlike(r"(?i)canonical|http-equiv"))
              .select(url, F.explode(targets(url, F.col("html"))).alias("to")))
    if extra_links is not None:
        linked = linked.unionByName(extra_links.select(F.col("from_url").alias("url"), F.col("to_url").alias("to")))
    linked = stage(linked.distinct(), "url-links")
    named = (rows.select(url).unionByName(linked.select(url)).unionByName(linked.select(F.col("to").alias("url"))))
    action = rule_of(url, rules)["action"]
    # only urls under a rule, by canonical form, and the pages' links matter
    flags = (named.select(canonical(url).alias("node"), action.alias("action"))
             .filter("node is not null and action is not null")
             .groupBy("node").agg(F.max(F.col("action") == "block").alias("block"),
                                  F.max(F.col("action") == "allow").alias("allow")))
    roots = stage(components(linked.select(canonical(url).alias("a"), canonical(F.col("to")).alias("b"))), "url-roots")
    group = F.coalesce("root", "node")
    blocked = (flags.join(roots, "node", "left").groupBy(group.alias("group"))
               .agg(F.max("block").alias("block"), F.max("allow").alias("allow"))
               .filter("block and not allow").select("group"))
    judged = rows.select(
        "id", host(url).alias("host"), path(url).alias("path"), rule_of(url, rules).alias("r"),
        canonical(url).alias("node"))
    own = judged.filter("r is not null").select("id", "host", "path", "r", F.lit(False).alias("alias"))
    # the few groups that pass a block on, by node: members by link, else the node itself
    inherits = stage(blocked.join(roots, F.col("group") == F.col("root"), "left")
                     .select(F.coalesce("node", "group").alias("node")).distinct(), "blocked-nodes")
    open_rows = judged.filter("r is null").join(
        inherits.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left").select(
            "id", "host", "path", "r", F.col("n").isNotNull().alias("alias"))
    return own.unionByName(open_rows).select(
        F.col("id").alias(id_col), "host", "path", F.col("r.rule").alias("rule"),
        F.coalesce(F.col("r.action"), F.when(F.col("alias"), "block").otherwise("allow")).alias("verdict"),
        F.col("alias").alias("alias_of_block"))
