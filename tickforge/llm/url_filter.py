r"""URL allow and block rules that reach aliases over redirects and canonical links.

A rule is a host and the beginning of a path; it fits its host and all subdomains, and the longest fitting rule decides.  A url without
a rule takes the method's verdict: pages and their redirect or canonical targets form connected components, and an
alias of a blocked url is blocked, unless its component also holds an explicitly allowed url.  Whatever nothing blocks is allowed.  Rules are held against urls as they are
written, in links as in pages: the form in which equivalent urls are equal only says which belong together.

Edges come from ``<link rel=canonical>`` and ``<meta http-equiv=refresh>`` of each page, and from a table of redirects
if there is one.  Targets are unescaped and resolved against their page; a node is a url without fragment and default port, with scheme and host in small
letters and at least ``/`` for a path.  Only edges and the urls that they touch are shuffled.

Defined results: a null url, or one without ``://``, has an empty host and path and fits no rule; null html has no edges; pages with
the same url share a verdict; targets of pages without ``://`` and targets with another scheme than ``x://`` (mail, scripts) are ignored; dots in
relative targets stay but for a leading ``./``; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .scratch import materialize

#: Fixed rules: (host, beginning of the path, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
UPPER, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, UPPER, SMALL)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: tuple = RULES) -> Column:
    """The longest fitting rule as ``(rule, verdict)``, else null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for h, p, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def with_node(rows: DataFrame, url: str, out: str) -> DataFrame:
    """``rows`` with ``out``, the form of a url in which equivalent ones are equal; others without ``://`` stay as they are.

    The parts are columns of their own, so the url is taken apart once, whatever is made of them.
    """
    parts = {f"_{out}{i}": F.regexp_extract(url, r"(?s)^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^#]*)", i) for i in (1, 2, 3)}
    rows = rows.withColumns(parts)
    one, two, rest = map(F.col, parts)
    scheme, host = F.translate(one, UPPER, SMALL), F.translate(two, UPPER, SMALL)
    host = F.when(scheme == "http", F.regexp_replace(host, ":(?:80)?$", "")).when(scheme == "https", F.regexp_replace(host, ":(?:443)?$", "")).otherwise(host)
    whole = F.concat(scheme, F.lit("://"), host, F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest)))
    return rows.withColumn(out, F.when(one == "", F.regexp_replace(url, r"(?s)#.*$", "")).otherwise(whole)).drop(*parts)


def with_target(rows: DataFrame, base: str, target: str, out: str) -> DataFrame:
    """``rows`` with ``out``, the absolute url that a target on the page ``base`` names; null if it names none."""
    plain = F.col(target)
    for entity, char in (("&#38;", "&"), ("&#x26;", "&"), ("&amp;", "&")):
        plain = F.replace(plain, F.lit(entity), F.lit(char))
    rows = rows.withColumns({
        "_to": plain,
        "_scheme": F.regexp_extract(base, r"(?s)^([^:/?#]+:)//", 1),
        "_site": F.regexp_extract(base, r"(?s)^([^:/?#]+://[^/?#]*)", 1),
        "_page": F.regexp_extract(base, r"(?s)^([^:/?#]+://[^?#]*)", 1),
        "_folder": F.regexp_extract(base, r"(?s)^([^:/?#]+://[^?#]*/)[^/?#]*", 1),
    })
    to, site, folder = F.col("_to"), F.col("_site"), F.col("_folder")
    url = (
        F.when((to == "") | (site == ""), None)
        .when(to.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), to)
        .when(to.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), None)
        .when(to.startswith("//"), F.concat("_scheme", to))
        .when(to.startswith("/"), F.concat(site, to))
        .when(to.startswith("?"), F.concat("_page", to))
        .when(to.startswith("#"), F.col(base))
        .otherwise(F.concat(F.when(F.length(folder) > F.length(site), folder).otherwise(F.concat(site, F.lit("/"))), F.regexp_replace(to, r"^(?:\./)+", "")))
    )
    return rows.withColumn(out, url).drop("_to", "_scheme", "_site", "_page", "_folder")


def links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``from, to``: each page that names another url as its canonical form or redirects to it, and that url, as they are written."""
    html = F.col(html_col)
    tag = F.regexp_extract(html, r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?canonical\b)[^>]*>", 0)
    canonical = F.regexp_extract(tag, r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1)
    meta = F.regexp_extract(html, r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)[^>]*>", 0)
    refresh = F.regexp_extract(meta, r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)", 1)
    rows = pages.filter(F.col(url_col).isNotNull() & html.rlike("(?i)canonical|http-equiv"))
    rows = rows.select(F.col(url_col).alias("from"), F.explode(F.array(canonical, refresh)).alias("said")).filter("said <> ''")
    return with_target(rows, "from", "said", "to").filter("to is not null").select("from", "to")


def _verdicts(urls: DataFrame, rules: tuple) -> DataFrame:
    """``node, said`` of the urls ``url, node`` that a rule fits as they are written."""
    return urls.select("node", rule_for(host_of(F.col("url")), path_of(F.col("url")), rules)["verdict"].alias("said")).filter("said is not null")


def filter_urls(pages: DataFrame, redirects: DataFrame | None = None, rules: tuple = RULES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col, host, path, rule, verdict`` of each page.  ``redirects``: columns ``u, v`` of urls."""
    written = links(pages, url_col, html_col)
    if redirects is not None:
        written = written.unionByName(redirects.select(F.col("u").alias("from"), F.col("v").alias("to")).filter("u is not null and v is not null"))
    written = materialize(with_node(with_node(written, "from", "u"), "to", "v"), "links")
    groups = connected_components(written.select("u", "v"))
    rows = with_node(pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url")), "_url", "_node")
    rows = rows.withColumn("host", host_of(F.col("_url"))).withColumn("path", path_of(F.col("_url")))
    rows = rows.withColumn("_rule", rule_for(F.col("host"), F.col("path"), rules))
    # What rules say of the urls of a group as they are written: those of links, and those of pages without links.
    ends = written.select(F.col("from").alias("url"), F.col("u").alias("node")).unionByName(written.select(F.col("to").alias("url"), F.col("v").alias("node")))
    said = _verdicts(ends, rules).unionByName(rows.select(F.col("_node").alias("node"), F.col("_rule.verdict").alias("said")).filter("said is not null"))
    judged = groups.join(said, "node").groupBy("component").agg(F.max(F.col("said") == "block").alias("_block"), F.max(F.col("said") == "allow").alias("_allow"))
    blocked = groups.join(judged.filter(F.col("_block") & ~F.col("_allow")), "component").select("node")
    rows = rows.join(blocked.withColumn("_alias", F.lit(True)), F.col("_node") == F.col("node"), "left")
    return rows.select(
        F.col("_id").alias(id_col),
        "host",
        "path",
        F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", F.when(F.col("_alias"), "block").otherwise("allow")).alias("verdict"),
    )
