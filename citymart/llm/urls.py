"""Blocking pages by rules on their urls, carried over redirects and canonical links to their aliases."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citymart.llm.components import connected_components

#: Tags that name another address of the same page, and the attribute that holds it.
_TAG = r"(?is)<(?:link|meta)\b[^>]*>"
_CANONICAL = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b"
_REFRESH = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b"
_HREF = r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
_TARGET = r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)"


def _lower(column: Column) -> Column:
    """A-Z only."""
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, in lower case; else empty."""
    return _lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _without_dots(path: Column) -> Column:
    """``path`` without the segments ``.`` and ``..``, which lead to the folder itself and the one above."""

    def step(done: Column, name: Column) -> Column:
        up = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(name == "..", up).when(name == ".", done).otherwise(F.concat(done, F.array(name)))

    names = F.split(F.regexp_replace(path, r"/(\.\.?)$", "/$1/"), "/")
    kept = F.aggregate(F.slice(names, 2, F.size(names)), F.array().cast("array<string>"), step)
    return F.when(F.instr(path, "/.") > 0, F.concat(F.lit("/"), F.array_join(kept, "/"))).otherwise(path)


def address(url: Column) -> Column:
    """Address by which pages and links meet: host, path and query, without scheme and fragment. An
    empty path is ``/``."""
    query = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^[^?#]*(\?[^#]*)", 1)
    path = F.when(path_of(url) == "", F.lit("/")).otherwise(_without_dots(path_of(url)))
    return F.when(F.instr(url, "://") > 0, F.concat(host_of(url), path, query))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits as ``host/path`` text and its verdict; NULL if none does.

    Rules are (verdict, host, path). A rule fits its host and all subdomains if the path starts with
    the rule's. Of rules of equal length ``allow`` goes first. There are few rules, so they are
    expressions, tried from the longest on.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[0] == "allow", r)):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(decision)).otherwise(verdict)
    return name, verdict


def alias_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Pairs of addresses, ``a`` and ``b``: a page's own and one that it redirects to or calls canonical.

    Links are read from ``<link rel=canonical>`` and ``<meta http-equiv=refresh>``. Addresses without
    host are resolved against the page's: those that begin with a slash against its host, with ``?``
    against its path, others against its folder. A page with an empty path has no folder here, and an
    address with another scheme (``mailto:``) is none.
    """
    tags = pages.filter(F.col(html_col).rlike(r"(?i)canonical|refresh")).select(
        F.col(url_col).alias("url"), F.explode(F.regexp_extract_all(html_col, F.lit(_TAG), F.lit(0))).alias("tag")
    )
    found = F.when(F.col("tag").rlike(_CANONICAL), F.regexp_extract("tag", _HREF, 1)).when(
        F.col("tag").rlike(_REFRESH), F.regexp_extract("tag", _TARGET, 1)
    )
    links = tags.select("url", F.replace(found, F.lit("&amp;"), F.lit("&")).alias("to")).filter("to <> ''")
    site = F.concat(F.lit("http://"), host_of(F.col("url")))
    to = (
        F.when(F.col("to").startswith("//"), F.concat(F.lit("http:"), "to"))
        .when(F.col("to").startswith("/"), F.concat(site, "to"))
        .when(F.col("to").startswith("?"), F.concat(site, path_of(F.col("url")), "to"))
        .when(F.col("to").rlike(r"^([A-Za-z][A-Za-z0-9+.-]*:|#)") | F.regexp_like(F.col("to"), F.lit("^[^?#]*://")), F.col("to"))
        .when(path_of(F.col("url")) != "", F.concat(site, F.regexp_extract(path_of(F.col("url")), "(?s)^.*/", 0), "to"))
    )
    links = links.select(address(F.col("url")).alias("a"), address(to).alias("b"))
    return links.filter("a is not null and b is not null and a <> b").distinct()


def judge_pages(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    links: DataFrame | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """One row per row of ``pages``: ``id_col``, ``host``, ``path``, ``rule``, ``verdict``.

    A page's own rule decides. Without one it shares the fate of its aliases, the addresses joined to
    its own by redirects and canonical links in either direction (those in the pages, or ``links``
    with ``a`` and ``b``): ``allow`` if a rule allows one of them, else ``block`` if a rule blocks
    one, else ``allow``. A linked address counts even if no page has it. NULL urls and those without
    ``://`` have an empty host and path, no aliases, and no rule unless one is empty. Rows with NULL
    or repeated ids or urls are judged one by one, other columns are ignored, an empty table gives no
    rows.

    Only linked addresses enter the component search; verdicts are combined per component before
    they are joined back, and pages without links need no shuffle but that join.
    """
    if links is None:
        links = alias_links(pages, url_col, html_col)
    a, b = (F.regexp_replace(c, r"^([^/?#]+)(?=$|\?)", "$1/") for c in ("a", "b"))  # given ones may lack a path
    groups = connected_components(links.select(a.alias("a"), b.alias("b")))
    host, path = F.regexp_extract("node", r"(?s)^([^/?#]*)", 1), F.regexp_extract("node", r"(?s)^[^/?#]*([^?#]*)", 1)
    groups = groups.withColumn("verdict", matching_rule(host, path, rules)[1])
    fates = groups.groupBy("component").agg(F.min("verdict").alias("fate"))  # allow sorts before block
    fates = groups.join(fates.filter("fate is not null"), "component").select(F.col("node").alias("__address"), "fate")

    page = pages.select(id_col, host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"), address(F.col(url_col)).alias("__at"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    page = page.select("*", rule.alias("rule"), verdict.alias("__verdict"))
    judged = page.join(fates, F.col("__at") == F.col("__address"), "left")
    return judged.select(
        id_col, "host", "path", "rule", F.coalesce("__verdict", "fate", F.lit("allow")).alias("verdict")
    )
