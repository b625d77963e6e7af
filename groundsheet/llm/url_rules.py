"""URL verdicts by rules, carried over redirects and canonical links."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from groundsheet.llm.components import components
from groundsheet.operators.lineage import materialize

ALLOW, BLOCK = "allow", "block"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LINK = r"(?is)<link\b[^>]*>"
_META = r"(?is)<meta\b[^>]*>"
_HREF = r"""(?is)\bhref\s*=\s*["']?([^"'\s>]+)"""
_TARGET = r"""(?is)\burl\s*=\s*["']?([^"'\s>]+)"""


def _has_site(url: Column) -> Column:
    return F.coalesce(F.instr(url, "://") > 0, F.lit(False))


def host(url: Column) -> Column:
    """From the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; empty for null or no ``://``."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.when(_has_site(url), F.translate(found, _UPPER, _LOWER)).otherwise("")


def path(url: Column) -> Column:
    """What follows the host up to ``? #`` or the end; empty for null or no ``://``."""
    return F.when(_has_site(url), F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(/[^?#]*)", 1)).otherwise("")


def page_key(url: Column) -> Column:
    """One name for a page: host, path and query, without scheme and fragment; null without a host."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
    return F.when(host(url) != "", F.concat(host(url), path(url), query))


def matching_rule(host_: Column, path_: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits, as a struct of rule and verdict; null if none does.

    A rule ``host/path`` fits its host and all subdomains where the path starts with the rule's.
    Every suffix of the host is looked up in a literal map, so rules cost no shuffle and no join.
    """
    if not rules:
        return F.lit(None).cast("struct<length:int,rule:string,verdict:string,start:string>")
    by_host: dict[str, dict[str, str]] = {}
    for verdict, rule in rules:
        if verdict not in (ALLOW, BLOCK):
            raise ValueError(f"verdict {verdict}")
        if by_host.setdefault(rule.partition("/")[0], {}).setdefault(rule, verdict) != verdict:
            raise ValueError(f"rule {rule} both allows and blocks")
    listed = []
    for name, own in sorted(by_host.items()):
        structs = [
            F.struct(F.lit(len(r)).alias("length"), F.lit(r).alias("rule"), F.lit(v).alias("verdict"), F.lit(r[len(name) :]).alias("start"))
            for r, v in sorted(own.items())
        ]
        listed += [F.lit(name), F.array(*structs)]
    known = F.create_map(*listed)
    labels = F.split(host_, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), ".")
    )
    fitting = F.filter(
        F.flatten(F.filter(F.transform(suffixes, lambda s: F.try_element_at(known, s)), lambda x: x.isNotNull())),
        lambda r: F.startswith(path_, r["start"]),
    )
    return F.array_max(fitting)


def alias_links(pages: DataFrame) -> DataFrame:
    """Pairs (url, target) of redirect and canonical-link edges declared in the pages' html.

    Targets are absolute addresses; a target without ``://`` names no host and is left out.
    """
    canonical = F.filter(F.regexp_extract_all("html", F.lit(_LINK), F.lit(0)), lambda t: t.rlike(r"""(?is)\brel\s*=\s*["']?canonical\b"""))
    refresh = F.filter(F.regexp_extract_all("html", F.lit(_META), F.lit(0)), lambda t: t.rlike(r"""(?is)\bhttp-equiv\s*=\s*["']?refresh\b"""))
    targets = F.concat(
        F.transform(canonical, lambda t: F.regexp_extract(t, _HREF, 1)),
        F.transform(refresh, lambda t: F.regexp_extract(t, _TARGET, 1)),
    )
    return pages.select("url", F.explode(targets).alias("target")).where(F.instr("target", "://") > 0)


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], links: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict and alias_of of every row of ``pages`` (page_id, url).

    ``links`` (url, target) are redirect and canonical edges.  Pages joined by edges, directly or
    over others, are one page under several names.  A url that a rule fits has the rule's verdict,
    so an explicit allow stands against any alias.  Any other url is blocked if a name in its
    component is blocked by a rule, and allowed otherwise.  Names seen only in ``links`` carry
    blocks too.

    ``alias_of`` is the smallest name of the component, null for a url without edges.  Null urls
    and urls without ``://`` have empty host and path, fit no rule, have no aliases and are
    allowed; repeated rows are judged alike; edges that repeat, hold nulls or point to themselves
    add nothing; with no edges the rules alone decide.  Other columns are not read.
    """
    keyed = pages.select("page_id", F.col("url").cast("string").alias("url")).select(
        "page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), page_key(F.col("url")).alias("key")
    )
    keyed = keyed.withColumn("fit", matching_rule(F.col("host"), F.col("path"), rules))
    edges = materialize(
        links.select(page_key(F.col("url")).alias("a"), page_key(F.col("target")).alias("b")).where("a <> b").distinct(),
        "aliases",
    )
    roots = components(edges, "a", "b")
    address = F.concat(F.lit("x://"), F.col("node"))
    ruled = roots.withColumn("fit", matching_rule(host(address), path(address), rules))
    blocked = ruled.groupBy("root").agg(F.max(F.coalesce(F.col("fit.verdict") == BLOCK, F.lit(False))).alias("alias_blocked"))
    aliases = materialize(roots.join(blocked, "root").withColumnRenamed("node", "key"), "alias-verdicts")
    inherited = F.when(F.col("alias_blocked"), BLOCK).otherwise(ALLOW)
    return keyed.join(aliases, "key", "left").select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", inherited).alias("verdict"), F.col("root").alias("alias_of"),
    )
