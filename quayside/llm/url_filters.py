"""URL filters: host and path rules, and block decisions that follow redirects and canonical links to aliases.

DataFrame functions only. Every url is split into host and path and judged by the longest rule that fits. Pages name
aliases of themselves by all canonical links and timed redirects in their html, of any length; urls and aliases are the nodes, those
links the edges, and the connected components are found by distributed contraction. In a component, an explicit allow
of any member comes before a block of any member, and decides for the members that have no rule of their own; without
either, the verdict is allow. A page's own rule always stands.

Null urls, and urls without "://", have empty host and path, no rule and no aliases; null html names no alias; ids may
be null or repeat; rows that repeat are judged alike; an empty table gives an empty result; further columns are ignored.
Very long pages are read whole; tags inside comments and scripts count like others. Ties of rules: see `best_of`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, lower_ascii, pick
from .components import components

#: Up to so many rules are a literal of the plan; more are a table.
FEW_RULES = 100
#: Whole tags of a page; values in quotes may hold ">".
TAGS = r"""(?is)<((?:link|meta)\b(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+)>"""
#: The time and the address of a refresh.
REFRESH = r"""(?is)^\s*+(?=[\d.])\d*+(?:\.[\d.]*+)?(?:\s*+[;,]|\s)\s*+(?:url\s*+=\s*+)?["']?\s*+([^"'\s>]+)"""
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"


def host_of(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, PARTS, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def node_of(url: Column) -> Column:
    """What aliases are compared by: host, path and query; null without a host."""
    node = F.concat(host_of(url), path_of(url), F.regexp_extract(url, PARTS, 3))
    return F.when(host_of(url) != "", node)


def parsed_rules(rules: list[tuple[str, str]]) -> list[tuple[int, str, str, bool, str]]:
    """(length, host, path, whether it allows, rule) of "host/path" rules, in the order in which later ones win."""
    made = [(len(r), r.partition("/")[0].lower(), "/" + r.partition("/")[2], verdict == "allow", r) for r, verdict in rules]
    if any(verdict not in ("allow", "block") for _, verdict in rules):
        raise ValueError("a rule's verdict is allow or block")
    return sorted(made)


RULE = "array<struct<size:int,host:string,path:string,allows:boolean,rule:string>>"


def best_of(candidates: Column, host: Column, path: Column) -> Column:
    """Struct of `rule` and `verdict` of the longest candidate that fits, null if none does.

    Of equally long ones the one whose host, then path sorts last wins; of one rule with both verdicts, allow.
    """
    fits = F.filter(candidates, lambda r: ((host == r["host"]) | host.endswith(F.concat(F.lit("."), r["host"]))) & path.startswith(r["path"]))
    best = F.array_max(fits)
    return F.when(F.size(fits) > 0, F.struct(best["rule"].alias("rule"), F.when(best["allows"], "allow").otherwise("block").alias("verdict")))


def with_rule(rows: DataFrame, rules: list[tuple[str, str]], name: str) -> DataFrame:
    """Rows of `host, path, ...` with the struct `name` of the longest rule that fits the host or one it is below.

    A few rules are a literal that every row looks through. More of them are a table that is joined by host: every
    distinct host looks up itself and the hosts above it, so a row meets only the rules of those.
    """
    made = parsed_rules(rules)
    if len(made) <= FEW_RULES:
        literal = F.array(*[F.struct(F.lit(n).alias("size"), F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(a).alias("allows"), F.lit(r).alias("rule")) for n, h, p, a, r in made])
        return rows.withColumn(name, best_of(literal.cast(RULE), F.col("host"), F.col("path")))
    given = rows.sparkSession.createDataFrame(made, "size int, rule_host string, path string, allows boolean, rule string")
    per_host = given.groupBy("rule_host").agg(F.collect_list(F.struct("size", F.col("rule_host").alias("host"), "path", "allows", "rule")).alias("some"))
    parts = F.split("host", r"\.")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, k, F.size(parts)), "."))
    hosts = rows.select("host").distinct().withColumn("rule_host", F.explode(above))
    known = hosts.join(per_host, "rule_host").groupBy("host").agg(F.flatten(F.collect_list("some")).alias("candidates"))
    joined = rows.join(known, "host", "left")
    return joined.withColumn(name, best_of(F.coalesce("candidates", F.array().cast(RULE)), F.col("host"), F.col("path"))).drop("candidates")


def plain(value: Column) -> Column:
    """An attribute's value with its character references resolved: those that urls in html hold."""
    for reference, char in (("&quot;|&#34;|&#x22;", '"'), ("&#39;|&#x27;|&apos;", "'"), ("&lt;|&#60;|&#x3c;", "<"), ("&gt;|&#62;|&#x3e;", ">"), ("&amp;|&#38;|&#x26;", "&")):
        value = F.regexp_replace(value, f"(?i){reference}", char)
    return value


def attribute(tag: Column, name: str) -> Column:
    """The value of a tag's attribute, in quotes or without; empty if there is none."""
    before = r"""(?is)^[a-z]++(?:[\s/]++(?!NAME\s*+=)[^\s=>/"']++(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>]++))?+)*+[\s/]++NAME\s*+=\s*+"""
    value = r"""(?:"([^"]*+)"|'([^']*+)'|["']?([^\s"'>]++))"""
    pattern = before.replace("NAME", name) + value
    return plain(F.trim(F.concat(*[F.regexp_extract(tag, pattern, k) for k in (1, 2, 3)])))


def without_dots(path: Column) -> Column:
    """A path without "." and ".." segments."""
    parts = F.split(path, "/")

    def step(kept: Column, part: Column) -> Column:
        up = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(1)))
        return F.when(part == ".", kept).when(part == "..", up).otherwise(F.concat(kept, F.array(part)))

    whole = F.array_join(F.aggregate(parts, F.array().cast("array<string>"), step), "/")
    whole = F.when(path.rlike(r"(?s)/\.{1,2}$"), F.concat(whole, F.lit("/"))).otherwise(whole)
    return F.when(path.rlike(r"(?s)/\.{1,2}(/|$)"), whole).otherwise(path)


def absolute(link: Column, url: Column) -> Column:
    """A link of a page as a whole url."""
    scheme = F.regexp_extract(url, r"(?s)^(.*?)://", 1)
    site = F.concat(scheme, F.lit("://"), host_of(url))
    folder = F.regexp_extract(path_of(url), r"(?s)^(.*/)[^/]*$", 1)
    bare, rest = F.regexp_extract(link, r"(?s)^([^?#]*)", 1), F.regexp_extract(link, r"(?s)^[^?#]*(.*)$", 1)
    below = F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), bare)
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.startswith("//"), F.concat(scheme, F.lit(":"), link))
        .when(link.startswith("/"), F.concat(site, without_dots(bare), rest))
        .when(link.startswith("?"), F.concat(site, path_of(url), link))
        .when(link.startswith("#"), F.concat(site, path_of(url), F.regexp_extract(url, PARTS, 3)))
        .otherwise(F.concat(site, without_dots(below), rest))
    )


def links_of(html: Column) -> Column:
    """All canonical links and refresh addresses of a page."""

    def link(tag: Column) -> Column:
        is_link = tag.rlike("(?i)^link")
        canonical = F.when(F.array_contains(F.split(F.lower(attribute(tag, "rel")), r"\s+"), "canonical"), attribute(tag, "href"))
        refresh = F.when(F.lower(attribute(tag, "http-equiv")) == "refresh", F.regexp_extract(attribute(tag, "content"), REFRESH, 1))
        return F.when(is_link, canonical).otherwise(refresh)

    return F.filter(F.transform(F.regexp_extract_all(html, F.lit(TAGS), F.lit(1)), link), lambda t: t != "")


def alias_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Distinct `a, b` node pairs that pages name as the same content."""
    hinted = pages.where(F.col(html).rlike("(?i)canonical|refresh") & F.col(url).contains("://"))
    named = hinted.select(F.col(url).alias("url"), F.explode(links_of(F.col(html))).alias("link"))
    pairs = named.select(node_of(F.col("url")).alias("a"), node_of(absolute(F.col("link"), F.col("url"))).alias("b"))
    return pairs.where("a IS NOT NULL AND b IS NOT NULL AND a != b").distinct()


def verdicts_of_aliases(edges: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """`node, verdict` of every node in a component with a decision."""
    labels = components(edges)
    url = F.concat(F.lit("://"), F.col("node"))
    judged = with_rule(labels.select("component", host_of(url).alias("host"), path_of(url).alias("path")), rules, "own")
    decided = judged.groupBy("component").agg(F.bool_or(F.col("own.verdict") == "allow").alias("allowed"), F.bool_or(F.col("own.verdict") == "block").alias("blocked"))
    said = decided.select("component", F.when(F.col("allowed"), "allow").when(F.col("blocked"), "block").alias("verdict")).where("verdict IS NOT NULL")
    return labels.join(said, "component").select("node", "verdict")


def judge(pages: DataFrame, rules: list[tuple[str, str]], *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """`page_id, host, path, rule, verdict` of every page."""
    rows = pick(pages, page_id=id_col, url=url_col, html=html_col)
    aliases = durable(verdicts_of_aliases(alias_edges(rows), rules))
    url = F.col("url")
    judged = rows.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), node_of(url).alias("node"))
    judged = with_rule(judged, rules, "fit")
    spread = judged.join(aliases, "node", "left")
    return spread.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", "verdict", F.lit("allow")).alias("verdict"))
