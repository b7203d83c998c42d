"""URL filters over redirect equivalence.

A rule list judges a URL by host and path. Pages joined by a redirect
(``<meta http-equiv=refresh>``) or a canonical link, absolute or relative to the
page or its ``<base href>``, are aliases: the classes
are the connected components of those edges, found by distributed contraction.
A page under no rule of its own takes its class's decision: allow if any
member is explicitly allowed, else block if any member is blocked, else allow.
A page's own rule always wins.

Edge cases: a null URL, or one without ``://``, has an empty host and path, no
alias and no rule. A null html has no links. Repeated rows are judged alike;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from gridmart.llm.common import WS_CHARS, bucket_lookup, bucketed, checkpointed, let
from gridmart.llm.components import connected_components

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A longer rule list is looked up by host instead of tried rule by rule; both give the same.
TRIED_RULES = 64


@dataclass(frozen=True)
class UrlRule:
    action: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """The address behind a URL: host, path and query, without scheme and fragment."""
    host = host_of(url)
    path = path_of(url)
    query = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1), F.lit(""))
    return F.when(host != "", F.concat(host, F.when(path == "", F.lit("/")).otherwise(path), query))


def rule_of(host: Column, path: Column, rules: list[UrlRule], tried: int = TRIED_RULES) -> Column:
    """The longest fitting rule as struct<rule, action>, else null.

    Rules of the same text count once, allow before block. A list of any length is part of the plan.
    """
    for r in rules:
        if r.action not in ("allow", "block"):
            raise ValueError(f"unknown action {r.action!r}")
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text, r.action))
    if len(rules) > tried:
        return _looked_up(host, path, ordered)
    out = None
    for r in ordered:
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = (F if out is None else out).when(
            fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.action).alias("action")))
    return out


def _looked_up(host: Column, path: Column, ordered: list[UrlRule]) -> Column:
    """Every suffix of the host that starts at a label is looked up; of the fitting rules the first one counts."""
    by_host: dict[str, list[dict]] = {}
    for i, r in enumerate(ordered):
        by_host.setdefault(r.host, []).append({"place": i, "path": r.path, "rule": r.text, "action": r.action})
    buckets = 1 << len(by_host).bit_length()
    table = F.from_json(F.lit(bucketed(by_host, buckets)),
                        "array<map<string,array<struct<place:int,path:string,rule:string,action:string>>>>")

    def best(known: Column) -> Column:
        found = F.flatten(F.transform(let(F.split(host, r"\.", -1), lambda ls: F.transform(
            ls, lambda _, i: F.array_join(F.slice(ls, i + 1, F.size(ls)), "."))),
            lambda h: F.coalesce(bucket_lookup(known, h, buckets), F.array())))
        return let(F.array_min(F.filter(found, lambda r: path.startswith(r["path"]))), lambda r: F.when(
            r.isNotNull(), F.struct(r["rule"].alias("rule"), r["action"].alias("action"))))

    return let(table, best)


def link_tags(html: Column) -> Column:
    """The ``link``, ``meta`` and ``base`` tags outside comments."""
    return F.regexp_extract_all(
        F.regexp_replace(F.coalesce(html, F.lit("")), r"(?s)<!--.*?-->", ""),
        F.lit(r"(?is)<(?:link|meta|base)\s[^>]*>"), F.lit(0))


def _value(tag: Column, name: str) -> Column:
    attr = r"""(?is)\s{}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""".format(name)
    return F.concat(*[F.regexp_extract(tag, attr, i) for i in (1, 2, 3)])


def _address(raw: Column) -> Column:
    return F.replace(F.trim(raw, F.lit(WS_CHARS)), F.lit("&amp;"), F.lit("&"))


def link_targets(tags: Column) -> Column:
    """Raw targets of the canonical links and meta refreshes among ``link_tags``."""

    def target(tag: Column) -> Column:
        rels = F.split(F.lower(_value(tag, "rel")), r"[ \t\n\f\r]+")
        canonical = tag.rlike(r"(?i)^<link\s") & F.array_contains(rels, "canonical")
        refresh = tag.rlike(r"(?i)^<meta\s") & (F.lower(F.trim(_value(tag, "http-equiv"))) == "refresh")
        url = F.regexp_extract(_value(tag, "content"), r"""(?is)url\s*=\s*['"]?([^'"]*)""", 1)
        return _address(F.when(canonical, _value(tag, "href")).when(refresh, url).otherwise(""))

    return F.filter(F.transform(tags, target), lambda x: x != "")


def base_of(tags: Column, url: Column) -> Column:
    """What a page's targets are relative to: its first ``<base href>``, else its URL."""
    hrefs = F.transform(F.filter(tags, lambda x: x.rlike(r"(?i)^<base\s")), lambda x: _address(_value(x, "href")))
    href = F.get(F.filter(hrefs, lambda x: x != ""), F.lit(0))
    return F.coalesce(absolute(href, url), url)


def without_dots(path: Column) -> Column:
    """A path that starts with a slash without its ``.`` and ``..`` segments (RFC 3986, 5.2.4)."""

    def joined(segments: Column) -> Column:  # the first stands before the leading slash
        kept = F.aggregate(
            F.slice(segments, F.lit(2), F.size(segments)), F.array().cast("array<string>"),
            lambda a, x: F.when(x == ".", a).when(x == "..", F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0))))
            .otherwise(F.concat(a, F.array(x))))
        closed = F.element_at(segments, -1).isin(".", "..")
        return let(kept, lambda k: F.concat(
            F.lit("/"), F.array_join(k, "/"), F.when(closed & (F.size(k) > 0), F.lit("/")).otherwise("")))

    return F.when(path.contains("/."), let(F.split(path, "/"), joined)).otherwise(path)


def absolute(target: Column, base: Column) -> Column:
    """A target resolved against a base URL (RFC 3986, 5.2); null for ``mailto:x`` and the like.

    A target with a scheme and ``//`` stays as it is. All parts are bound once, as
    each stands in several places.
    """

    def resolved(x: Column) -> Column:
        scheme = F.regexp_extract(x["base"], r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)
        start = F.concat(scheme, F.lit(":"), F.when(x["net"] != "", x["net"]).otherwise(
            F.concat(F.lit("//"), host_of(x["base"]))))
        own = F.when(path_of(x["base"]) == "", F.lit("/")).otherwise(path_of(x["base"]))
        folder = lambda o: F.substr(
            o, F.lit(1), F.char_length(o) - F.char_length(F.substring_index(o, "/", -1)))
        path = F.when((x["net"] != "") | x["path"].startswith("/"), x["path"]).otherwise(
            F.concat(let(own, folder), x["path"]))
        full = F.when((x["net"] == "") & (x["path"] == ""), own).otherwise(let(path, without_dots))
        return F.concat(start, full, x["rest"])

    parts = lambda t, b: F.struct(
        b.alias("base"), F.regexp_extract(t, r"^//[^/?#]*", 0).alias("net"),
        F.regexp_extract(t, r"^(?://[^/?#]*)?([^?#]*)", 1).alias("path"),
        F.regexp_extract(t, r"(?s)^[^?#]*(.*)", 1).alias("rest"))
    return let(F.struct(target.alias("t"), base.alias("b")), lambda x: (
        F.when(x["t"].rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), x["t"])
        .when(x["t"].rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None))
        .when(x["t"].startswith("#"), x["b"])
        .otherwise(let(parts(x["t"], x["b"]), resolved))))


def alias_edges(pages: DataFrame) -> DataFrame:
    """``a, b``: the page's address and that of a redirect or canonical target."""
    # One expression: a filter on a column of tags would find them a second time.
    targets = let(link_tags(F.col("html")), lambda tags: let(base_of(tags, F.col("url")), lambda base: F.transform(
        link_targets(tags), lambda t: let(absolute(t, base), node_of))))
    return pages.select("url", F.explode(targets).alias("b")).select(node_of(F.col("url")).alias("a"), "b").where(
        "a IS NOT NULL AND b IS NOT NULL AND a <> b")


def judge_urls(pages: DataFrame, rules: list[UrlRule], more_edges: DataFrame | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict``; ``more_edges`` adds known redirects (``a, b`` URLs)."""
    edges = alias_edges(pages)
    if more_edges is not None:
        edges = edges.union(more_edges.select(node_of(F.col("a")), node_of(F.col("b"))))
    edges = checkpointed(edges.dropna().distinct())
    rows = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumn("hit", rule_of(F.col("host"), F.col("path"), rules))
    if edges.isEmpty():  # no aliases: the rules alone decide
        judged = rows.withColumn("passed_on", F.lit(None).cast("string"))
    else:
        parts = connected_components(edges)
        url = F.concat(F.lit("x://"), F.col("node"))
        own = parts.withColumn("action", rule_of(host_of(url), path_of(url), rules)["action"])
        decided = own.groupBy("component").agg(F.min("action").alias("passed_on")).dropna()  # allow < block
        aliases = own.where("action IS NULL").join(decided, "component").select("node", "passed_on")
        # Only pages without a rule ask their class; the others skip the join.
        asking = rows.where("hit IS NULL").withColumn("node", node_of(F.col("url")))
        judged = (rows.where("hit IS NOT NULL").withColumn("passed_on", F.lit(None).cast("string"))
                  .unionByName(asking.join(aliases, "node", "left").drop("node")))
    return judged.select(
        "page_id", "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce(F.col("hit.action"), F.col("passed_on"), F.lit("allow")).alias("verdict"),
    )
