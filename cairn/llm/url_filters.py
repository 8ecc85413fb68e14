"""URL filters with redirect equivalence, in DataFrame expressions only.

Explicit rules decide the URLs that they fit.  For the rest, URLs joined by
redirects and canonical links form classes (distributed connected components);
a block on any member reaches the members that no rule fits, unless an allow
rule fits a member: an explicit allow has precedence over a propagated block.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cairn.llm.components import connected_components
from cairn.llm.scratch import Scratch


@dataclass(frozen=True)
class UrlRule:
    """A host with its subdomains, and a prefix of the path."""

    action: str  # allow or block
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: The rules of the production filter.
PRODUCTION_RULES = (
    UrlRule("allow", "org", "/"),
    UrlRule("block", "example.org", "/es/"),
    UrlRule("block", "example.org", "/en/1"),
    UrlRule("allow", "com", "/fr/"),
    UrlRule("block", "com", "/de/"),
)
DEFAULT_VERDICT = "allow"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_VALUE = r"(\"[^\">]*\"|'[^'>]*'|[^\s\"'>]+)"
_TOKEN = r"(?:\"(?:[^\">]*\s)?{0}(?=[\s\"])|'(?:[^'>]*\s)?{0}(?=[\s'])|{0}(?=[\s/>]))"
_CANONICAL = r"(?is)<link\b(?=[^>]*\srel\s*=\s*" + _TOKEN.format("canonical") + r")[^>]*?\shref\s*=\s*" + _VALUE
_REFRESH = r"(?is)<meta\b(?=[^>]*\shttp-equiv\s*=\s*" + _TOKEN.format("refresh") + r")[^>]*?\scontent\s*=\s*" + _VALUE
_BASE = r"(?is)<base\b[^>]*?\shref\s*=\s*" + _VALUE
_REFRESH_URL = r"(?is)\burl\s*=\s*[\"']?([^\"'>]*)"


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(_part(url, 1), _UPPER, _LOWER)


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return _part(url, 2)


def _part(url: Column, group: int) -> Column:
    text = F.coalesce(url, F.lit(""))
    rest = F.substr(text, F.locate("://", text) + 3)
    return F.when(F.locate("://", text) == 0, F.lit("")).otherwise(
        F.regexp_extract(rest, r"(?s)^([^/?#]*)([^?#]*)", group))


def url_node(url: Column) -> Column:
    """What names one resource: host, path and query; scheme and fragment do not matter."""
    text = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(text, r"(?s)^[^?#]*(\?[^#]*)", 1)
    host = url_host(url)
    return F.when(host != "", F.concat(host, url_path(url), query))


def _fits(rule: UrlRule, host: Column, path: Column) -> Column:
    at_host = (host == rule.host) | host.endswith("." + rule.host)
    return at_host & path.startswith(rule.path)


def explicit_rule(host: Column, path: Column, rules: tuple[UrlRule, ...] = PRODUCTION_RULES) -> Column:
    """struct(rule, action) of the longest rule that fits, else null; of equal length, allow goes first."""
    ranked = sorted(rules, key=lambda r: (-len(r.text), r.action, -len(r.host), r.text))
    chain = F
    for r in ranked:
        chain = chain.when(_fits(r, host, path), F.struct(F.lit(r.text).alias("rule"), F.lit(r.action).alias("action")))
    return chain.otherwise(F.lit(None)) if ranked else F.lit(None).cast("struct<rule:string,action:string>")


def _attribute(raw: Column) -> Column:
    """An attribute's value without quotes, with the references to ``&`` decoded."""
    return F.trim(F.regexp_replace(F.regexp_replace(raw, "^[\"']|[\"']$", ""), "&amp;|&#38;|&#[xX]26;", "&"))


def _bind(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _without_dots(path: Column) -> Column:
    """A path that begins with ``/`` without its ``.`` and ``..`` segments (RFC 3986, 5.2.4)."""
    def step(kept: Column, part: Column) -> Column:
        up = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))
        return F.when(part == "..", up).when(part == ".", kept).otherwise(F.array_append(kept, part))

    def joined(parts: Column) -> Column:
        return _bind(F.aggregate(parts, F.array().cast("array<string>"), step), lambda kept: F.concat(
            F.lit("/"), F.array_join(kept, "/"),
            F.when(F.element_at(parts, -1).isin(".", "..") & (F.size(kept) > 0), "/").otherwise("")))

    return F.when(path.contains("/."), _bind(F.split(F.substr(path, F.lit(2)), "/"), joined)).otherwise(path)


def resolve(base: Column, reference: Column) -> Column:
    """The URL that a reference names on a page (RFC 3986, 5.2); null where it names none with a host.

    Scheme and fragment matter for no node, so ``http`` stands for a scheme that the reference takes from its base.
    """
    def whole(of_base: Column, ref: Column) -> Column:
        scheme = F.regexp_extract(ref, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)

        def absolute(own: Column) -> Column:
            path, query = F.regexp_extract(own, r"(?s)^[^?]*", 0), F.regexp_extract(own, r"(?s)\?.*$", 0)
            folder = F.when(of_base["path"] == "", "/").otherwise(F.regexp_extract(of_base["path"], r"(?s)^.*/", 0))
            full = F.when(path == "", of_base["path"]).when(path.startswith("/"), path).otherwise(F.concat(folder, path))
            return F.when(own.startswith("//"), F.concat(F.lit("http:"), own)).when(
                (scheme == "") & (of_base["host"] != "") & (own != ""), F.concat(F.lit("http://"), of_base["host"], full, query))

        return _bind(F.when(scheme != "", F.substr(ref, F.length(scheme) + 2)).otherwise(ref), absolute)

    def cleaned(target: Column) -> Column:
        path = _bind(url_path(target), lambda p: F.when(p.startswith("/"), _without_dots(p)).otherwise(p))
        return F.when(url_host(target) != "", F.concat(F.lit("http://"), url_host(target), path, F.regexp_extract(target, r"(?s)\?.*$", 0)))

    def of(base_url: Column) -> Column:
        parts = F.struct(url_host(base_url).alias("host"), url_path(base_url).alias("path"))
        return _bind(parts, lambda p: _bind(F.regexp_extract(reference, r"(?s)^[^#]*", 0), lambda ref: whole(p, ref)))

    return _bind(_bind(base, of), cleaned)


def alias_edges(pages: DataFrame, url_col: str = "url", html_col: str | None = "html",
                redirects: DataFrame | None = None) -> DataFrame:
    """Edges ``src``, ``dst`` between URL nodes: canonical links, refreshes and recorded redirects.

    All links of a page count; relative ones are resolved against the page's
    URL, or its first ``<base href>``.  redirects: optional table with columns
    ``from_url`` and ``to_url``.  Nulls, targets without a host, links of a page
    to itself and pages whose URL has no host give no edge; repeated rows give
    repeated edges; empty tables give none.
    """
    found = None
    if html_col is not None:
        html, url = F.col(html_col), F.col(url_col)
        linked = pages.where(html.rlike("(?i)canonical|http-equiv")).select(url.alias("u"), html.alias("h"))
        refreshed = F.transform(F.regexp_extract_all("h", F.lit(_REFRESH), 1), lambda v: F.regexp_extract(_attribute(v), _REFRESH_URL, 1))
        canonical = F.transform(F.regexp_extract_all("h", F.lit(_CANONICAL), 1), _attribute)
        based = F.coalesce(resolve(F.col("u"), _attribute(F.regexp_extract("h", _BASE, 1))), F.col("u"))
        targets = linked.select("u", based.alias("base"), F.explode(F.concat(canonical, refreshed)).alias("t")).where("t <> ''")
        found = targets.select(url_node(F.col("u")).alias("src"), _bind(resolve(F.col("base"), F.col("t")), url_node).alias("dst"))
    if redirects is not None:
        recorded = redirects.select(url_node(F.col("from_url")).alias("src"), url_node(F.col("to_url")).alias("dst"))
        found = recorded if found is None else found.unionByName(recorded)
    if found is None:
        found = pages.sparkSession.createDataFrame([], "src string, dst string")
    return found.where(F.col("src").isNotNull() & F.col("dst").isNotNull() & (F.col("src") != F.col("dst")))


def filter_urls(pages: DataFrame, rules: tuple[UrlRule, ...] = PRODUCTION_RULES, id_col: str = "page_id",
                url_col: str = "url", html_col: str | None = "html", redirects: DataFrame | None = None,
                default: str = DEFAULT_VERDICT) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict, component, basis``.

    basis: ``rule``, ``alias`` (decided by the class) or ``default``.  component is the smallest URL of the
    page's class, null where nothing links the page.  Null URLs and URLs without ``://`` have empty host and
    path, fit no rule, have no alias and get the default.  Repeated rows and equal URLs get equal verdicts;
    an empty table gives none; other columns are not read.
    """
    scratch = Scratch(pages.sparkSession, "urls")
    url = F.col(url_col)
    judged = pages.select(
        F.col(id_col).alias("page_id"), url_host(url).alias("host"), url_path(url).alias("path"),
        url_node(url).alias("node"),
    ).withColumn("hit", explicit_rule(F.col("host"), F.col("path"), rules))
    edges = scratch.cut(alias_edges(pages, url_col, html_col, redirects).distinct(), "aliases")
    if edges.isEmpty():
        return judged.select(
            "page_id", "host", "path", F.col("hit.rule").alias("rule"),
            F.coalesce("hit.action", F.lit(default)).alias("verdict"), F.lit(None).cast("string").alias("component"),
            F.when(F.col("hit").isNotNull(), "rule").otherwise("default").alias("basis"))
    classes = connected_components(edges, scratch)
    ends = edges.select(F.col("src").alias("node")).union(edges.select("dst")).distinct()
    members = scratch.cut(ends.join(classes, "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")), "classes")
    with_scheme = F.concat(F.lit("http://"), F.col("node"))
    decided = members.withColumn("hit", explicit_rule(url_host(with_scheme), url_path(with_scheme), rules))
    by_class = decided.groupBy("component").agg(
        F.max(F.coalesce(F.col("hit.action") == "allow", F.lit(False))).alias("allowed"),
        F.max(F.coalesce(F.col("hit.action") == "block", F.lit(False))).alias("blocked"))
    by_class = by_class.select("component", F.when(F.col("allowed"), "allow").when(F.col("blocked"), "block").alias("passed"))
    by_node = members.join(by_class, "component").select("node", "component", "passed")
    return judged.join(by_node, "node", "left").select(
        "page_id", "host", "path", F.col("hit.rule").alias("rule"),
        F.coalesce("hit.action", "passed", F.lit(default)).alias("verdict"), "component",
        F.when(F.col("hit").isNotNull(), "rule").when(F.col("passed").isNotNull(), "alias").otherwise("default").alias("basis"))
