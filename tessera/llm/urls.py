"""URL filter with redirect equivalence.

Pages that redirect to each other, or name each other as canonical, are one resource. Explicit rules judge URLs; a
block decision reaches all aliases of a URL, unless an alias is explicitly allowed. DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stars import components

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)\A.*?://([^/?#]*)([^?#]*)(\??[^#]*)"


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)


def host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def address(url: Column) -> Column:
    """What two URLs of one resource share: host, path without dot segments, and query. Null where there is no ``://``."""
    return F.when(F.contains(url, F.lit("://")), F.concat(host(url), _without_dots(path(url)), F.regexp_extract(url, _PARTS, 3)))


def _without_dots(path_: Column) -> Column:
    """``path_`` with ``.`` and ``..`` segments followed."""
    parts = F.split(path_, "/")
    empty = F.array().cast("array<string>")
    follow = lambda done, part: F.when(part == ".", done).when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))).otherwise(F.array_append(done, part))
    kept = F.aggregate(parts, empty, follow)
    folder = F.when(F.element_at(parts, -1).isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    return F.when(F.contains(path_, F.lit("/.")), F.concat(F.array_join(kept, "/"), folder)).otherwise(path_)


def resolve(target: Column, url: Column) -> Column:
    """The absolute form of a link's ``target`` in the page ``url`` (the scheme does not matter here)."""
    base, folder = path(url), F.regexp_extract(path(url), r"(?s)\A.*/", 0)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    here = F.concat(F.lit("http://"), host(url))
    return (
        F.when(target.rlike(r"\A[A-Za-z][A-Za-z0-9+.-]*:"), target)
        .when(target.startswith("//"), F.concat(F.lit("http:"), target))
        .when(target.startswith("/"), F.concat(here, target))
        .when(target.startswith("?"), F.concat(here, base, target))
        .when(target.startswith("#"), url)
        .otherwise(F.concat(here, folder, target))
    )


def judge(host_: Column, path_: Column, rules: tuple[Rule, ...], value) -> Column:
    """``value(rule)`` of the longest rule that fits (of equal ones an allowing rule), else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.verdict == "allow")):  # the last one added is asked first
        fits = ((host_ == rule.host) | host_.endswith("." + rule.host)) & path_.startswith(rule.path)
        out = F.when(fits, F.lit(value(rule))).otherwise(out)
    return out


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(a, b)`` addresses that a canonical link or an immediate redirect in a page's HTML makes equal.

    All tags count. Targets are read against the page's url, as a browser does. Rows whose url or target has no address
    give no link.
    """
    attribute = r"""(?is)\b%s\s*=\s*["']?\s*([^"'\s>]+)"""
    tags = lambda pattern: F.regexp_extract_all(html, F.lit(pattern), F.lit(0))
    canonical = F.transform(tags(r"""(?is)<link\b[^>]*\brel\s*=\s*["']?(?:[\w-]+\s+)*canonical\b[^>]*>"""), lambda tag: F.regexp_extract(tag, attribute % "href", 1))
    refresh = F.transform(tags(r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>"""), lambda tag: F.regexp_extract(tag, r"""(?is)\burl\s*=\s*["']?\s*([^"'\s>]+)""", 1))
    tagged = F.contains(F.lower(html), F.lit("canonical")) | F.contains(F.lower(html), F.lit("http-equiv"))
    found = pages.where(tagged & F.contains(F.col(url), F.lit("://"))).select(F.col(url).alias("url"), F.explode(F.concat(canonical, refresh)).alias("target")).where("target <> ''")
    target = F.replace(F.col("target"), F.lit("&amp;"), F.lit("&"))
    return found.select(address(F.col("url")).alias("a"), address(resolve(target, F.col("url"))).alias("b")).where("a is not null and b is not null")


def filter_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, url: str = "url", html: str = "html", redirects: DataFrame | None = None) -> DataFrame:
    """``pages`` without ``html``, with ``host, path, rule, verdict``.

    ``redirects``: further ``(a, b)`` addresses known to be equal. A page with a rule has the rule's verdict. Any other
    page is allowed, but for one whose aliases hold a blocked URL and no explicitly allowed one. A null url, or one
    without ``://``, has an empty host and path and no aliases. Column names of the result must not be in ``pages``.
    """
    links = page_links(pages, url, html)
    if redirects is not None:
        links = links.unionByName(redirects.select("a", "b").where("a is not null and b is not null"))
    kept = pages.select(*[c for c in pages.columns if c != html])
    judged = kept.withColumn("host", host(F.col(url))).withColumn("path", path(F.col(url)))
    judged = judged.withColumn("rule", judge(F.col("host"), F.col("path"), rules, lambda r: r.text)).withColumn("_ruled", judge(F.col("host"), F.col("path"), rules, lambda r: r.verdict))
    aliases = components(links)
    # decisions of all addresses that are linked, whether or not they were crawled
    bare = F.substring_index("id", "?", 1)
    id_host = F.regexp_extract(bare, r"(?s)\A([^/]*)", 1)
    id_path = F.regexp_extract(bare, r"(?s)\A[^/]*(.*)\z", 1)
    decided = aliases.withColumn("_v", judge(id_host, id_path, rules, lambda r: r.verdict)).groupBy("root").agg(F.max(F.col("_v") == "block").alias("any_block"), F.max(F.col("_v") == "allow").alias("any_allow"))
    blocked = aliases.join(decided.where("any_block and not coalesce(any_allow, false)"), "root").select(F.col("id").alias("_address"))
    marked = judged.withColumn("_address", address(F.col(url))).join(blocked.withColumn("_alias_blocked", F.lit(True)), "_address", "left")
    verdict = F.coalesce("_ruled", F.when(F.col("_alias_blocked"), F.lit("block")), F.lit("allow"))
    return marked.select(*judged.drop("_ruled").columns, verdict.alias("verdict"))
