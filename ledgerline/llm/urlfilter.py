"""URL blocking that follows redirects and canonical links.

A rule names a host and a path: it fits a url whose host is that host or one of
its subdomains and whose path starts with the rule's path. Of the rules that fit,
the longest decides. Urls that no rule fits take the decision of their aliases:
urls are joined by links (a page's refresh redirect, its canonical link, and the
plain form of a url without tracking parameters, fragment or scheme), connected
components are found by Spark, and a component with an explicitly allowed url
is allowed, else one with a blocked url is blocked, else it is allowed.

Declared links are read as a browser reads them: html entities in the target are
decoded, and it is resolved against the page's ``<base href>`` or else its url,
so relative (``/x``, ``../x``, ``?p=2``) and protocol-relative (``//host/x``)
targets count. Empty targets, those of schemes without ``//`` (``mailto:``), and
relative ones of a page whose url has no ``://`` lead nowhere.

Nulls and odd rows: a url that is null or has no ``://`` has an empty host and
path; a null url fits no rule, has no alias, and is allowed. Repeated urls are
one node. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from html import unescape
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, stored
from .components import components


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = [
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
]

TRACKING = r"utm_[a-z]+|ref|fbclid|gclid"
#: Named references with and without their semicolon, and the numbers that html reads as windows-1252.
ENTITIES = {f"&{name}": text for name, text in html5.items()} | {f"&#{n};": unescape(f"&#{n};") for n in range(128, 160)}


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fits(rule: Rule) -> Column:
    """Host equal or a subdomain, path with the rule's as its start."""
    host = F.col("host")
    return ((host == rule.host) | host.endswith("." + rule.host)) & F.col("path").startswith(rule.path)


def ruled(rules: list[Rule], field: str) -> Column:
    """The text or verdict of the longest rule that fits host and path; null if none does."""
    out = F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), r.text)):
        out = F.when(fits(r), F.lit(getattr(r, field))).otherwise(out)
    return out


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value in the expression only once however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def without_dots(path: Column) -> Column:
    """path without its segments ``.`` and ``..`` (RFC 3986, 5.2.4)."""
    up = lambda done, part: F.concat(F.regexp_replace(done, r"/[^/]*\z", ""), part)
    joined = lambda parts: F.aggregate(F.slice(parts, F.lit(2), F.size(parts)), F.element_at(parts, 1), up)
    ended = F.regexp_replace(path, r"(/\.\.?)\z", "$1/")
    short = bound(F.split(F.regexp_replace(ended, r"/\.(?=/)", ""), r"/\.\.(?=/)"), joined)
    return F.when(path.rlike(r"/\.\.?(?:/|\z)"), short).otherwise(path)


def plain(url: Column) -> Column:
    """The form that aliases of one page share: no scheme, fragment, tracking parameters, dot segments, end slash; host in lower case."""
    rest = F.concat(without_dots(path_of(url)), F.regexp_extract(url, r"(?s)^.*?://[^/?#]*[^?#]*([^#]*)", 1))
    # A whole run of neighbours in one match; possessive, so that a long run needs no stack.
    rest = F.regexp_replace(rest, rf"([?&])(?:(?:{TRACKING})=[^&]*+(?:&|$))++", "$1")
    rest = F.regexp_replace(F.regexp_replace(rest, r"[?&]$", ""), r"/$", "")
    return F.when(F.instr(url, "://") > 0, F.concat(F.lit("//"), host_of(url), rest)).otherwise(url)


def decoded(text: Column) -> Column:
    """An attribute's text with its html entities decoded; names without a semicolon stay if ``=`` or a letter follows."""
    known = F.str_to_map(F.lit("\x01".join(f"{name}\x02{x}" for name, x in ENTITIES.items())), F.lit("\x01"), F.lit("\x02"))
    tokens = F.regexp_extract_all(text, F.lit(r"(?s)&#[xX][0-9a-fA-F]+;?|&#[0-9]+;?|&[A-Za-z][A-Za-z0-9]*[;=]?|[^&]++|&"), F.lit(0))

    def number(token: Column) -> Column:
        digits = F.regexp_extract(token, r"^&#[xX]?0*([0-9a-fA-F]*)", 1)
        code = lambda d: F.when(F.length(d) > 8, F.lit("0")).when(token.rlike("^&#[xX]"), F.conv(d, 16, 10)).otherwise(d).try_cast("long")
        odd = lambda n: n.isNull() | (n == 0) | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF)
        return bound(bound(digits, code), lambda n: F.when(odd(n), F.lit(0xFFFD)).otherwise(n))

    def one(token: Column) -> Column:
        sign = lambda n: F.coalesce(
            F.try_element_at(known, F.concat(F.lit("&#"), n.cast("string"), F.lit(";"))), F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32"))
        return F.when(~token.startswith("&"), token).when(token.rlike("^&#."), bound(number(token), sign)).otherwise(
            F.coalesce(F.try_element_at(known, token), token))

    return F.when(F.instr(text, "&") > 0, F.array_join(F.transform(tokens, one), "")).otherwise(text)


def resolved(target: Column, base: Column) -> Column:
    """The absolute url that target, as written in a page of url base, leads to (RFC 3986, 5.2); null if there is none."""
    slash = lambda path: F.when(path == "", F.lit("/")).otherwise(path)

    def whole(t: Column, b: Column) -> Column:
        scheme, root = F.regexp_extract(b, r"(?s)^(.*?:)//", 1), F.regexp_extract(b, r"(?s)^(.*?://[^/?#]*)", 1)
        return (
            F.when(t == "", F.lit(None))
            .when(t.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*://"), t)
            .when(t.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), F.lit(None))
            .when(t.startswith("//"), F.concat(F.when(scheme != "", scheme).otherwise("http:"), t))
            .when(F.coalesce(root, F.lit("")) == "", F.lit(None))
            .when(t.startswith("/"), F.concat(root, t))
            .when(t.startswith("?"), F.concat(root, slash(path_of(b)), t))
            .when(t.startswith("#"), F.concat(F.regexp_extract(b, r"(?s)^([^#]*)", 1), t))
            .otherwise(F.concat(root, slash(F.regexp_extract(path_of(b), r"(?s)^(.*/)", 1)), t)))

    def tidy(url: Column) -> Column:
        parts = [F.regexp_extract(url, rf"(?s)^{what}", 1) for what in (r"(.*?://[^/?#]*)", r".*?://[^/?#]*[^?#]*(.*)")]
        return F.concat(parts[0], bound(path_of(url), without_dots), parts[1])

    return bound(bound(target, lambda t: bound(base, lambda b: whole(t, b))), lambda url: F.when(url.isNotNull(), tidy(url)))


def shown(html: Column) -> Column:
    """html without comments and without what is in scripts and styles; what is not closed goes to the end."""
    return F.regexp_replace(html, r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b.*?(?:</\1\s*>|\z)", " ")


def page_links(pages: DataFrame) -> DataFrame:
    """(a, b): what a page's html declares to be the same page under another url, as refresh redirect or canonical link; b is absolute."""
    value = r"\s*=\s*[\"']?([^\"'\s>]+)"
    clean = lambda text: F.btrim(decoded(text), F.lit("\"' \t\n\x0c\r"))
    # An attribute's name has blank space before it: data-href is another one.
    href = lambda tag: F.regexp_extract(tag, rf"(?is)\shref{value}", 1)
    content = F.regexp_extract("tag", r"(?is)\scontent\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", 1)
    pages = pages.where(F.col("html").rlike(r"(?i)canonical|refresh")).select("url", shown(F.col("html")).alias("html"))
    base = F.regexp_extract("html", r"(?is)<base\b[^>]*?\shref\s*=[^>]*>", 0)
    tags = pages.select("url", base.alias("base"), F.explode(F.regexp_extract_all("html", F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))).alias("tag"))
    canonical = F.when(F.col("tag").rlike(r"(?is)^<link\b.*?\srel\s*=\s*[\"']?canonical"), href("tag"))
    refresh = F.when(F.col("tag").rlike(r"(?is)^<meta\b.*?\shttp-equiv\s*=\s*[\"']?refresh"), F.regexp_extract(content, rf"(?is)url{value}", 1))
    written = F.transform(F.array(href("base"), F.coalesce(canonical, refresh)), clean)
    url = F.col("url")
    target = bound(written, lambda w: resolved(w[1], F.coalesce(resolved(w[0], url), url)))
    return tags.select(url.alias("a"), target.alias("b"))


def judge(pages: DataFrame, rules: list[Rule] = RULES, links: DataFrame | None = None) -> DataFrame:
    """page_id, url, host, path, rule and verdict of every page.

    ``links`` (a, b) are further redirects between urls, such as a crawl log has.
    """
    pages = pages.select("page_id", "url", "html")
    own = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), plain(F.col("url")).alias("node"))
    own = own.withColumn("rule", ruled(rules, "text")).withColumn("said", ruled(rules, "verdict"))
    declared = page_links(pages)
    if links is not None:
        declared = declared.unionByName(links.select("a", "b"))
    declared = stored(declared.dropna().distinct(), "url_links")
    # Urls with the same plain form are one node, so only links between different nodes are left to follow.
    edges = declared.select(plain(F.col("a")).alias("a"), plain(F.col("b")).alias("b")).where("a <> b").distinct()
    component = components(edges).withColumnRenamed("component", "group")
    # What links lead to may be ruled too without being a page itself.
    targets = declared.select(F.explode(F.array("a", "b")).alias("url")).distinct().select(
        plain(F.col("url")).alias("node"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    targets = targets.select("node", ruled(rules, "verdict").alias("said"))
    said = own.select("node", "said").unionByName(targets).groupBy("node").agg(
        F.max(F.col("said") == "allow").alias("allow"), F.max(F.col("said") == "block").alias("block"))
    named = said.join(component, "node", "left").withColumn("group", F.coalesce("group", "node"))
    groups = named.groupBy("group").agg(F.max("allow").alias("allow"), F.max("block").alias("block"))
    blocked = groups.where("coalesce(block, false) and not coalesce(allow, false)").select("group")
    blocked = named.join(blocked, "group", "left_semi").select("node", F.lit(True).alias("blocked"))
    return own.join(blocked, "node", "left").select(
        "page_id", "url", "host", "path", "rule",
        F.coalesce("said", F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"))
