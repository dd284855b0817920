"""URL filter with redirect equivalence, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import Scratch, checked_broadcast, components

#: The rules (verdict, host, path) of the query.
RULES = [
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end; empty without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rules_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """verdict, host, path of rules given as a list."""
    rows = F.array(*(F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path")) for v, h, p in rules))
    return spark.range(1).select(F.inline(rows))


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """host, path, rule, ruled for every distinct (host, path) that a rule fits; the longest rule wins, at equal length allow, then
    the larger text. Each URL meets the rules of its own host and its parent domains only, by an equi-join on the domain."""
    r = rules.select(F.col("host").alias("domain"), F.col("path").alias("prefix"), F.col("verdict").alias("ruled"))
    labels = F.split("host", r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels))))
    return (
        urls.select("host", "path", F.explode(domains).alias("domain"))
        .join(r, "domain")
        .where(F.startswith("path", "prefix"))
        .withColumn("rule", F.concat("domain", "prefix"))
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rule").alias("n"), (F.col("ruled") == "allow").alias("allow"), "rule", "ruled")).alias("m"))
        .select("host", "path", "m.rule", "m.ruled")
    )


#: Where a page names another URL as its own: canonical links and refresh redirects.
CANONICAL = (
    r"(?is)<link\b(?=[^>]*\brel\s*=\s*[\"']?[^\"'>]*\bcanonical\b)[^>]*\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))"
)
REFRESH = (
    r"(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b)[^>]*\bcontent\s*=\s*"
    r"(?:\"[^\">]*?url\s*=\s*'?\s*([^\s\"'>]+)|'[^'>]*?url\s*=\s*\"?\s*([^\s\"'>]+)|[^\s\"'>]*?url\s*=\s*([^\s\"'>]+))"
)


def resolved(target: Column, url: Column) -> Column:
    """A link's target as a full URL: relative ones against the page's host and path, without dot segments; null for other schemes."""
    path = F.regexp_extract(target, r"(?s)^([^?#]*)", 1)
    base = F.regexp_replace(path_of(url), r"[^/]*$", "")
    merged = F.when(path.startswith("/"), path).otherwise(F.concat(F.when(base == "", "/").otherwise(base), path))
    parts = F.split(F.substring(merged, 2, 1 << 30), "/", -1)
    # .. takes the segment before it along; a dot segment at the end leaves a slash
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda t, x: F.when(x == "..", F.slice(t, 1, F.greatest(F.size(t) - 1, F.lit(0)))).when(x == ".", t).otherwise(F.concat(t, F.array(x))),
        lambda t: F.when(F.element_at(parts, -1).isin(".", ".."), F.concat(t, F.array(F.lit("")))).otherwise(t),
    )
    inside = F.when(path == "", path_of(url)).otherwise(F.concat(F.lit("/"), F.array_join(kept, "/")))
    return (
        F.when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.startswith("//"), F.concat(F.lit("http:"), target))
        .when(~target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), F.concat(F.lit("http://"), host_of(url), inside))
    )


def page_links(pages: DataFrame) -> DataFrame:
    """url, target: all canonical-link and refresh edges found in each page's html. Relative targets resolve against the page's own
    host and path."""
    html = F.coalesce(F.col("html"), F.lit(""))
    some = pages.where(F.lower(html).rlike("canonical|refresh"))
    found = F.concat(*(F.regexp_extract_all(html, F.lit(p), F.lit(i)) for p in (CANONICAL, REFRESH) for i in (1, 2, 3)))
    found = F.filter(F.transform(found, lambda x: F.trim(x)), lambda x: x != "")
    e = some.select("url", F.explode(F.array_distinct(found)).alias("target"))
    return e.select("url", resolved(F.col("target"), F.col("url")).alias("target")).where("target is not null")


def url_filter(pages: DataFrame, rules: DataFrame, edges: DataFrame | None = None, id_col: str = "page_id") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    A page with a rule gets the rule's verdict. The others get the verdict of their redirect class: URLs are nodes by (host, path),
    edges(url, target) and the pages' own canonical and refresh links make them equivalent, and a class is blocked if a rule blocks
    any of its URLs, unless a rule explicitly allows one of them. Pages in no class and classes without a rule are allowed. Rules are
    applied to targets that have no page of their own, too.

    Null URLs and URLs without :// have an empty host and path: no rule fits them, no edge touches them, they are allowed. Repeated
    pages each get their row. Decisions are found once per distinct URL and join back by (host, path). ORACLE covers the rules only, not
    the classes; tests/llm/test_llm.py covers these.
    """
    scratch = Scratch(pages.sparkSession, "url_filter")
    parts = lambda c: F.struct(host_of(F.col(c)).alias("host"), path_of(F.col(c)).alias("path"))
    base = pages.select(F.col(id_col).alias("page_id"), parts("url").alias("n")).select("page_id", "n.host", "n.path")
    links = page_links(pages)
    links = links if edges is None else links.unionByName(edges.select("url", "target"))
    links = scratch.put(links.select(parts("url").alias("u"), parts("target").alias("v")).where("u.host <> '' and v.host <> ''").distinct(), "links")
    urls = scratch.put(
        base.select("host", "path").unionAll(links.select("u.*")).unionAll(links.select("v.*")).where("host <> ''").distinct(), "urls"
    )
    ruled = scratch.put(matched(urls, F.broadcast(rules) if rules.count() <= 10_000 else rules), "ruled")
    if not links.isEmpty():
        comp = scratch.put(components(links, scratch).select("node.host", "node.path", "root"), "classes")
        verdict = (
            comp.join(ruled, ["host", "path"])
            .groupBy("root")
            .agg(F.max((F.col("ruled") == "block").cast("int")).alias("b"), F.max((F.col("ruled") == "allow").cast("int")).alias("a"))
            .where("b = 1 and a = 0")
            .select("root")
        )
        inherit = comp.join(verdict, "root").select("host", "path", F.lit("block").alias("inherited"))
        ruled = scratch.put(ruled.join(inherit, ["host", "path"], "full"), "decided")
    else:
        ruled = ruled.withColumn("inherited", F.lit(None).cast("string"))
    return base.join(checked_broadcast(ruled, 512), ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", "inherited", F.lit("allow")).alias("verdict")
    )


ORACLE = r"""
WITH p AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
r(v, h, q) AS (VALUES ('block', 'com', '/en/'), ('allow', 'example.com', '/en/7'), ('allow', 'net', '/de/'),
                      ('block', 'example.net', '/de/8'), ('block', 'org', '/es/')),
m AS (
  SELECT p.page_id, arg_max(h || q, length(h || q)) AS rule, arg_max(v, length(h || q)) AS v
  FROM p JOIN r ON (p.host = h OR ends_with(p.host, '.' || h)) AND starts_with(p.path, q) GROUP BY p.page_id)
SELECT p.page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM p LEFT JOIN m USING (page_id)
"""
