"""URL filtering with redirect equivalence.

Rules name a host and a path: a rule fits its host and all subdomains, if the
url's path starts with the rule's, and the longest fitting rule decides.  A
page without a rule of its own takes the decision of its aliases: pages and
targets linked by redirects and canonical links are one class (distributed
connected components), and the class is blocked if one of its addresses is
blocked by a rule and none is allowed by one.  An explicit allow always wins.

An address is host, path and query; scheme and fragment do not tell addresses
apart, and rules look at host and path only.  A link to a path without a query
means the page at that path also if all its pages there have one and the same
query.  Rules are matched through a join on the host's suffixes; they are
broadcast by Spark only below its own size threshold.

Defined results: a null url, or one without ``://``, has an empty host and
path, fits no rule and is allowed; every row gets a row; equally long rules:
allow first, then by name; rows with null html have no links; a page that
links to itself is its own class.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from strata.llm.components import components

_CANONICAL = (r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*\bhref\s*=\s*["']?([^"'\s>]+)""")
_REFRESH = (r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*\bcontent\s*=\s*["']?\s*[0-9.]*\s*[;,]\s*url\s*=\s*["']?([^"'\s>]+)""")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """After the first ``://`` up to a slash, question mark, hash or the end; A-Z lower-cased."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host, up to a question mark, hash or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def query(url: Column) -> Column:
    """From the first question mark after the host up to a hash or the end; empty if nothing follows the mark."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*[^?#]*(\?[^#]+)", 1), F.lit(""))


def matched(addresses: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict): the longest rule (verdict, host, path) that fits each distinct address."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    each = addresses.where("host != ''").select("host", "path").distinct().withColumn("suffix", F.explode(suffixes))
    own = rules.select(F.col("host").alias("suffix"), F.col("path").alias("rule_path"), "verdict",
                       F.concat("host", "path").alias("rule"))
    fits = each.join(own, "suffix").where(F.expr("startswith(path, rule_path)"))
    best = F.min(F.struct((-F.length("rule")).alias("size"), "verdict", "rule"))  # "allow" sorts before "block"
    return fits.groupBy("host", "path").agg(best.alias("best")).select("host", "path", "best.rule", "best.verdict")


def links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, path, query, to_host, to_path, to_query): redirects and canonical links found in the pages."""
    targets = F.array_compact(F.array(*[F.nullif(F.regexp_extract(html, p, 1), F.lit("")) for p in (_CANONICAL, _REFRESH)]))
    found = (pages.where(F.col(html).rlike(_CANONICAL) | F.col(html).rlike(_REFRESH))
             .select(host(F.col(url)).alias("host"), path(F.col(url)).alias("path"), query(F.col(url)).alias("query"),
                     F.explode(targets).alias("target"))
             .where("host != ''"))
    target, folder = F.col("target"), F.regexp_extract("path", "^(.*/)", 1)
    scheme_less = target.startswith("//")
    full = F.when(scheme_less, F.concat(F.lit("x:"), target)).otherwise(target)
    whole = scheme_less | target.rlike("^[A-Za-z][A-Za-z0-9+.-]*://")
    site_path = F.regexp_extract(target, "(?s)^([^?#]*)", 1)
    site_query = F.regexp_extract(target, r"(?s)^[^?#]*(\?[^#]+)", 1)
    to_host = F.when(whole, host(full)).otherwise(F.col("host"))
    to_path = (F.when(whole, path(full)).when(target.startswith("/"), site_path)
               .when(site_path == "", F.col("path"))
               .otherwise(F.concat(F.when(folder == "", F.lit("/")).otherwise(folder), site_path)))
    to_query = F.when(whole, query(full)).when(target.startswith("#"), F.col("query")).otherwise(site_query)
    return (found.select("host", "path", "query", to_host.alias("to_host"), to_path.alias("to_path"), to_query.alias("to_query"))
            .where("to_host != ''"))


def _bare(edges: DataFrame, rows: DataFrame) -> DataFrame:
    """Links from a target without a query to the one query that all pages at its host and path have."""
    only = (rows.where("host != ''").groupBy("host", "path").agg(F.min("query").alias("to_query"), F.max("query").alias("last"))
            .where("to_query = last and to_query != ''").drop("last"))
    targets = edges.where("to_query = ''").select(F.col("to_host").alias("host"), F.col("to_path").alias("path")).distinct()
    return targets.join(only, ["host", "path"]).select(
        "host", "path", F.lit("").alias("query"), F.col("host").alias("to_host"), F.col("path").alias("to_path"), "to_query")


def judge(pages: DataFrame, rules: DataFrame, more_links: DataFrame | None = None, id_col: str = "page_id",
          url: str = "url", html: str = "html") -> DataFrame:
    """Per page: id, host, path, rule (null if none fits), verdict.

    ``more_links`` (host, path, to_host, to_path, with query and to_query where there are any) adds redirects known
    from elsewhere, such as a crawl log.
    """
    rows = pages.select(F.col(id_col), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"),
                        query(F.col(url)).alias("query"))
    edges = links(pages, url, html)
    if more_links is not None:
        for missing in {"query", "to_query"} - set(more_links.columns):
            more_links = more_links.withColumn(missing, F.lit(""))
        edges = edges.unionByName(more_links.select(*edges.columns))
    edges = edges.unionByName(_bare(edges, rows))
    name = lambda *parts: F.concat(*map(F.col, parts))
    aliases = components(edges.select(name("host", "path", "query").alias("u"),
                                      name("to_host", "to_path", "to_query").alias("v")))
    ends = edges.select("host", "path", "query").union(edges.select("to_host", "to_path", "to_query")).distinct()
    ruled = (ends.join(matched(ends, rules), ["host", "path"])
             .select(name("host", "path", "query").alias("vertex"), "verdict"))
    decided = (aliases.join(ruled, "vertex").groupBy("component")
               .agg(F.min("verdict").alias("class_verdict")))  # one allow outweighs every block
    decisions = aliases.join(decided, "component").select(F.col("vertex").alias("address"), "class_verdict")
    own = matched(rows, rules)
    judged = rows.join(own, ["host", "path"], "left").withColumn("address", name("host", "path", "query"))
    return judged.join(decisions, "address", "left").select(
        id_col, "host", "path", "rule", F.coalesce("verdict", "class_verdict", F.lit("allow")).alias("verdict"))
