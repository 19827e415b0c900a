"""Allow and block rules for URLs, passed on to aliases over redirects and canonical links."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.common import attach, require_columns
from pairloom.llm.components import components
from pairloom.session import Workspace

# Up to this many rules are broadcast (at most some 2 KB each); more are joined by a shuffle.
FEW_RULES = 20_000
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(host, F.lit("")), _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to ``? #`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def alias_edges(pages: DataFrame, tables: Workspace) -> DataFrame:
    """Edges a -> b from each page's url to its canonical link and its meta refresh, without fragments.

    Only tags outside comments and scripts that name the target in the usual
    attributes count; relative targets are resolved against the url.
    """
    html = F.regexp_replace("html", r"(?is)<!--.*?-->|<script\b.*?</script>", "")
    tags = F.regexp_extract_all(html, F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), F.lit(0))
    found = pages.where(F.lower("html").rlike("canonical|refresh")).select("url", F.explode(tags).alias("tag"))
    quoted = lambda name: F.regexp_extract("tag", rf"(?is)\b{name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", 0)
    value = lambda name: F.regexp_replace(quoted(name), r"(?is)^[a-z-]+\s*=\s*[\"']?|[\"']$", "")
    canonical = F.lower(value("rel")).rlike(r"(^|\s)canonical(\s|$)") & F.col("tag").rlike("(?is)^<link")
    refresh = (F.lower(value("http-equiv")) == "refresh") & F.col("tag").rlike("(?is)^<meta")
    target = F.when(canonical, value("href")).when(
        refresh, F.regexp_extract(value("content"), r"(?is)^\s*[\d.]+\s*[;,]\s*url\s*=\s*['\"]?(.*?)['\"]?\s*$", 1)
    )
    found = tables.save(found.select("url", F.trim(F.regexp_replace(target, "&amp;", "&")).alias("target")))
    named = found.where(F.length("target") > 0)
    scheme = F.regexp_extract("url", r"(?s)^(.*?):", 1)
    site = F.regexp_extract("url", r"(?s)^.*?://[^/?#]*", 0)
    folder = F.regexp_extract("url", r"(?s)^(.*?://[^/?#]*(?:[^?#]*/)?)", 1)
    folder = F.when(folder.endswith("/"), folder).otherwise(F.concat(folder, F.lit("/")))
    full = (
        F.when(F.col("target").rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), F.col("target"))
        .when(F.col("target").startswith("//"), F.concat(scheme, F.lit(":"), "target"))
        .when(F.col("target").startswith("/"), F.concat(site, "target"))
        .otherwise(F.concat(folder, "target"))
    )
    resolved = tables.save(named.select("url", full.alias("to")))
    return tables.save(resolved.select(node_of(F.col("url")).alias("a"), node_of(F.col("to")).alias("b")))


def node_of(url: Column) -> Column:
    """The url that servers see: without its fragment, host lower-cased."""
    plain = F.regexp_replace(url, r"(?s)#.*$", "")
    rest = F.regexp_extract(plain, r"(?s)^.*?://[^/?#]*(.*)$", 1)
    return F.when(url.contains("://"), F.concat(F.regexp_extract(plain, r"(?s)^(.*?://)", 1), host_of(url), rest)).otherwise(plain)


def match_rules(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """``rows`` (host, path and others) with ``rule`` and ``decision`` of the longest rule that fits, else null.

    ``rules`` has host, path, verdict; a rule fits its host and all subdomains if
    the path starts with its path. Each row looks its host's suffixes up with
    prefixes of its path, of the lengths that rules have, so rules are joined by
    equality and a row meets at most one rule per suffix and length. Of equally
    long rules the longer host wins, then allow.
    """
    known = rules.where(F.col("host").isNotNull()).select(
        "host", F.coalesce("path", F.lit("")).alias("path"), "verdict"
    ).groupBy("host", "path").agg(F.min("verdict").alias("verdict"))  # "allow" sorts before "block"
    spans = [r[0] for r in known.select(F.length("path")).distinct().collect()]  # bounded by the longest url
    hint = F.broadcast if known.limit(FEW_RULES + 1).count() <= FEW_RULES else lambda df: df
    lookup = known.select(
        F.col("host").alias("_suffix"), F.col("path").alias("_prefix"),
        F.concat("host", "path").alias("rule"), F.col("verdict").alias("decision"),
    )
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(".", F.slice(labels, i, F.size(labels)))
    )
    cuts = F.array_distinct(F.transform(F.array(*[F.lit(n) for n in spans or [0]]), lambda n: F.substring("path", F.lit(1), n)))
    # Different (host, path) pairs are looked up once, however many rows share one.
    places = rows.select("host", "path").distinct()
    tried = places.select("host", "path", F.explode(suffixes).alias("_suffix")).select(
        "host", "path", "_suffix", F.explode(cuts).alias("_prefix")
    )
    best = tried.join(hint(lookup), ["_suffix", "_prefix"]).groupBy("host", "path").agg(
        F.max(F.struct(F.length("rule").alias("n"), F.length("_suffix").alias("h"), (F.col("decision") == "allow").alias("f"), "rule", "decision")).alias("_best")
    )
    return best.select("host", "path", "_best.rule", "_best.decision")


def judge(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] | DataFrame, redirects: DataFrame | None = None,
    default: str = "allow", tables: Workspace | None = None,
) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, component.

    ``rules`` are (host, path, allow or block). A page that a rule fits has that
    rule's verdict. The others have the verdict of their aliases: urls joined by
    canonical links, meta refreshes or ``redirects`` (columns a, b) form
    components; if a rule allows any url of it, the component is allowed, else
    it is blocked if a rule blocks one. Pages without either have ``default``.
    ``component`` is the smallest url of the component, null for pages without
    aliases. Null urls and urls without ``://`` have an empty host and path and
    fit no rule; null html has no links. No rows give no rows.
    """
    spark = pages.sparkSession
    tables = tables or Workspace(spark, "url")
    pages = require_columns(pages, ["page_id", "url", "html"])
    if not isinstance(rules, DataFrame):
        rules = spark.createDataFrame(list(rules), "host string, path string, verdict string")
    edges = alias_edges(pages, tables)
    if redirects is not None:
        edges = edges.unionByName(redirects.select(node_of(F.col("a")).alias("a"), node_of(F.col("b")).alias("b")))
    linked = tables.save(components(edges, tables))
    nodes = linked.withColumn("host", host_of(F.col("node"))).withColumn("path", path_of(F.col("node")))
    rows = tables.save(pages.select(
        "page_id", node_of(F.col("url")).alias("node"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    ))
    places = rows.select("host", "path").unionByName(nodes.select("host", "path")).where(F.col("host") != "")
    ruled = tables.save(match_rules(places, rules))

    decided = nodes.join(ruled, ["host", "path"]).groupBy("component").agg(
        # "allow" sorts before "block", so an explicit allow wins.
        F.min("decision").alias("passed_on")
    )
    sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("_n"))
    known = linked.join(decided, "component", "left").join(sizes, "node").select("node", "component", "passed_on", "_n")
    known = tables.save(known)
    total = max(1, rows.count())
    places_n = tables.save(rows.groupBy("host", "path").agg(F.count(F.lit(1)).alias("_m")).join(ruled, ["host", "path"]))
    place = F.struct("host", "path")
    named = attach(rows, known, "node", "_n", total).select("page_id", "host", "path", "component", "passed_on", place.alias("place"))
    full = attach(named, places_n.select(place.alias("place"), "rule", "decision", "_m"), "place", "_m", total)
    verdict = F.coalesce("decision", "passed_on", F.lit(default))
    return full.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "component")
