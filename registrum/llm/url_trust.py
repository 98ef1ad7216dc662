"""URL filter by rules and by trust and distrust that spread over links, in DataFrame functions.

A rule is a verdict, a host and a path; it fits its host and all subdomains where the path starts
with the rule's, and the longest rule wins. Pages without a rule get the verdict of their host.

Hosts most of whose pages are allowed by rules are trusted seeds, hosts most of whose pages are
blocked are distrusted ones, each with the share of those pages as weight. Trust is a
personalised PageRank over host edges; distrust runs over the same edges reversed, since a page
answers for what it links to. Both are iterated until no rank changes by more than ``TOLERANCE`` of
itself, so hosts at any distance from a seed are reached. Edges are the links of the pages to other hosts, counted per pair of
hosts, and one between a host and its parent domain where both have pages. A host is blocked
where its distrust exceeds its trust by more than ``MARGIN`` of it.

Pages shrink to counts per host and per pair of hosts before anything is joined, by partial
aggregates. Ranks are written to the shared folder every few rounds. Hosts go back to their pages
by a join of two exchanges, which adaptive execution splits where one host is hot.

Null urls and urls without ``://`` have an empty host and path, fit no rule and are allowed. Null
html has no links. Repeated rows are judged alike. Other columns of the pages are not carried along.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registrum.session import write_and_reread

DAMPING = 0.85
# The first test of convergence, then one with every table.
ROUNDS = 12
ROUNDS_PER_TABLE = 4
TOLERANCE = 1e-8
# Sums of floats depend on their order in the last digits, and ranks end within the tolerance.
MARGIN = 1e-6
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Absolute links and those that only leave out the scheme.
LINK = r"""(?i)\b(?:href|src)\s*=\s*["']?((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def _host(rest: Column) -> Column:
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)


def host(url: Column) -> Column:
    return F.coalesce(_host(_after_scheme(url)), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(own_host: Column, own_path: Column, rules: list[Rule], value: str) -> Column:
    """``text`` or ``verdict`` of the longest rule that fits, else null."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((own_host == rule.host) | own_host.endswith("." + rule.host)) & own_path.startswith(rule.path)
        out = F.when(fits, F.lit(getattr(rule, value))).otherwise(out)
    return out


def host_edges(pages: DataFrame, url: str, html: str) -> DataFrame:
    """src, dst and weight, each pair of hosts once."""
    links = pages.select(
        host(F.col(url)).alias("src"),
        F.explode(F.array_distinct(F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(LINK), F.lit(1)))).alias("to"),
    )
    target = _host(F.regexp_extract("to", "//(.*)", 1)).alias("dst")
    return (
        links.select("src", target)
        .where("src <> dst and src <> '' and dst <> ''")
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
    )


def ranks(edges: DataFrame, seeds: DataFrame) -> DataFrame:
    """Personalised PageRank of both kinds: kind, host, rank.

    ``edges`` has kind, src, dst, weight and ``seeds`` kind, host, seed. What a host without
    outgoing edges holds goes no further.
    """
    sums = seeds.groupBy("kind").agg(F.sum("seed").alias("total"))
    seeds = seeds.join(F.broadcast(sums), "kind")  # two rows
    seeds = write_and_reread(seeds.select("kind", "host", (F.col("seed") / F.col("total")).alias("rank")), "seeds")
    outgoing = edges.groupBy("kind", "src").agg(F.sum("weight").alias("out"))
    shares = edges.join(write_and_reread(outgoing, "outgoing"), ["kind", "src"])
    shares = shares.select("kind", F.col("src").alias("host"), "dst", (F.col("weight") / F.col("out")).alias("share"))
    shares = write_and_reread(shares, "edges")
    start = seeds.withColumn("rank", F.col("rank") * (1 - DAMPING))
    current, done = seeds, 0
    while True:
        before = current.withColumnRenamed("rank", "old")
        for _ in range(ROUNDS_PER_TABLE):
            moved = current.join(shares, ["kind", "host"]).select(
                "kind", F.col("dst").alias("host"), (F.col("rank") * F.col("share") * DAMPING).alias("rank")
            )
            current = moved.unionByName(start).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        current = write_and_reread(current, "ranks")
        done += ROUNDS_PER_TABLE
        if done >= ROUNDS:
            # A host that is reached for the first time has no rank before.
            change = F.abs(F.col("rank") - F.coalesce("old", F.lit(0.0)))
            changed = current.join(before, ["kind", "host"], "left").where(change > F.col("rank") * TOLERANCE)
            if changed.isEmpty():
                return current


def judge(
    pages: DataFrame, rules: list[Rule], page_id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """page_id, host, path, rule, verdict, trust, distrust; one row per page."""
    own = pages.select(F.col(page_id).alias("page_id"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    own = own.withColumns({
        "rule": rule_of(F.col("host"), F.col("path"), rules, "text"),
        "ruled": rule_of(F.col("host"), F.col("path"), rules, "verdict"),
    })
    own = write_and_reread(own, "urls")
    hosts = own.where("host <> ''").groupBy("host").agg(
        F.count(F.lit(1)).alias("pages"), F.count_if(F.col("ruled") == "allow").alias("allowed"),
        F.count_if(F.col("ruled") == "block").alias("blocked"),
    )
    hosts = write_and_reread(hosts, "hosts")
    seeds = hosts.where("2 * allowed > pages").selectExpr("'trust' AS kind", "host", "allowed / pages AS seed").unionByName(
        hosts.where("2 * blocked > pages").selectExpr("'distrust' AS kind", "host", "blocked / pages AS seed")
    )
    parents = hosts.select("host", F.regexp_extract("host", r"^[^.]+\.(.+\..+)$", 1).alias("parent"))
    family = parents.join(hosts.select(F.col("host").alias("parent")), "parent").select(
        F.explode(F.array(
            F.struct(F.col("host").alias("src"), F.col("parent").alias("dst")),
            F.struct(F.col("parent").alias("src"), F.col("host").alias("dst")),
        )).alias("edge")
    ).select("edge.src", "edge.dst", F.lit(1.0).alias("weight"))
    edges = write_and_reread(host_edges(pages, url, html).unionByName(family), "links")
    both = edges.select(F.lit("trust").alias("kind"), "src", "dst", "weight").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
    )
    found = ranks(both, seeds).groupBy("host").agg(
        *[F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("rank"))), F.lit(0.0)).alias(k) for k in ("trust", "distrust")]
    )
    found = write_and_reread(found, "host-ranks")
    judged = own.join(found, "host", "left")
    trust, distrust = (F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust"))
    by_host = F.when(distrust > trust * (1 + MARGIN), "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", by_host).alias("verdict"),
        trust.alias("trust"), distrust.alias("distrust"),
    )
