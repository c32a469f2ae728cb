"""URL filters: longest-match rules, and link-graph propagation of trust and distrust.

The main path is DataFrame functions only.  Rules name a host with all its subdomains and a path
beginning; the longest that fits decides.  For the other pages the verdict comes from their host:
personalised PageRank spreads trust from the hosts of allowed pages along host edges (from the linking to
the linked host), and the same walk on reversed edges spreads distrust from the hosts of blocked pages to
those that link to them.  A seed's weight is the share of the host's pages that the rules decide.  A
host is blocked if its distrust reaches ``MIN_DISTRUST`` and ``BLOCK_RATIO`` times its trust.

Edges are counted per (source, target) before anything is joined, so a host with a third of all pages is
one row of each of its targets; every second step is checkpointed.

Defined results: a null url, or one without ``://``, has empty host and path, fits no rule and is allowed;
a null html has no links; links without a host stay within theirs and carry nothing; repeated rows count
as pages and each give their row.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import cut

DAMPING = 0.85
TOLERANCE = 1e-4
MAX_STEPS = 1000  # a guard: the change shrinks by DAMPING a step, so about 60 steps meet the tolerance
MIN_DISTRUST = 0.25
BLOCK_RATIO = 2.0


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


# FIXED VALUES: the rules of the contract.
RULES = [Rule("org", "/", "allow"), Rule("example.org", "/es/", "block"), Rule("example.org", "/en/1", "block"),
         Rule("com", "/fr/", "allow"), Rule("com", "/de/", "block")]


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty if there is none."""
    at = F.locate("://", url)
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_after_scheme(url), r"^([^/?#]*)", 1), string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null."""
    longest_first = sorted(rules, key=lambda r: (-len(r.text), r.text))
    fits = [F.when(((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
                   F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))) for r in longest_first]
    return F.coalesce(*fits)


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between different hosts; ``pages`` has __host and html."""
    link = F.explode(F.array_distinct(F.regexp_extract_all(
        F.coalesce("html", F.lit("")), F.lit(r"(?i)<a\s[^>]*?href\s*=\s*[\"']?\s*((?:[a-z][a-z0-9+.\-]*:)?//[^\"'\s>]+)"), 1)))
    links = pages.select(F.col("__host").alias("src"), link.alias("link"))
    target = host_of(F.when(F.col("link").startswith("//"), F.concat(F.lit(":"), F.col("link"))).otherwise(F.col("link")))
    return links.withColumn("dst", target).where("src != '' and dst != '' and src != dst") \
        .groupBy("src", "dst").agg(F.count("*").alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, steps: int = MAX_STEPS) -> DataFrame:
    """Personalised PageRank, in units of a seed's own weight: (host, score) of all hosts reached.

    ``edges`` (src, dst, n) carry scores from src to dst in proportion to n; ``seeds`` (host, weight).
    Steps go on until ``TOLERANCE`` is met; more than ``steps`` raise."""
    total = edges.groupBy("src").agg(F.sum("n").alias("total"))
    shares = cut(edges.join(total, "src").select("src", "dst", (F.col("n") / F.col("total")).alias("share")))
    scores = cut(seeds.select("host", F.col("weight").alias("score")))
    if shares.isEmpty():
        return scores
    mass = scores.agg(F.sum("score")).first()[0] or 0.0
    for _ in range(steps):
        moved = shares.join(scores.withColumnRenamed("host", "src"), "src").groupBy(F.col("dst").alias("host")) \
            .agg((damping * F.sum(F.col("share") * F.col("score"))).alias("score"))
        new = cut(moved.unionByName(seeds.select("host", F.col("weight").alias("score"))).groupBy("host").agg(F.sum("score").alias("score")))
        change = new.withColumnRenamed("score", "new").join(scores, "host", "full").agg(
            F.sum(F.abs(F.coalesce("new", F.lit(0.0)) - F.coalesce("score", F.lit(0.0))))).first()[0] or 0.0
        scores = new
        if change <= TOLERANCE * max(mass, 1e-12):
            return scores
    raise RuntimeError(f"host scores still change by {change} of {mass} after {steps} steps")


def judge(pages: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Per page row: page_id, host, path, rule, verdict, and the host's trust and distrust."""
    pages = pages.select("page_id", "url", "html").withColumn("__host", host_of(F.col("url")))
    judged = pages.select("page_id", "__host", path_of(F.col("url")).alias("path")) \
        .withColumn("__found", rule_of(F.col("__host"), F.col("path"), rules))
    by_host = cut(judged.where("__host != ''").groupBy(F.col("__host").alias("host")).agg(
        F.count("*").alias("n"), F.count_if(F.col("__found.verdict") == "allow").alias("allowed"),
        F.count_if(F.col("__found.verdict") == "block").alias("blocked")))
    edges = cut(host_edges(pages))
    backward = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "n")
    trust = propagate(edges, by_host.where("allowed > 0").select("host", (F.col("allowed") / F.col("n")).alias("weight")))
    distrust = propagate(backward, by_host.where("blocked > 0").select("host", (F.col("blocked") / F.col("n")).alias("weight")))
    hosts = trust.withColumnRenamed("score", "trust").join(distrust.withColumnRenamed("score", "distrust"), "host", "full") \
        .select(F.col("host").alias("__host"), F.coalesce("trust", F.lit(0.0)).alias("trust"),
                F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
    bad = (F.coalesce("distrust", F.lit(0.0)) >= MIN_DISTRUST) & (F.col("distrust") >= BLOCK_RATIO * F.col("trust"))
    return judged.join(hosts, "__host", "left").select(
        "page_id", F.col("__host").alias("host"), "path", F.col("__found.rule").alias("rule"),
        F.coalesce(F.col("__found.verdict"), F.when(bad, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
