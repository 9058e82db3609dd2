"""URL filters by link-graph propagation, in DataFrame functions alone.

Path rules decide the urls that they fit. All others take their host's
verdict: personalised PageRank spreads trust from hosts with allowed pages
along the links between hosts, and distrust from hosts with blocked pages
against them (who links to a blocked host is suspect). Both are scaled so that
an even share is 1; a host whose distrust exceeds its trust by ``margin`` is
blocked.

Scale: urls and links collapse to hosts and host pairs in map-side aggregates,
so a host with a third of all pages is one row per task; the iterations move
host rows only, and each round is written, so that plans stay of one size. A host
with very many links meets in a sum, and adaptive execution splits its join.
Rounds go on until all rank still under way is below the tolerance, however long the
ways between hosts are: it shrinks by ``damping`` a round, so 1e-6 takes 96 rounds
at most, and as many as the longest way where links make no circles. The written
rounds, narrow rows of the hosts reached, are summed up once at the end.

Defined results: a null url, or one without ``://``, has empty host and path
and no rule; it gets the default verdict, as do hosts without evidence. Null
html has no links; links of a host to itself and links without a host are not
edges; repeated rows each get their verdict (and count as pages); an empty
table gives no rows; extra columns are ignored."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatio.llm.scratch import Scratch, cleaned_shuffles, drop, scratch_path

#: (host, path, verdict) of the registered query (fixed values).
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class TrustRules:
    rules: tuple = RULES
    damping: float = 0.85
    tolerance: float = 1e-6         # all ranks (sum 1) together are off by less
    margin: float = 1.0
    default: str = "allow"

    def __post_init__(self):
        if not 1e-13 <= self.tolerance < 1 or not 0 <= self.damping < 1:
            raise ValueError("tolerance is from 1e-13 up to 1, damping from 0 up to 1 (both below 1)")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url by position: after the first
    ``://`` up to ``/``, ``?``, ``#``; then up to ``?``, ``#``."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):       # the longer override
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def host_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst) pairs of different hosts, from absolute and
    protocol-relative links."""
    src, _ = host_and_path(F.col(url_col))
    links = F.regexp_extract_all(F.coalesce(F.col(html_col), F.lit("")),
                                 F.lit(r"""(?i)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^\s"'<>/?#]+)"""), F.lit(1))
    return (pages.filter(F.col(html_col).contains("//")).select(src.alias("src"), F.explode(links).alias("dst"))
            .select("src", F.translate(F.col("dst"), UPPER, LOWER).alias("dst"))
            .filter("src <> '' AND dst <> '' AND src <> dst").distinct())


def personalised_rank(edges: DataFrame, seeds: DataFrame, cfg: TrustRules, scratch: Scratch, name: str) -> DataFrame:
    """(host, rank) with sum 1 over all hosts (0 without seeds), to
    ``cfg.tolerance``: a walk starts at the seeds by their weight, goes on from a
    host with ``damping`` by one of its links, and else starts anew, as it does
    at hosts without links. The rank is the sum over the lengths of ways, scaled
    to 1: rounds hand on what the one before received, until too little is left.
    ``seeds``: (host, weight) of every host."""
    spark = scratch.spark
    total = seeds.agg(F.sum("weight")).first()[0] or 1.0          # one row
    out = edges.groupBy("src").agg(F.count(F.lit(1)).alias("out"))
    shares = scratch.put(edges.join(out, "src").select("src", "dst", (F.lit(cfg.damping) / F.col("out")).alias("share")),
                         f"{name}-shares")
    base = scratch_path(spark, f"{scratch.what}-{name}-rounds")
    held = seeds.filter("weight > 0").select("host", (F.col("weight") / F.lit(total)).alias("part"))
    k, left = 0, 1.0
    while left * cfg.damping / (1 - cfg.damping) >= cfg.tolerance:     # what all later rounds could add
        path = f"{base}/round={k}"
        with cleaned_shuffles(spark):
            held.write.parquet(path)
        now = spark.read.schema("host string, part double").parquet(path)
        left = now.agg(F.sum("part")).first()[0] or 0.0           # one row
        held = (shares.join(now, F.col("src") == F.col("host")).groupBy(F.col("dst").alias("host"))
                .agg(F.sum(F.col("part") * F.col("share")).alias("part")))
        k += 1
    ways = spark.read.schema("host string, part double, round int").parquet(base).groupBy("host").agg(F.sum("part").alias("part"))
    ways = scratch.put(ways, f"{name}-sums")
    scale = ways.agg(F.sum("part")).first()[0] or 1.0             # one row
    drop(spark, base)
    scratch.drop(f"{name}-shares")
    return seeds.join(ways, "host", "left").select("host", (F.coalesce("part", F.lit(0.0)) / F.lit(scale)).alias("rank"))


def host_scores(pages: DataFrame, cfg: TrustRules, scratch: Scratch, url_col: str = "url",
                html_col: str = "html") -> DataFrame:
    """(host, trust, distrust, verdict) of every host of a page or a link."""
    host, path = host_and_path(F.col(url_col))
    _, verdict = rule_of(F.col("host"), F.col("path"), cfg.rules)
    judged = pages.select(host.alias("host"), path.alias("path")).select("host", verdict.alias("verdict")).filter("host <> ''")
    share = lambda v: F.sum((F.col("verdict") == v).cast("long")) / F.count(F.lit(1))
    seeds = judged.groupBy("host").agg(F.coalesce(share("allow"), F.lit(0.0)).alias("allowed"),
                                       F.coalesce(share("block"), F.lit(0.0)).alias("blocked"))
    edges = scratch.put(host_edges(pages, url_col, html_col), "edges")
    named = edges.select(F.explode(F.array("src", "dst")).alias("host")).distinct()
    seeds = named.join(seeds, "host", "full_outer").select(
        "host", F.coalesce("allowed", F.lit(0.0)).alias("allowed"), F.coalesce("blocked", F.lit(0.0)).alias("blocked"))
    seeds = scratch.put(seeds, "seeds")
    trust = personalised_rank(edges, seeds.select("host", F.col("allowed").alias("weight")), cfg, scratch, "trust")
    back = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    distrust = personalised_rank(back, seeds.select("host", F.col("blocked").alias("weight")), cfg, scratch, "distrust")
    n = seeds.agg(F.count(F.lit(1)).alias("hosts"))               # one row
    out = (trust.withColumnRenamed("rank", "trust").join(distrust.withColumnRenamed("rank", "distrust"), "host")
           .crossJoin(F.broadcast(n))
           .select("host", F.round(F.col("trust") * F.col("hosts"), 9).alias("trust"),
                   F.round(F.col("distrust") * F.col("hosts"), 9).alias("distrust")))
    evidence = (F.col("trust") > 0) | (F.col("distrust") > 0)
    return scratch.put(out.withColumn("verdict", F.when(~evidence, F.lit(cfg.default)).when(
        F.col("distrust") - F.col("trust") >= cfg.margin, F.lit("block")).otherwise(F.lit("allow"))), "scores")


def judge_urls(pages: DataFrame, cfg: TrustRules | None = None, id_col: str = "page_id", url_col: str = "url",
               html_col: str = "html") -> DataFrame:
    """Per row: id, host, path, rule, verdict, and its host's trust and distrust."""
    cfg = cfg or TrustRules()
    src = pages.select(pages[id_col].alias("id"), pages[url_col].alias("url"), pages[html_col].alias("html"))
    scores = host_scores(src, cfg, Scratch(pages.sparkSession, "trust"), "url", "html")
    host, path = host_and_path(F.col("url"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), cfg.rules)
    judged = src.select("id", host.alias("host"), path.alias("path")).select(
        "id", "host", "path", rule.alias("rule"), verdict.alias("by_rule"))
    scores = scores.select(F.col("host").alias("h"), "trust", "distrust", F.col("verdict").alias("by_host"))
    return judged.join(scores, F.col("host") == F.col("h"), "left").select(
        F.col("id").alias(id_col), "host", "path", "rule",
        F.coalesce("by_rule", "by_host", F.lit(cfg.default)).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
