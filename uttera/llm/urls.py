"""URL filter: host and path rules, and trust and distrust propagated over the host graph.

Everything is DataFrame functions. Rules are a bounded parameter and become one expression,
longest first. Pages that no rule fits are judged by their host: personalised PageRank starts from
trusted hosts (weight: the share of the host's pages that rules allow) along links, and from
blocked hosts (the share that rules block) against links. Going forward a host's score is divided by its links; going
back a host takes on its targets' distrust by the share of its own links that lead there, so it doesn't matter how
many others link to them. A host is blocked if its distrust exceeds its
trust and reaches ``THRESHOLD`` of what a host whose pages are all blocked starts with.

Edges are links between different hosts (absolute or scheme-relative href and src), counted once
a page and target; a page's relative links stay on its host and carry no edge. Pages and links are
summed per host before anything is joined, so the graph is as large as the number of linked hosts.

Defined results: a null url, or one without ``://``, has an empty host and path and no rule, and is
allowed (an empty host has no seeds); null html has no links; repeated rows are judged alike.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from uttera.llm.scratch import Scratch

#: Fixed rules: (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
DAMPING = 0.85
TOLERANCE = 1e-3
CUT = 4
THRESHOLD = 0.5
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"""(?i)(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


def lower_ascii(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: str) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")))


def path_of(url: str) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_struct(host: Column, path: Column, rules=RULES) -> Column:
    """The longest fitting rule as (rule, verdict), null if none fits; of equally long ones a block."""
    ranked = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block"))
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict"))) for v, h, p in ranked]
    return F.coalesce(*fits, F.lit(None).cast("struct<rule:string,verdict:string>"))


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, weight): how many pages of src link to dst."""
    found = pages.select(F.col("host").alias("src"), F.explode(F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(_LINK), F.lit(1)), lower_ascii))).alias("dst"))
    return found.where("src <> dst and src <> '' and dst <> ''").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("weight"))


def propagate(seeds: DataFrame, edges: DataFrame, scratch: Scratch, tolerance: float = TOLERANCE, damping: float = DAMPING) -> DataFrame:
    """(host, kind, score): kind t along the links, kind d against them. seeds: (host, kind, seed of at most 1).

    What a round adds is at most ``damping`` of what the one before added, so rounds end when no host's score changes by
    more than ``tolerance`` of a full seed's start, however long the chains are; every ``CUT`` rounds are a written table.
    """
    out = edges.groupBy("src").agg(F.sum("weight").alias("all"))
    shares = edges.join(out, "src").withColumn("share", F.col("weight") / F.col("all"))
    there = shares.select(F.lit("t").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"), "share")
    flow = scratch.save(there.unionByName(shares.select(F.lit("d").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"), "share")), "flow")
    start = seeds.select("host", "kind", ((1 - damping) * F.col("seed")).alias("score"))
    if flow.isEmpty():
        return start
    now = scratch.save(start.withColumn("step", F.col("score")), "round0")
    k = 0
    while not now.where(F.col("step") > tolerance * (1 - damping)).isEmpty():
        for _ in range(CUT):
            gain = damping * F.col("step") * F.col("share")
            moved = now.join(flow, ["kind", "host"]).select(F.col("to").alias("host"), "kind", gain.alias("score"), gain.alias("step"))
            kept = now.select("host", "kind", "score", F.lit(0.0).alias("step"))
            now = moved.unionByName(kept).groupBy("host", "kind").agg(F.sum("score").alias("score"), F.sum("step").alias("step"))
        k += 1
        now = scratch.save(now, f"round{k}")
        scratch.drop(f"round{k - 1}")
    return now.drop("step")


def judge(pages: DataFrame, scratch: Scratch, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust of every page."""
    cut = pages.select("page_id", host_of("url").alias("host"), path_of("url").alias("path"), "html")
    ruled = cut.withColumn("fit", rule_struct(F.col("host"), F.col("path"), rules))
    by_host = ruled.where("host <> ''").groupBy("host").agg(F.avg((F.coalesce(F.col("fit.verdict"), F.lit("")) == "allow").cast("double")).alias("t"), F.avg((F.coalesce(F.col("fit.verdict"), F.lit("")) == "block").cast("double")).alias("d"))
    seeds = scratch.save(by_host, "hosts").select("host", F.explode(F.array(F.struct(F.lit("t").alias("kind"), F.col("t").alias("seed")), F.struct(F.lit("d").alias("kind"), F.col("d").alias("seed")))).alias("s")).select("host", "s.kind", "s.seed").where("seed > 0")
    scores = propagate(seeds, host_edges(cut), scratch)
    hosts = scratch.save(scores.groupBy("host").agg(F.sum(F.when(F.col("kind") == "t", F.col("score"))).alias("trust"), F.sum(F.when(F.col("kind") == "d", F.col("score"))).alias("distrust")), "scores")
    scratch.keep("scores")
    joined = ruled.drop("html").join(hosts, "host", "left").withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in ("trust", "distrust")})
    bad = (F.col("distrust") > F.col("trust")) & (F.col("distrust") >= THRESHOLD * (1 - DAMPING))
    return joined.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), F.coalesce(F.col("fit.verdict"), F.when(bad, "block").otherwise("allow")).alias("verdict"), "trust", "distrust")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), Scratch(spark, "urls"))
