"""URL filters: rules on host and path, and trust that spreads over the links between hosts.

A url with a rule gets that rule's verdict. For the rest, two personalised PageRanks run over the host graph: trust from
hosts whose pages the rules mostly allow, along the links, and distrust from hosts whose pages they mostly block,
against the links (who links to bad hosts is suspect). Each seed restarts with weight 1. A host is blocked if more
than ``threshold`` of the trust and distrust it has is distrust; a host that neither reaches is allowed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.llm.common import lower_ascii, stored

ALLOW, BLOCK = "allow", "block"
DAMPING = 0.85
THRESHOLD = 0.5
# Rounds end when no more than this part of the seeds' weight still moves, and after this many in any case: what is
# left then is less than DAMPING to that power.
TOLERANCE = 1e-4
ROUNDS = 60
LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""

Rule = tuple[str, str, str]


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_number(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The place in ``rules`` of the longest rule that fits, or null. A short list: each rule is an expression."""
    found = F.lit(None).cast("int")
    for k in sorted(range(len(rules)), key=lambda k: len(rules[k][1] + rules[k][2])):
        _, name, start = rules[k]
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        found = F.when(fits, F.lit(k)).otherwise(found)
    return found


def _choice(number: Column, values: Sequence[str]) -> Column:
    return F.when(number.isNotNull(), F.element_at(F.array(*(F.lit(v) for v in values)), number + 1))


def host_links(pages: DataFrame) -> DataFrame:
    """``source``, ``target``, ``links``: links between different hosts; a link without a host stays on its own."""
    links = pages.select(
        host_of(F.col("url")).alias("source"),
        F.explode(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1))).alias("target"),
    ).withColumn("target", lower_ascii(F.col("target")))
    return links.where("source <> target and source <> ''").groupBy("source", "target").agg(F.count(F.lit(1)).alias("links"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """``host``, ``trust``, ``distrust`` of every host that a seed reaches.

    ``edges`` as from ``host_links``; ``seeds`` has ``host``, ``trust`` and ``distrust``, the restart weights. Trust that
    reaches a host without links ends there. Each round joins the scores to the edges and sums per host, and is
    written to the shared folder, so a lost executor costs one round at most.
    """
    both = edges.select("source", "target", "links", F.lit(0).alias("kind")).union(
        edges.select(F.col("target"), F.col("source"), "links", F.lit(1))
    )
    total = both.groupBy("source", "kind").agg(F.sum("links").alias("total"))
    steps = stored(
        both.join(total, ["source", "kind"]).select(
            "source", "kind", "target", (damping * F.col("links") / F.col("total")).alias("share")
        ),
        "host-steps",
    )
    start = seeds.select("host", F.lit(0).alias("kind"), F.col("trust").alias("score")).union(
        seeds.select("host", F.lit(1), "distrust")
    )
    start = stored(start.where("score > 0"), "host-seeds")
    weight = start.agg(F.sum("score")).first()[0] or 0.0
    scores, moving = start, start
    for _ in range(rounds):
        # power series: what moved last is passed on and added up
        passed = moving.join(steps, (moving["host"] == steps["source"]) & (moving["kind"] == steps["kind"])).select(
            steps["target"].alias("host"), steps["kind"], (F.col("score") * F.col("share")).alias("score")
        )
        moving = stored(passed.groupBy("host", "kind").agg(F.sum("score").alias("score")), "host-moving")
        still = moving.agg(F.sum("score")).first()[0] or 0.0
        if still > 0:
            scores = stored(
                scores.union(moving).groupBy("host", "kind").agg(F.sum("score").alias("score")), "host-scores"
            )
        if still <= TOLERANCE * weight:
            break
    side = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0))
    return scores.groupBy("host").agg(side(0).alias("trust"), side(1).alias("distrust"))


def judge_urls(pages: DataFrame, rules: Sequence[Rule], threshold: float = THRESHOLD) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``trust`` and ``distrust`` of every row of ``pages``.

    ``pages`` needs page_id, url and html; other columns are not read. ``rules`` are (verdict, host, path start). A
    null url, or one without ``://``, has an empty host and path, and such rows are no part of the graph; a null html
    has no links. Repeated rows are judged each. An empty table gives an empty result.
    """
    urls = pages.select("page_id", host_of(pages["url"]).alias("host"), path_of(pages["url"]).alias("path"))
    urls = urls.withColumn("number", rule_number(F.col("host"), F.col("path"), rules))
    named = urls.withColumn("ruled", _choice(F.col("number"), [r[0] for r in rules]))
    votes = named.where("host <> ''").groupBy("host").agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if(F.col("ruled") == ALLOW).alias("allowed"),
        F.count_if(F.col("ruled") == BLOCK).alias("blocked"),
    )
    seeds = votes.select(
        "host",
        F.when(F.col("allowed") * 2 > F.col("pages"), 1.0).otherwise(0.0).alias("trust"),
        F.when(F.col("blocked") * 2 > F.col("pages"), 1.0).otherwise(0.0).alias("distrust"),
    )
    edges = stored(host_links(pages), "host-links")
    scores = propagate(edges, seeds).withColumnRenamed("host", "_host")
    share = F.col("distrust") / (F.col("trust") + F.col("distrust"))
    method = F.when(share > threshold, BLOCK).otherwise(ALLOW)
    # many pages may share a host; scores have one row per host, and the adaptive join splits a host's pages
    return named.join(scores, named["host"] == scores["_host"], "left").select(
        "page_id",
        "host",
        "path",
        _choice(F.col("number"), [r[1] + r[2] for r in rules]).alias("rule"),
        F.coalesce("ruled", method).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"),
        F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )
