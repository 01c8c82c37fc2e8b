"""URLs judged by rules, and by trust and distrust that spread over the links between hosts.

Every host with pages under an allowing rule is a trusted seed, every one with pages under a blocking
rule a distrusted seed, each by the share of its pages. Trust is personalised PageRank along links
from the trusted seeds; distrust is the same along reversed links from the distrusted ones, so that
hosts which link to bad hosts are distrusted. A seed hands out its share of pages, not its part of 1,
so the thresholds do not depend on the number of seeds. A host is blocked where most of its own pages
are, or where the distrust that others hand it reaches LIMIT and its distrust exceeds its trust; every
other host is allowed, so clean pages of a host with some blocked ones are. A rule that fits a url
overrides that.

A null url, or one without "://", has an empty host and path and no rule; an empty host has no links,
so it is allowed. A null page has no links. Repeated links count as often as they occur, links of a host to itself not at all. Repeated rows each
give their row. Only page_id, url and html are used, so other columns cannot clash. Empty tables give
no rows. Only DataFrame operations are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remanente.llm.common import written

#: Host and path with the verdict of a url that they fit.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
#: Share that a host hands on, rounds of handing on, and least distrust from others to block. A seed of
#: most of a host's pages hands out more than half of 1, so half of the 0.05 for seeds of 1 loses no host.
DAMPING, ROUNDS, LIMIT = 0.85, 12, 0.025
#: Rounds after which the shares are written, so that the plan stays short.
CUT_EVERY = 4

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host_of(url: Column) -> Column:
    """After the first "://" up to "/", "?", "#" or the end, A-Z as a-z; empty if there is none."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, _UPPER, _UPPER.lower()), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to "?", "#" or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def under(host: Column, domain: str) -> Column:
    return (host == domain) | host.endswith("." + domain)


def best_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as text, and its verdict; null if none does."""
    rule = verdict = F.lit(None).cast("string")
    for domain, start, kind in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = under(host, domain) & path.startswith(start)
        rule = F.when(fits, F.lit(domain + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def host_links(pages: DataFrame) -> DataFrame:
    """src, dst, n: links between different hosts in the pages' html, added up before the shuffle."""
    target = r"(?is)<(?:a|area|link|iframe|form|frame)\s[^>]*?(?:href|src|action)\s*=\s*[\"']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^\s\"'>]+)"
    found = pages.select(
        host_of(F.col("url")).alias("src"),
        F.explode(F.regexp_extract_all("html", F.lit(target), 1)).alias("link"),
    )
    whole = F.when(F.col("link").startswith("//"), F.concat(F.lit("x:"), "link")).otherwise(
        F.col("link")
    )
    ends = found.select("src", host_of(whole).alias("dst"))
    return (
        ends.where("src <> '' AND dst <> '' AND src <> dst")
        .groupBy("src", "dst")
        .agg(F.count("*").alias("n"))
    )


def spread(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """kind, host, score after some rounds from seeds (kind, host, weight) over weighted edges.

    ``edges`` has kind, src, dst and n, the number of links.
    """
    total = edges.groupBy("kind", "src").agg(F.sum("n").alias("total"))
    shares = written(
        edges.join(total, ["kind", "src"]).select(
            "kind", "src", "dst", (F.col("n") / F.col("total")).alias("share")
        ),
        "links",
    )
    first = seeds.select("kind", "host", ((1 - DAMPING) * F.col("weight")).alias("score"))
    now = first
    for k in range(1, rounds + 1):
        handed = (
            now.withColumnRenamed("host", "src")
            .join(shares, ["kind", "src"])
            .select(
                "kind",
                F.col("dst").alias("host"),
                (DAMPING * F.col("score") * F.col("share")).alias("score"),
            )
        )
        now = first.union(handed).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        if k % CUT_EVERY == 0 and k < rounds:
            now = written(now, "scores")
    return now


def host_shares(pages: DataFrame, rules=RULES) -> DataFrame:
    """kind, host, weight: the share of a host's pages under each kind of rule, where there are any."""
    named = pages.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    _, verdict = best_rule(F.col("host"), F.col("path"), rules)
    pages_of = named.where("host <> ''").groupBy("host").agg(
        F.count("*").alias("n"),
        F.count(F.when(verdict == "allow", 1)).alias("trust"),
        F.count(F.when(verdict == "block", 1)).alias("distrust"),
    )
    each = [
        F.struct(F.lit(kind).alias("kind"), (F.col(kind) / F.col("n")).alias("weight"))
        for kind in ("trust", "distrust")
    ]
    found = pages_of.select("host", F.explode(F.array(*each)).alias("x"))
    return found.select("x.kind", "host", "x.weight").where("weight > 0")


def majorities(shares: DataFrame) -> DataFrame:
    """Seeds of 1 where most of a host's pages are under one kind of rule."""
    return shares.where("weight > 0.5").withColumn("weight", F.lit(1.0))


def host_scores(
    pages: DataFrame, rules=RULES, rounds: int = ROUNDS, seeds: DataFrame | None = None
) -> DataFrame:
    """host, trust, distrust of all hosts that a seed (kind, host, weight) reaches.

    If no seeds are given, they are the majorities.
    """
    links = written(host_links(pages), "links")
    if seeds is None:
        seeds = written(majorities(host_shares(pages, rules)), "seeds")
    edges = links.select(F.lit("trust").alias("kind"), "src", "dst", "n").union(
        links.select(
            F.lit("distrust").alias("kind"),
            F.col("dst").alias("src"),
            F.col("src").alias("dst"),
            "n",
        )
    )
    scores = spread(edges, seeds, rounds)

    def of(name: str) -> Column:
        return F.sum(F.when(F.col("kind") == name, F.col("score")).otherwise(0.0)).alias(name)

    return scores.groupBy("host").agg(of("trust"), of("distrust"))


def judge(pages: DataFrame, rules=RULES, limit: float = LIMIT) -> DataFrame:
    """page_id, host, path, rule, verdict, trust and distrust of the host."""
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    named = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = best_rule(F.col("host"), F.col("path"), rules)
    seeds = written(host_shares(pages, rules), "seeds")
    own = seeds.where("kind = 'distrust'").select("host", F.col("weight").alias("blocked"))
    scores = host_scores(pages, rules, seeds=seeds).join(own, "host", "left")
    scores = written(scores, "scores")
    trust, distrust, blocked = (F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust", "blocked"))
    handed = distrust - (1 - DAMPING) * blocked
    bad = (blocked > 0.5) | ((handed >= limit) & (distrust > trust))
    own = F.when(bad, "block").otherwise("allow")
    return named.join(scores, "host", "left").select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, own).alias("verdict"),
        trust.alias("trust"),
        distrust.alias("distrust"),
    )
