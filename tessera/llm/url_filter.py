"""URL filters: ordered rules first, then trust and distrust that spread over the links between hosts.

Hosts with pages under an allow rule are trusted seeds, hosts with pages under a block rule blocked
seeds, each by its share of such pages. Trust follows links forward (personalised PageRank), distrust
follows them backward: who links to blocked hosts is suspect. A page without a rule is blocked if its
host's held distrust reaches a threshold and exceeds its held trust; what a host holds is counted before
it sends anything on, so that being linked to doesn't clear it.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, small

_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_HREF = r"""(?i)<a\b[^>]*?\bhref\s*=\s*["']?([^"'\s>]+)"""
DAMPING = 0.85
THRESHOLD = 0.5
#: Rounds end when no score moves by more than the tolerance, which the damping reaches in about 70; more than ROUNDS are an error.
ROUNDS = 160
TOLERANCE = 1e-5
#: Rounds between two cuts of the lineage.
STRIDE = 4


class Rule(NamedTuple):
    verdict: str
    prefix: str

    @property
    def host(self) -> str:
        return self.prefix.partition("/")[0]

    @property
    def path(self) -> str:
        return self.prefix[len(self.host) :]


#: The contract's rules.
RULES = (Rule("allow", "com/"), Rule("block", "example.com/en/"), Rule("allow", "www.example.com/en/"), Rule("block", "net/es/"), Rule("block", "net/fr/"))


def url_host(url: Column) -> Column:
    """What follows the first :// up to /, ? or #, with A-Z lower-cased; empty if there is none."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2)


def rule_of(host: Column, path: Column, rules: Sequence[Rule], field: str) -> Column:
    """The `field` of the longest rule that fits; null without one. Of equally long rules the first wins."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.prefix)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(getattr(rule, field))).otherwise(found)
    return found


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, n): links between different hosts; relative links stay on their host and don't count."""
    targets = F.filter(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(_HREF), 1), lambda x: x.rlike("^([A-Za-z][A-Za-z0-9+.-]*:)?//"))
    links = pages.select(url_host(F.col("url")).alias("src"), F.explode(targets).alias("to"))
    links = links.select("src", url_host(F.when(F.col("to").startswith("//"), F.concat(F.lit("x:"), "to")).otherwise(F.col("to"))).alias("dst"))
    return links.where("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").alias("n"))


def spread_scores(seeds: DataFrame, links: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, trust, distrust, held_trust, held_distrust) from (host, trust, distrust) seeds over (src, dst, n) links.

    x = (1 - damping) seed + damping (what comes in along the links, by their share of the sender's);
    a host without links in that direction keeps what it would send. Distrust runs against the links.
    A host that keeps ends at seed + damping / (1 - damping) what comes in, one that sends at 1 - damping of
    that; held_trust and held_distrust are the former for both, never below the seed.
    Rounds end when no score moves by more than the tolerance; scores that don't settle in `rounds` raise an error.
    """
    links = cut(links)
    hosts = seeds.groupBy("host").agg(F.max("trust").alias("trust0"), F.max("distrust").alias("distrust0"))
    ends = links.select(F.col("src").alias("host")).union(links.select(F.col("dst").alias("host"))).distinct()
    nodes = cut(hosts.join(ends, "host", "full").na.fill(0.0, ["trust0", "distrust0"]))
    if links.isEmpty():
        return nodes.select("host", *[F.col(f"{c}0").alias(f"{held}{c}") for held in ("", "held_") for c in ("trust", "distrust")])
    out = links.groupBy("src").agg(F.sum("n").alias("out"))
    into = links.groupBy("dst").agg(F.sum("n").alias("in"))
    steps = cut(links.join(out, "src").join(into, "dst").select("src", "dst", (F.col("n") / F.col("out")).alias("forward"), (F.col("n") / F.col("in")).alias("backward")))
    ends_of = F.broadcast if links.count() <= 50_000 else (lambda x: x)
    nodes = nodes.join(ends_of(out.select(F.col("src").alias("host"), F.lit(True).alias("sends"))), "host", "left").join(ends_of(into.select(F.col("dst").alias("host"), F.lit(True).alias("gets"))), "host", "left")
    nodes = cut(nodes.select("host", "trust0", "distrust0", F.col("sends").isNull().alias("keeps_trust"), F.col("gets").isNull().alias("keeps_distrust"), F.col("trust0").alias("trust"), F.col("distrust0").alias("distrust")))
    for step in range(rounds):
        forward = steps.join(nodes.select(F.col("host").alias("src"), "trust"), "src").select(F.col("dst").alias("host"), (F.col("trust") * F.col("forward")).alias("t"), F.lit(0.0).alias("d"))
        backward = steps.join(nodes.select(F.col("host").alias("dst"), "distrust"), "dst").select(F.col("src").alias("host"), F.lit(0.0).alias("t"), (F.col("distrust") * F.col("backward")).alias("d"))
        got = forward.unionByName(backward).groupBy("host").agg(F.sum("t").alias("t"), F.sum("d").alias("d"))
        new = nodes.join(got, "host", "left").na.fill(0.0, ["t", "d"])
        trust = (1 - damping) * F.col("trust0") + damping * (F.col("t") + F.when(F.col("keeps_trust"), F.col("trust")).otherwise(0.0))
        distrust = (1 - damping) * F.col("distrust0") + damping * (F.col("d") + F.when(F.col("keeps_distrust"), F.col("distrust")).otherwise(0.0))
        new = new.select("host", "trust0", "distrust0", "keeps_trust", "keeps_distrust", trust.alias("trust"), distrust.alias("distrust"), F.greatest(F.abs(trust - F.col("trust")), F.abs(distrust - F.col("distrust"))).alias("moved"))
        if step % STRIDE == STRIDE - 1:
            new = cut(new)
            if new.where(F.col("moved") > tolerance).isEmpty():
                nodes = new.drop("moved")
                break
        nodes = new.drop("moved")
    else:
        raise RuntimeError(f"scores did not settle in {rounds} rounds")
    # rounded, so that the last bits of a sum don't part equal scores
    held = [F.round(F.greatest(F.col(f"{c}0"), F.when(F.col(f"keeps_{c}"), F.col(c)).otherwise(F.col(c) / (1 - damping))), 9).alias(f"held_{c}") for c in ("trust", "distrust")]
    return nodes.select("host", "trust", "distrust", *held)


def judge_urls(pages: DataFrame, rules: Sequence[Rule] = RULES, threshold: float = THRESHOLD, **spreading) -> DataFrame:
    """Judge every page's url: (page_id, host, path, rule, verdict, trust, distrust), a row per input row.

    A null url, or one without ://, has an empty host and path, fits no rule and is allowed, as are
    hosts without any score. Null html has no links. page_id passes through, null or repeated; other
    columns are ignored; an empty table gives no rows. `rules` become one expression, so they are meant
    to be a list of hundreds at most. Pages of a hot host are counted before they are shuffled.
    """
    host, path = F.col("host"), F.col("path")
    parts = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    ruled = parts.select("page_id", "host", "path", rule_of(host, path, rules, "prefix").alias("rule"), rule_of(host, path, rules, "verdict").alias("ruling"))
    share = lambda v: F.avg((F.coalesce("ruling", F.lit("")) == v).cast("double"))
    seeds = ruled.where("host <> ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust"))
    scores = small(cut(spread_scores(seeds, host_links(pages), **spreading)), 50_000)
    judged = ruled.join(scores, "host", "left")
    blocked = (F.col("held_distrust") >= threshold) & (F.col("held_distrust") > F.col("held_trust"))
    return judged.select("page_id", "host", "path", "rule", F.coalesce("ruling", F.when(blocked, "block").otherwise("allow")).alias("verdict"), F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"))
