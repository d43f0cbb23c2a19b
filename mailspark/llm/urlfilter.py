"""URL filter: rules for hosts and paths, and for all other urls trust and distrust that spread along links of hosts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from mailspark.llm.common import stage

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Links to other hosts: an address with a scheme, or one that begins with two slashes.
LINK = r"""(?:href|src|HREF|SRC)\s*=\s*["']?\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


@dataclass(frozen=True)
class Rule:
    """Fits a host and its subdomains where the path of the url starts with ``path``."""

    verdict: str
    host: str
    path: str

    def __str__(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Settings:
    """Of the spreading. Scores are in units of a host all of whose pages are ruled: 1 is what it gives itself."""

    damping: float = 0.85
    rounds: int = 8
    threshold: float = 0.5


def host(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty if there is none."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(found, _UPPER, _LOWER)


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty if there is no ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    name = verdict = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(str(r)), str(r))):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        name, verdict = F.when(fits, str(rule)).otherwise(name), F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def edges(pages: DataFrame, html: str) -> DataFrame:
    """``a``, ``b``, ``n``: how many links the pages of host a hold to host b; none of a host to itself."""
    links = pages.select(F.col("host").alias("a"), F.explode(F.regexp_extract_all(html, F.lit(LINK), F.lit(1))).alias("b"))
    links = links.select("a", F.translate(F.regexp_replace("b", r"^.*@|:\d*$", ""), _UPPER, _LOWER).alias("b"))
    return links.where("a <> '' and b <> '' and a <> b").groupBy("a", "b").agg(F.count("*").alias("n"))


def spread(seeds: DataFrame, links: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``host``, ``trust``, ``distrust`` of every host that any reaches.

    ``seeds``: ``host``, ``allowed``, ``blocked``, the shares of its pages that rules allow and block. Both are
    personalised PageRanks, in ``rounds`` steps: trust follows links from allowed seeds, distrust follows them
    backwards from blocked ones. A step is a join of the ranks with the links and a sum per host; links were summed per
    pair of hosts before. Ranks are written after every fourth step.
    """
    s = settings
    kind = F.explode(F.array(F.struct(F.lit("t").alias("kind"), F.col("allowed").alias("s")),
                             F.struct(F.lit("d").alias("kind"), F.col("blocked").alias("s")))).alias("x")
    start = stage(seeds.select("host", kind).where("x.s > 0").select("x.kind", "host", (F.col("x.s") * (1 - s.damping)).alias("s")), "seeds")
    ways = links.select(F.lit("t").alias("kind"), "a", "b", "n").union(links.select(F.lit("d").alias("kind"), F.col("b"), F.col("a"), "n"))
    ways = ways.toDF("kind", "host", "to", "n")
    total = ways.groupBy("kind", "host").agg(F.sum("n").alias("all"))
    ways = ways.join(total, ["kind", "host"]).select("kind", "host", "to", (F.col("n") / F.col("all") * s.damping).alias("w"))
    ways = stage(ways, "ways")
    ranks = start
    for step in range(s.rounds):
        moved = ranks.join(ways, ["kind", "host"]).select("kind", F.col("to").alias("host"), (F.col("s") * F.col("w")).alias("s"))
        ranks = start.union(moved).groupBy("kind", "host").agg(F.sum("s").alias("s"))
        if step % 4 == 3:
            ranks = stage(ranks, "ranks")
    share = lambda k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("s"))) / (1 - s.damping), F.lit(0.0))
    return ranks.groupBy("host").agg(share("t").alias("trust"), share("d").alias("distrust"))


def judge(
    pages: DataFrame, rules: Sequence[Rule], settings: Settings = Settings(), key: str = "page_id", url: str = "url",
    html: str = "html",
) -> DataFrame:
    """``key``, ``host``, ``path``, ``rule``, ``verdict`` of every row.

    The longest rule that fits decides. Any other url is blocked if its host's distrust reaches the threshold and is
    more than its trust, else allowed; a url without host is allowed. Null or empty html has no links, rows that repeat
    count each.
    """
    rows = pages.select(F.col(key).alias(key), F.col(url).alias("__url"), F.col(html).alias("__html"))
    rows = rows.withColumns({"host": host(F.col("__url")), "path": path(F.col("__url"))})
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "verdict": verdict})
    share = lambda v: F.avg((F.coalesce("verdict", F.lit("")) == v).cast("double"))
    seeds = rows.where("host <> ''").groupBy("host").agg(share("allow").alias("allowed"), share("block").alias("blocked"))
    scores = spread(seeds, edges(rows, "__html"), settings)
    bad = scores.where((F.col("distrust") >= settings.threshold) & (F.col("distrust") > F.col("trust")))
    out = rows.join(bad.select(F.col("host").alias("__bad")), F.col("host") == F.col("__bad"), "left")
    verdict = F.coalesce("verdict", F.when(F.col("__bad").isNotNull(), "block").otherwise("allow"))
    return out.select(key, "host", "path", "rule", verdict.alias("verdict"))
