"""URL filter: rules, and for other urls trust and distrust spread over host links."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.merkle import lower_ascii
from tallyhouse.llm.shared import written
from tallyhouse.operators.joins import join_grouped

ALLOW, BLOCK = "allow", "block"
DAMPING = 0.85  # share of a host's score that goes on over its links
# Rounds end when no host gets more than this in one, at the latest after ROUNDS, when
# 0.85 ** 60, less than a ten-thousandth of the seeds' score, is still on its way.
TOLERANCE = 1e-3
ROUNDS = 60
THRESHOLD = 0.5  # a host is blocked if its distrust is more than this above its trust

# Hosts that the links of a page name. Every part is possessive or stops at the next tag, so that
# the work is in proportion to the page.
LINK = r"""(?i)<a\s[^<>]*?\bhref\s*+=\s*+["']?+\s*+(?:https?:)?//([^/?#"'\s<>]++)"""


@dataclass(frozen=True)
class Rule:
    """A verdict on a host, its subdomains, and paths that begin with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self) -> Column:
        host, path = F.col("host"), F.col("path")
        of_host = (host == self.host) | host.endswith("." + self.host)
        return of_host & path.startswith(self.path)


RULES = (
    Rule("com", "/", ALLOW),
    Rule("example.com", "/en/", BLOCK),
    Rule("www.example.com", "/en/", ALLOW),
    Rule("net", "/es/", BLOCK),
    Rule("net", "/fr/", BLOCK),
)


def with_rule(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``pages`` with host, path, rule and ruled (its verdict); the longest fitting rule wins.

    A null url, or one without ``://``, has an empty host and path, which no rule fits.
    """
    url = F.col("url").cast("string")
    part = lambda pattern: F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))
    split = pages.withColumn("path", part("://[^/?#]*([^?#]*)")).withColumn("host", part("://([^/?#]*)"))
    split = split.withColumn("host", lower_ascii("host"))
    rule, ruled = F.lit(None).cast("string"), F.lit(None).cast("string")
    for one in sorted(rules, key=lambda r: len(r.text)):
        rule = F.when(one.fits(), one.text).otherwise(rule)
        ruled = F.when(one.fits(), one.verdict).otherwise(ruled)
    return split.withColumn("rule", rule).withColumn("ruled", ruled)


def seeds(ruled: DataFrame) -> DataFrame:
    """(host, kind, score): the share of a host's pages that rules allow, and block."""
    shares = (
        ruled.where("host <> ''")
        .groupBy("host")
        .agg(
            F.count("*").alias("pages"),
            F.count_if(F.col("ruled") == ALLOW).alias(ALLOW),
            F.count_if(F.col("ruled") == BLOCK).alias(BLOCK),
        )
    )
    each = F.explode(F.array(*(F.struct(F.lit(kind).alias("kind"), F.col(kind).alias("of")) for kind in (ALLOW, BLOCK))))
    return (
        shares.select("host", "pages", each.alias("x"))
        .where("x.of > 0")
        .select("host", "x.kind", (F.col("x.of") / F.col("pages")).alias("score"))
    )


def host_links(pages: DataFrame) -> DataFrame:
    """(host, target, pages): the number of a host's pages that link to another host.

    Only links that name a host count; comments hold none. A page counts once for a target.
    """
    html = F.regexp_replace(F.col("html").cast("string"), "(?s)<!--.*?(?:-->|$)", " ")
    named = F.transform(F.regexp_extract_all(html, F.lit(LINK), F.lit(1)), lambda x: lower_ascii(x))
    return (
        with_rule(pages.select("url", "html"), ())
        .where("host <> ''")
        .select("host", F.explode(F.array_distinct(named)).alias("target"))
        .where("host <> target")
        .groupBy("host", "target")
        .agg(F.count("*").alias("pages"))
    )


def flows(links: DataFrame) -> DataFrame:
    """(kind, host, to, share): trust goes along links, distrust back along them, each in
    parts that add up to one for a host."""
    ways = []
    for kind, source, to in ((ALLOW, "host", "target"), (BLOCK, "target", "host")):
        way = links.select(F.col(source).alias("host"), F.col(to).alias("to"), "pages")
        sums = way.groupBy("host").agg(F.sum("pages").alias("all"))
        ways.append(
            join_grouped(way, sums, "host").select(
                F.lit(kind).alias("kind"), "host", "to", (F.col("pages") / F.col("all")).alias("share")
            )
        )
    return ways[0].union(ways[1])


def spread(start: DataFrame, ways: DataFrame) -> DataFrame:
    """(host, kind, score): personalised PageRank of both kinds, from their seeds.

    A host's score is its seed plus DAMPING times what comes over its links, so a host
    without links keeps its seed. Each round sends on only what arrived in the last one;
    the score is the sum of all rounds. Rounds are written, so a lost executor costs one.
    """
    arrived = [written(start, "seeds")]
    ways = written(ways, "flows")
    for _ in range(ROUNDS):
        sent = arrived[-1].withColumn("at", F.concat("kind", F.lit(" "), "host")).select("at", "score")
        going = ways.withColumn("at", F.concat("kind", F.lit(" "), "host")).select("at", "kind", "to", "share")
        step = (
            join_grouped(going, sent, "at")
            .groupBy(F.col("to").alias("host"), "kind")
            .agg((F.sum(F.col("share") * F.col("score")) * DAMPING).alias("score"))
        )
        arrived.append(written(step, "round"))
        if (arrived[-1].agg(F.max("score")).first()[0] or 0.0) <= TOLERANCE:
            break
    every = arrived[0]
    for step in arrived[1:]:
        every = every.unionByName(step)
    return every.groupBy("host", "kind").agg(F.sum("score").alias("score"))


def host_scores(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(host, trust, distrust) of hosts that have any."""
    start = seeds(with_rule(pages.select("url"), rules))
    found = spread(start, flows(written(host_links(pages), "links")))
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0))
    return found.groupBy("host").agg(of(ALLOW).alias("trust"), of(BLOCK).alias("distrust"))


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Verdicts on ``pages`` (page_id, url, html): the rule's, else the host's.

    Returns page_id, host, path, rule, verdict, and the host's trust and distrust. Hosts
    without either (nor an empty host) are allowed. A null html has no links; repeated rows are
    judged each and count as a page each; a null page_id stays null; other columns are not
    read; an empty table gives no rows.
    """
    given = pages.select("page_id", "url", "html")
    hosts = written(host_scores(given, rules), "hosts")
    ruled = with_rule(given.select("page_id", "url"), rules)
    zero = lambda name: F.coalesce(name, F.lit(0.0))
    judged = join_grouped(ruled, hosts, "host", "left").withColumns(
        {"trust": zero("trust"), "distrust": zero("distrust")}
    )
    own = F.when(F.col("distrust") - F.col("trust") > THRESHOLD, BLOCK).otherwise(ALLOW)
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "trust", "distrust"
    )
