"""URL verdicts: rules by host and path, and trust and distrust spread over links.

Hosts with pages under an allow rule are trusted seeds, hosts with pages under a block rule
distrusted ones, each by its share of such pages. Trust is a personalised PageRank along
host links; distrust is the same against them, from a blocked host to those that link to
it. Both are spread until what is still on its way cannot change a verdict. A page without a
rule takes the verdict of its host.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii, stored

DAMPING = 0.85
WRITTEN_EVERY = 5
LEAST = 1e-12  # of score: less than this on its way is none
THRESHOLD = 0.5  # of what a wholly blocked host without links has
LINK = r"""(?i)(?:href|src|action)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = [
    Rule("net", "/", "block"),
    Rule("example.net", "/en/", "allow"),
    Rule("example.com", "/de/", "block"),
    Rule("org", "/fr/", "allow"),
]


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty without ://."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as (rule, verdict), or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


def host_links(pages: DataFrame) -> DataFrame:
    """(src, dst, links) between different hosts, counted before they are shuffled."""
    linked = F.transform(F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(LINK), F.lit(1)), lower_ascii)
    return (
        pages.select(host_of(F.col("url")).alias("src"), F.explode(linked).alias("dst"))
        .where("src <> '' and src <> dst")
        .groupBy("src", "dst")
        .agg(F.count("*").alias("links"))
    )


def spread(hosts: DataFrame, trusting: DataFrame, distrusting: DataFrame, threshold: float) -> DataFrame:
    """host, trust, distrust: personalised PageRank from (host, allowed, blocked) along two lists of edges.

    ``part`` of an edge (src, dst, part) is the share of src's score that goes to dst. Scores of
    hosts without links are their seeds times 1 - DAMPING; what a host without outgoing links
    holds is not passed on. A round passes on what the round before has added. As all scores
    only grow, and all of them together by DAMPING / (1 - DAMPING) of the last addition at most,
    rounds end when that bound takes no host over ``threshold``, or is below LEAST. Every
    ``WRITTEN_EVERY`` rounds the scores are written, and the driver sees one row of sums.
    """
    state = hosts.select(
        "host",
        *(((1 - DAMPING) * F.col(seed)).alias(name) for seed, name in (("allowed", "trust"), ("blocked", "distrust"))),
    )
    reached = [
        edges.select(F.col("dst").alias("host"), F.lit(True).alias(name)).distinct()
        for edges, name in ((trusting, "may_trust"), (distrusting, "may_distrust"))
    ]
    state = state.join(reached[0], "host", "left").join(reached[1], "host", "left")
    state = state.withColumns({"new_trust": F.col("trust"), "new_distrust": F.col("distrust")})

    def passed(state: DataFrame, edges: DataFrame, name: str) -> DataFrame:
        sent = state.where(F.col(name) > 0).select(F.col("host").alias("src"), F.col(name).alias("score"))
        got = F.sum(F.col("score") * F.col("part")) * F.lit(DAMPING)
        return edges.join(sent, "src").groupBy(F.col("dst").alias("host")).agg(got.alias("got_" + name))

    excess = F.col("distrust") - F.col("trust")
    while True:
        state = stored(state, "url-score")
        seen = state.agg(
            F.sum("new_trust").alias("trust"),
            F.sum("new_distrust").alias("distrust"),
            F.min(F.when(F.col("may_distrust") & (excess <= threshold), threshold - excess)).alias("below"),
            F.min(F.when(F.col("may_trust") & (excess > threshold), excess - threshold)).alias("above"),
        ).first()
        trust, distrust = ((x or 0.0) * DAMPING / (1 - DAMPING) for x in (seen.trust, seen.distrust))
        stays = seen.below is None or distrust <= max(seen.below, LEAST)
        if stays and (seen.above is None or trust < max(seen.above, LEAST)):
            return state.select("host", "trust", "distrust")
        for _ in range(WRITTEN_EVERY):
            both = state.join(passed(state, trusting, "new_trust"), "host", "left").join(
                passed(state, distrusting, "new_distrust"), "host", "left"
            )
            more = {n: F.coalesce("got_" + n, F.lit(0.0)) for n in ("new_trust", "new_distrust")}
            state = both.select(
                "host",
                (F.col("trust") + more["new_trust"]).alias("trust"),
                (F.col("distrust") + more["new_distrust"]).alias("distrust"),
                "may_trust",
                "may_distrust",
                *(c.alias(n) for n, c in more.items()),
            )


def host_scores(judged: DataFrame, links: DataFrame, threshold: float) -> DataFrame:
    """host, trust, distrust of every host that has a page or is linked, see ``spread``."""
    seen = judged.where("host <> ''").groupBy("host").agg(
        F.avg(F.when(F.col("found.verdict") == "allow", 1.0).otherwise(0.0)).alias("allowed"),
        F.avg(F.when(F.col("found.verdict") == "block", 1.0).otherwise(0.0)).alias("blocked"),
    )
    linked = links.select(F.col("dst").alias("host")).distinct()
    hosts = seen.join(linked, "host", "full").select(
        "host", *(F.coalesce(c, F.lit(0.0)).alias(c) for c in ("allowed", "blocked"))
    )
    hosts = stored(hosts, "url-hosts")

    def parts(source: str, target: str) -> DataFrame:
        out = links.groupBy(F.col(source).alias("src")).agg(F.sum("links").alias("all"))
        moved = links.select(F.col(source).alias("src"), F.col(target).alias("dst"), "links")
        return stored(
            moved.join(out, "src").select("src", "dst", (F.col("links") / F.col("all")).alias("part")), "url-edges"
        )

    return spread(hosts, parts("src", "dst"), parts("dst", "src"), threshold)


def url_verdicts(pages: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    A host without a rule is blocked if its distrust exceeds its trust by more than
    ``THRESHOLD`` times what a wholly blocked host without links has, else allowed; so is a
    page without host allowed. Null or odd urls have empty host and path, null html has no
    links, and repeated rows are judged each for itself and count each. Only addresses with
    a host are links between hosts. Other columns are not looked at.
    """
    rules = RULES if rules is None else rules
    split = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    judged = split.withColumn("found", rule_of(F.col("host"), F.col("path"), rules))
    links = stored(host_links(pages), "url-links")
    limit = THRESHOLD * (1 - DAMPING)
    scores = host_scores(judged, links, limit)
    excess = F.col("distrust") - F.col("trust") > limit
    verdicts = scores.select("host", F.when(excess, "block").otherwise("allow").alias("of_host"))
    # Pages under a rule need no score of their host; the others meet one row per host.
    open_pages = judged.where("found is null").join(verdicts, "host", "left")
    ruled = judged.where("found is not null").withColumn("of_host", F.lit(None).cast("string"))
    return open_pages.unionByName(ruled).select(
        "page_id",
        "host",
        "path",
        F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", "of_host", F.lit("allow")).alias("verdict"),
    )
