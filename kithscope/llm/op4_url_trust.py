"""URL filter by link-graph propagation, in DataFrame and SQL functions only.

Rules judge urls first: a rule fits its host and all subdomains if the path starts with the rule's, and the longest rule
wins. What no rule fits is judged by host. Links of pages make weighted edges between hosts; personalised PageRank runs from
trusted seeds (hosts most of whose pages a rule allows), and on the reversed edges distrust runs from blocked seeds (hosts most of
whose pages a rule blocks). A host with more distrust than trust is blocked.

Pages are reduced to hosts and edges by map-side combined counts before anything is joined, so a host of a third of all pages is one
row; pages meet their host's row in a plain join that Spark splits where it is skewed. Mass that
reaches a host without links ends there.

Cases: a null url, or one without "://", has an empty host and path, fits no rule and is allowed; null html has no links; relative
links stay on their host and are no edges; repeated pages are judged each; of rules of one length the first by text wins; an empty
table gives an empty table; extra columns are ignored; long pages are searched whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kithscope.llm.frames import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Host of a link with one, scheme or not.
LINK_HOST = r"""(?i)href\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""
#: Rounds between two stored tables of ranks.
STORE_EVERY = 3
Rule = tuple[str, str, str]
"""(verdict, host, path), verdict allow or block."""


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rules_of_hosts(hosts: DataFrame, rules: list[Rule]) -> DataFrame:
    """(host, rules) of the hosts any rule fits; ``rules`` are structs, the longest first."""
    table = hosts.sparkSession.createDataFrame([(v, h, p) for v, h, p in rules], "verdict string, rule_host string, path string")
    labels = F.split("host", r"\.")
    suffix = F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    fitting = hosts.select("host", suffix.alias("rule_host")).join(table, "rule_host")
    rule = F.concat("rule_host", "path")
    return fitting.groupBy("host").agg(F.sort_array(F.collect_list(F.struct((-F.length(rule)).alias("n"), rule.alias("rule"), "path", "verdict"))).alias("rules"))


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, links) between different hosts; ``pages`` has host and html."""
    found = pages.filter("host <> ''").select("host", F.explode(F.regexp_extract_all("html", F.lit(LINK_HOST), 1)).alias("to"))
    found = found.select(F.col("host").alias("src"), F.translate("to", UPPER, LOWER).alias("dst")).filter("src <> dst")
    return found.groupBy("src", "dst").agg(F.count("*").alias("links"))


def propagate(edges: DataFrame, seeds: DataFrame, damping: float, tolerance: float) -> DataFrame:
    """(kind, host, rank) of r = (1 - damping) x seed share + damping x what linking hosts hand on, to within ``tolerance``.

    ``edges`` is (kind, src, dst, share), shares of one source summing to 1; ``seeds`` is (kind, host, share). Ranks only grow from
    round to round. Rounds end when over ``STORE_EVERY`` of them no host was reached and none grew by more than ``tolerance``
    of its own rank, however small that is.
    """
    start = stored(seeds.select("kind", "host", ((1 - damping) * F.col("share")).alias("rank")), "ranks")
    ranks = start
    while True:
        last = ranks
        for _ in range(STORE_EVERY):
            handed = edges.join(ranks.withColumnRenamed("host", "src"), ["kind", "src"])
            handed = handed.select("kind", F.col("dst").alias("host"), (damping * F.col("share") * F.col("rank")).alias("rank"))
            ranks = start.unionByName(handed).groupBy("kind", "host").agg(F.sum("rank").alias("rank"))
        ranks = stored(ranks, "ranks")
        before = last.withColumnRenamed("rank", "before")
        moved = ranks.join(before, ["kind", "host"], "left").filter(
            F.col("before").isNull() | (F.col("rank") - F.col("before") > tolerance * F.col("rank"))
        )
        if moved.isEmpty():
            return ranks


def judge_urls(
    pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", html_col: str = "html", *, damping: float = 0.85, tolerance: float = 1e-9
) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) per page."""
    host, path = host_and_path(F.col(url_col))
    named = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"), F.col(html_col).alias("html"))
    fitting = stored(rules_of_hosts(named.select("host").distinct(), rules), "host-rules")
    first = F.get(F.filter("rules", lambda r: F.startswith(F.col("path"), r.getField("path"))), F.lit(0))
    # Pages are counted by host and path before the rules are looked at.
    paths = named.groupBy("host", "path").agg(F.count("*").alias("n")).join(fitting, "host", "left").withColumn("first", first)
    of = lambda v: F.sum(F.when(F.col("first.verdict") == v, F.col("n")).otherwise(0))
    hosts = stored(paths.groupBy("host").agg(F.sum("n").alias("n"), of("allow").alias("n_allow"), of("block").alias("n_block")), "hosts")
    trusted, blocked = hosts.filter("host <> '' and 2 * n_allow > n"), hosts.filter("host <> '' and 2 * n_block > n")
    n_trusted, n_blocked = max(1, trusted.count()), max(1, blocked.count())
    seeds = trusted.select(F.lit("trust").alias("kind"), "host", F.lit(1 / n_trusted).alias("share")).unionByName(
        blocked.select(F.lit("distrust").alias("kind"), "host", F.lit(1 / n_blocked).alias("share"))
    )
    edges = host_edges(named)
    both = edges.select(F.lit("trust").alias("kind"), "src", "dst", "links").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "links")
    )
    both = stored(both, "edges")
    out = both.groupBy("kind", "src").agg(F.sum("links").alias("all"))
    shares = stored(both.join(out, ["kind", "src"]).select("kind", "src", "dst", (F.col("links") / F.col("all")).alias("share")), "edge-shares")
    ranks = propagate(shares, seeds, damping, tolerance).groupBy("host").agg(
        *(F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("rank"))), F.lit(0.0)).alias(k) for k in ("trust", "distrust"))
    )
    judged = hosts.select("host").join(ranks, "host", "left").join(fitting, "host", "left")
    judged = judged.select("host", "rules", *(F.coalesce(k, F.lit(0.0)).alias(k) for k in ("trust", "distrust")))
    done = named.drop("html").join(judged, "host").withColumn("first", first)
    by_host = F.when(F.col("distrust") > F.col("trust"), F.lit("block")).otherwise(F.lit("allow"))
    return done.select("page_id", "host", "path", F.col("first.rule").alias("rule"), F.coalesce("first.verdict", by_host).alias("verdict"), "trust", "distrust")
