r"""URL filtering by rules and by trust propagated over host links.

A rule (host, path) fits a host and its subdomains where the url's path starts
with the rule's; the longest fitting rule decides. Pages that no rule fits get
their host's verdict: trust starts at hosts with allowed pages (as many units
as pages) and follows links, distrust starts at hosts with blocked pages and
follows links backwards, both as personalised PageRank; a host is blocked when
its share distrust / (trust + distrust) exceeds ``threshold``. Unreached hosts
are allowed.

Edges are links between different hosts, counted, from href attributes with a
host, and both ways between a host and its parent domain where both are hosts
of pages. Iterations are DataFrame joins and sums; a written table cuts the
lineage every few of them. They end when no host was newly reached since the
last written table and all mass added since is below ``DAMPING ** ITERATIONS``
of the seeds', for trust and for distrust; no number of steps is fixed, so long
chains take as many as they have links (until a double underflows, after some
thousand). Mass at hosts without links is not handed back to
the seeds, which changes all shares of a vector alike.

Defined cases: a NULL url or one without ``://`` has empty host and path, fits
no rule, is no node and is allowed; NULL html has no link; repeated pages
count as often as they stand; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from histmart.llm.common import prepare, stage

# Rules of the registered query: verdict, host, path.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
DAMPING = 0.85
ITERATIONS = 128  # not a limit: DAMPING ** ITERATIONS is the share of mass at which propagation has converged
STAGE_EVERY = 4
THRESHOLD = 0.75
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"://([^/?#]*)([^?#]*)"
_HREF = r"""(?i)href\s*=\s*["']?(?:[a-z][a-z0-9+.\-]*:)?//([^/?#"'\s>]+)"""


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, NULL if none fits. Rules are parameters, not data."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def host_edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """(src, dst, weight): counted links between hosts, and host <-> parent domain."""
    linked = (pages.filter("host <> ''")
              .select(F.col("host").alias("src"), F.explode(F.regexp_extract_all("html", F.lit(_HREF), F.lit(1))).alias("dst"))
              .withColumn("dst", F.translate("dst", _UPPER, _LOWER)).filter("src <> dst"))
    # the parent is what follows the first dot; a top-level name is no host
    child = hosts.select("host", F.expr("substring(host, instr(host, '.') + 1)").alias("parent")).filter(
        "instr(host, '.') > 0")
    parents = child.join(hosts.select(F.col("host").alias("parent")), "parent").filter("host <> parent")
    both = parents.select(F.col("host").alias("src"), F.col("parent").alias("dst")).unionByName(
        parents.select(F.col("parent").alias("src"), F.col("host").alias("dst")))
    return linked.unionByName(both).groupBy("src", "dst").agg(F.count(F.lit(1)).cast("double").alias("weight"))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, iterations: int = ITERATIONS) -> DataFrame:
    """(host, trust, distrust) from seeds (host, trust, distrust) over edges (src, dst, weight), at convergence."""
    edges = stage(edges, "host-edges")
    out = edges.groupBy("src").agg(F.sum("weight").alias("total"))
    into = edges.groupBy("dst").agg(F.sum("weight").alias("total"))
    forward = edges.join(out, "src").select(
        F.col("src").alias("sender"), F.col("dst").alias("host"), (F.col("weight") / F.col("total")).alias("t"), F.lit(0.0).alias("d"))
    back = edges.join(into, "dst").select(
        F.col("dst").alias("sender"), F.col("src").alias("host"), F.lit(0.0).alias("t"), (F.col("weight") / F.col("total")).alias("d"))
    steps = stage(forward.unionByName(back), "host-steps")
    base = seeds.select("host", (F.col("trust") * (1 - damping)).alias("trust"),
                        (F.col("distrust") * (1 - damping)).alias("distrust"))
    def observed(df: DataFrame, name: str) -> tuple[DataFrame, list[tuple[int, float]]]:
        """The staged scores with the hosts reached and the mass of trust and of distrust."""
        seen = Observation()
        kinds = ("trust", "distrust")
        out = stage(df.observe(seen, *[F.count_if(F.col(k) > 0).alias(f"n_{k}") for k in kinds],
                               *[F.sum(k).alias(f"sum_{k}") for k in kinds]), name)
        return out, [(seen.get[f"n_{k}"] or 0, seen.get[f"sum_{k}"] or 0.0) for k in kinds]

    base, before = observed(base, "host-seeds")
    least = [mass * damping ** iterations for _, mass in before]
    scores = base
    for i in count(1):
        sent = scores.withColumnRenamed("host", "sender").join(steps, "sender").select(
            "host", (F.col("trust") * F.col("t") * damping).alias("trust"),
            (F.col("distrust") * F.col("d") * damping).alias("distrust"))
        scores = base.unionByName(sent).groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust"))
        if i % STAGE_EVERY == 0:
            scores, now = observed(scores, "host-scores")
            # scores only grow, so the summed change is the change of the sum
            if all(n == m and x - y <= few for (n, x), (m, y), few in zip(now, before, least)):
                return scores
            before = now


def judge(pages: DataFrame, url: str = "url", html: str = "html", rules: Sequence[tuple[str, str, str]] = RULES,
          damping: float = DAMPING, iterations: int = ITERATIONS, threshold: float = THRESHOLD) -> DataFrame:
    """Input columns but html, plus host, path, rule, verdict, trust and distrust (same names are replaced)."""
    prepare(pages.sparkSession)
    added = ("host", "path", "rule", "verdict", "trust", "distrust")
    keep = [c for c in pages.columns if c not in added + (html,)]
    u = F.col(f"`{url}`")
    # columns go through by their position, so any name may stand in the input
    parsed = pages.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)], F.col(f"`{html}`").alias("html"),
                          host_of(u).alias("host"), path_of(u).alias("path"))
    ruled = parsed.withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    hosts = stage(ruled.filter("host <> ''").groupBy("host").agg(
        F.count_if(F.col("fit.verdict") == "allow").cast("double").alias("trust"),
        F.count_if(F.col("fit.verdict") == "block").cast("double").alias("distrust")), "hosts")
    scores = propagate(hosts, host_edges(parsed.select("host", "html"), hosts), damping, iterations)
    share = F.try_divide(F.col("distrust"), F.col("trust") + F.col("distrust"))  # NULL: no mass reached the host
    bad = scores.select("host", "trust", "distrust", F.when(
        F.round(share, 9) > threshold, "block").otherwise("allow").alias("host_verdict"))
    return (ruled.drop("html").join(bad, "host", "left")
            .select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], "host", "path", F.col("fit.rule").alias("rule"),
                    F.coalesce("fit.verdict", "host_verdict", F.lit("allow")).alias("verdict"),
                    F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust")))


def op4_query(pages: DataFrame) -> DataFrame:
    return judge(pages).select("page_id", "host", "path", "rule", "verdict")
