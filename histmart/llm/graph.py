"""Connected components of an edge table by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from histmart.llm.common import scratch, stage


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the least id reachable from each end of an edge (a, b).

    Each round takes the least label among the neighbours (pre-aggregated, so
    a hot node sends one row per task), then the label's own label, which
    halves the way left; rounds grow with the logarithm of the longest path.
    Every round is a written table, the last one kept; only a count reaches the
    driver. Joins are by sort-merge, so that no round leaves a broadcast in the
    executors' memory.
    """
    with scratch(edges.sparkSession):
        both = stage(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "graph-edges")
        labels = stage(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select(
            "id", F.least("id", "m").alias("component")), "graph-labels")
        while True:
            near = both.join(labels.select(F.col("id").alias("b"), F.col("component").alias("m")).hint("merge"), "b").groupBy(
                F.col("a").alias("id")).agg(F.min("m").alias("m"))
            lower = labels.join(near.hint("merge"), "id").select("id", F.col("component").alias("old"), F.least("component", "m").alias("label"))
            jump = labels.select(F.col("id").alias("label"), F.col("component").alias("far"))
            seen = Observation()
            labels = stage(lower.join(jump.hint("merge"), "label").select(
                "id", "old", F.least("label", "far").alias("component")).observe(
                seen, F.count_if(F.col("old") != F.col("component")).alias("changed")).select("id", "component"), "graph-labels", keep=True)
            if not seen.get["changed"]:
                return labels


def starred(met: DataFrame) -> DataFrame:
    """Edges (a, b) with the components of ``met`` (id, pivot), each id meeting a few pivots.

    An id keeps one edge, to its least pivot, and its other pivots are joined to that one; the same
    pivots meet often, so what is left is near a forest.
    """
    first = met.groupBy("id").agg(F.min("pivot").alias("a"), F.collect_set("pivot").alias("pivots"))
    ends = F.explode(F.array_union(F.array("id"), "pivots")).alias("b")
    return first.select("a", ends).filter("a <> b").distinct()
