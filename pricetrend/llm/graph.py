"""Connected components of an edge table by alternating large and small stars.

Every step is a ``min`` aggregate (combined before the shuffle) and an
equi-join, so a node with very many neighbours is never gathered in one task.
Each step is written to the shared checkpoint folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pricetrend.llm.common import cut_lineage


def _hung_on_least(neighbours: DataFrame, keep) -> DataFrame:
    """For each node the least of itself and its neighbours; the neighbours that
    ``keep`` selects, and the node itself, become children of that least one."""
    least = cut_lineage(neighbours.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "stars")
    out = neighbours.join(least, "u")
    children = out.where(keep).select(F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select("u", F.col("m").alias("v"))
    return children.unionByName(own).where("u <> v").distinct()


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``edges`` (u, v) -> (u, v) with v the least node reachable from u, for each
    node other than the least of its component. No edges give no rows.

    Raises if ``max_rounds`` rounds (each several times shortens every path)
    don't suffice; it never returns unfinished components.
    """
    edges = cut_lineage(edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    print_of = lambda d: d.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum((F.xxhash64("v", "u") % 1000003).cast("long"))).first()
    before = print_of(edges)
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = cut_lineage(_hung_on_least(both, F.col("v") > F.col("u")).where("v < u"), "large")
        # Large stars leave u > v; small stars look at the smaller neighbours only.
        edges = cut_lineage(_hung_on_least(large, F.col("v") < F.col("u")).where("v < u"), "small")
        now = print_of(edges)
        if tuple(now) == tuple(before):
            return edges
        before = now
    raise RuntimeError(f"components not settled after {max_rounds} rounds")
