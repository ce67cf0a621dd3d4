"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.storage import materialize


def _minimum(edges: DataFrame) -> DataFrame:
    # A written table carries no partitioning: the join below plans its own exchanges and
    # the optimizer can split a hub's partition.
    return materialize(edges.groupBy("u").agg(F.min("v").alias("m")), "star")


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """Rows ``node, component`` for every node that has an edge to another node.

    ``component`` is the smallest node id of the component. Nulls and self loops are ignored;
    without edges the result is empty. Links stay distributed: each round is two aggregations
    and two joins over the edge table, written to the shared folder.
    """
    e = edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v")).where("u <> v and u is not null").distinct()
    e = materialize(e, "edges")
    for _ in range(max_rounds):
        if _is_star_forest(e):
            break
        both = e.union(e.select("v", "u"))
        low = _minimum(both).select("u", F.least("u", "m").alias("m"))
        # Each edge gives one row, so no step makes more rows than there are edges.
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = materialize(large, "large-star")
        low = _minimum(large)
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        e = materialize(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "small-star")
    else:
        raise RuntimeError("components did not settle")
    roots = e.select(F.col("v").alias("node")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots.select("node", F.col("node").alias("component")))


def _is_star_forest(e: DataFrame) -> bool:
    """Whether each node has one edge to a smaller node, and that one has none."""
    n, nodes = e.agg(F.count("*"), F.countDistinct("u")).first()
    return n == nodes and not e.join(e.select(F.col("u").alias("inner")), F.col("v") == F.col("inner"), "left_semi").limit(1).count()
