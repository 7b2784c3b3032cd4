"""Connected components by alternating stars, in joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citymart.session import stage


def _mark(edges: DataFrame) -> tuple:
    """Number and order-free checksum of a set of edges."""
    row = edges.agg(
        F.count("*"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")),
    ).first()
    return tuple(row)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``component`` (smallest node reachable) for every node that has an edge.

    ``edges`` holds pairs of one type that can be ordered, in either direction; repeats, loops and
    pairs with a NULL are ignored. No edges give no rows.

    Each round links every larger neighbour of a node to the node's smallest neighbour, then every
    smaller one likewise; the set shrinks towards stars whose centre is the component's smallest
    node, in a number of rounds logarithmic in the nodes. The minima combine before the shuffle and
    the join's other side has one row per node, so a hot centre is split as a skewed join. Every
    round is a table in the shared folder: lineage stays short and lost executors cost one round.
    """
    edges = edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    edges = stage(edges.filter("a < b").distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        both = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("low"))
        low = low.select("n", F.least("n", "low").alias("low"))
        # the larger neighbours of n go to its smallest one
        large = edges.join(low, F.col("a") == F.col("n")).select(F.col("low").alias("a"), "b").distinct()
        low = large.groupBy(F.col("b").alias("n")).agg(F.min("a").alias("low"))
        # the smaller neighbours of n, and n, go to its smallest one
        small = large.join(low, F.col("b") == F.col("n"))
        small = small.select(
            F.explode(
                F.array(
                    F.struct(F.col("low").alias("a"), F.col("b").alias("b")),
                    F.struct(F.col("low").alias("a"), F.col("a").alias("b")),
                )
            ).alias("e")
        ).select("e.a", "e.b")
        edges = stage(small.filter("a < b").distinct(), "edges")
        before, mark = mark, _mark(edges)
        if before == mark:
            break
    stars = edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
    centres = edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return stars.unionAll(centres)
