"""Distributed connected components by alternating large-star and small-star steps.

Every step is a ``groupBy`` minimum (pre-aggregated in each task) joined back on the node; edges
stay in Spark and lineage is cut by ``checkpoint()``.  The minima are checkpointed too: both sides of
the join are then shuffled for it alone, so Spark can split a node with very many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step on edges ``u, v``: links each node's larger (or smaller) neighbours to the least
    node among them and itself."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = both.where("v < u")
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("n"), F.least("u", "m").alias("m")).checkpoint(eager=True)
    if large:
        moved = both.where("v > u").join(least, F.col("u") == F.col("n")).select(
            F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = both.join(least, F.col("u") == F.col("n")).select(
            F.col("v").alias("u"), F.col("m").alias("v"))
        moved = moved.unionAll(least.select(F.col("n").alias("u"), F.col("m").alias("v")))
    return moved.where("u <> v").select(F.greatest("u", "v").alias("u"),
                                        F.least("u", "v").alias("v")).distinct()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``node, component`` for every node of an edge; the component is its least node.

    Edges with a NULL end are ignored; a self-edge makes a component of one node.  Works for any
    node type that has an order.
    """
    ensure_checkpoint_dir(edges.sparkSession)
    a, b = F.col(src), F.col(dst)
    known = edges.where(a.isNotNull() & b.isNotNull()).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    known = known.distinct().checkpoint(eager=True)
    alone = known.where("u = v").select("u")
    links = known.where("u <> v")
    state = None
    while True:
        for large in (True, False):
            links = _star(links, large).checkpoint(eager=True)
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == state:
            break
        state = now
    roots = links.select(F.col("v").alias("node")).distinct().withColumn("component", F.col("node"))
    found = links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
    rest = alone.join(found, alone["u"] == found["node"], "left_anti")
    return found.unionAll(rest.select(F.col("u").alias("node"), F.col("u").alias("component")))
