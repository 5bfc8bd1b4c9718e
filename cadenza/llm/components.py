"""Connected components of an edge table, without collecting it anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .skew import looked_up
from .workspace import Workspace


def components(edges: DataFrame, space: Workspace, name: str) -> DataFrame:
    """``node``, ``root`` (the least node that it reaches) of edges ``a``, ``b``.

    Each step replaces a node's root by the least root of its neighbours and then by
    that root's own root (pointer jumping), so that the steps grow with the logarithm
    of the longest chain.  A step's table is written to the shared folder.  Nodes of many
    neighbours and roots of many nodes are looked up by broadcast (see ``skew``).
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a != b").distinct()
    both = space.keep(both, f"{name}-both")
    edge_rows = both.count()
    roots = space.keep(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("root")), f"{name}-0")
    nodes = roots.count()
    step = 0
    while True:
        near = looked_up(both, roots.select(F.col("node").alias("b"), F.col("root").alias("r")), "b", edge_rows).groupBy("a").agg(F.min("r").alias("r"))
        lower = space.keep(roots.join(near, roots["node"] == near["a"]).select("node", F.least("root", "r").alias("root"), F.col("root").alias("was")), f"{name}-lower-{step}")
        jump = roots.select(F.col("node").alias("root"), F.col("root").alias("up"))
        lower = looked_up(lower, jump, "root", nodes)
        step += 1
        new = space.keep(lower.select("node", F.least("root", "up").alias("root"), (F.least("root", "up") != F.col("was")).alias("moved")), f"{name}-{step}")
        for old in (f"{name}-{step - 1}", f"{name}-lower-{step - 1}"):
            space.drop(old)
        roots = new.select("node", "root")
        if not new.filter("moved").limit(1).count():
            space.drop(f"{name}-both")
            return roots
