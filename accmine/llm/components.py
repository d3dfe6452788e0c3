"""Connected components of a large edge table by repeated contraction.

Each round every node hooks to its smallest neighbour (if smaller than itself), the hooks are followed
to their ends by pointer doubling, and the edges are rewritten between the ends; finished when none is
left. Every step is a join or an aggregate between staged tables, so a node with very many edges is
pre-aggregated before the shuffle or split by the skew handling of the join; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node that has an edge to another node: nodes of one component share a root,
    which is one of them. Repeated edges and loops do no harm; an empty table gives an empty result."""
    e = staged(edges.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v"))
               .distinct(), "cc-edges")
    nodes = staged(e.select(F.col("u").alias("node")).unionByName(e.select(F.col("v").alias("node"))).distinct()
                   .withColumn("root", F.col("node")), "cc-nodes")
    while not e.isEmpty():
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        hook = staged(both.groupBy("u").agg(F.min("v").alias("p")).select("u", F.least("u", "p").alias("p")), "cc-hook")
        while True:
            up = hook.select(F.col("u").alias("p"), F.col("p").alias("pp"))
            step = staged(hook.join(up, "p").select("u", F.col("pp").alias("p"), (F.col("pp") != F.col("p")).alias("moved")),
                          "cc-jump")
            hook = step.select("u", "p")
            if step.where("moved").isEmpty():
                break
        nodes = staged(nodes.join(hook.withColumnRenamed("u", "root"), "root", "left")
                       .select("node", F.coalesce("p", "root").alias("root")), "cc-nodes")
        left = e.join(hook, "u").select(F.col("p").alias("pu"), "v")
        right = left.join(hook.select(F.col("u").alias("v"), F.col("p").alias("pv")), "v")
        e = staged(right.where(F.col("pu") != F.col("pv"))
                   .select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct(), "cc-edges")
    return nodes
