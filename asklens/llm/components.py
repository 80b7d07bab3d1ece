"""Connected components of a link table, as Spark joins and aggregates (FastSV).

Every round hooks trees onto smaller neighbours and halves the paths, so the rounds
grow with the logarithm of the longest chain.  A label that a large component shares may
be a third of all rows; the joins on labels go through ``join_groups``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asklens.llm.common import join_groups, written


def components(links: DataFrame) -> DataFrame:
    """``links(a, b)`` of longs -> (node, root) for every node with a link; root is the smallest node reachable."""
    both = links.where("a <> b").select("a", "b")
    edges = written(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    # first labels: the smallest neighbour, if smaller
    state = written(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
                    .select("node", F.least("node", "least").alias("parent")), "labels")
    while True:
        up = _with_grandparent(state)
        seen = edges.join(up.select(F.col("node").alias("b"), F.col("grand").alias("other")), "b")
        near = seen.groupBy("a").agg(F.min("other").alias("near"))
        low = written(up.join(near.withColumnRenamed("a", "node"), "node"), "round")
        offers = (low.select("node", F.least("parent", "grand", "near").alias("label"))
                  .unionByName(low.select(F.col("parent").alias("node"), F.col("near").alias("label"))))
        new = offers.groupBy("node").agg(F.min("label").alias("parent"))
        changed = new.join(state.select("node", F.col("parent").alias("before")), "node")
        state = written(changed, "labels")
        if state.where("parent <> before").isEmpty():
            return state.select("node", F.col("parent").alias("root"))
        state = state.select("node", "parent")


def _with_grandparent(state: DataFrame) -> DataFrame:
    """(node, parent, grand): the parent's parent.  Only parents with children are asked for, once each."""
    sizes = state.groupBy("parent").agg(F.count(F.lit(1)).alias("children"))
    grands = written(sizes.join(state.select(F.col("node").alias("parent"), F.col("parent").alias("grand")), "parent"),
                     "grandparents")
    return join_groups(state, grands, ["parent"], "children").select("node", "parent", "grand")
