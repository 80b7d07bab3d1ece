"""Cross-check of the DataFrame PageRank with GraphX itself (through the JVM
gateway; GraphX has no Python API) on the follow graph of sf0.001."""

import pytest
from pyspark.sql import functions as F

from asklens.operators import graph as G
from asklens.session import scratch_path
from asklens.sources import adapters as A
from asklens.sources.tables import Tables


def _graphx_ranks(spark, edge_file, tol):
    jvm = spark.sparkContext._jvm
    sc = spark.sparkContext._jsc.sc()
    level = jvm.org.apache.spark.storage.StorageLevel.MEMORY_ONLY()
    graph = jvm.org.apache.spark.graphx.GraphLoader.edgeListFile(sc, edge_file, False, -1, level, level)
    tag = getattr(jvm.scala.reflect, "ClassTag$").__getattr__("MODULE$")
    ranked = jvm.org.apache.spark.graphx.lib.PageRank.runUntilConvergence(
        graph, float(tol), 0.15, tag.Int(), tag.Int())
    pairs = ranked.vertices().toJavaRDD().collect()
    return {int(p._1()): float(p._2()) for p in pairs}


def test_converged_pagerank_equals_graphx(spark, sf_small):
    try:
        spark.sparkContext._jvm.org.apache.spark.graphx.GraphLoader
    except Exception:  # noqa: BLE001
        pytest.skip("GraphX not on the classpath")
    g = G.FollowGraph(A.follow_pairs(Tables(spark, sf_small)))
    edge_file = scratch_path(spark, "edge-list")
    (g.medges.select(F.explode(F.array_repeat(F.concat_ws(" ", "srcId", "dstId"), F.col("m").cast("int"))))
     .write.text(edge_file))
    want = _graphx_ranks(spark, edge_file, 1e-4)
    got = {r["id"]: r["rank"] for r in G.pagerank_converged(g.vertices, g.medges, tol=1e-4).collect()}
    assert got.keys() == want.keys()
    worst = max(abs(got[k] - want[k]) for k in want)
    assert worst < 1e-9, worst
