"""Induced subgraphs by broadcast nodes and by a key filter: the same edges, filtered below the shuffle."""

import random

import pytest

from asklens.operators import graph as G


def _graph(spark, seed):
    rnd = random.Random(seed)
    # vertex 1 holds a third of all edges; some edges stand twice
    rows = [(1 if rnd.random() < 0.33 else rnd.randrange(60), rnd.randrange(60)) for _ in range(600)]
    nodes = rnd.sample(range(70), 30) + [1]
    edges = spark.createDataFrame([(a, b, "following") for a, b in rows], "srcId long, dstId long, relation string")
    return rows, nodes, edges, spark.createDataFrame([(n, "x") for n in nodes] + [(None, "y")], "id long, kind string")


@pytest.mark.parametrize("settings", [{}, {"broadcast_rows": 0, "filter_bits": 1 << 12}, {"broadcast_rows": 5, "filter_bits": 64}])
def test_both_ways_equal_brute_force(spark, settings):
    for seed in range(2):
        rows, nodes, edges, node_table = _graph(spark, seed)
        got = sorted(tuple(r) for r in G.induced_edges(edges, node_table, **settings).collect())
        assert got == sorted((a, b) for a, b in rows if a in nodes and b in nodes)
    empty = spark.createDataFrame([], "id long")
    assert G.induced_edges(edges, empty, **settings).count() == 0


def test_filter_stands_below_the_shuffle(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        edges = spark.range(2000).selectExpr("id AS srcId", "id * 7 % 2000 AS dstId")
        out = G.induced_edges(edges, spark.range(0, 2000, 100), broadcast_rows=3, filter_bits=1 << 14)
        plan = out._jdf.queryExecution().executedPlan().toString()
        # one pass of the filter over both ends, between the edges' scan and their first shuffle
        below = plan.split("Exchange hashpartitioning(srcId", 1)[1].split("Range", 1)[0]
        assert below.count("ArrowEvalPython") == 1 and "Exchange" not in below
        assert out.count() == sum(1 for s in range(0, 2000, 100) if s * 7 % 2000 % 100 == 0)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_million_nodes(spark):
    edges = spark.range(3_000_000).selectExpr("id AS srcId", "id * 31 % 3000000 AS dstId")
    nodes = spark.range(0, 3_000_000, 3)
    n = G.induced_edges(edges, nodes, broadcast_rows=100_000, filter_bits=1 << 23).count()
    assert n == 1_000_000  # 31 and the number of vertices keep multiples of 3
