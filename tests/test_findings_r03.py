"""Exact education pages (F5), the ego network without a shuffle of the line items (F9), edges fed by in-edges (F10, F11, F13),
short neighbour lists without numbering (F12)."""
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from asklens.operators import graph as G
from asklens.sources import adapters as A
from asklens.sources.tables import Tables


class _Tables:
    def __init__(self, **frames):
        self.__dict__.update(frames)


def _orders(spark, n):
    return spark.range(n).selectExpr("id * 7 AS o_orderkey", "5L AS o_custkey", "'1-URGENT' AS o_orderpriority", "'F' AS o_orderstatus")


def test_education_pages_by_position(spark):
    t = _Tables(orders=_orders(spark, 45))
    sizes = {r["page"]: r["n"] for r in A._educations(t, positions=True).select("page", F.size("educations").alias("n")).collect()}
    assert sizes == {0: 20, 1: 20, 2: 5}


def test_profile_flatten_sql_is_by_position():
    assert "row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey)" in entry.oracle_sql()["profile_flatten"]


@pytest.mark.parametrize("limit", [100_000, 1])
def test_ego_network_line_items_not_shuffled(spark, monkeypatch, limit):
    monkeypatch.setattr(A, "USER_ORDERS", limit)
    monkeypatch.setattr(A, "checkpoint", lambda df: df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = spark.range(90).selectExpr("id div 30 * 7 AS l_orderkey", "cast(id % 7 AS int) AS l_linenumber", "id AS l_suppkey", "id AS l_partkey")
        t = _Tables(orders=_orders(spark, 3), lineitem=lines)
        rows = A.follow_rows(t, ["u5"])
        assert ("BroadcastHashJoin" in rows._jdf.queryExecution().executedPlan().toString()) == (limit > 1)
        kinds = {r["kind"]: r["count"] for r in G.ego_network(A.follow_docs(t, ["u5"]), "u5").groupBy("kind").count().collect()}
        assert kinds == {"user": 90, "question": 6, "topic": 90}  # three orders of two pages
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_short_neighbour_lists_are_not_numbered(spark, monkeypatch):
    g = G.FollowGraph(spark.createDataFrame([("a", "b"), ("a", "c"), ("b", "a")], "src string, dst string"))
    g.medges
    want = sorted(map(str, G.collect_neighbors(g.vertices, g.medges, page_size=2).collect()))

    def fail(*a, **k):
        raise AssertionError("numbered")
    monkeypatch.setattr(G, "rank_within_group", fail)
    assert sorted(map(str, G.collect_neighbors(g.vertices, g.medges, page_size=2).collect())) == want
    with pytest.raises(AssertionError):
        G.collect_neighbors(g.vertices, g.medges, page_size=1)


def test_edges_know_whether_their_source_is_fed(spark):
    edges = spark.createDataFrame([(1, 2, 1), (1, 3, 3), (2, 1, 1), (4, 1, 2)], "srcId bigint, dstId bigint, m bigint")
    got = {(r["src"], r["dst"]): (r["w"], r["fed"]) for r in G.weighted_edges(edges).collect()}
    assert got == {(1, 2): (0.25, True), (1, 3): (0.75, True), (2, 1): (1.0, True), (4, 1): (1.0, False)}


def test_edges_first_give_the_same_graph(spark, sf_small):
    pairs = A.follow_pairs(Tables(spark, sf_small))
    one, two = G.FollowGraph(pairs), G.FollowGraph(pairs)
    two.medges
    one.vertices
    assert one.vertices.exceptAll(two.vertices).isEmpty() and two.vertices.exceptAll(one.vertices).isEmpty()
    assert one.medges.exceptAll(two.medges).isEmpty() and two.medges.exceptAll(one.medges).isEmpty()
