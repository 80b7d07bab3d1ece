"""Follow graph: FIXTURES PageRank/degrees/two-hop/recommendation and properties."""

import pytest
from pyspark.sql import functions as F

from asklens.operators import graph as G
from asklens.operators.edge_grid import EdgeGrid
from asklens.sources import adapters as A
from asklens.sources.tables import Tables

# FIXTURES.md: edges 1->2 (twice), 1->3, 2->3, 3->1, 4->3, 3->5.
EDGES = [(1, 2), (1, 2), (1, 3), (2, 3), (3, 1), (4, 3), (3, 5)]
# GraphX pageRank(1e-4) on that graph (FIXTURES.md).
CONVERGED = {"1": 1.039830127358778, "2": 0.9159030218760035, "3": 1.6775766887785437,
             "4": 0.326860034627897, "5": 1.039830127358778}


@pytest.fixture(scope="module")
def fixture_graph(spark):
    pairs = spark.createDataFrame([(str(a), str(b)) for a, b in EDGES], "src string, dst string")
    return G.FollowGraph(pairs)


def _by_node(g, df, col):
    names = {r["id"]: r["node"] for r in g.vertices.collect()}
    return {names[r["id"]]: r[col] for r in df.collect()}


def _ranked(g, ranks):
    return G.ranked_vertices(g.vertices, ranks)


@pytest.mark.parametrize("hot", [False, True])
def test_pagerank_converged_matches_graphx(fixture_graph, hot):
    g = fixture_graph
    got = _by_node(g, G.pagerank_converged(g.vertices, g.medges, tol=1e-4, cell_edges=1 if hot else None), "rank")
    assert got.keys() == CONVERGED.keys()
    for k, v in CONVERGED.items():
        assert got[k] == pytest.approx(v, abs=1e-12)
    assert sum(got.values()) == pytest.approx(5.0, abs=1e-9)


def _static_pagerank(edges, rounds=10, reset=0.15):
    nodes = sorted({x for e in edges for x in e})
    out = {n: 0 for n in nodes}
    for s, _ in edges:
        out[s] += 1
    r = {n: 1.0 for n in nodes}
    for _ in range(rounds):
        s = {n: 0.0 for n in nodes}
        for a, b in edges:
            s[b] += r[a] / out[a]
        r = {n: reset + (1 - reset) * s[n] for n in nodes}
    tot = sum(r.values())
    return {str(n): v * len(nodes) / tot for n, v in r.items()}


@pytest.mark.parametrize("hot", [False, True])
def test_pagerank_fixed_brute_force(fixture_graph, hot):
    g = fixture_graph
    kw = {"min_rows": 0, "max_keys": 2} if hot else {}
    got = _by_node(g, G.pagerank_fixed(g.vertices, g.medges, rounds=10, checkpoint_every=3, **kw), "rank")
    want = _static_pagerank(EDGES)
    for k, v in want.items():
        assert got[k] == pytest.approx(v, abs=1e-12)


def test_degrees(fixture_graph):
    g = fixture_graph
    assert _by_node(g, G.in_degree(g.medges), "in_degree") == {"1": 1, "2": 2, "3": 3, "5": 1}
    assert _by_node(g, G.out_degree(g.medges), "out_degree") == {"1": 3, "2": 1, "3": 2, "4": 1}
    ranks = G.pagerank_converged(g.vertices, g.medges)
    both = _by_node(g, G.rank_degrees(_ranked(g, ranks), g.medges), "in_degree")
    assert sorted(both) == ["1", "2", "3"]  # inner joins drop 4 and 5


@pytest.mark.parametrize("hot", [False, True])
def test_two_hop_and_recommendation(fixture_graph, hot):
    g = fixture_graph
    names = {r["id"]: r["node"] for r in g.vertices.collect()}
    ranked = _ranked(g, G.pagerank_converged(g.vertices, g.medges))
    kw = {"min_rows": 0, "max_keys": 2} if hot else {}
    th = G.two_hop_weights(ranked, g.medges, **kw)
    counts = {(names[r["id"]], names[r["sn_id"]]): r["count"] for r in th.collect()}
    assert counts == {("1", "3"): 2, ("1", "1"): 1, ("1", "5"): 1, ("2", "1"): 1, ("2", "5"): 1,
                      ("3", "2"): 2, ("3", "3"): 1, ("4", "1"): 1, ("4", "5"): 1}
    rec = {names[r["srcId"]]: names[r["dstId"]] for r in G.follow_recommend(th).collect()}
    assert rec == {"1": "3", "2": "1", "3": "2", "4": "1"}


def test_argmax_not_first(spark):
    th = spark.createDataFrame([(1, 10, 1.0, 1, 1.0), (1, 11, 5.0, 1, 5.0), (1, 12, 5.0, 1, 5.0)],
                               "id long, sn_id long, sn_rank double, count long, weight double")
    assert G.follow_recommend(th).first()["dstId"] == 11


def test_reversed_direction(spark):
    docs = spark.createDataFrame([("a", [("b", "B")]), ("c", [("b", "B"), ("a", "A")])],
                                 "urlToken string, following array<struct<urlToken:string,name:string>>")
    fwd = sorted(tuple(r) for r in G.follow_pairs(docs).collect())
    rev = sorted(tuple(r) for r in G.follow_pairs(docs, "reversed").collect())
    assert fwd == [("a", "b"), ("c", "a"), ("c", "b")]
    assert rev == [("a", "c"), ("b", "a"), ("b", "c")]


def test_dense_index_is_sorted_and_dense(spark):
    keys = spark.range(0, 500).select(F.format_string("k%05d", (F.col("id") * 7919) % 500).alias("node"))
    ids = G.dense_index(keys.repartition(7), "node").collect()
    got = sorted((r["id"], r["node"]) for r in ids)
    assert [i for i, _ in got] == list(range(500))
    assert [n for _, n in got] == sorted(n for _, n in got)


def test_docs_explode_equals_flat_pairs(spark, sf_small):
    t = Tables(spark, sf_small)
    a = G.follow_pairs(A.follow_docs(t)).groupBy("src", "dst").count()
    b = A.follow_pairs(t).groupBy("src", "dst").count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_graph_properties(spark, sf_small):
    g = G.FollowGraph(A.follow_pairs(Tables(spark, sf_small)))
    n_edges = A.follow_pairs(Tables(spark, sf_small)).count()
    assert G.in_degree(g.medges).agg(F.sum("in_degree")).first()[0] == n_edges
    assert G.out_degree(g.medges).agg(F.sum("out_degree")).first()[0] == n_edges
    ranks = G.pagerank_fixed(g.vertices, g.medges)
    n, total = ranks.agg(F.count("*"), F.sum("rank")).first()
    assert total == pytest.approx(n, rel=1e-9)
    ranked = _ranked(g, ranks)
    rec = G.follow_recommend(G.two_hop_weights(ranked, g.medges))
    e1 = g.medges.select(F.col("srcId").alias("a"), F.col("dstId").alias("b"))
    e2 = g.medges.select(F.col("srcId").alias("b"), F.col("dstId").alias("c"))
    reach = e1.join(e2, "b").select(F.col("a").alias("srcId"), F.col("c").alias("dstId")).distinct()
    assert rec.select("srcId", "dstId").exceptAll(reach).count() == 0


def test_node_sizes(spark):
    df = spark.createDataFrame([(250.0,), (10.0,), (100.0,), (60.0,)], "rank double")
    row = df.select(G.core_size(F.col("rank")).alias("c"), G.neighbour_size(F.col("rank")).alias("n")).collect()
    assert row[0]["c"] == 20
    assert [r["n"] for r in row[1:]] == [3, 12, 12]


def test_collect_neighbors_pages(fixture_graph):
    g = fixture_graph
    names = {r["id"]: r["node"] for r in g.vertices.collect()}
    nb = G.collect_neighbors(g.vertices, g.medges, page_size=1)
    rows = nb.collect()
    got = {}
    for r in rows:
        got.setdefault(names[r["id"]], []).extend((names[x["id"]], x["m"]) for x in r["neighbors"])
    assert sorted(got["1"]) == [("2", 2), ("3", 1)]
    assert got["5"] == [] and got["4"] == [("3", 1)]
    assert max(len(r["neighbors"]) for r in rows) <= 1  # exact pages of page_size


def test_recommend_in_batches_equals_single_pass(spark, sf_small):
    from asklens.session import scratch_path
    g = G.FollowGraph(A.follow_pairs(Tables(spark, sf_small)))
    ranked = _ranked(g, G.pagerank_fixed(g.vertices, g.medges))
    one = G.follow_recommend(G.two_hop_weights(ranked, g.medges))
    path = scratch_path(spark, "rec-batches")
    many = G.recommend_in_batches(ranked, g.medges, path, 3)
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0
    again = G.recommend_in_batches(ranked, g.medges, path, 3)  # all batches committed: nothing recomputed
    assert again.count() == one.count()
    for other, batches in ((g.medges.limit(10), 3), (g.medges, 4)):  # another graph, another number of batches
        with pytest.raises(ValueError):
            G.recommend_in_batches(ranked, other, path, batches)


def test_pagerank_round_cap_is_an_error(spark, sf_small):
    g = G.FollowGraph(A.follow_pairs(Tables(spark, sf_small)))
    with pytest.raises(RuntimeError):
        G.pagerank_converged(g.vertices, g.medges, max_rounds=2)


def test_rank_within_group_spans_partitions(spark):
    rows = [(0, i) for i in range(300)] + [(1, i) for i in range(0, 40, 2)] + [(2, 7)]
    df = spark.createDataFrame(rows, "g long, o long").repartition(5)
    got = G.rank_within_group(df, "g", "o", "r").collect()
    want = {(g, o): i for g in (0, 1, 2) for i, o in enumerate(sorted(o for gg, o in rows if gg == g))}
    assert {(r["g"], r["o"]): r["r"] for r in got} == want


def test_follow_documents_are_pages_of_twenty(spark):
    from asklens.session import scratch_path
    d = scratch_path(spark, "tables")
    spark.createDataFrame([(1, 7, "F", "1-URGENT"), (2, 8, "O", "2-HIGH")],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string") \
        .write.parquet(f"{d}/orders.parquet")
    lines = [(1, i % 9, 100 + i, 1000 + i) for i in range(45)] + [(2, 1, 5, 6)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_suppkey long, l_partkey long") \
        .write.parquet(f"{d}/lineitem.parquet")
    docs = A.follow_docs(Tables(spark, d)).collect()
    sizes = sorted(len(r["following"]) for r in docs)
    assert sizes == [1, 5, 20, 20]
    flat = [f["urlToken"] for r in sorted(docs, key=lambda r: r["_id"]) for f in r["following"]]
    want = [f"u{s}" for _, _, s, _ in sorted(lines, key=lambda x: (x[0], x[1], x[2], x[3]))]
    assert flat == want


def test_empty_graph(spark):
    g = G.FollowGraph(spark.createDataFrame([], "src string, dst string"))
    assert g.vertices.count() == 0 and g.medges.count() == 0
    assert G.pagerank_fixed(g.vertices, g.medges).count() == 0
    assert G.pagerank_converged(g.vertices, g.medges).count() == 0
    ranked = _ranked(g, G.pagerank_fixed(g.vertices, g.medges))
    assert G.follow_recommend(G.two_hop_weights(ranked, g.medges)).count() == 0


def test_chain_by_hand(spark):
    g = G.FollowGraph(spark.createDataFrame([("a", "b"), ("b", "c")], "src string, dst string"))
    # a keeps 0.15; b = 0.15 + 0.85 * 0.15; c = 0.15 + 0.85 * b; then scaled to sum 3
    raw = {"a": 0.15, "b": 0.2775, "c": 0.385875}
    want = {k: v * 3 / sum(raw.values()) for k, v in raw.items()}
    for ranks in (G.pagerank_fixed(g.vertices, g.medges), G.pagerank_converged(g.vertices, g.medges)):
        got = _by_node(g, ranks, "rank")
        for k, v in want.items():
            assert got[k] == pytest.approx(v, abs=1e-12)


def test_hub_is_split_at_its_own_size(spark):
    """A middle vertex with 300 x 200 paths, cells of 400: the same paths as unsplit."""
    edges = spark.createDataFrame([(i, 0, 1) for i in range(1, 301)] + [(0, 1000 + i, 2) for i in range(200)],
                                  "srcId bigint, dstId bigint, m bigint")
    ranked = spark.range(0, 1300).selectExpr("id", "cast(id as string) node", "id * 1.0D rank")
    split = G.two_hop_weights(ranked, edges, min_rows=400)
    assert split.count() == 60_000 and split.exceptAll(G.two_hop_weights(ranked, edges)).count() == 0
    summary = {r["id"]: r for r in G.two_hop_summary(split).collect()}
    assert summary[5]["candidates"] == 200 and summary[5]["paths"] == 400 and summary[5]["best"] == 1199


def test_large_weights_tie(spark):
    th = spark.createDataFrame([(1, 20, 123456789.0), (1, 30, 123456789.00000001), (2, 20, 1e-7), (2, 30, 2e-7)],
                               "id bigint, sn_id bigint, weight double")
    assert {r["srcId"]: r["dstId"] for r in G.follow_recommend(th).collect()} == {1: 20, 2: 30}


def test_parallel_follows_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(G, "EDGE_CHUNK", 3)
    g = G.FollowGraph(spark.createDataFrame([("a", "b")] * 8 + [("b", "a")] * 3 + [("c", "a")], "src string, dst string"))
    names = {r["id"]: r["node"] for r in g.vertices.collect()}
    got = {}
    for r in g.edges().collect():
        k = names[r["srcId"]] + names[r["dstId"]]
        got[k] = got.get(k, 0) + 1
    assert got == {"ab": 8, "ba": 3, "ca": 1}
    assert {names[r["id"]]: r["in_degree"] for r in g.in_degrees().collect()} == {"a": 4, "b": 8}
    assert {names[r["id"]]: r["out_degree"] for r in g.out_degrees().collect()} == {"a": 8, "b": 3, "c": 1}


def test_grid_spreads_a_hub_and_bounds_its_mirrors(spark):
    # vertex 0 has a third of all edges; all vertices have in-edges
    rows = [(0, v, 1.0 / 300) for v in range(1, 301)] + [(v, (v * 7 + k) % 301, 0.5) for v in range(1, 301) for k in range(2)]
    wedges = spark.createDataFrame(rows, "src long, dst long, w double")
    grid = EdgeGrid(wedges, cell_edges=30)
    cells = grid.cells.where("w IS NOT NULL").groupBy("id", "column").count().collect()
    hub = [r["count"] for r in cells if r["id"] == 0]
    assert len(hub) == 10 and sum(hub) == 300 and max(hub) < 90
    assert {r["column"] for r in cells if r["id"] != 0} == {0}
    received = wedges.groupBy(F.col("dst").alias("id")).agg(F.sum("w").alias("delta"))
    state = grid.start(received)
    assert state.count() == 301 + 9
    # every column of the hub holds the same value after a round, equal to a plain sum
    after = grid.step(state, 0.0, 0.85).where("id = 0").collect()
    first = {r["id"]: r["delta"] for r in received.collect()}
    want = 0.85 * sum(first[a] * w for a, b, w in rows if b == 0)
    assert len(after) == 10 and all(r["delta"] == pytest.approx(want, rel=1e-12) for r in after)
    assert all(r["total"] == pytest.approx(first[0] + want, rel=1e-12) for r in after)
    grid.release()


def test_rounds_join_the_grid_without_moving_it(spark):
    wedges = spark.range(1, 200).selectExpr("id AS src", "id * 3 % 200 AS dst", "1.0D AS w")
    grid = EdgeGrid(wedges)
    state = grid.start(wedges.groupBy(F.col("dst").alias("id")).agg(F.sum("w").alias("delta")))
    plan = grid.step(grid.step(state, 0.0, 0.85), 0.0, 0.85)._jdf.queryExecution().executedPlan().toString()
    for below in plan.split("InMemoryTableScan")[1:]:
        assert "Exchange" not in below.split("InMemoryRelation", 1)[0]
    assert plan.count("InMemoryTableScan") == 2  # each round reads the cells once, and the last state once
    grid.release()
