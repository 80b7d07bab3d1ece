"""Random multigraphs (with a hub) against brute-force Python versions of each measure."""

from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from asklens.operators import graph as G

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@st.composite
def multigraphs(draw):
    n = draw(st.integers(3, 9))
    edges = draw(st.lists(st.tuples(st.integers(0, n - 1), st.integers(0, n - 1)), min_size=2, max_size=25))
    hub = draw(st.integers(0, n - 1))
    edges += [(hub, v) for v in range(n)] if draw(st.booleans()) else [(v, hub) for v in range(n)]
    hot = draw(st.booleans())
    return edges, hot


def _graph(spark, edges):
    pairs = spark.createDataFrame([(f"v{a}", f"v{b}") for a, b in edges], "src string, dst string")
    g = G.FollowGraph(pairs)
    names = {r["id"]: r["node"] for r in g.vertices.collect()}
    return g, names


def _kw(hot):
    return {"min_rows": 0, "max_keys": 2} if hot else {}


def _static(edges, rounds=10, reset=0.15):
    nodes = sorted({f"v{x}" for e in edges for x in e})
    out = Counter(f"v{a}" for a, _ in edges)
    r = {n: 1.0 for n in nodes}
    for _ in range(rounds):
        s = defaultdict(float)
        for a, b in edges:
            s[f"v{b}"] += r[f"v{a}"] / out[f"v{a}"]
        r = {n: reset + (1 - reset) * s[n] for n in nodes}
    tot = sum(r.values())
    return {n: v * len(nodes) / tot for n, v in r.items()}


def _delta(edges, tol=1e-4, reset=0.15):
    """GraphX pageRank(tol): rank = delta = reset; senders = last round's receivers with delta > tol."""
    nodes = sorted({f"v{x}" for e in edges for x in e})
    out = Counter(f"v{a}" for a, _ in edges)
    rank = {n: reset for n in nodes}
    delta = dict(rank)
    active = set(nodes)
    while True:
        msg = defaultdict(float)
        for a, b in edges:
            a, b = f"v{a}", f"v{b}"
            if a in active and delta[a] > tol:
                msg[b] += delta[a] / out[a]
        if not msg:
            break
        for v, m in msg.items():
            delta[v] = (1 - reset) * m
            rank[v] += delta[v]
        active = set(msg)
    tot = sum(rank.values())
    return {n: v * len(nodes) / tot for n, v in rank.items()}


@SETTINGS
@given(multigraphs())
def test_pagerank_against_brute_force(spark, case):
    edges, hot = case
    g, names = _graph(spark, edges)
    fixed = {names[r["id"]]: r["rank"] for r in G.pagerank_fixed(g.vertices, g.medges, **_kw(hot)).collect()}
    conv = {names[r["id"]]: r["rank"] for r in G.pagerank_converged(g.vertices, g.medges, cell_edges=1 if hot else None).collect()}
    for n, v in _static(edges).items():
        assert fixed[n] == pytest.approx(v, abs=1e-9)
    for n, v in _delta(edges).items():
        assert conv[n] == pytest.approx(v, abs=1e-9)


@SETTINGS
@given(multigraphs())
def test_two_hop_and_recommend_against_brute_force(spark, case):
    edges, hot = case
    g, names = _graph(spark, edges)
    ranks = {r["id"]: r["rank"] for r in G.pagerank_fixed(g.vertices, g.medges).collect()}
    ranked = G.ranked_vertices(g.vertices, G.pagerank_fixed(g.vertices, g.medges))
    th = G.two_hop_weights(ranked, g.medges, **_kw(hot))
    got = {(names[r["id"]], names[r["sn_id"]]): r["count"] for r in th.collect()}
    want = Counter()
    for a, b in edges:
        for b2, c in edges:
            if b == b2:
                want[(f"v{a}", f"v{c}")] += 1
    assert got == dict(want)
    by_name = {names[i]: v for i, v in ranks.items()}
    best = {}
    for (a, c), cnt in want.items():
        key = (round(by_name[c] * cnt, 9), -int(c[1:]))
        if a not in best or key > best[a][0]:
            best[a] = (key, c)
    rec = {names[r["srcId"]]: names[r["dstId"]] for r in G.follow_recommend(th).collect()}
    # ties go to the smallest id; ids are ranks of names, so compare by weight, then the id order
    id_of = {v: k for k, v in names.items()}
    for a, (key, c) in best.items():
        r = rec[a]
        assert round(by_name[r] * want[(a, r)], 9) == key[0]
        tied = [c2 for (a2, c2), cnt in want.items() if a2 == a and round(by_name[c2] * cnt, 9) == key[0]]
        assert id_of[r] == min(id_of[t] for t in tied)
