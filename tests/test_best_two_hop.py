import random

import pytest
from pyspark.sql import functions as F

from asklens.operators import graph as G
from asklens.operators.best_two_hop import best_two_hop


def frames(spark, edges, ranks):
    merged = {}
    for e in edges:
        merged[e] = merged.get(e, 0) + 1
    return (spark.createDataFrame([(i, str(i), float(r)) for i, r in ranks.items()], "id bigint, node string, rank double"),
            spark.createDataFrame([(a, b, m) for (a, b), m in merged.items()], "srcId bigint, dstId bigint, m bigint"))


def both(spark, edges, ranks, **options):
    ranked, merged = frames(spark, edges, ranks)
    found = best_two_hop(ranked, merged, **options)
    want = sorted(map(tuple, G.follow_recommend(G.two_hop_weights(ranked, merged)).collect()))
    assert sorted(map(tuple, found.edges.collect())) == want
    total = G.two_hop_weights(ranked, merged).agg(F.sum("count")).first()[0] or 0
    assert found.total_paths == total
    paths = found.rounds.agg(F.sum("paths")).first()[0] or 0
    assert paths <= total
    return paths, total


@pytest.mark.parametrize("seed", range(4))
def test_same_as_all_paths(spark, seed):
    rng = random.Random(seed)
    n = rng.choice([6, 15, 40])
    edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(n * 4)]  # parallel follows, self follows, dead ends
    ranks = {i: rng.choice([0.15, 1.0, 1.0, rng.random() * 5]) for i in range(n)}  # many ties
    both(spark, edges, ranks)
    both(spark, edges, ranks, shares=(0.5,), min_rows=9)


def test_popular_vertices_end_the_search(spark):
    """A few vertices of high rank and many follows, as in a social graph: the long tail is hardly expanded."""
    rng = random.Random(9)
    n, stars = 400, 12
    edges = [(a, rng.randrange(stars)) for a in range(n) for _ in range(6)]
    edges += [(a, stars + int((n - stars) * rng.random() ** 2)) for a in range(n) for _ in range(5)]
    edges += [(s, stars + rng.randrange(n - stars)) for s in range(stars) for _ in range(40)]
    ranks = {i: 60.0 / (i + 1) if i < stars else 0.15 + rng.random() * 0.1 for i in range(n)}
    paths, total = both(spark, edges, ranks)
    assert paths < 0.5 * total


def test_no_paths_and_no_edges(spark):
    assert both(spark, [(1, 2), (3, 2)], {1: 1.0, 2: 2.0, 3: 1.0}) == (0, 0)
    assert both(spark, [], {1: 1.0}) == (0, 0)
