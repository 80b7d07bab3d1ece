"""Two-hop counts made in cells of users and candidates: the same rows as by the shuffle of all paths."""
import random

import numpy as np
import pytest

from asklens.operators import graph as G
from asklens.operators import two_hop_cells as C


def _frames(spark, rng, n, edges):
    merged = {}
    for e in edges:
        merged[e] = merged.get(e, 0) + rng.choice([1, 1, 3])
    ranked = spark.createDataFrame([(i, str(i), rng.choice([0.15, 1.0, rng.random()])) for i in range(n)], "id bigint, node string, rank double")
    return ranked, spark.createDataFrame([(a, b, m) for (a, b), m in merged.items()], "srcId bigint, dstId bigint, m bigint")


@pytest.mark.parametrize("options", [{}, {"block_edges": 37}, {"block_edges": 50, "min_rows": 12}])
def test_same_rows_as_by_shuffle(spark, options):
    rng = random.Random(4)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(500)] + [(7, i) for i in range(60)] + [(i, 9) for i in range(60)]
    ranked, merged = _frames(spark, rng, 60, edges)
    want = G.two_hop_weights(ranked, merged)
    got = G.two_hop_weights(ranked, merged, shuffled_paths=0, **options)
    assert got.schema == want.schema
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    assert sorted(map(tuple, G.follow_recommend(got).collect())) == sorted(map(tuple, G.follow_recommend(want).collect()))


def test_paths_are_not_shuffled(spark):
    """40 users x 40 middle vertices x 40 candidates: 64,000 paths, of which no exchange may carry any."""
    edges = spark.range(40 * 40).selectExpr("id div 40 srcId", "1000 + id % 40 dstId", "1L m").union(
        spark.range(40 * 40).selectExpr("1000 + id div 40 srcId", "id % 40 dstId", "1L m"))
    ranked = spark.range(2000).selectExpr("id", "cast(id as string) node", "id * 1.0D rank")
    th = G.two_hop_weights(ranked, edges, shuffled_paths=0)
    plan = th._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in plan and "Join" not in plan
    assert {r["count"] for r in th.collect()} == {40}


@pytest.mark.parametrize("chunk", [1, 5, 64, 10_000])
def test_chunks_of_any_size(chunk):
    """A user with more paths than a chunk, a first hop with more, users that end with a batch."""
    import pyarrow as pa
    rng = random.Random(chunk)
    second = [(b, c, rng.choice([1, 2])) for b in range(10) for c in range(b * 3)]
    first = sorted((a, rng.randrange(12), rng.choice([1, 2, 1 << 40])) for a in (1, 1, 2, 5, 5, 5, 9) for _ in range(8))
    cell = C._Cell(pa.table({"b": [x[0] for x in second], "c": [x[1] for x in second], "m": [x[2] for x in second],
                             "rank": [float(x[1]) for x in second]}), chunk)
    out = []
    for i in range(0, len(first), 7):
        some = first[i:i + 7]
        out += list(cell.add(pa.RecordBatch.from_pydict({k: pa.array([x[j] for x in some]) for j, k in enumerate("abm")})))
    out += list(cell.flush(True))
    want = {}
    for a, b, m in first:
        for b2, c, m2 in second:
            if b == b2:
                want[a, c, float(c)] = want.get((a, c, float(c)), 0) + m * m2
    rows = [tuple(r.values()) for batch in out for r in batch.to_pylist()]
    assert len(rows) == len(want) and {r[:3]: r[3] for r in rows} == want


def test_best_of_unordered_batches(spark):
    rng = np.random.default_rng(2)
    rows = [(int(rng.integers(50)), i, float(rng.choice([1.0, 2.0, 2.5])), 2) for i in range(3000)]
    th = spark.createDataFrame(rows, "id bigint, sn_id bigint, weight double, count bigint").repartition(3)
    got = {r["id"]: tuple(r)[1:] for r in G.two_hop_summary(th).collect()}
    for u in range(50):
        mine = [r for r in rows if r[0] == u]
        assert got[u] == (len(mine), 2 * len(mine), sum(r[2] for r in mine), min((-r[2], r[1]) for r in mine)[1])
