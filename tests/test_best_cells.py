"""The search by tiers inside the cells (findings F2 and F3 of the fourth round)."""
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from asklens.operators import best_two_hop as B
from asklens.operators import graph as G
from asklens.operators.best_cells import TierCell


def _graph(spark, seed, n=60):
    rng = random.Random(seed)
    merged = {(rng.randrange(n), int(n * rng.random() ** 2)): rng.choice([1, 1, 3]) for _ in range(n * 8)}
    ranked = spark.createDataFrame([(i, str(i), rng.choice([0.15, 1.0, rng.random() * 5])) for i in range(n)], "id bigint, node string, rank double")
    return ranked, spark.createDataFrame([(a, b, m) for (a, b), m in merged.items()], "srcId bigint, dstId bigint, m bigint")


@pytest.mark.parametrize("options", [{}, {"block_edges": 70}, {"block_edges": 90, "min_rows": 14}])
def test_tiers_in_one_pass(spark, options, monkeypatch):
    """without hubs no tier is a pass of its own; the same edges, however the cells are cut."""
    ranked, merged = _graph(spark, 5)
    want = sorted(map(tuple, G.follow_recommend(G.two_hop_weights(ranked, merged)).collect()))
    total = G.two_hop_weights(ranked, merged).agg(F.sum("count")).first()[0]
    if "min_rows" not in options:
        monkeypatch.setattr(B, "two_hop_weights", lambda *a, **k: pytest.fail("a pass for one tier"))
    found = B.best_two_hop(ranked, merged, **options)
    assert sorted(map(tuple, found.edges.collect())) == want
    rounds = [tuple(r) for r in found.rounds.orderBy("tier").collect()]
    assert found.total_paths == total and sum(r[2] for r in rounds) < total
    assert rounds[0][1] == len(want) and all(x[1] >= y[1] for x, y in zip(rounds, rounds[1:]))


@pytest.mark.parametrize("chunk", [1, 7, 100, 100_000])
def test_cell_of_tiers_in_chunks_of_any_size(chunk):
    rng = random.Random(chunk)
    rank = {c: rng.choice([0.15, 2.0, rng.random()]) for c in range(40)}
    second = [(b, c, rng.choice([1, 1, 2])) for b in range(12) for c in rng.sample(range(40), 3 * b)]
    first = sorted((a, b, rng.choice([1, 2, 1 << 30])) for a in range(30) for b in rng.sample(range(14), 1 + a % 9))
    cell = TierCell(pa.table({"b": [x[0] for x in second], "c": [x[1] for x in second], "m": [x[2] for x in second],
                              "rank": [rank[x[1]] for x in second], "tier": pa.array([x[1] * 3 // 40 for x in second], pa.int32())}), 3, chunk)
    out = []
    for i in range(0, len(first), 11):
        some = first[i:i + 11]
        out += list(cell.add(pa.RecordBatch.from_pydict({k: pa.array([x[j] for x in some]) for j, k in enumerate("abm")})))
    got = {r["id"]: r for batch in out + list(cell.flush(True)) for r in batch.to_pylist()}
    weight, total = {}, {}
    for a, b, m in first:
        for b2, c, m2 in second:
            if b == b2:
                weight.setdefault(a, {})[c] = weight.get(a, {}).get(c, 0) + m * m2
                total[a] = total.get(a, 0) + m * m2
    assert set(got) == set(weight)
    for a, counts in weight.items():
        steady = {c: rank[c] * n * 8193.0 - (rank[c] * n * 8193.0 - rank[c] * n) for c, n in counts.items()}
        assert -got[a]["minus_id"] == min(steady, key=lambda c: (-steady[c], c)) and got[a]["w"] == max(steady.values())
        assert got[a]["p0"] + got[a]["p1"] + got[a]["p2"] <= total[a]


def test_paths_query_in_one_pass(spark, tmp_path, monkeypatch):
    """all paths counted, fewer expanded, without a pass for each tier."""
    from asklens.plans.queries import REGISTRY

    rng = random.Random(3)
    orders = [(o, o % 30, "1-URGENT") for o in range(240)]
    lines = [(o, n, int(20 * rng.random() ** 2), n) for o in range(240) for n in range(3)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey bigint, l_linenumber int, l_suppkey bigint, l_partkey bigint").write.parquet(
        f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(B, "two_hop_weights", lambda *a, **k: pytest.fail("a pass for one tier"))
    follows = [(o % 30, s) for o, _, s, _ in lines]
    out = {a: sum(x == a for x, _ in follows) for a in range(30)}
    assert tuple(REGISTRY["follow_recommend_paths"](spark, str(tmp_path)).first()) == (sum(out[b] for _, b in follows), True)
