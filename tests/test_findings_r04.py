"""Finding F1 of the fourth round: disk of the two-hop step."""
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from asklens.operators import graph as G
from asklens.operators import two_hop_cells as C
from asklens.session import checkpoint


def test_rows_of_a_chunk_lie_by_candidate():
    """equal candidates, ranks and weights side by side, so that files of the rows are small."""
    second = [(b, c, 1) for b in range(20) for c in range(100, 140) if (b * c) % 3]
    cell = C._Cell(pa.table({"b": [x[0] for x in second], "c": [x[1] for x in second], "m": [x[2] for x in second],
                             "rank": [float(x[1]) for x in second]}), C.CHUNK_ROWS)
    first = [(a, b, 1) for a in range(500) for b in range(a % 3, 20, 3)]
    out = list(cell.add(pa.RecordBatch.from_pydict({k: pa.array([x[j] for x in first]) for j, k in enumerate("abm")}))) + list(cell.flush(True))
    rows = [tuple(r.values()) for batch in out for r in batch.to_pylist()]
    want = {}
    for a, b, _ in first:
        for b2, c, _ in second:
            if b == b2:
                want[a, c] = want.get((a, c), 0) + 1
    assert len(rows) == len(want) and {r[:2]: r[3] for r in rows} == want
    assert sum(x[1] != y[1] for x, y in zip(rows, rows[1:])) == 26  # each of the 27 candidates in one run


@pytest.mark.parametrize("big", [0, 1 << 55])
def test_order_by_candidate_of_any_size(big):
    user, code, counts = np.array([0, 0, 1, 2]), np.array([1, 3, 1, 0]), np.array([2, 5, 1, 7 + big])
    got = C._by_candidate(user, code, counts)
    assert list(zip(*(x.tolist() for x in got))) == [(2, 0, 7 + big), (1, 1, 1), (0, 1, 2), (0, 3, 5)]


def test_files_of_finished_shuffles_are_deleted(spark):
    """the two-hop step starts without the files of the steps before it."""
    def held():
        ids = spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses().keySet().mkString(",")
        return {int(x) for x in ids.split(",") if x}

    before = max(held(), default=-1)
    edges = checkpoint(spark.range(2000).selectExpr("id % 50 srcId", "id % 37 dstId").groupBy("srcId", "dstId").agg(F.count("*").alias("m")))
    ranked = spark.range(50).selectExpr("id", "cast(id as string) node", "id * 1.0D rank")
    made = {x for x in held() if x > before}
    assert made
    th = G.two_hop_weights(ranked, edges, shuffled_paths=0)
    for _ in range(100):
        if not made & held():
            break
        time.sleep(0.1)
    assert not made & held()
    assert th.count() == 50 * 37
