import numpy as np
import pytest
from pyspark.sql import functions as F

from asklens.operators import inner_product as IP
from asklens.operators import recommend as M
from asklens.plans.queries import _ratings
from asklens.sources.tables import Tables

SCHEMA = "id bigint, features array<float>"


def table(spark, ids, factors):
    return spark.createDataFrame([(int(i), [float(x) for x in f]) for i, f in zip(ids, factors)], SCHEMA)


def brute(user_ids, users, item_ids, items, k):
    """All scores, exactly: the factors are small integers, so 32-bit products do not round."""
    out = set()
    for u, x in zip(user_ids, users):
        order = sorted((-float(x @ q), int(i)) for i, q in zip(item_ids, items))[:k]
        out |= {(int(u), i, -s, p + 1) for p, (s, i) in enumerate(order)}
    return out


def got(found):
    return {(r["user"], r["item"], r["rating"], r["position"]) for r in found.best.collect()}


@pytest.mark.parametrize("k,block,group", [(1, 5, 7), (3, 5, 1000), (10, 16, 7), (10, 1000, 1000), (50, 8, 13)])
def test_same_as_all_pairs_with_ties(spark, k, block, group):
    rng = np.random.default_rng(k + block)
    scale = rng.integers(1, 12, size=(40, 1))
    items = rng.integers(-3, 4, size=(40, 5)) * scale
    items[7] = items[8] = items[9]          # equal items: the smaller ids win
    items[20] = 0
    users = np.vstack([rng.integers(-4, 5, size=(30, 5)), np.zeros((1, 5), int)])
    item_ids, user_ids = rng.permutation(1000)[:40], rng.permutation(500)[:31] + 10**12
    found = IP.top_items(table(spark, user_ids, users), table(spark, item_ids, items), k, block_items=block, group_users=group)
    assert got(found) == brute(user_ids, users, item_ids, items, k)
    rounds = found.rounds.orderBy("round").collect()
    assert sum(r["pairs"] for r in rounds) <= 31 * 40 and rounds[0]["users"] == 31


def test_norms_that_differ_save_most_pairs(spark):
    """A few items of large norm, as popular items have: users are done after the first blocks."""
    rng = np.random.default_rng(2)
    items = np.abs(rng.integers(1, 5, size=(2000, 6))) * np.maximum(1, 4000 // np.arange(1, 2001))[:, None]
    users = rng.integers(1, 6, size=(200, 6))
    found = IP.top_items(table(spark, range(200), users), table(spark, range(2000), items), 5, block_items=50)
    assert got(found) == brute(range(200), users, range(2000), items, 5)
    assert found.rounds.agg(F.sum("pairs")).first()[0] < 0.2 * 200 * 2000


def test_few_or_no_items_and_users(spark):
    users, items = table(spark, [1, 2], [[1, 0], [0, 1]]), table(spark, [5], [[2, 3]])
    assert got(IP.top_items(users, items, 10)) == {(1, 5, 2.0, 1), (2, 5, 3.0, 1)}
    nobody, nothing = table(spark, [], []), table(spark, [], [])
    assert IP.top_items(users, nothing, 10).best.count() == 0
    assert IP.top_items(nobody, items, 10).best.count() == 0


@pytest.fixture(scope="module")
def fitted(spark, sf_small):
    split = M.hash_split(_ratings(Tables(spark, sf_small)))
    train, test = (split.where(f"part = '{p}'").drop("part") for p in ("train", "test"))
    return M.fit_als(train, seed=5, max_iter=6), train, test


def test_same_as_the_models_own_recommendations(fitted):
    rec, _, _ = fitted
    want = {r["_u"]: [(x["_q"], x["rating"]) for x in r["recommendations"]] for r in rec.model.recommendForAllUsers(10).collect()}
    mine = {}
    for r in M.pruned_search(rec, 10, block_items=10).best.orderBy("position").collect():
        mine.setdefault(r["user"], []).append((r["item"], r["rating"]))
    assert mine.keys() == want.keys()
    for u, rows in mine.items():
        assert [q for q, _ in rows] == [q for q, _ in want[u]]
        assert [x for _, x in rows] == pytest.approx([x for _, x in want[u]], abs=1e-5)


def test_factors_solve_their_systems(spark, fitted):
    """Against numpy's solver for every user, and a moved factor is noticed."""
    rec, train, _ = fitted
    residuals = {r["UId"]: r for r in M.normal_residuals(rec, train).collect()}
    items = {r["id"]: np.array(r["features"], dtype=float) for r in rec.model.itemFactors.collect()}
    users = {r["id"]: np.array(r["features"], dtype=float) for r in rec.model.userFactors.collect()}
    rated = {}
    for r in rec._with_index(train).collect():
        rated.setdefault((r["UId"], r["_u"]), []).append((items[r["_q"]], r["rate"]))
    assert residuals.keys() == {u for u, _ in rated}
    for (uid, u), rows in rated.items():
        q, rate = np.array([a for a, _ in rows]), np.array([b for _, b in rows])
        x = np.linalg.solve(q.T @ q + M.ALS_REG * len(rows) * np.eye(q.shape[1]), q.T @ rate)
        assert users[u] == pytest.approx(x, abs=1e-4)
        assert residuals[uid]["residual"] < 1e-5 and residuals[uid]["n_ratings"] == len(rows)
    assert min(r["residual"] for r in M.normal_residuals(rec, train, reg=M.ALS_REG * 1.2).collect()) > 1e-5
    moved = train.withColumn("rate", F.col("rate") + F.when(F.col("UId") == min(residuals), 0.5).otherwise(0.0))
    assert {r["UId"] for r in M.normal_residuals(rec, moved).collect() if r["residual"] > 1e-5} == {min(residuals)}


def test_predictions_recomputed(fitted):
    rec, _, test = fitted
    key = lambda r: (r["UId"], r["QId"])
    own = {key(r): r["prediction"] for r in M.dot_predictions(rec, test).collect()}
    model = {key(r): r["prediction"] for r in M.predict(rec, test).collect()}
    assert own.keys() == model.keys() and all(own[k] == pytest.approx(model[k], abs=1e-4) for k in own)
