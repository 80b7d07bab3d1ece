"""Ratings, upsert, lookup, top-k and ALS (FIXTURES: action weights, upsert, integers)."""

import math

import pytest
from pyspark.sql import functions as F

from asklens.functions.text import tolerant_int
from asklens.operators import ratings as R
from asklens.operators import recommend as M
from asklens.plans.queries import _ratings
from asklens.sources.tables import Tables


def test_distinct_action_weights(spark):
    acts = spark.createDataFrame([
        ("u", "1", "answer_approve"), ("u", "1", "answer_approve"),
        ("u", "1", "answer_collect"), ("u", "2", "answer_publish"), ("u", "2", "answer_comment"),
        (None, "3", "answer_approve"),
    ], "userUrlToken string, questionId string, actType string")
    follows = spark.createDataFrame([("u", "1"), ("u", "1")], "userUrlToken string, questionId string")
    got = {r["questionId"]: r["rate"]
           for r in R.action_rating(R.weighted_actions(acts), R.follow_rates(follows)).collect()}
    assert got == {"1": 7.5, "2": 2.5}


def test_unknown_action_type_weighs_other(spark):
    acts = spark.createDataFrame([("u", "1", "question_follow"), ("u", "2", "anything")],
                                 "userUrlToken string, questionId string, actType string")
    assert {r["rate"] for r in R.weighted_actions(acts).collect()} == {2.5}


def test_followed_questions_from_last_doc(spark):
    docs = spark.createDataFrame([
        ("a1", "u", [("q1", "t")]), ("a2", "u", [("q2", "t")]),
    ], "_id string, urlToken string, question array<struct<id:string,title:string>>")
    acts = spark.createDataFrame([("u", "q2", "answer_approve"), ("u", "q1", "answer_collect")],
                                 "userUrlToken string, questionId string, actType string")
    got = {r["questionId"]: r["rate"]
           for r in R.action_rating(R.weighted_actions(acts), R.followed_questions(docs)).collect()}
    # the later document replaces the earlier one: q1 keeps only its action weight
    assert got == {"q2": 6.0, "q1": 1.5}


def test_upsert_and_idempotence(spark):
    schema = "UId int, QId int, rate double"
    old = spark.createDataFrame([(1, 1, 5.0), (1, 2, 1.0)], schema)
    new = spark.createDataFrame([(1, 2, 2.5), (2, 1, 1.0)], schema)
    once = R.upsert(old, new)
    assert sorted(tuple(r) for r in once.collect()) == [(1, 1, 5.0), (1, 2, 2.5), (2, 1, 1.0)]
    twice = R.upsert(once, new)
    assert sorted(tuple(r) for r in twice.collect()) == sorted(tuple(r) for r in once.collect())


def test_tolerant_int(spark):
    df = spark.createDataFrame([("12",), (" 7 ",), ("12.5",), ("+3",), ("x",), (None,)], "s string")
    assert [r[0] for r in df.select(tolerant_int("s")).collect()] == [12, 7, None, 3, None, None]


def test_first_match_lookup(spark):
    idmap = spark.createDataFrame([("b", "u", "2"), ("a", "u", "1"), ("c", "v", "x")],
                                  "_id string, urlToken string, UId string")
    users = spark.createDataFrame([("u",), ("v",), ("w",)], "userUrlToken string")
    got = sorted(tuple(r) for r in R.user_id_lookup(users, idmap).collect())
    assert got == [("u", 1)]


def test_topk_per_group_bounded_and_planned(spark, sf_small):
    r = _ratings(Tables(spark, sf_small))
    top = M.topk_per_group(r, "UId", [F.col("rate").desc(), F.col("QId")], 3)
    assert top.groupBy("UId").count().agg(F.max("count")).first()[0] <= 3
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_als_properties(spark, sf_small):
    r = _ratings(Tables(spark, sf_small))
    s = M.hash_split(r)
    train = s.where("part = 'train'").drop("part")
    test = s.where("part = 'test'").drop("part")
    model = M.fit_als(train, seed=7, max_iter=5)
    recs = M.top_items(model, 10)
    assert recs.groupBy("UId").count().agg(F.max("count")).first()[0] <= 10
    pred = M.predict(model, test)
    rmse = M.rmse(pred).first()["rmse"]
    assert rmse is None or math.isfinite(rmse)
    if pred.count():
        assert M.rmse_value(pred) == pytest.approx(rmse, rel=1e-6)
    assert M.preview(recs).count() <= 10


def test_hash_split_is_repeatable(spark, sf_small):
    r = _ratings(Tables(spark, sf_small))
    a = M.hash_split(r).orderBy("UId", "QId").collect()
    b = M.hash_split(r.repartition(3)).orderBy("UId", "QId").collect()
    assert a == b


def test_als_with_ids_beyond_int(spark):
    big = 3_000_000_000
    rows = [(u, q, float((u + q) % 5 + 1)) for u in (1, 2, big, big + 7) for q in (10, 20, big * 2)]
    r = spark.createDataFrame(rows, "UId long, QId long, rate double")
    rec = M.fit_als(r, seed=3, max_iter=3)
    pred = M.predict(rec, r)
    assert pred.count() == len(rows)
    assert {x["UId"] for x in M.top_items(rec, 2).collect()} == {1, 2, big, big + 7}


def test_later_document_without_questions_hides_nothing(spark):
    docs = spark.createDataFrame(
        [("1", "u", [("q1", "t")]), ("2", "u", None), ("3", None, [("q9", "t")])],
        "_id string, urlToken string, question array<struct<id:string,title:string>>")
    assert [tuple(r) for r in R.followed_questions(docs).collect()] == [("u", "q1", 5.0)]


def test_one_rating_per_pair(spark):
    rated = spark.createDataFrame([("a", "7", 1.0), ("a", " 7", 2.0), ("b", "7", 3.0), ("c", "1_0", 4.0), ("c", "x", 5.0)],
                                  "userUrlToken string, questionId string, rate double")
    ids = spark.createDataFrame([("1", "a", "5"), ("2", "b", "5"), ("3", "c", "6")], "_id string, urlToken string, UId string")
    assert sorted(map(tuple, R.to_ratings(rated, ids).collect())) == [(5, 7, 3.0), (6, 10, 4.0)]


def test_als_same_model_whatever_the_partitions(spark):
    rows = [(u, q, float((u * q) % 5 + 1)) for u in range(40) for q in range(20) if (u + q) % 3]
    df = spark.createDataFrame(rows, "UId bigint, QId bigint, rate double")
    got = []
    for parts in (2, 7):
        rec = M.fit_als(df.repartition(parts), seed=1, max_iter=4)
        got.append({(r["UId"], r["QId"]): r["prediction"] for r in M.predict(rec, df).collect()})
    assert got[0].keys() == got[1].keys()
    assert max(abs(got[0][k] - got[1][k]) for k in got[0]) < 1e-3


def test_unseen_large_ids_are_cold_starts(spark):
    df = spark.createDataFrame([(u, q, 1.0 + u) for u in range(5) for q in range(5)], "UId bigint, QId bigint, rate double")
    rec = M.fit_als(df, max_iter=2)
    test = spark.createDataFrame([(3_000_000_000, 1, 1.0), (1, 1, 2.0)], "UId bigint, QId bigint, rate double")
    assert [r["UId"] for r in M.predict(rec, test).collect()] == [1]
