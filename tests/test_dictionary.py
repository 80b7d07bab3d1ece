import os

import pytest

from asklens.operators import dictionary as D
from asklens.operators import ratings as R


def tokens(spark, values):
    return spark.createDataFrame([(v,) for v in values], "t string")


def test_ids_never_move_and_are_dense(spark, tmp_path):
    path = f"file:{tmp_path}/dictionary"
    first = {r["node"]: r["id"] for r in D.grow(spark, path, tokens(spark, ["m", "z", "m", None, "c"])).collect()}
    assert first == {"c": 0, "m": 1, "z": 2}
    both = {r["node"]: (r["id"], r["version"]) for r in D.grow(spark, path, tokens(spark, ["b", "m", "a", "é", "z", "b"])).collect()}
    assert {n: i for n, (i, v) in both.items() if v == 1} == first
    assert {n: i for n, (i, v) in both.items() if v == 2} == {"a": 3, "b": 4, "é": 5}
    again = D.grow(spark, path, tokens(spark, ["a", "c"]))
    assert {r["node"]: r["id"] for r in again.collect()} == {n: i for n, (i, _) in both.items()}
    union = {r["node"] for r in D.grow(spark, f"file:{tmp_path}/one", tokens(spark, ["m", "z", "c", "b", "a", "é"])).collect()}
    assert union == set(both)  # the same tokens, other numbers


def test_a_load_that_was_cut_off_leaves_the_last_version(spark, tmp_path):
    path = f"file:{tmp_path}/dictionary"
    D.grow(spark, path, tokens(spark, ["x", "y"]))
    broken = tmp_path / "dictionary" / "version-000002"
    spark.createDataFrame([(99, "ghost")], D.SCHEMA).write.parquet(f"file:{broken}")
    os.remove(broken / "_SUCCESS")
    assert {r["node"] for r in D.read(spark, path).collect()} == {"x", "y"}
    grown = {r["node"]: r["id"] for r in D.grow(spark, path, tokens(spark, ["w"])).collect()}
    assert grown == {"x": 0, "y": 1, "w": 2}


def test_empty_loads(spark, tmp_path):
    path = f"file:{tmp_path}/dictionary"
    assert D.read(spark, path).count() == 0
    assert D.grow(spark, path, tokens(spark, [])).count() == 0
    assert {r["id"] for r in D.grow(spark, path, tokens(spark, ["q"])).collect()} == {0}


def test_two_new_rows_of_one_key_are_refused(spark):
    old = spark.createDataFrame([(1, 1, 1.0)], "UId bigint, QId bigint, rate double")
    new = spark.createDataFrame([(1, 1, 2.0), (2, 2, 3.0), (1, 1, 4.0)], "UId bigint, QId bigint, rate double")
    with pytest.raises(Exception, match="two new rows"):
        R.upsert(old, new).count()
    assert sorted(map(tuple, R.upsert(old, new.limit(2)).collect())) == [(1, 1, 2.0), (2, 2, 3.0)]


def test_ids_beyond_64_bits_are_kept_apart(spark):
    rated = spark.createDataFrame([("a", "9" * 20, 1.0), ("a", "7", 2.0), ("b", "7", 3.0), ("a", "x", 4.0), ("c", "8", 5.0), ("d", "x", 6.0)],
                                  "userUrlToken string, questionId string, rate double")
    ids = spark.createDataFrame([("1", "a", "5"), ("2", "b", "-1" + "0" * 19), ("3", "c", "no"), ("4", "d", "1" * 30)],
                                "_id string, urlToken string, UId string")
    got = sorted(map(tuple, R.rejected_ratings(rated, ids).collect()))
    assert got == [("a", "9" * 20, "5", 1.0), ("b", "7", "-1" + "0" * 19, 3.0)]
    assert [tuple(r) for r in R.to_ratings(rated, ids).collect()] == [(5, 7, 2.0)]
