"""Key filters: no false negatives, few false positives, full filters keep everything."""

import pytest
from pyspark.sql import functions as F

from asklens.operators.bloom import KeyFilter


def test_keeps_every_key_and_few_others(spark):
    keys = spark.range(0, 3000, 3).select(F.concat(F.lit("k"), "id").alias("k"))
    all_rows = spark.range(3000).select("id", F.concat(F.lit("k"), "id").alias("k"))
    f = KeyFilter(keys, "k", 1 << 14)
    kept = {r["id"] for r in f.keep(all_rows, "k").collect()}
    assert kept >= set(range(0, 3000, 3)) and len(kept) < 1150
    assert 0 < f.fill < 0.5


def test_any_of_several_keys_nulls_and_empty(spark):
    f = KeyFilter(spark.createDataFrame([(1,), (None,)], "k long"), "k", 1 << 12)
    rows = spark.createDataFrame([(1, 7), (7, 1), (8, 9), (None, 8)], "a long, b long")
    assert {tuple(r) for r in f.keep(rows, "a", "b").collect()} == {(1, 7), (7, 1), (None, 8)}
    none = KeyFilter(spark.createDataFrame([], "k long"), "k", 64)
    assert none.fill == 0 and none.keep(rows, "a").count() == 0


def test_full_filter_keeps_all_rows(spark):
    f = KeyFilter(spark.range(1000), "id", 64)
    assert f.fill >= 0.9 and f.keep(spark.range(5000), "id").count() == 5000
    with pytest.raises(ValueError):
        KeyFilter(spark.range(1), "id", 100)
