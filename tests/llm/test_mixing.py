import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from asklens.llm import mixing
from asklens.llm.common import running_sums, written

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fill(sizes, weights=(1, 2, 3), most=3):
    """Targets by resharing the excess until no source is above its cap, in exact numbers."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = Fraction(sum(sizes.values())), {}
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(capped.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return {**capped, **share}
        capped |= {s: Fraction(most * sizes[s]) for s in over}


def check(df):
    got = mixing.mix(df).collect()
    texts = df.collect()
    assert sorted((repr(r["doc_id"]), repr(r["source"]), r["size"]) for r in got) == sorted(
        (repr(r["doc_id"]), repr(r["source"]), len(WORD.findall(r["text"] or ""))) for r in texts)
    sizes = {}
    for r in got:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
    targets = fill(sizes) if sizes else {}
    for s in sizes:
        mine = [r for r in got if r["source"] == s]
        assert all(r["source_size"] == sizes[s] and r["target"] == pytest.approx(float(targets[s])) for r in mine)
        assert all(0 <= r["taken"] <= 3 * r["size"] for r in mine)
        assert abs(sum(r["taken"] for r in mine) - targets[s]) <= 0.5 + 1e-6
        # at most one document is cut
        whole = int(max(0, round(float(targets[s])))) // sizes[s] if sizes[s] else 0
        assert sum(r["taken"] not in (whole * r["size"], (whole + 1) * r["size"]) for r in mine) <= 1
    return got


def test_documents_and_odd(docs, odd, none):
    check(docs)
    check(odd)
    assert check(none) == []


def test_caps_and_a_hot_source(spark):
    df = spark.range(0, 1200, 1, 12).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") < 1000, "a").when(F.col("id") < 1100, "b").when(F.col("id") < 1110, "c").otherwise(
            F.concat(F.lit("s"), F.col("id") % 7)).alias("source"),
        F.repeat(F.lit("w "), (F.col("id") % 9).cast("int")).alias("text"))
    check(df)
    assert check(df) and sorted(map(tuple, mixing.mix(df.repartition(5)).drop("row_no").collect())) == sorted(
        map(tuple, mixing.mix(df).drop("row_no").collect()))


def test_mixed_documents(docs, odd, none):
    for df in (docs, odd):
        taken = mixing.mix(df).agg(F.sum("taken")).first()[0]
        out = mixing.mixed_documents(df)
        assert out.columns == df.columns
        assert out.agg(F.sum(mixing.n_words(F.col("text")))).first()[0] == taken
    assert mixing.mixed_documents(none).count() == 0


def test_first_words(spark):
    df = spark.createDataFrame([("  a\tbb \n c ",)], "t string")
    assert [df.select(mixing.first_words(F.col("t"), F.lit(n))).first()[0] for n in (1, 2, 3)] == ["  a", "  a\tbb", "  a\tbb \n c"]


def test_running_sums(spark):
    df = spark.range(0, 5000, 1, 7).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("g"), F.col("id").alias("k"), (F.col("id") % 11).alias("v"))
    got = running_sums(df, [F.col("k").desc()], ["v"], "t", ["g"]).collect()
    at = {}
    for r in sorted(got, key=lambda r: -r["k"]):
        assert r["before_v"] == at.get(r["g"], 0)
        at[r["g"]] = at.get(r["g"], 0) + r["v"]
    assert written(df, "again").count() == 5000
