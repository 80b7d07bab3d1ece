"""Sinks, export ledger and crawl bookkeeping (FIXTURES: export, caps)."""

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from asklens.operators import crawl as C
from asklens.session import scratch_path
from asklens.sources import io as IO


def test_export_twice_exports_nothing_new(spark):
    docs = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "_id string, v int")
    ledger = scratch_path(spark, "ledger")
    spark.createDataFrame([("a",), ("b:::3",)], "value string").write.text(ledger)
    first = IO.incremental_export(docs, ledger, scratch_path(spark, "run"))
    assert [r["_id"] for r in first.collect()] == ["c"]
    second = IO.incremental_export(docs, ledger, scratch_path(spark, "run"))
    assert second.count() == 0


def test_export_without_ledger(spark):
    docs = spark.createDataFrame([("a", 1)], "_id string, v int")
    got = IO.incremental_export(docs, scratch_path(spark, "no-ledger"), scratch_path(spark, "run"))
    assert got.count() == 1


def test_crash_between_export_and_ledger_exports_nothing_twice(spark, monkeypatch):
    docs = spark.createDataFrame([(f"k{i}", i) for i in range(9)], "_id string, v int")
    ledger, runs = scratch_path(spark, "ledger"), [scratch_path(spark, f"run-{i}") for i in range(4)]
    IO.incremental_export(docs.where("v < 3"), ledger, runs[0])
    enter = IO._enter

    def lost(*_):
        raise OSError("lost")

    # the records are written, the ledger is not: the next run knows them all the same
    monkeypatch.setattr(IO, "_enter", lost)
    with pytest.raises(OSError):
        IO.incremental_export(docs.where("v < 6"), ledger, runs[1])
    monkeypatch.setattr(IO, "_enter", enter)
    assert sorted(r["v"] for r in IO.incremental_export(docs, ledger, runs[2]).collect()) == [6, 7, 8]
    # cut off in the write of the records: the same run starts again
    more = docs.unionByName(spark.createDataFrame([("x", 99)], docs.schema))
    IO.incremental_export(more, ledger, runs[3])
    _lose(runs[3])
    _lose(os.path.join(IO._run_folder(ledger, runs[3]), "ids"))
    assert [r["v"] for r in IO.incremental_export(more, ledger, runs[3]).collect()] == [99]
    everything = [r["v"] for run in runs for r in spark.read.schema(docs.schema).json(run).collect()]
    assert sorted(everything) == [*range(9), 99]
    # cut off after it: the same run gives what it wrote
    _lose(os.path.join(IO._run_folder(ledger, runs[3]), "ids"))
    assert [r["v"] for r in IO.incremental_export(more, ledger, runs[3]).collect()] == [99]
    with pytest.raises(FileExistsError):
        IO.incremental_export(docs, ledger, runs[0])


def _lose(path):
    os.remove(os.path.join(path.removeprefix("file:"), "_SUCCESS"))


def test_compacted_ledger_says_the_same(spark):
    docs = spark.createDataFrame([(f"k{i}", i) for i in range(20)] + [(None, 50)], "_id string, v int")
    ledger = scratch_path(spark, "ledger")
    spark.createDataFrame([("k19:::3",)], "value string").write.text(ledger)
    for top in (5, 10):
        IO.incremental_export(docs.where(f"v < {top}"), ledger, scratch_path(spark, "run"))
    ids = sorted(r["_id"] for r in IO.read_ledger(spark, ledger).distinct().collect())
    IO.compact_ledger(spark, ledger)
    IO.compact_ledger(spark, ledger)
    assert len(IO._segments(spark, ledger)) == 1 and sorted(r["_id"] for r in IO.read_ledger(spark, ledger).collect()) == ids
    # a filter that is too full leaves the work to the join; a record without an id is in no ledger
    left = IO.incremental_export(docs, ledger, scratch_path(spark, "run"), filter_bits=64)
    assert sorted(r["v"] for r in left.collect()) == [*range(10, 19), 50]


def test_ledger_is_thinned_below_the_shuffle(spark):
    done = spark.range(1000).select(F.col("id").cast("string").alias("_id"))
    docs = spark.range(990, 1010).select(F.col("id").cast("string").alias("_id"))
    f = IO.KeyFilter(docs, "_id", 1 << 14)
    new = docs.hint("merge").join(f.keep(done, "_id").hint("merge"), "_id", "left_anti")
    plan = new._jdf.queryExecution().executedPlan().toString().split("SortMergeJoin", 1)[1]
    lines = plan.splitlines()
    assert max(i for i, x in enumerate(lines) if "Exchange" in x) < next(i for i, x in enumerate(lines) if "ArrowEvalPython" in x)
    assert new.count() == 10


def test_default_save_mode_refuses_overwrite(spark):
    df = spark.range(3)
    path = scratch_path(spark, "sink")
    IO.save(df, path)
    with pytest.raises(AnalysisException):
        IO.save(df, path)
    IO.save(df, path, mode="overwrite")
    assert spark.read.parquet(path).count() == 3


def test_snapshot_single_file(spark):
    path = scratch_path(spark, "snap")
    IO.save_snapshot(spark.range(10).repartition(4), path)
    back = spark.read.json(path)
    assert back.count() == 10 and len(back.inputFiles()) == 1


def _discovered(spark):
    return spark.createDataFrame(
        [("x", 1, 1), ("y", 1, 2), ("x", 2, 1), ("z", 2, 2), ("w", 3, 1)],
        "user string, l_orderkey long, l_linenumber int")


def test_pending_and_caps(spark):
    ledger = spark.createDataFrame([("y:::5",), ("w:::ERROR",)], "value string")
    pend = [(r["user"], r["first_order"]) for r in C.pending(_discovered(spark), ledger).orderBy("first_order").collect()]
    assert pend == [("x", 1), ("z", 2)]
    assert C.next_pending(_discovered(spark), ledger).first()["user"] == "x"
    assert [r["user"] for r in C.global_cap(_discovered(spark), 2).collect()] == ["x", "y"]


def test_follow_cap_and_totals(spark):
    rows = spark.createDataFrame([("u", i, 1, i, i) for i in range(5)] + [("v", 9, 1, 1, 1)],
                                 "user string, l_orderkey long, l_linenumber int, l_suppkey long, l_partkey long")
    capped = C.follow_cap(rows, 3)
    assert capped.where("user = 'u'").count() == 3 and capped.where("user = 'v'").count() == 1
    tot = {r["user"]: r["follow_total_count"] for r in C.follow_totals(rows.select("user")).collect()}
    assert tot == {"u": 5, "v": 1, None: 6}
