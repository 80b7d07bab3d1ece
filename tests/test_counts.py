"""Counts and the streaming service (FIXTURES: null rules, declared types)."""

import json
import os

from pyspark.sql import functions as F

from asklens.operators import counts
from asklens.schemas import PROFILE_SCHEMA
from asklens.session import scratch_path
from asklens.streaming import counts as S


def _profiles(spark):
    rows = [
        {"_id": "1", "business": "IT", "educations": [{"school": "A", "major": "m"}, {"school": None, "major": "x"}]},
        {"_id": "2", "business": None, "educations": []},
        {"_id": "3", "educations": None},
        {"_id": "4", "business": "IT", "educations": [{"school": "A", "major": "q"}]},
    ]
    path = scratch_path(spark, "profiles-fixture")
    spark.createDataFrame([(json.dumps(r),) for r in rows], "value string").coalesce(1).write.text(path)
    return path


def test_null_rules(spark):
    df = spark.read.schema(PROFILE_SCHEMA).json(_profiles(spark))
    school = {r["school"]: r["count"] for r in counts.school_count(df).collect()}
    assert school == {"A": 2, None: 1}
    business = {r["business"]: r["count"] for r in counts.business_count(df).collect()}
    assert business == {"IT": 2, None: 2}
    nested = sorted((r["_id"], r["school"] or "") for r in counts.nested_path_project(df).collect())
    assert nested == [("1", ""), ("1", "A"), ("4", "A")]


def test_declared_types(spark):
    path = scratch_path(spark, "declared")
    doc = {"_id": "1", "isActive": True, "badge": [{"type": "best", "topics": []}]}
    spark.createDataFrame([(json.dumps(doc),)], "value string").write.text(path)
    row = spark.read.schema(PROFILE_SCHEMA).json(path).first()
    assert row["isActive"] is None
    assert json.loads(row["badge"][0]) == {"type": "best", "topics": []}


def test_stream_equals_batch(spark):
    path = _profiles(spark)
    src = S.profile_stream(spark, path)
    streamed, q = S.run_once(spark, counts.school_count(src), "t_school", scratch_path(spark, "t-school"))
    batch = counts.school_count(spark.read.schema(PROFILE_SCHEMA).json(path))
    assert sorted(streamed.collect(), key=str) == sorted(batch.collect(), key=str)
    assert q.lastProgress is not None


def test_drip_runs_several_batches(spark):
    path = scratch_path(spark, "drip-in")
    rows = [json.dumps({"_id": str(i), "educations": [{"school": f"s{i % 3}", "major": "m"}]}) for i in range(12)]
    spark.createDataFrame([(r,) for r in rows], "value string").repartition(6).write.text(path)
    src = S.profile_stream(spark, path, max_files_per_trigger=1)
    out, q = S.run_once(spark, counts.school_count(src), "t_drip", scratch_path(spark, "t-drip"))
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) > 1
    assert {r["school"]: r["count"] for r in out.collect()} == {"s0": 4, "s1": 4, "s2": 4}


def test_service_runs_both_queries(spark):
    path = _profiles(spark)
    out = scratch_path(spark, "service")
    qs = S.start_service(spark, path, out, trigger={"availableNow": True})
    for q in qs:
        q.awaitTermination()
    school = spark.read.json(os.path.join(out, "count_schools", "snapshot.json"))
    assert {r["school"]: r["count"] for r in school.collect()} == {"A": 2, None: 1}
    business = spark.read.parquet(os.path.join(out, "count_businesses", "table"))
    assert {r["business"]: r["count"] for r in business.collect()} == {"IT": 2, None: 2}


def test_location_count_explodes(spark):
    df = spark.createDataFrame([(["a", "b"],), (["a"],), ([],), (None,)], "locations array<string>")
    got = {r["location"]: r["count"] for r in counts.location_count(df).collect()}
    assert got == {"a": 2, "b": 1}
    assert counts.location_count(df).where(F.col("location").isNull()).count() == 0


def test_restart_resumes_from_checkpoint(spark):
    src_dir = scratch_path(spark, "restart-in")
    out = scratch_path(spark, "restart-out")

    def add(files):
        rows = [json.dumps({"_id": str(i), "business": b}) for i, b in enumerate(files)]
        spark.createDataFrame([(r,) for r in rows], "value string").coalesce(1).write.mode("append").text(src_dir)

    def run():
        src = S.profile_stream(spark, src_dir)
        res, _ = S.run_once(spark, counts.business_count(src), "t_restart", out)
        return {r["business"]: r["count"] for r in res.collect()}

    add(["IT", "IT", "Law"])
    assert run() == {"IT": 2, "Law": 1}
    add(["IT", "Art"])
    assert run() == {"IT": 3, "Law": 1, "Art": 1}  # state restored; old files not recounted


def test_service_with_processing_time_trigger(spark):
    path = _profiles(spark)
    out = scratch_path(spark, "service-pt")
    qs = S.start_service(spark, path, out, trigger={"processingTime": "1 second"}, state_partitions=2)
    try:
        for q in qs:
            q.processAllAvailable()
    finally:
        for q in qs:
            q.stop()
    business = spark.read.json(os.path.join(out, "count_businesses", "snapshot.json"))
    assert {r["business"]: r["count"] for r in business.collect()} == {"IT": 2, None: 2}


def test_archive_moves_processed_files(spark):
    src_dir = scratch_path(spark, "arch-in")
    arch = scratch_path(spark, "arch-out")
    rows = [json.dumps({"_id": str(i), "business": "IT"}) for i in range(4)]
    spark.createDataFrame([(r,) for r in rows], "value string").repartition(2).write.text(src_dir)
    src = S.profile_stream(spark, src_dir, archive_dir=arch)
    out, q = S.run_once(spark, counts.business_count(src), "t_arch", scratch_path(spark, "arch-q"))
    assert {r["business"]: r["count"] for r in out.collect()} == {"IT": 4}


def test_tagged_counts_equal_the_two_counts(spark):
    df = spark.read.schema(PROFILE_SCHEMA).json(_profiles(spark))
    got = sorted(((r["tag"], r["key"], r["count"]) for r in S.tagged_counts(df).collect()), key=str)
    want = [("count_schools", r["school"], r["count"]) for r in counts.school_count(df).collect()]
    want += [("count_businesses", r["business"], r["count"]) for r in counts.business_count(df).collect()]
    assert got == sorted(want, key=str)
    assert S.tagged_counts(df.where("false")).count() == 0


def test_service_reads_each_file_once_and_resumes(spark):
    src, out = scratch_path(spark, "service-in"), scratch_path(spark, "service-out")

    def add(names):
        rows = [json.dumps({"_id": n, "business": "IT", "educations": [{"school": n, "major": "m"}]}) for n in names]
        spark.createDataFrame([(r,) for r in rows], "value string").repartition(3).write.mode("append").text(src)

    def run():
        q, = S.start_service(spark, src, out, {"availableNow": True}, state_partitions=2, max_files_per_trigger=1)
        q.awaitTermination()
        assert q.exception() is None
        read = sum(p["numInputRows"] for p in q.recentProgress)
        state = [o["customMetrics"] for p in q.recentProgress for o in p["stateOperators"]]
        assert any(m.startswith("rocksdb") for metrics in state for m in metrics)
        school = spark.read.json(os.path.join(out, "count_schools", "snapshot.json"))
        business = spark.read.parquet(os.path.join(out, "count_businesses", "table"))
        return read, {r["school"]: r["count"] for r in school.collect()}, {r["business"]: r["count"] for r in business.collect()}

    add(["a", "b", "a"])
    assert run() == (3, {"a": 2, "b": 1}, {"IT": 3})
    add(["b", "c"])
    assert run() == (2, {"a": 2, "b": 2, "c": 1}, {"IT": 5})  # state restored, the first files not read again
