"""End-to-end jobs over JSON inputs derived from sf0.001."""

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from asklens import apps
from asklens.session import scratch_path
from asklens.sources import adapters as A
from asklens.sources import io as IO
from asklens.sources.tables import Tables


@pytest.fixture(scope="module")
def inputs(spark, sf_small):
    t = Tables(spark, sf_small)
    base = scratch_path(spark, "apps-in")
    A.follow_docs(t).write.json(os.path.join(base, "docs"))
    A.actions(t).drop("event_id").write.json(os.path.join(base, "actions"))
    A.id_map(t).write.json(os.path.join(base, "idmap"))
    return base


def test_graph_job(spark, inputs):
    out = scratch_path(spark, "apps-graph")
    apps.graph_job(spark, os.path.join(inputs, "docs"), out)
    v = spark.read.parquet(os.path.join(out, "vertices"))
    e = spark.read.parquet(os.path.join(out, "edges"))
    r = spark.read.parquet(os.path.join(out, "ranks"))
    rec = spark.read.parquet(os.path.join(out, "recommend"))
    assert r.count() == v.count() and e.count() > 0
    assert r.agg(F.sum("rank")).first()[0] == pytest.approx(v.count(), rel=1e-9)
    assert rec.select("srcId").distinct().count() == rec.count()
    with pytest.raises(AnalysisException):  # default save mode refuses to overwrite
        apps.graph_job(spark, os.path.join(inputs, "docs"), out)


def test_ratings_job_upserts(spark, inputs):
    out = scratch_path(spark, "apps-ratings")
    args = (os.path.join(inputs, "docs"), os.path.join(inputs, "actions"), os.path.join(inputs, "idmap"), out)
    apps.ratings_job(spark, *args)
    table = apps.ratings_table(spark, out)
    assert table.version() == 1
    first = table.read().count()
    # a version that was not finished does not count and is written again
    spark.range(3).write.json(table.manifest_path(2))
    os.remove(os.path.join(table.manifest_path(2).removeprefix("file:"), "_SUCCESS"))
    apps.ratings_job(spark, *args)
    assert table.version() == 2 and table.read().count() == first
    recs = spark.read.parquet(os.path.join(out, "recommendations"))
    assert recs.groupBy("UId").count().agg(F.max("count")).first()[0] <= 10


def test_graph_job_resumes(spark, inputs):
    out = scratch_path(spark, "apps-resume")
    args = (spark, os.path.join(inputs, "docs"), out)
    apps.graph_job(*args, recommend_batches=2, resume=True)
    full = spark.read.parquet(os.path.join(out, "recommend"))
    want = sorted(map(tuple, full.collect()))
    # lose a table in mid-write and half of a batch: both are made again
    local = out.removeprefix("file:")
    batch = next(os.path.join(local, d) for d in os.listdir(local) if d.startswith("recommend_batches-")) + "/batch=0"
    for lost in (os.path.join(local, "recommend"), batch):
        os.remove(os.path.join(lost, "_SUCCESS"))
    for name in [f for f in os.listdir(batch) if f.startswith("part-")][1:]:
        os.remove(os.path.join(batch, name))
    apps.graph_job(*args, recommend_batches=2, resume=True)
    assert sorted(map(tuple, spark.read.parquet(os.path.join(out, "recommend")).collect())) == want
    # other documents do not resume this folder
    other = scratch_path(spark, "apps-other")
    spark.read.json(os.path.join(inputs, "docs")).limit(20).write.json(other)
    with pytest.raises(ValueError):
        apps.graph_job(spark, other, out, resume=True)
    apps.graph_job(spark, other, out, mode="overwrite", recommend_batches=2)
    assert spark.read.parquet(os.path.join(out, "recommend")).count() < len(want)


def test_cli_graph(spark, inputs):
    out = scratch_path(spark, "apps-cli")
    apps.main(["graph", "--follow-docs", os.path.join(inputs, "docs"), "--out", out, "--recommend-batches", "2"])
    assert spark.read.parquet(os.path.join(out, "recommend")).count() > 0
    with pytest.raises(ValueError):
        IO.claim(spark, os.path.join(out, next(d for d in os.listdir(out.removeprefix("file:")) if d.startswith("recommend_batches-"))), {})
