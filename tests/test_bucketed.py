"""The bucketed table: upserts touch their buckets only, versions, crashes, refused rows."""

import os
import random

import pytest
from pyspark.errors import AnalysisException, PySparkException

from asklens.schemas import RATING_SCHEMA
from asklens.session import scratch_path
from asklens.sources.bucketed import BucketedTable


def _table(spark, buckets=8, path=None):
    return BucketedTable(spark, path or scratch_path(spark, "bucketed"), RATING_SCHEMA, buckets=buckets)


def _rows(spark, rows):
    return spark.createDataFrame(rows, "UId long, QId long, rate double")


def _dict(df):
    return {(r["UId"], r["QId"]): r["rate"] for r in df.collect()}


def _files(table, version):
    return {f.split("/data/")[1] for f in table.read(version).inputFiles()}


def test_random_upserts_equal_a_dict(spark):
    rnd, table, want = random.Random(5), _table(spark), {}
    for step in range(3):
        # user 1 holds most rows
        new = {(1 if rnd.random() < 0.6 else rnd.randrange(9), rnd.randrange(60)): float(rnd.randrange(9)) for _ in range(40)}
        want |= new
        assert table.upsert(_rows(spark, [(*k, v) for k, v in new.items()])) == step + 1
        assert _dict(table.read()) == want
    assert table.read().schema.names == ["UId", "QId", "rate"]


def test_untouched_buckets_keep_their_files(spark):
    table = _table(spark)
    table.upsert(_rows(spark, [(u, q, 1.0) for u in range(10) for q in range(10)]))
    table.upsert(_rows(spark, [(3, 3, 9.0)]))
    old, new = _files(table, 1), _files(table, 2)
    b, = [r[0] for r in _rows(spark, [(3, 3, 9.0)]).select(table.bucket_of()).collect()]
    assert {f.split("/")[0] for f in old ^ new} == {f"_bucket={b}"}
    assert len(old & new) >= 6
    assert _dict(table.read(1))[3, 3] == 1.0 and _dict(table.read())[3, 3] == 9.0 and table.read().count() == 100


def test_crash_between_files_and_manifest_leaves_the_old_version(spark, monkeypatch):
    table = _table(spark)
    table.upsert(_rows(spark, [(1, 1, 1.0), (2, 2, 2.0)]))

    def lost(*_):
        raise OSError("lost")

    monkeypatch.setattr(table, "_commit", lost)
    with pytest.raises(OSError):
        table.upsert(_rows(spark, [(1, 1, 5.0), (7, 7, 7.0)]))
    again = _table(spark, path=table.path)
    assert again.version() == 1 and _dict(again.read()) == {(1, 1): 1.0, (2, 2): 2.0}
    # neither does a manifest that was not finished
    again.upsert(_rows(spark, [(1, 1, 6.0)]))
    os.remove(os.path.join(again.manifest_path(2).removeprefix("file:"), "_SUCCESS"))
    assert _dict(again.read()) == {(1, 1): 1.0, (2, 2): 2.0}
    assert again.upsert(_rows(spark, [(3, 3, 3.0)])) == 2
    assert _dict(again.read()) == {(1, 1): 1.0, (2, 2): 2.0, (3, 3): 3.0}


def test_refused_and_empty(spark):
    table = _table(spark)
    assert table.read().count() == 0 and table.version() == 0
    assert table.upsert(_rows(spark, [])) == 1 and table.read().count() == 0
    table.upsert(_rows(spark, [(1, 1, None)]))
    assert _dict(table.read()) == {(1, 1): None}
    assert table.upsert(_rows(spark, [])) == 2  # nothing new: no version
    for bad in ([(1, 1, 1.0), (1, 1, 2.0)], [(None, 1, 1.0)]):
        with pytest.raises((AnalysisException, PySparkException)):
            table.upsert(_rows(spark, bad))
    assert table.version() == 2 and _dict(table.read()) == {(1, 1): None}
    with pytest.raises(ValueError):
        _table(spark, buckets=4, path=table.path).read()
