"""Session helpers only fill in settings the caller left unset."""

from asklens.session import apply_scale_conf, ensure_checkpoint_dir, scratch_path, tune_session


def test_tune_session_respects_explicit_settings(spark):
    s = spark.newSession()
    key = "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"
    s.conf.set(key, "false")
    tune_session(s)
    assert s.conf.get(key) == "false"
    fresh = spark.newSession()
    tune_session(fresh)
    assert fresh.conf.get(key) == "true"


def test_apply_scale_conf_keeps_explicit_partitions(spark):
    s = spark.newSession()
    s.conf.set("spark.sql.shuffle.partitions", "7")
    apply_scale_conf(s)
    assert s.conf.get("spark.sql.shuffle.partitions") == "7"
    assert s.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") in ("256m", str(256 << 20))


def test_scratch_paths_live_under_the_checkpoint_folder(spark):
    base = ensure_checkpoint_dir(spark)
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(base) and b.startswith(base) and a != b


def test_a_cluster_must_name_its_checkpoint_folder():
    from types import SimpleNamespace

    import pytest

    from asklens.session import ensure_checkpoint_dir

    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]"):
        sc = SimpleNamespace(master=master, getCheckpointDir=lambda: None)
        spark = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: d))
        with pytest.raises(RuntimeError):
            ensure_checkpoint_dir(spark)
