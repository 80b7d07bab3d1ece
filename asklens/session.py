"""Session helpers: configuration, the shared checkpoint folder and scratch paths.

On a cluster the checkpoint folder is whatever the cluster names in
``spark.checkpoint.dir`` (or what the application already passed to
``setCheckpointDir``).  Only when neither is set -- local tests and the bench --
do we pick a folder of our own.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job of this library relies on: AQE for runtime re-planning
# (partition coalescing, broadcast of sides that turn out small, skew-join
# splitting) and UTC so timestamps never depend on the host.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    # let AQE coalesce the partitions of plans that get cached or checkpointed;
    # otherwise every persisted intermediate keeps spark.sql.shuffle.partitions
    # partitions, however small it is
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Settings for a large cluster (hundreds of TB, ~1000 executors).  Shuffle
# partitions start high and AQE coalesces them to ~256 MB each; skewed join
# partitions are split; input splits stay large enough to keep task counts sane.
SCALE_CONF = {
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
}


def apply_scale_conf(spark: SparkSession, overrides: dict | None = None) -> None:
    """Apply SCALE_CONF (plus overrides) to runtime SQL settings the cluster left unset."""
    conf = dict(SCALE_CONF)
    conf.update(overrides or {})
    for k, v in conf.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)
    for k, v in BASE_CONF.items():
        if k.startswith("spark.sql.") and spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)


# Runtime SQL settings the library relies on for speed (never for results);
# applied to a session only where the session has not set them itself.
RUNTIME_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
}


def tune_session(spark: SparkSession) -> None:
    for k, v in RUNTIME_DEFAULTS.items():
        if spark.conf.get(k, None) in (None, ""):
            spark.conf.set(k, v)


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app: str = "asklens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master or "local[8]").appName(app)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def default_parallelism(spark: SparkSession) -> int:
    """Cluster parallelism (total cores); a conf lookup on sessions without a local context."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - e.g. a Spark Connect session
        return int(spark.conf.get("spark.default.parallelism", "8") or 8)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only if none is configured."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns the checkpoint folder
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set: on a cluster it must name a folder that all executors share")
        # Unset: a local run (tests, bench).  A cluster always names a shared folder.
        configured = tempfile.mkdtemp(prefix="asklens-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (never a machine-local temp dir)."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "scratch", f"{name}-{uuid.uuid4().hex[:12]}")


def persist_partitioned(df):
    """Cache a frame that ends in an explicit ``repartition`` so that joins on its
    key keep using that partitioning (no re-shuffle per use).  The cache is built
    with ``canChangeCachedPlanOutputPartitioning`` off -- with it on, Spark treats
    a cached plan's partitioning as unknown -- and the setting is restored."""
    from pyspark import StorageLevel

    spark = df.sparkSession
    key = "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "false")
    try:
        cached = df.persist(StorageLevel.MEMORY_AND_DISK)
        cached.count()
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
    return cached


def drop_unused(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files that no frame refers to any more.

    It deletes them when the driver collects garbage, which a driver with memory to spare hardly ever does, so
    the files of all steps of a job would lie on the disks together."""
    gc.collect()
    try:
        spark.sparkContext._jvm.System.gc()
    except Exception:  # noqa: BLE001 - Spark Connect: the server's own garbage
        pass


def checkpoint(df):
    """Cut lineage with a reliable checkpoint (survives executor loss).

    The frame is persisted first, so the checkpoint write reads the cached
    blocks instead of recomputing the plan a second time.
    """
    from pyspark import StorageLevel

    ensure_checkpoint_dir(df.sparkSession)
    cached = df.persist(StorageLevel.MEMORY_AND_DISK)
    out = cached.checkpoint(eager=True)
    cached.unpersist()
    return out
