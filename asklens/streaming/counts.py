"""Continuous counts over a directory of profile JSON files (A1, A4, K1-K7).

Source: ``readStream.schema(fixed).json(dir)`` -- no inference, optional
``maxFilesPerTrigger`` to meter arrival.  Each query is a complete-mode
stateful count (state grows with the number of distinct schools or
businesses, not with the input) written by a ``foreachBatch`` callback that
persists the batch once and overwrites both sinks.  Queries carry an explicit
checkpoint location, so a restart resumes rather than recounting.

The service counts schools and businesses in one stateful query over tagged keys
(``tagged_counts``): every file is read and parsed once, and the rows of a batch go to the sinks of their tag.
Its state lies in RocksDB with changelog checkpoints, so a trigger uploads the keys that changed, not all of them.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from asklens.operators import counts
from asklens.schemas import PROFILE_SCHEMA
from asklens.session import tune_session

# the service's counts: name (also of the output folder) -> column of its result
SERVICE_COUNTS = {"count_schools": "school", "count_businesses": "business"}
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
SERVICE_TRIGGER = {"processingTime": "3 seconds"}  # fixed value: the reference's interval


def streaming_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session on the same context with its own shuffle-partition count.

    A stateful query fixes its number of state-store partitions at its first
    start (it is recorded in the checkpoint), from ``spark.sql.shuffle.partitions``.
    Counting a few thousand schools needs a handful, not the batch default;
    a new session sets that without touching the caller's configuration.
    """
    if not state_partitions:
        return spark
    s = spark.newSession()
    s.conf.set("spark.sql.shuffle.partitions", str(int(state_partitions)))
    tune_session(s)
    return s


def service_session(spark: SparkSession, state_partitions: int | None = None) -> SparkSession:
    """A session of its own for the service: RocksDB state, and ``state_partitions`` of it when given."""
    s = streaming_session(spark, state_partitions)
    if s is spark:
        s = spark.newSession()
        tune_session(s)
    for key, value in STATE_CONF.items():
        s.conf.set(key, value)
    return s


def profile_stream(spark: SparkSession, input_dir: str, max_files_per_trigger: int | None = None,
                   schema=PROFILE_SCHEMA, archive_dir: str | None = None) -> DataFrame:
    """Profile JSON files arriving in ``input_dir``, read with the fixed schema.

    ``max_files_per_trigger`` meters arrival (K7).  ``archive_dir`` moves files
    out of the input folder once a batch has committed them (Spark's
    ``cleanSource``), so a folder that receives files forever does not make
    every trigger list an ever-growing directory.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if archive_dir:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    return reader.json(input_dir)


def dual_sink(table_path: str, snapshot_path: str | None = None, table_format: str = "parquet"):
    """Batch callback writing the whole (complete-mode) result to a table and,
    optionally, to a one-file JSON snapshot; the batch is computed once (T11)."""
    def write_batch(df: DataFrame, epoch_id: int) -> None:
        df.persist()
        try:
            df.write.format(table_format).mode("overwrite").save(table_path)
            if snapshot_path:
                df.coalesce(1).write.mode("overwrite").json(snapshot_path)
        finally:
            df.unpersist()
    return write_batch


def start_count(counted: DataFrame, name: str, table_path: str, checkpoint_dir: str,
                snapshot_path: str | None = None, trigger: dict | None = None) -> StreamingQuery:
    return (counted.writeStream.outputMode("complete")
            .foreachBatch(dual_sink(table_path, snapshot_path))
            .queryName(name)
            .option("checkpointLocation", checkpoint_dir)
            .trigger(**(trigger or SERVICE_TRIGGER))
            .start())


def tagged_counts(profiles: DataFrame) -> DataFrame:
    """(tag, key, count): ``counts.school_count`` and ``counts.business_count`` of one pass.  A profile gives one tagged key per
    education and one for its business; a null school or business is a key, null educations give none."""
    def tagged(name, key):
        return F.struct(F.lit(name).alias("tag"), key.alias("key"))

    schools = F.transform(F.col("educations.school"), lambda s: tagged("count_schools", s))
    business = F.array(tagged("count_businesses", F.col("business")))
    keys = F.concat(F.coalesce(schools, F.array().cast("array<struct<tag:string,key:string>>")), business)
    return profiles.select(F.explode(keys).alias("k")).groupBy(F.col("k.tag").alias("tag"), F.col("k.key").alias("key")).count()


def routed_sinks(out_dir: str, table_format: str = "parquet"):
    """Batch callback: the rows of each tag to the table and snapshot of its count; the batch is computed once.
    A batch run again after a crash overwrites what its first run wrote."""
    def write_batch(df: DataFrame, epoch_id: int) -> None:
        df.persist()
        try:
            for name, column in SERVICE_COUNTS.items():
                rows = df.where(F.col("tag") == name).select(F.col("key").alias(column), "count")
                rows.write.format(table_format).mode("overwrite").save(os.path.join(out_dir, name, "table"))
                rows.coalesce(1).write.mode("overwrite").json(os.path.join(out_dir, name, "snapshot.json"))
        finally:
            df.unpersist()
    return write_batch


def start_service(spark: SparkSession, input_dir: str, out_dir: str, trigger: dict | None = None,
                  state_partitions: int | None = None, max_files_per_trigger: int | None = None,
                  archive_dir: str | None = None) -> list[StreamingQuery]:
    """Both counts by one query, so each file is read once and may be archived afterwards; the sinks are those of two named
    counts.  ``awaitTermination()`` of the query raises its failure (T10)."""
    src = profile_stream(service_session(spark, state_partitions), input_dir, max_files_per_trigger, archive_dir=archive_dir)
    return [(tagged_counts(src).writeStream.outputMode("complete")
             .foreachBatch(routed_sinks(out_dir))
             .queryName("count_profiles")
             .option("checkpointLocation", os.path.join(out_dir, "_checkpoint"))
             .trigger(**(trigger or SERVICE_TRIGGER))
             .start())]


def run_once(spark: SparkSession, counted: DataFrame, name: str, out_dir: str) -> tuple[DataFrame, StreamingQuery]:
    """Drain everything available (``availableNow``), then return the table sink."""
    table = os.path.join(out_dir, "table")
    q = start_count(counted, name, table, os.path.join(out_dir, "_checkpoint"),
                    os.path.join(out_dir, "snapshot.json"), {"availableNow": True})
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return spark.read.parquet(table), q
