"""Sinks, snapshots, the export ledger and line files.

Paths are parameters.  On a cluster they name the shared store; locally the
registry writes under the session's checkpoint folder (``scratch_path``).
"""

from __future__ import annotations

import hashlib
import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asklens.functions.text import ledger_id
from asklens.operators.bloom import BITS, KeyFilter


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, asked of its own file system.  Any other trouble (access, format) stays an error."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def complete(spark: SparkSession, path: str) -> bool:
    """Whether a Spark write to ``path`` was finished: a half-written folder has no ``_SUCCESS``."""
    return path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def fingerprint(df: DataFrame) -> str:
    """A digest of a table's rows, whatever their order: their count and the sum of their hashes."""
    hashes = F.xxhash64(*df.columns).cast("decimal(38,0)")
    n, total = df.agg(F.count(F.lit(1)), F.sum(hashes)).first()
    return f"{n}:{total or 0}"


def claim(spark: SparkSession, path: str, manifest: dict) -> None:
    """Bind an output folder to what it is made from.  A folder that a run with another manifest has claimed is refused."""
    at = f"{path.rstrip('/')}/_manifest"
    text = json.dumps(manifest, sort_keys=True)
    if complete(spark, at):
        found = spark.read.text(at).first()["value"]
        if found != text:
            raise ValueError(f"{path} belongs to another run: {found}, not {text}")
    else:
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(at)


def save(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists", **options) -> None:
    """Collection sink with an explicit save mode; Spark's default refuses to overwrite."""
    df.write.format(fmt).mode(mode).options(**options).save(path)


def save_snapshot(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Single-file JSON snapshot (A5).  ``coalesce(1)`` puts the write in one task,
    so use it only for results bounded by their key count (one row per group)."""
    df.coalesce(1).write.mode(mode).json(path)


def read_json(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def _run_folder(ledger_path: str, run_path: str) -> str:
    return os.path.join(ledger_path, "runs", hashlib.sha256(run_path.encode()).hexdigest()[:16])


def _folders(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder of the ledger: one a run or a compaction, none when it is not there."""
    if not path_exists(spark, path):
        return []
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return sorted(f.getPath().getName() for f in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p))


def _segments(spark: SparkSession, ledger_path: str) -> list[str]:
    """Finished segments: the ids of runs, and what compactions made of them."""
    runs = [os.path.join(ledger_path, "runs", n, "ids") for n in _folders(spark, os.path.join(ledger_path, "runs"))]
    merged = [os.path.join(ledger_path, "merged", n) for n in _folders(spark, os.path.join(ledger_path, "merged"))]
    return [p for p in runs + merged if complete(spark, p)]


def read_ledger(spark: SparkSession, ledger_path: str, key: str = "_id") -> DataFrame | None:
    """Ids of a ledger folder, or None when there is none yet: its lines (``id`` or ``id:::...``), and the ids of its segments."""
    if not path_exists(spark, ledger_path):
        return None
    ids = spark.read.text(ledger_path).select(ledger_id(F.col("value")).alias(key))
    segments = _segments(spark, ledger_path)
    return ids.unionByName(spark.read.schema("id string").parquet(*segments).select(F.col("id").alias(key))) if segments else ids


def _enter(records: DataFrame, ledger_path: str, run_path: str, key: str) -> None:
    """Put the ids of a finished run into the ledger, as a segment of its own."""
    ids = records.select(F.col(key).cast("string").alias("id"))
    ids.write.mode("overwrite").parquet(os.path.join(_run_folder(ledger_path, run_path), "ids"))


def recover_exports(spark: SparkSession, ledger_path: str, schema, key: str = "_id") -> set[str]:
    """Enter the runs that were written to their end but not into the ledger, as a crash between the two leaves them.
    Gives their paths."""
    found = set()
    for name in _folders(spark, os.path.join(ledger_path, "runs")):
        folder = os.path.join(ledger_path, "runs", name)
        if complete(spark, os.path.join(folder, "run")) and not complete(spark, os.path.join(folder, "ids")):
            run_path = spark.read.text(os.path.join(folder, "run")).first()["value"]
            if complete(spark, run_path):
                _enter(spark.read.schema(schema).json(run_path), ledger_path, run_path, key)
                found.add(run_path)
    return found


def incremental_export(docs: DataFrame, ledger_path: str, run_path: str, key: str = "_id", filter_bits: int = BITS) -> DataFrame:
    """Export documents not yet in the ledger as JSON lines into ``run_path``, and enter
    their ids into the ledger (A7, C7).  Returns the exported records, read back from ``run_path``.

    No record is exported twice.  A run is announced in the ledger before it is written; its records count once the write
    is finished, and a next run first enters the ids of finished runs that the ledger lacks.  A run that was
    cut off in its write may be started again with the same path, which it writes over; one cut off after it
    gives the records that it wrote.  A ``run_path`` that some other job wrote is refused.  One run at a time.

    The ledger grows for ever, a run does not: a Bloom filter of the run's keys thins the ledger in its scan, and
    the exact anti-join shuffles what passes (``KeyFilter``).
    """
    spark = docs.sparkSession
    ledger_path = ledger_path.rstrip("/")
    folder = _run_folder(ledger_path, run_path)
    if run_path in recover_exports(spark, ledger_path, docs.schema, key):
        return spark.read.schema(docs.schema).json(run_path)
    announced = complete(spark, os.path.join(folder, "run"))
    if path_exists(spark, run_path) and (not announced or complete(spark, os.path.join(folder, "ids"))):
        raise FileExistsError(run_path)
    done = read_ledger(spark, ledger_path, key)
    new = docs
    if done is not None:
        new = docs.join(KeyFilter(docs.select(F.col(key).cast("string").alias(key)), key, filter_bits).keep(done, key), key, "left_anti")
    if not announced:
        run = spark.createDataFrame([(run_path,)], "value string").coalesce(1)
        run.write.mode("overwrite").text(os.path.join(folder, "run"))
    new.select(*docs.columns).write.mode("overwrite").json(run_path)
    exported = spark.read.schema(docs.schema).json(run_path)
    _enter(exported, ledger_path, run_path, key)
    return exported


def compact_ledger(spark: SparkSession, ledger_path: str, files: int = 1) -> None:
    """Merge the finished segments of a ledger into one of ``files`` files, repeated ids once.  The old ones go when the new one is
    finished; a crash before that leaves ids twice in the ledger, which says the same."""
    old = _segments(spark, ledger_path)
    if len(old) < 2:
        return
    merged = os.path.join(ledger_path, "merged", uuid.uuid4().hex[:16])
    spark.read.schema("id string").parquet(*old).distinct().repartition(files, "id").write.parquet(merged)
    for path in old:
        # of a run, the announcement goes with its ids
        gone = spark._jvm.org.apache.hadoop.fs.Path(os.path.dirname(path) if path.endswith("/ids") else path)
        gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)


def write_lines(df: DataFrame, path: str, col: str = "line", mode: str = "append") -> None:
    df.select(F.col(col).alias("value")).write.mode(mode).text(path)
