"""A table in buckets of its key, whose upsert rewrites the buckets it touches only.

Layout under one folder::

    data/_bucket=<b>/_write=<attempt>/...   files of one bucket as one attempt wrote them
    manifests/version-<n>/                  one row a bucket: the attempt that holds it, null while it is empty

A version is its manifest, and counts once that is finished (``_SUCCESS``).  An upsert writes the touched buckets
under an attempt name of its own, then the next manifest, which names the old files of all other buckets.  A crash before
that leaves files that no manifest names, and the version before stays what it was.  One writer at a time.

Scale: the key's hash spreads rows, so buckets are alike in size however skewed one key column is; choose ``buckets`` for
some 100 MB each.  The driver holds the manifest (one row a bucket), never rows.  An upsert reads, shuffles and writes
in proportion to the touched buckets and the new rows.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from asklens.operators.ratings import upsert
from asklens.session import checkpoint
from asklens.sources.io import complete

MANIFEST = "bucket int, attempt string"


class BucketedTable:
    """``keys`` and ``buckets`` hold for the life of a table: another bucket count than the manifest's is refused."""

    def __init__(self, spark: SparkSession, path: str, schema, keys=("UId", "QId"), buckets: int = 64, fmt: str = "parquet"):
        if buckets < 1:
            raise ValueError("a table has one bucket at least")
        self.spark, self.path, self.keys, self.buckets, self.fmt = spark, path.rstrip("/"), list(keys), buckets, fmt
        self.schema = spark.createDataFrame([], schema).schema
        self.data = os.path.join(self.path, "data")
        if {"_bucket", "_write"} & set(self.schema.names):
            raise ValueError("_bucket and _write are the table's own columns")

    def manifest_path(self, version: int) -> str:
        return os.path.join(self.path, "manifests", f"version-{version:06d}")

    def version(self) -> int:
        """The newest finished version, 0 before the first."""
        n = 0
        while complete(self.spark, self.manifest_path(n + 1)):
            n += 1
        return n

    def manifest(self, version: int | None = None) -> dict[int, str | None]:
        """bucket -> the attempt that holds it."""
        version = self.version() if version is None else version
        if not version:
            return dict.fromkeys(range(self.buckets))
        rows = self.spark.read.schema(MANIFEST).json(self.manifest_path(version)).collect()
        if len(rows) != self.buckets:
            raise ValueError(f"{self.path} has {len(rows)} buckets, not {self.buckets}")
        return {r["bucket"]: r["attempt"] for r in rows}

    def bucket_of(self) -> Column:
        """The bucket of a row: its keys as the schema types them, hashed."""
        return F.pmod(F.xxhash64(*[F.col(k).cast(self.schema[k].dataType) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def read(self, version: int | None = None, only=None) -> DataFrame:
        """The rows of a version (the newest), or of its buckets ``only``."""
        held = self.manifest(version)
        paths = [os.path.join(self.data, f"_bucket={b}", f"_write={a}") for b, a in sorted(held.items())
                 if a is not None and (only is None or b in only)]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.format(self.fmt).schema(self.schema).option("basePath", self.data).load(paths)
        return rows.select(*self.schema.names)

    def upsert(self, new: DataFrame) -> int:
        """Insert-or-replace the rows of ``new`` by key; gives the version that holds them.  Two new rows of one key are an
        error, and so is a null key, which no later row could replace."""
        held, version = self.manifest(), self.version()
        null = F.lit(False)
        for k in self.keys:
            null = null | F.col(k).isNull()
        refuse = F.raise_error(F.lit(f"a new row without {', '.join(self.keys)}")).cast("boolean")
        # read twice below, and the buckets it touches must be those it writes
        new = checkpoint(new.select(*[F.col(f.name).cast(f.dataType) for f in self.schema]).where(F.when(null, refuse).otherwise(True)))
        touched = {r[0] for r in new.select(self.bucket_of()).distinct().collect()}
        if version and not touched:
            return version
        attempt = f"{version + 1:06d}-{uuid.uuid4().hex[:12]}"
        merged = upsert(self.read(version, touched), new, self.keys).select(*self.schema.names, self.bucket_of().alias("_bucket"))
        (merged.repartition(max(1, len(touched)), "_bucket").withColumn("_write", F.lit(attempt))
         .write.format(self.fmt).partitionBy("_bucket", "_write").mode("append").save(self.data))
        self._commit(version + 1, {**held, **dict.fromkeys(touched, attempt)})
        return version + 1

    def _commit(self, version: int, held: dict) -> None:
        rows = self.spark.createDataFrame(sorted(held.items()), MANIFEST)
        rows.coalesce(1).write.option("ignoreNullFields", "false").mode("overwrite").json(self.manifest_path(version))
