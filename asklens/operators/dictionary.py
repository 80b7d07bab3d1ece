"""A vertex dictionary that grows: ids of tokens stay what they were, new tokens get the next ones.

The dictionary is a folder of versions.  A load writes one version with the tokens that no finished version has, numbered in
sort order from the number of tokens so far, so the ids of all versions together are dense, and
those of the versions before never move.  A version counts once its write is finished (``_SUCCESS``); a load
that was cut off leaves an unfinished folder, which the next load writes over.  One load at a time.

Scale: a load reads the old versions once for an anti-join on the token and sorts its new tokens only, by ranges.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from asklens.operators.graph import dense_index
from asklens.sources.io import complete

SCHEMA = "id bigint, node string"


def version_path(path: str, version: int) -> str:
    return os.path.join(path, f"version-{version:06d}")


def versions(spark: SparkSession, path: str) -> int:
    """The number of finished versions."""
    n = 0
    while complete(spark, version_path(path, n + 1)):
        n += 1
    return n


def read(spark: SparkSession, path: str) -> DataFrame:
    """(id, node, version) of all finished versions."""
    out = spark.createDataFrame([], SCHEMA + ", version int")
    for v in range(1, versions(spark, path) + 1):
        part = spark.read.schema(SCHEMA).parquet(version_path(path, v))
        out = part.withColumn("version", F.lit(v)) if v == 1 else out.unionByName(part.withColumn("version", F.lit(v)))
    return out


def grow(spark: SparkSession, path: str, tokens: DataFrame) -> DataFrame:
    """Add the tokens of a one-column table that are not in the dictionary yet; nulls have no id.  Gives ``read``."""
    known, number = read(spark, path), versions(spark, path) + 1
    asked = tokens.select(F.col(tokens.columns[0]).cast("string").alias("node")).where("node IS NOT NULL").distinct()
    new = dense_index(asked.join(known.select("node"), "node", "left_anti"), "node")
    base = known.count()
    new.select((F.col("id") + base).alias("id"), "node").write.mode("overwrite").parquet(version_path(path, number))
    return read(spark, path)
