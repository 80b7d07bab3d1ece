"""Scan of the driver's parquet tables.

Every read is a plain ``spark.read.parquet`` so Catalyst prunes columns and
pushes filters into the scan; callers select only the columns they need.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


class Tables:
    """Lazy accessor: ``Tables(spark, sf_dir).orders`` is a DataFrame over orders.parquet."""

    def __init__(self, spark: SparkSession, sf_dir: str, fmt: str = "parquet"):
        self.spark = spark
        self.sf_dir = sf_dir
        self.fmt = fmt

    def load(self, name: str) -> DataFrame:
        path = os.path.join(self.sf_dir, f"{name}.{self.fmt}")
        return self.spark.read.format(self.fmt).load(path)

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLE_NAMES:
            return self.load(name)
        raise AttributeError(name)


def read_collection(spark: SparkSession, path: str, fmt: str = "parquet",
                    schema=None, **options) -> DataFrame:
    """Document-collection scan (A2): the format is a parameter, the schema explicit when known."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)
