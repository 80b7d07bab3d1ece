"""Counts by school, business and location (D1-D3) and the nested-path projection.

All are ``explode`` + ``groupBy().count()``: Spark runs a partial count per
task before the shuffle, so the shuffled volume is bounded by the number of
distinct keys per task, whatever the skew of the key.  ``explode`` drops null
and empty arrays; a null element is its own (null) group, as is a null scalar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_by_exploded(df: DataFrame, array_path: str, alias: str) -> DataFrame:
    return df.select(F.explode(F.col(array_path)).alias(alias)).groupBy(alias).count()


def school_count(profiles: DataFrame) -> DataFrame:
    return count_by_exploded(profiles, "educations.school", "school")


def location_count(profiles: DataFrame) -> DataFrame:
    return count_by_exploded(profiles, "locations", "location")


def business_count(profiles: DataFrame) -> DataFrame:
    return profiles.select("business").groupBy("business").count()


def nested_path_project(profiles: DataFrame) -> DataFrame:
    """One row per education element: (_id, school)."""
    return profiles.select("_id", F.explode(F.col("educations.school")).alias("school"))
