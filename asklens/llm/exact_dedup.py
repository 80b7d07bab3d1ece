"""Exact dedup by skew-safe combining.

1. Each task combines its own rows with equal digest and equal text.
2. The winners are dealt by (digest, salt), the salt being the task they come from
   modulo ``salts``, and combined again: a group of copies that fills every
   task meets in ``salts`` tasks, with one row from each source task.
3. The salts' winners are combined by digest.

Every grouping key holds the full normalised text beside its digest, so a winner stands for equal
texts only.  The documents then look up their group by digest, second hash and length,
without their texts; should two different texts ever agree in all three, the job
fails instead of answering wrongly.

Defined cases: a null text is an empty text; null ids lose against any id (``keep_id`` is null if the whole
group has none); of rows that repeat the id that stays, exactly one stays; extra columns are not looked at;
an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asklens.llm.common import join_groups, numbered, written

SPACE = r"[\x20\x09-\x0D]+"
SALTS = 16
KEY = ["digest", "check", "chars"]


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def _identity(norm: Column, digest) -> list[Column]:
    return [digest(norm).alias("digest"), F.xxhash64(norm).alias("check"), F.length(norm).alias("chars")]


def sha256(text: Column) -> Column:
    return F.sha2(text, 256)


def copy_groups(texts: DataFrame, salts: int = SALTS, digest=sha256) -> DataFrame:
    """One row per distinct normalised text of ``texts(doc_id, norm)``: its identity, ``keep_id``, ``group_size``."""
    keyed = texts.select("doc_id", "norm", *_identity(F.col("norm"), digest),
                         F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"))
    # Spark's partial aggregation is step 1, the shuffle by (digest, text, salt) step 2
    salted = keyed.groupBy(*KEY, "norm", "salt").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("n"))
    whole = salted.groupBy(*KEY, "norm").agg(F.min("keep_id").alias("keep_id"), F.sum("n").alias("group_size"))
    alone = whole.drop("norm").groupBy(*KEY).agg(
        F.min("keep_id").alias("keep_id"), F.min("group_size").alias("group_size"), F.count(F.lit(1)).alias("texts"))
    clash = F.raise_error(F.lit("two different texts agree in digest, hash and length"))
    return alone.select(*KEY, "keep_id", F.when(F.col("texts") > 1, clash.cast("bigint"))
                        .otherwise(F.col("group_size")).alias("group_size"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None,
                salts: int = SALTS, digest=sha256) -> DataFrame:
    """One row per row of ``docs``: row_no, doc_id, keep_id, group_size, kept, digest.

    ``row_col`` names a column that numbers the rows of a written table; without it the rows are
    numbered here, as their identities are written."""
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    norm = docs.select(row.alias("row_no"), F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias("norm"))
    members = written(norm.select("row_no", "doc_id", *_identity(F.col("norm"), digest)), "members")
    groups = written(copy_groups(norm.select("doc_id", "norm"), salts, digest), "copy-groups")
    found = written(join_groups(members, groups, KEY, "group_size")
                    .withColumn("stays", F.col("doc_id").eqNullSafe(F.col("keep_id"))), "found")
    # rows that repeat the id that stays: only the first of them stays.  Usually there are none.
    first = written(found.where("stays").groupBy(*KEY).agg(F.min("row_no").alias("first_row"),
                                                           F.count(F.lit(1)).alias("stay")).where("stay > 1"), "ties")
    # rows that cannot stay look for a key that no group has, each another one
    asked = F.when(F.col("stays"), F.col("sha")).otherwise(F.concat(F.lit("-"), F.col("row_no")))
    tied = join_groups(found.withColumnRenamed("digest", "sha").withColumn("digest", asked), first, KEY, "stay", "left")
    kept = F.col("stays") & (F.col("first_row").isNull() | (F.col("first_row") == F.col("row_no")))
    return tied.select("row_no", "doc_id", "keep_id", "group_size", kept.alias("kept"), F.col("sha").alias("digest"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns as they were."""
    rows, row = numbered(docs)
    kept = exact_dedup(rows, id_col, text_col, row).where("kept").select(F.col("row_no").alias(row))
    return rows.join(kept, row, "left_semi").drop(row)
