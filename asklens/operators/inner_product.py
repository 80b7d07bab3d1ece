"""Exact maximum inner product search over two factor tables, without scoring all pairs.

Items are dealt into blocks by falling norm.  By Cauchy-Schwarz no item of a block can score higher for a user than
the user's norm times the block's largest norm, so a user whose k-th best score is above that bound is done with this block
and with all later ones.  Blocks are visited in rounds of one, one, two, four, ... blocks: each round takes the users that are not done, sends
each to the blocks of the round that its bound still allows, and the k best so far, now with a higher
threshold, go into the next round.  The result is exact, ties included: equal scores go to the smaller item id.

Scale: a block is a few thousand items; the users of a block are dealt over as many groups as their number asks for, each
with a copy of the block, so neither a popular block nor many users meet in one task.  Every round's state is written to
the shared scratch folder.  Scores are 32-bit dot products, as MLlib's are; the bound has a margin for their rounding.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from asklens.session import scratch_path

BLOCK_ITEMS = 4096
GROUP_USERS = 16384
MARGIN = 1e-5


@dataclass
class TopItems:
    """``best``: user, item, rating, position (from 1).  ``rounds``: round, users, pairs (scored in that round)."""

    best: DataFrame
    rounds: DataFrame


def norm(vector: str) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x))


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _scorer(k: int):
    def score(users, items):
        import numpy as np
        import pandas as pd

        if not len(users) or not len(items):
            return pd.DataFrame({"user": [], "item": [], "rating": []}).astype({"user": "int64", "item": "int64", "rating": "float32"})
        items = items.sort_values("item")
        ids = items["item"].to_numpy()
        factors = np.stack(items["features"].to_numpy()).astype(np.float32)
        out = []
        for at in range(0, len(users), 1024):
            some = users.iloc[at:at + 1024]
            ratings = np.stack(some["features"].to_numpy()).astype(np.float32) @ factors.T
            # the k largest of each row; of equal ones those of the smaller ids, as the sort is stable
            places = np.argsort(-ratings, axis=1, kind="stable")[:, :k]
            out.append(pd.DataFrame({"user": np.repeat(some["user"].to_numpy(), places.shape[1]), "item": ids[places].ravel(),
                                     "rating": np.take_along_axis(ratings, places, axis=1).ravel()}))
        return pd.concat(out, ignore_index=True)

    return score


def top_items(users: DataFrame, items: DataFrame, k: int, block_items: int = BLOCK_ITEMS,
              group_users: int = GROUP_USERS) -> TopItems:
    """The ``k`` items of largest inner product of every user.  ``users``, ``items``: id bigint, features array<float>.

    Ids are unique in each table; users without items give no rows."""
    spark = users.sparkSession
    n_items = items.count()
    rounds: list[tuple[int, int, int]] = []
    empty = spark.createDataFrame([], "user bigint, item bigint, rating float, position int")
    if not n_items:
        return TopItems(empty, spark.createDataFrame([], "round int, users bigint, pairs bigint"))
    n_blocks = -(-n_items // block_items)
    dealt = _written(items.select(F.col("id").cast("bigint").alias("item"), "features", norm("features").alias("norm"))
                     .repartitionByRange(n_blocks, F.col("norm").desc(), "item")
                     .withColumn("block", F.spark_partition_id()), "item-blocks")
    sizes = dealt.groupBy("block").agg(F.max("norm").alias("bound"), F.count(F.lit(1)).alias("size"))
    # a row a block; blocks that the range sampling left empty vanish here
    order = Window.orderBy("block")
    blocks = _written(sizes.withColumn("place", F.row_number().over(order) - 1), "item-bounds")
    n_blocks = blocks.count()
    dealt = dealt.join(F.broadcast(blocks.select("block", "place")), "block").drop("block")
    people = _written(users.select(F.col("id").cast("bigint").alias("user"), "features", norm("features").alias("norm")), "people")
    best = _written(empty, "best")
    lo, step = 0, 1
    while lo < n_blocks:
        hi = min(n_blocks, lo + step)
        bounds = blocks.where(F.col("place").between(lo, hi - 1)).agg(
            F.transform(F.array_sort(F.collect_list(F.struct("place", "bound"))), lambda x: x["bound"])).scalar()
        threshold = best.where(F.col("position") == k).select("user", F.col("rating").alias("kth"))
        open_ = people.join(threshold, "user", "left").withColumn("bounds", bounds)
        needed = F.size(F.filter("bounds", lambda b: F.col("kth").isNull() | (
            b * F.col("norm") * (1 + MARGIN) + MARGIN >= F.col("kth"))))
        asked = _written(open_.withColumn("needed", needed).where("needed > 0").select("user", "features", "needed"), "open-users")
        n_users = asked.count()
        if not n_users:
            break  # the bounds fall: nobody needs a later block either
        groups = -(-n_users // group_users)
        group = F.pmod(F.xxhash64("user"), F.lit(groups)).cast("int")
        visits = asked.select("user", "features", group.alias("grp"), F.explode(
            F.sequence(F.lit(lo), F.col("needed") + (lo - 1))).alias("place"))
        here = dealt.where(F.col("place").between(lo, hi - 1)).select("item", "features", "place", F.explode(
            F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp"))
        found = visits.groupBy("place", "grp").cogroup(here.groupBy("place", "grp")).applyInPandas(
            _scorer(k), "user bigint, item bigint, rating float")
        merged = best.drop("position").unionByName(found)
        w = Window.partitionBy("user").orderBy(F.col("rating").desc(), "item")
        best = _written(merged.withColumn("position", F.row_number().over(w)).where(F.col("position") <= k), "best")
        pairs = asked.groupBy("needed").count().join(
            F.broadcast(blocks.select(F.col("place"), "size")), F.col("place").between(lo, F.col("needed") + (lo - 1))).agg(
            F.sum(F.col("count") * F.col("size")).alias("n")).first()["n"]
        rounds.append((len(rounds), n_users, int(pairs)))
        lo, step = hi, hi
    return TopItems(best, spark.createDataFrame(rounds, "round int, users bigint, pairs bigint"))
