"""Crawl bookkeeping as set operations.

The reference keeps text files of discovered and finished users and scans
them linearly per request; here the lists are DataFrames and "not yet
done" is an anti-join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asklens.functions.text import ledger_id
from asklens.operators.recommend import topk_per_group

# The crawler's caps.
FOLLOW_LIMIT = 100    # follows kept per user
USER_LIMIT = 25_000   # discovered users kept


def first_seen(discovered: DataFrame, user: str = "user", pos=("l_orderkey", "l_linenumber")) -> DataFrame:
    """(user, first_order, first_line): first position per user -- a partial ``min``."""
    p = F.min(F.struct(*[F.col(c) for c in pos])).alias("_p")
    return (discovered.groupBy(user).agg(p)
            .select(user, F.col(f"_p.{pos[0]}").alias("first_order"),
                    F.col(f"_p.{pos[1]}").alias("first_line")))


def done_ids(ledger: DataFrame, value: str = "value") -> DataFrame:
    return ledger.select(ledger_id(F.col(value)).alias("user")).distinct()


def pending(discovered: DataFrame, ledger: DataFrame, user: str = "user") -> DataFrame:
    """Users discovered but not in the done ledger, with their first position."""
    return first_seen(discovered, user).join(done_ids(ledger).withColumnRenamed("user", user),
                                             user, "left_anti")


def next_pending(discovered: DataFrame, ledger: DataFrame) -> DataFrame:
    """The first pending user in discovery order (F3): a bounded top-1."""
    return pending(discovered, ledger).orderBy("first_order", "first_line", "user").limit(1)


def follow_totals(rows: DataFrame, user: str = "user") -> DataFrame:
    """Follows per user, plus the grand total (user = NULL), repeats counted."""
    return rows.rollup(user).agg(F.count(F.lit(1)).alias("follow_total_count"))


def follow_cap(rows: DataFrame, n: int = FOLLOW_LIMIT, user: str = "user",
               order=("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")) -> DataFrame:
    """The first n follows of each user, in list order."""
    return topk_per_group(rows, user, [F.col(c) for c in order], n, position="pos")


def global_cap(discovered: DataFrame, n: int = USER_LIMIT, user: str = "user") -> DataFrame:
    """The first n distinct users in discovery order."""
    return first_seen(discovered, user).orderBy("first_order", "first_line", user).limit(n)
