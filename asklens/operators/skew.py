"""Hot-key detection.

A key is *hot* when its rows (or work) exceed a task's fair share.  The
threshold is ``max(min_rows, total / max_keys)``, so by pigeonhole at most
``max_keys`` keys can qualify: the hot-key table has a proven size bound and
may be broadcast.  Whoever splits such a key buckets its rows by a hash of their content
(``xxhash64``), never ``rand()``, so a recomputed task after an executor loss routes every row to
the same bucket as the first attempt.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from asklens.session import checkpoint, default_parallelism

DEFAULT_MIN_ROWS = 2_000_000   # rows a single task handles comfortably
DEFAULT_MAX_KEYS = 50_000      # upper bound on the broadcast hot-key table


TARGET_PARTITION_BYTES = 128 << 20


def partitions_for(spark, rows: float, row_bytes: int) -> int:
    """Partition count for ``rows`` rows of about ``row_bytes`` bytes: ~128 MB each,
    never fewer than the cluster's default parallelism."""
    want = math.ceil(float(rows) * row_bytes / TARGET_PARTITION_BYTES)
    return max(default_parallelism(spark), want, 1)


def hot_keys(df: DataFrame, key: str, weight: Column | None = None,
             min_rows: int = DEFAULT_MIN_ROWS, max_keys: int = DEFAULT_MAX_KEYS,
             with_total: bool = False):
    """Return (hot key table, its row count[, total weight]).  At most ``max_keys`` rows."""
    from pyspark import StorageLevel

    w = weight if weight is not None else F.lit(1)
    per_key = df.groupBy(key).agg(F.sum(w).alias("_w")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        total, top = per_key.agg(F.sum("_w"), F.max("_w")).first()
        total = float(total or 0)
        threshold = max(float(min_rows), total / float(max_keys))
        if top is None or float(top) <= threshold:  # the usual case: nothing is hot
            out = (per_key.limit(0).select(key), 0)
        else:
            hot = checkpoint(per_key.where(F.col("_w") > F.lit(threshold)).select(key))
            out = (hot, hot.count())
        return out + (total,) if with_total else out
    finally:
        per_key.unpersist()
