"""Running sums inside groups of any size, with one shuffle and one written table."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from asklens.llm.common import map_batches, written


def ranged_sums(rows: DataFrame, group: str, order: list[Column], values: list[str], name: str) -> DataFrame:
    """``rows`` (written) with ``before_<value>``: the sum of each bigint value over the rows of the same group before it.

    Rows are dealt by ranges of (group, order), so a large group is spread over many tasks, and each task sums
    its own rows as they pass.  Only the first group of a part can have rows in earlier parts, so what to add is at most one
    row a part: it is broadcast.  ``group`` holds no nulls; order columns must tell rows apart or tied rows
    be alike."""
    sort = [F.col(group), *order]
    dealt = rows.repartitionByRange(*sort).sortWithinPartitions(*sort)
    at, n = rows.columns.index(group), len(values)
    places = [rows.columns.index(v) for v in values]
    names = [*rows.columns, "__part", "__seq", *[f"__in_{v}" for v in values]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq, last, carry = TaskContext.get().partitionId(), 0, None, np.zeros(n, dtype=np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            keys = b.column(at)
            new = np.ones(b.num_rows, dtype=bool)
            new[1:] = pc.not_equal(keys.slice(1), keys.slice(0, b.num_rows - 1)).to_numpy(zero_copy_only=False)
            goes_on = last is not None and keys[0].as_py() == last
            starts = np.flatnonzero(new)
            group_of = np.cumsum(new) - 1
            before = []
            for j, place in enumerate(places):
                v = b.column(place).to_numpy(zero_copy_only=False).astype(np.int64)
                ahead = np.cumsum(v) - v
                inside = ahead - ahead[starts][group_of]
                if goes_on:
                    inside[group_of == 0] += carry[j]
                carry[j] = inside[-1] + v[-1]
                before.append(pa.array(inside))
            last = keys[b.num_rows - 1].as_py()
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(b.num_rows, part, dtype=np.int32)),
                 pa.array(np.arange(seq, seq + b.num_rows, dtype=np.int64)), *before], names)
            seq += b.num_rows

    schema = ", ".join([*[f"`{c}` {t}" for c, t in rows.dtypes], "__part int", "__seq bigint", *[f"`__in_{v}` bigint" for v in values]])
    local = written(map_batches(dealt, run, schema), name)
    ends = local.groupBy("__part").agg(
        F.min_by(group, "__seq").alias("first_key"), F.max_by(group, "__seq").alias("last_key"),
        *[F.max_by(F.col(f"__in_{v}") + F.col(v), "__seq").alias(f"t_{v}") for v in values])
    # two rows a part: its first group asks, its last group gives
    both = ends.select("__part", F.lit(0).alias("gives"), F.col("first_key").alias("key"),
                       *[F.lit(0).cast("bigint").alias(f"t_{v}") for v in values]).unionByName(
        ends.select("__part", F.lit(1).alias("gives"), F.col("last_key").alias("key"), *[f"t_{v}" for v in values]))
    ahead = Window.partitionBy("key").orderBy("__part", "gives").rowsBetween(Window.unboundedPreceding, -1)
    offsets = both.select("__part", "gives", "key", *[F.sum(f"t_{v}").over(ahead).alias(f"o_{v}") for v in values]).where(
        "gives = 0 AND (" + " OR ".join(f"o_{v} <> 0" for v in values) + ")").select(
        F.col("__part").alias("o_part"), F.col("key").alias("o_key"), *[f"o_{v}" for v in values])
    joined = local.join(F.broadcast(offsets), (local["__part"] == offsets["o_part"]) & (local[group] == offsets["o_key"]), "left")
    return joined.select(*rows.columns, *[
        (F.col(f"__in_{v}") + F.coalesce(f"o_{v}", F.lit(0))).alias(f"before_{v}") for v in values])
