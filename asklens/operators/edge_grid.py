"""Weighted edges in a vertex-cut: a source's edges lie in as many cells as its degree asks for.

An edge lies in cell (source, column), the column being a hash of its target over the source's number of
columns.  That is one for a source with up to a task's share of edges and grows with its degree, so a source owning a
third of all edges is spread over a third of the tasks, by the same plan as all others.  A vertex's value is kept once
a column (mirrored).  Sources with several columns are fewer than there are shares, so their table is
broadcast, and the mirrors add less than two rows a share.

A round is one join on (vertex, column) with the cached cells, which keep their partitioning, and one aggregate with
map-side combine.  Each cell also holds a row that carries the vertex's running total into the
next round, so a round uses the last one's result once, and several rounds make one job without anything stored between.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asklens.operators.skew import partitions_for
from asklens.session import checkpoint, persist_partitioned


class EdgeGrid:
    """``wedges`` (src, dst, w); only vertices with in-edges ever hold a value, so only their out-edges are kept."""

    def __init__(self, wedges: DataFrame, cell_edges: int | None = None):
        n = wedges.count()
        parts = partitions_for(wedges.sparkSession, n, 40)
        share = cell_edges or max(1, math.ceil(n / parts))
        columns = wedges.groupBy(F.col("src").alias("id")).agg(F.ceil(F.count(F.lit(1)) / share).cast("int").alias("columns"))
        # fewer than n / share rows: each has more edges than a share
        self.wide = F.broadcast(checkpoint(columns.where("columns > 1")))
        holders = wedges.select(F.col("dst").alias("id")).distinct()
        kept = wedges.withColumnRenamed("src", "id")
        # ``weighted_edges`` tells the fed sources
        kept = self._columns(kept.where("fed") if "fed" in wedges.columns else kept.join(holders, "id", "left_semi"))
        kept = kept.select("id", F.pmod(F.xxhash64("dst"), F.col("columns")).cast("int").alias("column"), "dst", "w")
        kept = (kept.join(self.wide.withColumnsRenamed({"id": "dst", "columns": "mirrors"}), "dst", "left")
                .select("id", "column", "dst", "w", F.coalesce("mirrors", F.lit(1)).alias("mirrors")))
        carry = self._mirrored(holders).select("id", "column", F.col("id").alias("dst"), F.lit(None).cast("double").alias("w"),
                                               F.lit(None).cast("int").alias("mirrors"))
        self.cells = persist_partitioned(kept.unionByName(carry).repartition(parts, "id", "column"))

    def _columns(self, rows: DataFrame) -> DataFrame:
        return rows.join(self.wide, "id", "left").withColumn("columns", F.coalesce("columns", F.lit(1)))

    def _mirrored(self, rows: DataFrame) -> DataFrame:
        """``rows`` (id, ...) once for each column of the vertex."""
        wide = self._columns(rows)
        return wide.select(*rows.columns, F.explode(F.sequence(F.lit(0), F.col("columns") - 1)).alias("column"))

    def start(self, received: DataFrame) -> DataFrame:
        """State (id, column, total, delta) of vertices that received ``delta`` (id, delta)."""
        return self._mirrored(received).select("id", "column", F.col("delta").alias("total"), "delta")

    def step(self, state: DataFrame, least: float, scale: float) -> DataFrame:
        """One round: vertices whose delta exceeds ``least`` send ``delta * w``; a receiver's new delta is ``scale`` times the
        sum, null where nothing came, and joins its total.  Every column of a vertex gets the same messages."""
        carried = F.col("w").isNull()
        sent = (state.hint("shuffle_hash").join(self.cells, ["id", "column"]).where(carried | (F.col("delta") > F.lit(least)))
                .select(F.col("dst").alias("id"),
                        F.explode(F.when(carried, F.array("column")).otherwise(F.sequence(F.lit(0), F.col("mirrors") - 1))).alias("column"),
                        F.when(carried, F.col("total")).alias("t"), F.when(~carried, F.col("delta") * F.col("w")).alias("m")))
        sums = sent.groupBy("id", "column").agg(F.sum("t").alias("t"), (F.lit(scale) * F.sum("m")).alias("delta"))
        return sums.select("id", "column", (F.col("t") + F.coalesce("delta", F.lit(0.0))).alias("total"), "delta")

    def release(self) -> None:
        self.cells.unpersist()
