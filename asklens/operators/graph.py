"""Follow graph: vertex ids, edges, degrees, PageRank, two-hop recommendation,
ranked subgraphs and ego networks (I1-I11), all as DataFrame jobs.

Representation: ``vertices (id bigint, node string)`` and ``edges (srcId,
dstId, relation)`` with one row per follow (multi-edges kept).  The
algorithms work on *merged* edges ``(srcId, dstId, m)``: parallel follows
collapsed to a multiplicity, which is exactly how every measure here counts
them (out-degree, message weight, two-hop path count).
"""

from __future__ import annotations

from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from asklens.operators.bloom import BITS, KeyFilter
from asklens.operators.edge_grid import EdgeGrid
from asklens.operators.skew import DEFAULT_MAX_KEYS, DEFAULT_MIN_ROWS, hot_keys, partitions_for
from asklens.operators.two_hop_cells import BLOCK_EDGES, best_candidates, count_in_cells, per_user_parts
from asklens.session import checkpoint, drop_unused, persist_partitioned
from asklens.sources.io import claim, complete, fingerprint

RESET = 0.15  # PageRank reset probability
BROADCAST_NODES = 1_000_000  # ids (8 MB) that a subgraph's semi-joins send to every task
EDGE_CHUNK = 10_000  # copies of one edge spelled out at a time
SHUFFLED_PATHS = 10_000_000  # two-hop paths that are shuffled rather than counted in cells


# ---------------------------------------------------------------- build

def follow_pairs(docs: DataFrame, direction: str = "follow") -> DataFrame:
    """(src, dst) tokens, one row per follow.  ``direction='reversed'`` swaps the
    ends, which is what the reference's ordinal re-read produces (SURVEY T2)."""
    pairs = docs.select(F.col("urlToken").alias("src"),
                        F.explode(F.col("following.urlToken")).alias("dst"))
    if direction == "reversed":
        return pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    if direction != "follow":
        raise ValueError(f"direction must be 'follow' or 'reversed', not {direction!r}")
    return pairs


def dense_index(keys: DataFrame, key: str, id_col: str = "id") -> DataFrame:
    """Dense 0-based index of distinct ``key`` values in sort order.

    Range-partition and sort, number rows inside each partition, then add the
    partition's offset (a running sum over one row per partition -- bounded by
    the partition count, so it is broadcast).  The numbered frame is
    checkpointed once, so the sizes and the ids come from the same
    materialisation and stay stable across recomputation (SURVEY T3).
    """
    ranged = (keys.repartitionByRange(F.col(key))
              .sortWithinPartitions(key)
              .select(key, F.spark_partition_id().alias("_pid"),
                      F.monotonically_increasing_id().alias("_mid")))
    ranged = checkpoint(ranged)
    sizes = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (ranged.join(F.broadcast(offsets), "_pid")
            .select((F.col("_off") + local).alias(id_col), F.col(key)))


def rank_within_group(df: DataFrame, group: str, order, rank_col: str = "rank") -> DataFrame:
    """0-based position of each row within its ``group`` by ``order`` (one or more columns).

    The same offset technique as ``dense_index``, per group: rows are range
    partitioned by (group, order), so a group larger than a partition spans
    several partitions and no task holds a whole hot group.  The offset of a
    group inside partition p is a running sum over the group's rows of
    (group, partition) counts -- one row per partition it spans, a bounded
    window.  The numbered frame is checkpointed once (stable positions).
    """
    orders = [order] if isinstance(order, str) else list(order)
    ranged = (df.repartitionByRange(F.col(group), *[F.col(o) for o in orders])
              .sortWithinPartitions(group, *orders)
              .select("*", F.spark_partition_id().alias("_pid"),
                      F.monotonically_increasing_id().alias("_mid")))
    ranged = checkpoint(ranged)
    spans = ranged.groupBy(group, "_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mid").alias("_first"))
    before = Window.partitionBy(group).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(group, "_pid", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (ranged.join(spans, [group, "_pid"])
            .withColumn(rank_col, F.col("_off") + F.col("_mid") - F.col("_first"))
            .drop("_pid", "_mid", "_first", "_off"))


def vertex_ids(pairs: DataFrame) -> DataFrame:
    """(id, node): every token that follows or is followed, densely numbered by token."""
    nodes = pairs.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    return dense_index(nodes, "node").select("id", "node")


def _resolve(pairs: DataFrame, vertices: DataFrame, *keep: str) -> DataFrame:
    v_src = vertices.select(F.col("node").alias("src"), F.col("id").alias("srcId"))
    v_dst = vertices.select(F.col("node").alias("dst"), F.col("id").alias("dstId"))
    return pairs.join(v_src, "src").join(v_dst, "dst").select("srcId", "dstId", *keep)


def follow_edges(pairs: DataFrame, vertices: DataFrame, relation: str = "following") -> DataFrame:
    """(srcId, dstId, relation): both ends resolved by inner joins; multi-edges kept."""
    return _resolve(pairs, vertices).withColumn("relation", F.lit(relation))


def merged_edges(pairs: DataFrame, vertices: DataFrame) -> DataFrame:
    """(srcId, dstId, m): parallel follows merged before the id joins (fewer rows to join)."""
    mp = pairs.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("m"))
    return _resolve(mp, vertices, "m")


def merge(edges: DataFrame) -> DataFrame:
    return edges.groupBy("srcId", "dstId").agg(F.count(F.lit(1)).alias("m"))


class FollowGraph:
    """A follow graph; each part is built when first asked for.

    Vertices need the distinct tokens only, degrees a count per token and one join with
    the vertices.  For everything else parallel follows are merged on the tokens first (a
    partial count), so the id joins run over distinct pairs, and the resolved pairs are
    materialised once with a reliable checkpoint, as are the range-numbered tokens (inside
    ``dense_index``; a recomputation could re-sample the ranges).  Asked for first, the edges
    number the vertices from the merged pairs, so the pairs themselves are made once.
    """

    def __init__(self, pairs: DataFrame):
        self.pairs = pairs

    @classmethod
    def from_docs(cls, docs: DataFrame, direction: str = "follow") -> "FollowGraph":
        return cls(follow_pairs(docs, direction))

    @cached_property
    def vertices(self) -> DataFrame:
        return vertex_ids(self.pairs)

    @cached_property
    def medges(self) -> DataFrame:
        """(srcId, dstId, m)."""
        if "vertices" in self.__dict__:
            return checkpoint(merged_edges(self.pairs, self.vertices))
        merged = self.pairs.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("m")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            self.vertices = vertex_ids(merged)
            drop_unused(merged.sparkSession)  # what the vertices were numbered by
            return checkpoint(_resolve(merged, self.vertices, "m"))
        finally:
            merged.unpersist()

    def edges(self, relation: str = "following") -> DataFrame:
        """(srcId, dstId, relation), one row per follow: every merged edge as often as it occurs, no join.

        A multiplicity is spelled out in chunks of ``EDGE_CHUNK`` so one pair followed
        a billion times is never one array."""
        chunks = self.medges.select("srcId", "dstId", "m", F.explode(
            F.sequence(F.lit(0).cast("long"), F.expr(f"(m - 1) div {EDGE_CHUNK}"))).alias("c"))
        copies = F.least(F.col("m") - F.col("c") * EDGE_CHUNK, F.lit(EDGE_CHUNK).cast("long"))
        return (chunks.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), copies)))
                .select("srcId", "dstId", F.lit(relation).alias("relation")))

    def _degree(self, end: str, name: str) -> DataFrame:
        counts = self.pairs.groupBy(F.col(end).alias("node")).agg(F.count(F.lit(1)).alias(name))
        return counts.join(self.vertices, "node").select("id", name)

    def in_degrees(self) -> DataFrame:
        return self._degree("dst", "in_degree")

    def out_degrees(self) -> DataFrame:
        return self._degree("src", "out_degree")


# ---------------------------------------------------------------- degrees

def in_degree(medges: DataFrame) -> DataFrame:
    return medges.groupBy(F.col("dstId").alias("id")).agg(F.sum("m").alias("in_degree"))


def out_degree(medges: DataFrame) -> DataFrame:
    return medges.groupBy(F.col("srcId").alias("id")).agg(F.sum("m").alias("out_degree"))


# ---------------------------------------------------------------- PageRank

def weighted_edges(medges: DataFrame) -> DataFrame:
    """(src, dst, w, fed): w = m / out-degree(src), the share of src's value each edge carries; fed: src has in-edges.

    Both are facts of the source, joined to the edges at once, so that no later step joins the edges with the receivers."""
    deg = medges.groupBy("srcId").agg(F.sum("m").alias("_d"))
    fed = _receivers(medges).select(F.col("src").alias("srcId"), F.lit(True).alias("_f"))
    sources = deg.join(fed, "srcId", "left")
    return (medges.join(sources, "srcId")
            .select(F.col("srcId").alias("src"), F.col("dstId").alias("dst"),
                    (F.col("m").cast("double") / F.col("_d")).alias("w"), F.col("_f").isNotNull().alias("fed")))


class _Spreader:
    """Sends a per-vertex value x along weighted out-edges: rows (dst, x * w).

    Edges of ordinary sources are hash-partitioned by src once and cached, so
    each round shuffles only the per-vertex values (and the messages, after a
    map-side partial sum).  Edges of *hot* sources -- a source owning more than
    a task's share of edges -- are kept apart, spread evenly, and joined against
    a broadcast of the hot sources' values (at most ``max_keys`` rows).
    """

    def __init__(self, wedges: DataFrame, min_rows: int, max_keys: int):
        self.hot, self.n_hot, n_edges = hot_keys(wedges, "src", min_rows=min_rows, max_keys=max_keys,
                                                 with_total=True)
        # sized from the edge count (src, dst, w: ~24 bytes a row), not from the
        # session's shuffle-partition setting, so small graphs do not pay for
        # hundreds of empty tasks every round and large ones get ~128 MB tasks
        parts = partitions_for(wedges.sparkSession, n_edges, 24)
        cold = wedges
        if self.n_hot:
            cold = wedges.join(F.broadcast(self.hot), "src", "left_anti")
            self.hot_edges = persist_partitioned(wedges.join(F.broadcast(self.hot), "src", "left_semi")
                                                    .repartition(parts, "src", "dst"))
        # cached with its hash partitioning by src kept, so no round re-shuffles the edges
        self.cold = persist_partitioned(cold.repartition(parts, "src"))

    def spread(self, values: DataFrame) -> DataFrame:
        """values (src, x) -> contributions (dst, c)."""
        out = self.cold.join(values, "src").select("dst", (F.col("x") * F.col("w")).alias("c"))
        if self.n_hot:
            hot_values = values.join(F.broadcast(self.hot), "src", "left_semi")
            hot = (self.hot_edges.join(F.broadcast(hot_values), "src")
                   .select("dst", (F.col("x") * F.col("w")).alias("c")))
            out = out.unionByName(hot)
        return out

    def release(self):
        self.cold.unpersist()
        if self.n_hot:
            self.hot_edges.unpersist()


def _receivers(medges: DataFrame) -> DataFrame:
    """Vertices with at least one in-edge, as ``src`` (the only ones whose rank can change)."""
    return medges.select(F.col("dstId").alias("src")).distinct()


def _normalise(ranks: DataFrame) -> DataFrame:
    """Scale so ranks sum to the number of vertices (the sink correction)."""
    n, total = ranks.agg(F.count(F.lit(1)), F.sum("rank")).first()
    if not total:
        return ranks
    return ranks.select("id", (F.col("rank") * F.lit(float(n)) / F.lit(float(total))).alias("rank"))


def _final_ranks(vertices: DataFrame, sums: DataFrame | None, reset: float, scale: float) -> DataFrame:
    """rank = reset + scale * sum for vertices that received, reset for the others."""
    if sums is None:
        return vertices.select("id", F.lit(float(reset)).alias("rank"))
    return (vertices.select("id").join(sums.withColumnRenamed("dst", "id"), "id", "left")
            .select("id", (F.lit(reset) + F.lit(scale) * F.coalesce(F.col("s"), F.lit(0.0))).alias("rank")))


def pagerank_fixed(vertices: DataFrame, medges: DataFrame, rounds: int = 10, reset: float = RESET,
                   checkpoint_every: int = 5, min_rows: int = DEFAULT_MIN_ROWS,
                   max_keys: int = DEFAULT_MAX_KEYS) -> DataFrame:
    """Static PageRank: start 1.0, ``rank = reset + (1-reset) * sum(rank(src) * w)``, ``rounds``
    times, then scaled to sum N.  -> (id, rank).

    Exact shortcuts: in round 1 every rank is 1.0, so the sums are a plain
    aggregate of edge weights (no join).  From round 2 on a vertex without
    in-edges has rank ``reset`` for good, so its edges add a constant
    ``reset * w``, aggregated once; each later round spreads only along edges
    whose source has in-edges, and only those vertices carry a value.
    """
    if rounds <= 0:
        return _normalise(vertices.select("id", F.lit(1.0).alias("rank")))
    drop_unused(medges.sparkSession)  # what the graph was built from
    wedges = weighted_edges(medges).persist(StorageLevel.MEMORY_AND_DISK)
    sums = wedges.groupBy("dst").agg(F.sum("w").alias("s"))  # round 1: every rank is 1.0
    sp = None
    if rounds > 1:
        base = checkpoint(wedges.where("NOT fed")
                          .groupBy("dst").agg((F.lit(reset) * F.sum("w")).alias("c")))
        sp = _Spreader(wedges.where("fed").select("src", "dst", "w"), min_rows, max_keys)
        for i in range(1, rounds):
            values = sums.select(F.col("dst").alias("src"),
                                 (F.lit(reset) + F.lit(1.0 - reset) * F.col("s")).alias("x"))
            sums = (sp.spread(values).unionByName(base)
                    .groupBy("dst").agg(F.sum("c").alias("s")))
            if (i + 1) % checkpoint_every == 0 and i + 1 < rounds:
                sums = checkpoint(sums)
    ranks = checkpoint(_final_ranks(vertices, sums, reset, 1.0 - reset))
    if sp is not None:
        sp.release()
    wedges.unpersist()
    return _normalise(ranks)


def pagerank_converged(vertices: DataFrame, medges: DataFrame, tol: float = 1e-4,
                       reset: float = RESET, max_rounds: int = 10_000, fold_every: int = 8,
                       cell_edges: int | None = None) -> DataFrame:
    """Delta PageRank run until no vertex sends (GraphX ``pageRank(tol)`` semantics).

    Every vertex starts with rank = delta = reset.  In each round the vertices
    that received messages in the previous round (all, at first) and whose
    delta exceeds ``tol`` send ``delta * m / outdeg`` along each out-edge; a
    receiver adds ``(1-reset) * sum`` to its rank and takes it as its new
    delta.  Round 1 is a plain aggregate of edge weights (every sender sends
    ``reset``); later senders are receivers, so later rounds run on the ``EdgeGrid`` of
    edges whose source has in-edges (``cell_edges``: edges a cell, by default a task's share).
    ``fold_every`` rounds are one job that ends in the only checkpoint.  A round without messages makes every
    later round empty, so testing for the end there gives the same result as testing each round.
    """
    if reset <= tol:  # nobody ever sends
        return _normalise(_final_ranks(vertices, None, reset, 0.0))
    wedges = weighted_edges(medges).persist(StorageLevel.MEMORY_AND_DISK)
    first = wedges.groupBy(F.col("dst").alias("id")).agg((F.lit(1.0 - reset) * (F.lit(reset) * F.sum("w"))).alias("delta"))
    grid = EdgeGrid(wedges, cell_edges)
    state = checkpoint(grid.start(first))
    wedges.unpersist()
    done, senders = 1, not state.isEmpty()
    while senders:
        if done >= max_rounds:
            raise RuntimeError(f"PageRank still sends messages after {max_rounds} rounds (tol={tol})")
        rounds = min(fold_every, max_rounds - done)
        for _ in range(rounds):
            state = grid.step(state, tol, 1.0 - reset)
        state = checkpoint(state)
        done += rounds
        senders = not state.where("delta IS NOT NULL").isEmpty()
    total = state.where(F.col("column") == 0).select(F.col("id").alias("dst"), F.col("total").alias("s"))
    ranks = checkpoint(_final_ranks(vertices, total, reset, 1.0))
    grid.release()
    return _normalise(ranks)


# ---------------------------------------------------------------- ranked tables

def ranked_vertices(vertices: DataFrame, ranks: DataFrame) -> DataFrame:
    return vertices.join(ranks, "id").select("id", "node", "rank")


def rank_degrees(ranked: DataFrame, medges: DataFrame) -> DataFrame:
    """Inner joins throughout: a vertex without in- or out-edges is not listed (T5)."""
    return (ranked.join(in_degree(medges), "id").join(out_degree(medges), "id")
            .select("id", "node", "rank", "in_degree", "out_degree"))


# ---------------------------------------------------------------- neighbours

def collect_neighbors(vertices: DataFrame, medges: DataFrame, page_size: int = 1000) -> DataFrame:
    """Out-neighbours per vertex as bounded pages: (id, page, neighbors array<struct<id,node,m>>).

    Neighbours are numbered in id order within their source (``rank_within_group``)
    and page = position div ``page_size``, so every page holds at most
    ``page_size`` neighbours however large a hub's degree.  Up to ``page_size`` neighbours
    are one page, so only longer lists are numbered.  A vertex without
    out-edges gets one empty page 0.
    """
    edges = medges.select("srcId", "dstId", "m")
    long = (edges.groupBy("srcId").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > page_size)  # few edges a page at least
            .select("srcId"))
    if long.isEmpty():
        ranked = edges.withColumn("_pos", F.lit(0).cast("long"))
    else:
        long = checkpoint(long)
        ranked = (edges.join(long, "srcId", "left_anti").withColumn("_pos", F.lit(0).cast("long"))
                  .unionByName(rank_within_group(edges.join(long, "srcId", "left_semi"), "srcId", "dstId", "_pos")
                               .select("srcId", "dstId", "m", "_pos")))
    nb = vertices.select(F.col("id").alias("dstId"), F.col("node").alias("_node"))
    rows = (ranked.join(nb, "dstId")
            .select("srcId", F.floor(F.col("_pos") / F.lit(page_size)).cast("long").alias("page"),
                    F.struct(F.col("dstId").alias("id"), F.col("_node").alias("node"), "m").alias("nb")))
    grouped = (rows.groupBy("srcId", "page")
               .agg(F.array_sort(F.collect_list("nb")).alias("neighbors")))
    empty = F.array().cast("array<struct<id:bigint,node:string,m:bigint>>")
    return (vertices.select("id").join(grouped, vertices["id"] == grouped["srcId"], "left")
            .select("id", F.coalesce(F.col("page"), F.lit(0).cast("long")).alias("page"),
                    F.coalesce(F.col("neighbors"), empty).alias("neighbors")))


# ---------------------------------------------------------------- two hops

def two_hop_weights(ranked: DataFrame, medges: DataFrame, min_rows: int = DEFAULT_MIN_ROWS, max_keys: int = DEFAULT_MAX_KEYS,
                    first_hop: DataFrame | None = None, second_hop: DataFrame | None = None,
                    shuffled_paths: float = SHUFFLED_PATHS, block_edges: int = BLOCK_EDGES, per_user: bool = False) -> DataFrame:
    """(id, sn_id, sn_rank, count, weight) for every path id -> b -> sn_id.

    ``count`` is the number of such paths with parallel follows multiplied
    (sum of m1 * m2 over middle vertices b), ``weight = sn_rank * count``.
    The rank of the far end is attached to the edge table first (a join over
    edges, not over paths).  ``first_hop`` restricts the first edge
    (a subset of ``medges``, e.g. one batch of sources), ``second_hop`` the second.

    Up to ``shuffled_paths`` paths are joined and shuffled (``_shuffled_counts``).  More are counted where they
    are made (``count_in_cells``), all but those from a user with more follows, or into a candidate with more
    second hops, than a task's share: a single cell would get too many, so these are shuffled.

    With ``per_user`` the rows are reduced to parts per user (``per_user_parts``) where they are made, which is all
    that ``follow_recommend`` and ``two_hop_summary`` need of them; every path is counted all the same.
    """
    def shuffled(first: DataFrame, second: DataFrame) -> DataFrame:
        rows = _weighted(_shuffled_counts(first, second, work, min_rows, max_keys))
        return per_user_parts(rows) if per_user else rows

    drop_unused(medges.sparkSession)  # what the ranks were made from
    e1 = (medges if first_hop is None else first_hop).select(
        F.col("srcId").alias("a"), F.col("dstId").alias("b"), F.col("m").alias("m1"))
    deg_in = e1.groupBy("b").agg(F.count(F.lit(1)).alias("_i")).persist(StorageLevel.MEMORY_AND_DISK)
    e2 = ((medges if second_hop is None else second_hop)
          .select(F.col("srcId").alias("b"), F.col("dstId").alias("c"), F.col("m").alias("m2"))
          .join(deg_in.select("b"), "b", "left_semi")  # a second hop that no first hop leads to makes no path
          .join(ranked.select(F.col("id").alias("c"), F.col("rank").alias("rank_c")), "c").select("b", "c", "m2", "rank_c"))
    e2 = checkpoint(e2)
    deg_out = e2.groupBy("b").agg(F.count(F.lit(1)).alias("_o"))
    work = deg_in.join(deg_out, "b").persist(StorageLevel.MEMORY_AND_DISK)
    paths, n1, n2 = (float(x or 0) for x in work.agg(F.sum(F.col("_i").cast("double") * F.col("_o")), F.sum("_i"), F.sum("_o")).first())
    try:
        if paths <= shuffled_paths:
            return shuffled(e1, e2)
        users, n_users = hot_keys(e1, "a", min_rows=min_rows, max_keys=max_keys)
        ends, n_ends = hot_keys(e2, "c", min_rows=min_rows, max_keys=max_keys)
        near = e1.join(F.broadcast(users), "a", "left_anti") if n_users else e1
        far = e2.join(F.broadcast(ends), "c", "left_anti") if n_ends else e2
        drop_unused(medges.sparkSession)
        counted = count_in_cells(near, far, n1, n2, paths, block_edges, per_user)
        if not per_user:
            counted = _weighted(counted)
        if n_users:
            counted = counted.unionByName(shuffled(e1.join(F.broadcast(users), "a", "left_semi"), e2))
        if n_ends:
            counted = counted.unionByName(shuffled(near, e2.join(F.broadcast(ends), "c", "left_semi")))
        return counted
    finally:
        work.unpersist()
        deg_in.unpersist()


def _weighted(counted: DataFrame) -> DataFrame:
    return counted.withColumn("weight", F.col("sn_rank") * F.col("count"))


def _shuffled_counts(e1: DataFrame, e2: DataFrame, work: DataFrame, min_rows: int, max_keys: int) -> DataFrame:
    """(id, sn_id, sn_rank, count) by a join on the middle vertex and an aggregate of the paths.

    A middle vertex whose path count (``work``: in x out) is
    more than a task's share is split over a grid of its own size: its in-edges
    go to one bucket per ``sqrt(min_rows)`` of them, by a hash of their source, and are
    replicated over the buckets of its out-edges, cut the same way, and vice versa.
    So a cell holds about ``min_rows`` paths, however large the hub.  All others
    are grids of one cell, in the same join.
    """
    hot, _ = hot_keys(work, "b", weight=F.col("_i").cast("double") * F.col("_o"),
                      min_rows=min_rows, max_keys=max_keys)
    side = max(1.0, float(min_rows) ** 0.5)
    grids = checkpoint(work.join(F.broadcast(hot), "b").select(  # at most max_keys rows
        "b", F.ceil(F.col("_i") / F.lit(side)).cast("int").alias("n1"),
        F.ceil(F.col("_o") / F.lit(side)).cast("int").alias("n2")))
    n1, n2 = F.coalesce(F.col("n1"), F.lit(1)), F.coalesce(F.col("n2"), F.lit(1))

    def bucket(col: str, n):
        return F.pmod(F.xxhash64(col), n.cast("bigint")).cast("int")

    def every(n):
        return F.explode(F.sequence(F.lit(0), n - 1))

    e1 = e1.join(F.broadcast(grids), "b", "left").select("a", "b", "m1", bucket("a", n1).alias("s1"), every(n2).alias("s2"))
    e2 = e2.join(F.broadcast(grids), "b", "left").select("b", "c", "m2", "rank_c", every(n1).alias("s1"), bucket("c", n2).alias("s2"))
    paths = e1.join(e2, ["b", "s1", "s2"])
    return (paths.groupBy(F.col("a").alias("id"), F.col("c").alias("sn_id"), F.col("rank_c").alias("sn_rank"))
            .agg(F.sum(F.col("m1") * F.col("m2")).alias("count")))


def steady(weight):
    """A weight cut to 40 of its 53 bits (12 digits, at any size), so that the order of a sum cannot
    swap a winner: adding and taking away a multiple rounds off the low bits."""
    far = weight * F.lit(8193.0)
    return far - (far - weight)


def follow_recommend(two_hop: DataFrame) -> DataFrame:
    """One recommendation per user: the two-hop vertex with the largest weight
    (compared by ``steady``), ties to the smallest id (the arg-max the reference intends, SURVEY T1)."""
    return best_candidates(two_hop).select(F.col("id").alias("srcId"), (-F.col("top.minus_id")).alias("dstId"),
                                           F.lit("recommend").alias("relation"))


def two_hop_summary(two_hop: DataFrame) -> DataFrame:
    """Per user, over all its two-hop candidates: how many, their paths and weights in all, and the best one."""
    return best_candidates(two_hop).select("id", "candidates", "paths", "weight", (-F.col("top.minus_id")).alias("best"))


def recommend_in_batches(ranked: DataFrame, medges: DataFrame, out_path: str, batches: int,
                         fmt: str = "parquet", **two_hop_kw) -> DataFrame:
    """``follow_recommend`` computed for one hash-batch of users at a time.

    Every user's candidates are still all of its two-hop paths; only the
    *set of users* handled per job is split (``pmod(xxhash64(srcId), batches)``),
    which bounds the path shuffle of a job to about 1/batches of the total.
    Each batch is written to ``out_path/batch=i``; a rerun skips batches whose write
    was finished (``_SUCCESS``), so a failed job resumes where it stopped.  The folder
    is bound to its graph, ranks and number of batches by a manifest: a run on anything
    else is refused.
    """
    spark = medges.sparkSession
    claim(spark, out_path, {"batches": batches, "edges": fingerprint(medges),
                            "ranks": fingerprint(ranked.select("id", F.format_string("%.9e", "rank").alias("rank")))})
    parts = [f"{out_path}/batch={i}" for i in range(batches)]
    for i, part in enumerate(parts):
        if complete(spark, part):
            continue
        first = medges.where(F.pmod(F.xxhash64("srcId"), F.lit(batches)) == i)
        th = two_hop_weights(ranked, medges, first_hop=first, per_user=True, **two_hop_kw)
        follow_recommend(th).write.format(fmt).mode("overwrite").save(part)
    return spark.read.format(fmt).load(parts).select("srcId", "dstId", "relation")


# ---------------------------------------------------------------- views

def top_ranked(ranked: DataFrame, n: int = 20, decimals: int = 9) -> DataFrame:
    """Top-n users by rank (ties by id): a bounded TakeOrderedAndProject."""
    return (ranked.orderBy(F.round("rank", decimals).desc(), F.col("id").asc()).limit(n)
            .select("id", "node", "rank"))


def core_size(rank):
    return F.floor(rank / F.lit(1000.0) * F.lit(80.0)).cast("long")


def neighbour_size(rank):
    return F.greatest(F.floor(F.least(rank, F.lit(50.0)) / F.lit(50.0) * F.lit(12.0)).cast("long"),
                      F.lit(3).cast("long"))


def core_subgraph_nodes(ranked: DataFrame, edges: DataFrame, n: int = 20) -> DataFrame:
    """Core = top-n by rank; neighbours = other ends of edges touching the core,
    in either direction, minus the core.  -> (id, node, size, kind)."""
    core = checkpoint(top_ranked(ranked, n))  # n rows, used four times
    core_ids = F.broadcast(core.select("id"))
    src, dst = core_ids.withColumnRenamed("id", "_s"), core_ids.withColumnRenamed("id", "_d")
    touching = (edges.join(src, edges["srcId"] == src["_s"], "left").join(dst, edges["dstId"] == dst["_d"], "left")
                .where("_s IS NOT NULL OR _d IS NOT NULL"))  # one pass over the edges
    ends = (touching.select(F.explode(F.array("srcId", "dstId")).alias("id")).distinct()
            .join(core_ids, "id", "left_anti"))
    neighbours = ranked.join(ends, "id", "left_semi")
    return (core.select("id", "node", core_size(F.col("rank")).alias("size"), F.lit("core").alias("kind"))
            .unionByName(neighbours.select("id", "node", neighbour_size(F.col("rank")).alias("size"),
                                           F.lit("neighbour").alias("kind")))
            .where(F.col("id").isNotNull() & F.col("node").isNotNull()))


def induced_edges(edges: DataFrame, nodes: DataFrame, broadcast_rows: int = BROADCAST_NODES,
                  filter_bits: int = BITS) -> DataFrame:
    """Edges whose two ends are both in ``nodes`` (C9), parallel ones kept: two semi-joins.

    Up to ``broadcast_rows`` distinct nodes go to every task.  Beyond that a key filter of theirs drops
    most other edges in the scan, on both ends at once, before the joins shuffle them."""
    ids = nodes.select("id").where("id IS NOT NULL").distinct()
    ends = edges.select("srcId", "dstId")
    if ids.limit(broadcast_rows + 1).count() <= broadcast_rows:
        ids = F.broadcast(ids)
    else:
        ends = KeyFilter(ids, "id", filter_bits).keep(ends, "srcId", "dstId", every=True)
    return (ends.join(ids, F.col("srcId") == ids["id"], "left_semi")
            .join(ids, F.col("dstId") == ids["id"], "left_semi"))


def core_subgraph(ranked: DataFrame, edges: DataFrame, n: int = 20) -> tuple[DataFrame, DataFrame]:
    nodes = checkpoint(core_subgraph_nodes(ranked, edges, n))
    return nodes, induced_edges(edges, nodes)


def ego_network(docs: DataFrame, user: str) -> DataFrame:
    """(source, target, label, kind) of one user's follows, questions and topics (G3), the documents read once."""
    def part(array_col: str, id_field: str, label_field: str, kind: str):
        return F.coalesce(F.transform(array_col, lambda x: F.struct(
            x[id_field].alias("target"), x[label_field].alias("label"), F.lit(kind).alias("kind"))),
            F.array().cast("array<struct<target:string,label:string,kind:string>>"))

    parts = F.concat(part("following", "urlToken", "name", "user"), part("question", "id", "title", "question"),
                     part("topic", "id", "title", "topic"))
    return (docs.where(F.col("urlToken") == F.lit(user)).select(F.explode(parts).alias("x"))
            .select(F.lit(user).alias("source"), "x.target", "x.label", "x.kind"))
