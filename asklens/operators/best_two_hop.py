"""The best two-hop candidate of every user without the full path set.

A candidate's weight is its rank times the number of paths to it.  Candidates are cut into tiers by falling potential,
rank times in-edges, and visited tier by tier: the paths of a tier count all of a candidate's paths at once, so
every weight seen is final.  What a user has not seen yet is bounded by the least of

* its most parallel follows of one vertex times the largest potential left,
* the largest rank left times its follows times the most parallel edges left,
* the largest rank left times its paths left (all its paths, a sum over its edges, less those seen).

A user whose best weight is above the bound is done, and its edges take no part in later tiers.  Exact: the
comparison is that of ``follow_recommend``, and a tie is never cut off.

Scale: the tiers are visited inside the cells of ``best_cells``, in one pass over the first hops; a cell is a search of its
own, by the same bounds over its own candidates, and the best of a user's cells is its best.  Users with more follows, and candidates
with more second hops, than a task's share are searched tier by tier (``_by_rounds``): the bounds of the tiers are a
handful of numbers, all else are joins and aggregates on users and middle vertices, hubs being split as in
``two_hop_weights``.  The state of the users is written to the shared scratch folder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from asklens.operators.best_cells import MARGIN, best_in_cells, found_schema
from asklens.operators.graph import two_hop_weights
from asklens.operators.skew import DEFAULT_MAX_KEYS, DEFAULT_MIN_ROWS, hot_keys
from asklens.operators.two_hop_cells import BLOCK_EDGES, best_candidates
from asklens.session import checkpoint, drop_unused

#: shares of the candidates, by falling potential, that the tiers end at
SHARES = (1 / 64, 1 / 16, 1 / 4, 3 / 4, 0.97)


@dataclass
class BestTwoHop:
    """``edges``: srcId, dstId, relation.  ``rounds``: tier, users, paths (expanded there).  ``total_paths``: of all users."""

    edges: DataFrame
    rounds: DataFrame
    total_paths: int


def best_two_hop(ranked: DataFrame, medges: DataFrame, shares: tuple[float, ...] = SHARES, min_rows: int = DEFAULT_MIN_ROWS,
                 max_keys: int = DEFAULT_MAX_KEYS, block_edges: int = BLOCK_EDGES) -> BestTwoHop:
    """One recommendation per user that has a two-hop path, as ``follow_recommend`` gives it."""
    spark = medges.sparkSession
    drop_unused(spark)
    into = (medges.groupBy(F.col("dstId").alias("c")).agg(F.sum("m").alias("in_m"), F.max("m").alias("most"), F.count(F.lit(1)).alias("_i"))
            .join(ranked.select(F.col("id").alias("c"), F.col("rank").alias("rank_c")), "c", "left")
            .withColumn("potential", F.col("rank_c") * F.col("in_m")))
    into = into.persist(StorageLevel.MEMORY_AND_DISK)
    cuts = into.agg(F.percentile_approx("potential", F.array(*[F.lit(1 - s) for s in shares]), F.lit(10_000))).first()[0] or []
    tier = sum((F.col("potential") < F.lit(c)).cast("int") for c in cuts) if cuts else F.when(F.col("potential").isNotNull(), 0)
    reached = checkpoint(into.withColumn("tier", tier))
    into.unpersist()
    limits = {r["tier"]: r for r in reached.where("tier IS NOT NULL").groupBy("tier").agg(  # one row a tier
        F.max("potential").alias("potential"), F.max("rank_c").alias("rank"), F.max("most").alias("most")).collect()}
    tiers = max(limits, default=0) + 1
    e1 = medges.select(F.col("srcId").alias("a"), F.col("dstId").alias("b"), F.col("m").alias("m1"))
    e2 = checkpoint(medges.select(F.col("srcId").alias("b"), F.col("dstId").alias("c"), F.col("m").alias("m2"))
                    .join(reached.select(F.col("c").alias("b")), "b", "left_semi")
                    .join(reached.select("c", "rank_c", "tier"), "c", "left").select("b", "c", "m2", "rank_c", "tier"))
    work = (e2.groupBy("b").agg(F.sum("m2").alias("out_m"), F.count("tier").alias("_o"))
            .join(reached.select(F.col("c").alias("b"), "in_m", "_i"), "b"))
    total, paths, n1, n2 = work.agg(F.sum(F.col("in_m") * F.col("out_m")), F.sum(F.col("_i").cast("double") * F.col("_o")),
                                    F.sum("_i"), F.sum("_o")).first()
    found = None
    if paths:
        e2 = e2.where("tier IS NOT NULL")
        users, n_users = hot_keys(e1, "a", min_rows=min_rows, max_keys=max_keys)
        ends, n_ends = hot_keys(e2, "c", min_rows=min_rows, max_keys=max_keys)
        near = e1.join(F.broadcast(users), "a", "left_anti") if n_users else e1
        far = e2.join(F.broadcast(ends), "c", "left_anti") if n_ends else e2
        drop_unused(spark)
        found = best_in_cells(near, far, float(n1), float(n2), float(paths), tiers, block_edges)
        options = {"min_rows": min_rows, "max_keys": max_keys, "block_edges": block_edges}
        if n_users:
            found = found.unionByName(_by_rounds(ranked, e1.join(F.broadcast(users), "a", "left_semi"), e2, limits, options))
        if n_ends:
            found = found.unionByName(_by_rounds(ranked, near, e2.join(F.broadcast(ends), "c", "left_semi"), limits, options))
    else:
        found = spark.createDataFrame([], found_schema(tiers))
    per_tier = [F.sum(f"p{t}").alias(f"p{t}") for t in range(tiers)]
    state = checkpoint(found.groupBy("id").agg(F.max(F.struct("w", "minus_id")).alias("best"), F.max("last").alias("last"), *per_tier))
    sums = state.agg(*[F.count(F.when(F.col("last") >= t, 1)).alias(f"u{t}") for t in range(tiers)], *per_tier).first()
    rounds = [(t, int(sums[f"u{t}"]), int(sums[f"p{t}"])) for t in sorted(limits) if sums[f"u{t}"]]
    edges = state.select(F.col("id").alias("srcId"), (-F.col("best.minus_id")).alias("dstId"), F.lit("recommend").alias("relation"))
    return BestTwoHop(edges, spark.createDataFrame(rounds, "tier int, users bigint, paths bigint"), int(total or 0))


def _by_rounds(ranked: DataFrame, e1: DataFrame, e2: DataFrame, limits: dict, options: dict) -> DataFrame:
    """What ``best_in_cells`` gives, one tier of all users after the other."""
    tiers = max(limits) + 1
    medges = e1.select(F.col("a").alias("srcId"), F.col("b").alias("dstId"), F.col("m1").alias("m"))
    second = e2.select(F.col("b").alias("srcId"), F.col("c").alias("dstId"), F.col("m2").alias("m"), "tier")
    out_m = second.groupBy(F.col("srcId").alias("dstId")).agg(F.sum("m").alias("out_m"))
    state = checkpoint(medges.join(out_m, "dstId").groupBy(F.col("srcId").alias("id")).agg(
        F.sum(F.col("m") * F.col("out_m")).alias("paths"), F.sum("m").alias("follows"), F.max("m").alias("parallel")))
    state = state.withColumns({"seen": F.lit(0).cast("bigint"), "best": F.lit(None).cast("struct<w:double,minus_id:bigint>"),
                               **{f"p{t}": F.lit(0).cast("bigint") for t in range(tiers)}})
    finished = []
    for t in sorted(limits):
        if state.isEmpty():
            break
        first = medges.join(state.select(F.col("id").alias("srcId")), "srcId", "left_semi")
        here = second.where(F.col("tier") == t).drop("tier")
        found = best_candidates(two_hop_weights(ranked, medges, first_hop=first, second_hop=here, per_user=True, **options)).select(
            "id", F.col("paths").alias("now"), "top")
        state = (state.join(found, "id", "left").withColumns({
            f"p{t}": F.coalesce("now", F.lit(0)), "seen": F.col("seen") + F.coalesce("now", F.lit(0)), "best": F.greatest("best", "top")})
            .drop("now", "top"))
        left = [limits[x] for x in limits if x > t]
        if left:
            rank, most = max(r["rank"] for r in left), max(r["most"] for r in left)
            bound = F.least(F.col("parallel") * F.lit(max(r["potential"] for r in left)), F.lit(rank) * F.col("follows") * F.lit(most),
                            F.lit(rank) * (F.col("paths") - F.col("seen")))
            done = (F.col("seen") == F.col("paths")) | F.coalesce(F.col("best.w") > bound * (1 + MARGIN), F.lit(False))
        else:
            done = F.lit(True)
        state = checkpoint(state.withColumn("done", done))
        finished.append(state.where("done").withColumn("last", F.lit(t)))
        state = state.where("NOT done").drop("done")
    out = [x.select("id", "best.w", "best.minus_id", "last", *[f"p{t}" for t in range(tiers)]) for x in finished]
    for more in out[1:]:
        out[0] = out[0].unionByName(more)
    return out[0] if out else e1.sparkSession.createDataFrame([], found_schema(tiers))
