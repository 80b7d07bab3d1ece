"""End-to-end jobs, one per application of the reference, with every path,
format and save mode a parameter.

    python -m asklens.apps graph   --follow-docs PATH --out DIR [--fmt parquet] [--mode errorifexists]
    python -m asklens.apps ratings --follow-docs PATH --actions PATH --id-map PATH --out DIR
    python -m asklens.apps stream  --input DIR --out DIR [--interval "3 seconds"]

Inputs are read with their fixed schemas (no inference).  Outputs:

* graph:   vertices (id, node), edges (srcId, dstId, relation), ranks (id, node, rank),
           rank_degrees, recommend (srcId, dstId, relation)
* ratings: ratings (UId, QId, rate; in buckets, each run upserts into those its rows fall in),
           predictions, recommendations (UId, QId, Rating); the RMSE is printed
* stream:  per query a table folder and a one-file JSON snapshot, rewritten each trigger
"""

from __future__ import annotations

import argparse
import os
import zlib

from pyspark.sql import SparkSession

from asklens.operators import graph as G
from asklens.operators import ratings as R
from asklens.operators import recommend as M
from asklens.schemas import ACTION_SCHEMA, FOLLOW_DOC_SCHEMA, RATING_SCHEMA
from asklens.session import apply_scale_conf, ensure_checkpoint_dir, tune_session
from asklens.sources import io as IO
from asklens.sources.bucketed import BucketedTable
from asklens.sources.tables import read_collection
from asklens.streaming import counts as S

RATING_BUCKETS = 64  # of the ratings table, unless the caller names a number


def graph_job(spark: SparkSession, follow_docs: str, out: str, fmt: str = "parquet",
              in_fmt: str = "json", mode: str = "errorifexists", direction: str = "follow",
              tol: float = 1e-4, recommend_batches: int = 1, resume: bool = False) -> None:
    """Follow documents -> vertices, edges, converged PageRank, degrees, recommendations.

    With ``resume`` a run that was interrupted goes on: tables whose write was finished are
    read, not made again.  The output folder is bound to its documents and settings; a
    resumed run on others is refused.  Batches of recommendations are kept in a folder
    of their own for each graph, so ``overwrite`` never meets another graph's."""
    docs = read_collection(spark, follow_docs, in_fmt, FOLLOW_DOC_SCHEMA)
    pairs = G.follow_pairs(docs, direction)
    settings = {"pairs": IO.fingerprint(pairs), "direction": direction, "tol": tol, "fmt": fmt}
    if resume:
        IO.claim(spark, out, settings)

    def table(name: str, make):
        path = os.path.join(out, name)
        if not (resume and IO.complete(spark, path)):
            IO.save(make(), path, fmt, "overwrite" if resume else mode)
        return spark.read.format(fmt).load(path)

    g = G.FollowGraph(pairs)
    table("vertices", lambda: g.vertices)
    table("edges", g.edges)
    ranked = table("ranks", lambda: G.ranked_vertices(g.vertices, G.pagerank_converged(g.vertices, g.medges, tol=tol)))
    table("rank_degrees", lambda: G.rank_degrees(ranked, g.medges))

    def recommend():
        if recommend_batches > 1:
            # bounded shuffle per job; finished batches survive a restart
            name = f"recommend_batches-{zlib.crc32(repr((settings, recommend_batches)).encode()):08x}"
            return G.recommend_in_batches(ranked, g.medges, os.path.join(out, name), recommend_batches, fmt)
        return G.follow_recommend(G.two_hop_weights(ranked, g.medges))

    table("recommend", lambda: recommend().select("srcId", "dstId", "relation"))


def ratings_table(spark: SparkSession, out: str, fmt: str = "parquet", buckets: int = RATING_BUCKETS) -> BucketedTable:
    return BucketedTable(spark, os.path.join(out, "ratings"), RATING_SCHEMA, ("UId", "QId"), buckets, fmt)


def ratings_job(spark: SparkSession, follow_docs: str, actions: str, id_map: str, out: str,
                fmt: str = "parquet", in_fmt: str = "json", seed: int = 42, k: int = M.TOP_K,
                num_blocks: int = M.ALS_BLOCKS, rating_buckets: int = RATING_BUCKETS) -> float:
    """Actions + followed questions -> ratings (upserted) -> ALS -> RMSE and top-k per user.

    ``num_blocks``: ALS blocks of users and of items, chosen once for a model (see ``fit_als``).
    ``rating_buckets``: buckets of the ratings table, fixed by the first run."""
    docs = read_collection(spark, follow_docs, in_fmt, FOLLOW_DOC_SCHEMA)
    acts = read_collection(spark, actions, in_fmt, ACTION_SCHEMA)
    ids = read_collection(spark, id_map, in_fmt, "_id string, urlToken string, UId string")
    rated = R.action_rating(R.weighted_actions(acts), R.followed_questions(docs))
    new = R.to_ratings(rated, ids)
    # ids beyond 64 bits have no place in the ratings: each run leaves them in a table of their own
    IO.save(R.rejected_ratings(rated, ids), os.path.join(out, "rejected_ratings"), fmt, "overwrite")
    table = ratings_table(spark, out, fmt, rating_buckets)
    table.upsert(new)
    ratings = table.read()
    train, test = M.random_split(ratings, seed=seed)
    model = M.fit_als(train, seed=seed, num_blocks=num_blocks)
    pred = M.predict(model, test)
    IO.save(pred, os.path.join(out, "predictions"), fmt, "overwrite")
    rmse = M.rmse_value(pred)
    print(f"Root-mean-square error = {rmse}")
    recs = M.top_items(model, k)
    M.preview_users(model, k).show(10)
    IO.save(recs, os.path.join(out, "recommendations"), fmt, "overwrite")
    return rmse


def stream_service(spark: SparkSession, input_dir: str, out: str, interval: str = "3 seconds") -> None:
    qs = S.start_service(spark, input_dir, out, trigger={"processingTime": interval})
    try:
        qs[0].awaitTermination()
    finally:
        for q in qs:
            q.stop()


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="asklens.apps")
    sub = ap.add_subparsers(dest="job", required=True)
    g = sub.add_parser("graph")
    g.add_argument("--follow-docs", required=True)
    g.add_argument("--out", required=True)
    g.add_argument("--fmt", default="parquet")
    g.add_argument("--in-fmt", default="json")
    g.add_argument("--mode", default="errorifexists")
    g.add_argument("--direction", default="follow", choices=["follow", "reversed"])
    g.add_argument("--recommend-batches", type=int, default=1)
    g.add_argument("--resume", action="store_true")
    r = sub.add_parser("ratings")
    for a in ("--follow-docs", "--actions", "--id-map", "--out"):
        r.add_argument(a, required=True)
    r.add_argument("--fmt", default="parquet")
    r.add_argument("--in-fmt", default="json")
    r.add_argument("--seed", type=int, default=42)
    r.add_argument("--als-blocks", type=int, default=M.ALS_BLOCKS)
    r.add_argument("--rating-buckets", type=int, default=RATING_BUCKETS)
    s = sub.add_parser("stream")
    s.add_argument("--input", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--interval", default="3 seconds")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"asklens-{args.job}").getOrCreate()
    ensure_checkpoint_dir(spark)
    tune_session(spark)
    apply_scale_conf(spark)
    if args.job == "graph":
        graph_job(spark, args.follow_docs, args.out, args.fmt, args.in_fmt, args.mode, args.direction,
                  recommend_batches=args.recommend_batches, resume=args.resume)
    elif args.job == "ratings":
        ratings_job(spark, args.follow_docs, args.actions, args.id_map, args.out, args.fmt, args.in_fmt,
                    args.seed, num_blocks=args.als_blocks, rating_buckets=args.rating_buckets)
    else:
        stream_service(spark, args.input, args.out, args.interval)


if __name__ == "__main__":
    main()
