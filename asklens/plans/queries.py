"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each builds its inputs from the driver's tables (``asklens.sources.adapters``)
and runs one library operator over the whole tables.  Double columns are
rounded to 6 decimals at the very end so results compare across engines.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from asklens.functions import text as X
from asklens.operators import counts
from asklens.operators.best_two_hop import best_two_hop
from asklens.operators import crawl as C
from asklens.operators import dictionary as D
from asklens.operators import graph as G
from asklens.operators import profiles as P
from asklens.operators import ratings as R
from asklens.operators import recommend as M
from asklens.schemas import RATING_SCHEMA
from asklens.session import default_parallelism, scratch_path
from asklens.sources import adapters as A
from asklens.sources import io as IO
from asklens.sources.bucketed import BucketedTable
from asklens.sources.tables import Tables
from asklens.streaming import counts as S

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def rounded(df: DataFrame, decimals: int = 6) -> DataFrame:
    return df.select(*[
        F.round(F.col(f.name), decimals).alias(f.name) if isinstance(f.dataType, T.DoubleType)
        else F.col(f.name)
        for f in df.schema.fields])


# ---------------------------------------------------------------- counts

@query("school_count")
def school_count(spark, sf):
    return counts.school_count(A.profiles(Tables(spark, sf), educations=True))


@query("business_count")
def business_count(spark, sf):
    return counts.business_count(A.profiles(Tables(spark, sf), locations=False))


@query("location_count")
def location_count(spark, sf):
    return counts.location_count(A.profiles(Tables(spark, sf)))


@query("nested_path_project")
def nested_path_project(spark, sf):
    return counts.nested_path_project(A.profiles(Tables(spark, sf), educations=True))


# ---------------------------------------------------------------- graph

def _graph(spark, sf) -> G.FollowGraph:
    return G.FollowGraph(A.follow_pairs(Tables(spark, sf)))


def _edge_graph(spark, sf) -> G.FollowGraph:
    """With the merged edges made first, so that they and the vertices come from one pass over the pairs."""
    g = _graph(spark, sf)
    g.medges  # noqa: B018
    return g


def _ranked_fixed(g: G.FollowGraph) -> DataFrame:
    return G.ranked_vertices(g.vertices, G.pagerank_fixed(g.vertices, g.medges, rounds=10))


@query("vertex_ids")
def vertex_ids(spark, sf):
    return _graph(spark, sf).vertices


@query("vertex_dictionary")
def vertex_dictionary(spark, sf):
    """A dictionary grown by two loads: the follows of every second user's orders, then all follows."""
    pairs = A.follow_pairs(Tables(spark, sf))
    nodes = pairs.select(F.col("src"), F.explode(F.array("src", "dst")).alias("node"))
    path = scratch_path(spark, "vertex-dictionary")
    D.grow(spark, path, nodes.where(F.substring("src", 2, 20).cast("bigint") % 2 == 0).select("node"))
    return D.grow(spark, path, nodes.select("node"))


@query("follow_edges")
def follow_edges(spark, sf):
    return _graph(spark, sf).edges()


@query("in_degree")
def in_degree(spark, sf):
    return _graph(spark, sf).in_degrees()


@query("out_degree")
def out_degree(spark, sf):
    return _graph(spark, sf).out_degrees()


@query("collect_neighbors")
def collect_neighbors(spark, sf):
    g = _edge_graph(spark, sf)
    nb = G.collect_neighbors(g.vertices, g.medges)
    return nb.select(
        "id", "page",
        F.aggregate("neighbors", F.lit(0).cast("long"), lambda acc, x: acc + x["m"]).alias("n_neighbors"),
        F.concat_ws(",", F.transform("neighbors", lambda x: F.concat(
            x["id"].cast("string"), F.lit("x"), x["m"].cast("string")))).alias("neighbors"))


@query("pagerank_fixed")
def pagerank_fixed(spark, sf):
    g = _edge_graph(spark, sf)
    return rounded(G.pagerank_fixed(g.vertices, g.medges, rounds=10))


@query("pagerank_converged")
def pagerank_converged(spark, sf):
    g = _edge_graph(spark, sf)
    return rounded(G.pagerank_converged(g.vertices, g.medges, tol=1e-4))


@query("ranked_vertices")
def ranked_vertices(spark, sf):
    return rounded(_ranked_fixed(_edge_graph(spark, sf)))


@query("rank_degrees")
def rank_degrees(spark, sf):
    g = _edge_graph(spark, sf)
    return rounded(G.rank_degrees(_ranked_fixed(g), g.medges))


@query("two_hop_weights")
def two_hop_weights(spark, sf):
    g = _edge_graph(spark, sf)
    return rounded(G.two_hop_weights(_ranked_fixed(g), g.medges))


@query("two_hop_summary")
def two_hop_summary(spark, sf):
    """An exact summary of every user's candidates; the candidates themselves are near all pairs of users."""
    g = _edge_graph(spark, sf)
    return rounded(G.two_hop_summary(G.two_hop_weights(_ranked_fixed(g), g.medges, per_user=True)), 4)


@query("follow_recommend")
def follow_recommend(spark, sf):
    g = _edge_graph(spark, sf)
    return G.follow_recommend(G.two_hop_weights(_ranked_fixed(g), g.medges, per_user=True))


@query("follow_recommend_tiered")
def follow_recommend_tiered(spark, sf):
    """The same recommendation, paths expanded by tiers of candidates until each user's best is certain."""
    g = _edge_graph(spark, sf)
    return best_two_hop(_ranked_fixed(g), g.medges).edges


@query("follow_recommend_paths")
def follow_recommend_paths(spark, sf):
    """All two-hop paths, and whether the tiers expanded fewer."""
    g = _edge_graph(spark, sf)
    found = best_two_hop(_ranked_fixed(g), g.medges)
    return found.rounds.agg(F.lit(found.total_paths).alias("total_paths"), (F.sum("paths") < F.lit(found.total_paths)).alias("fewer"))


@query("follow_recommend_batched")
def follow_recommend_batched(spark, sf):
    """The same recommendation computed in 4 restartable user batches."""
    g = _edge_graph(spark, sf)
    return G.recommend_in_batches(_ranked_fixed(g), g.medges, scratch_path(spark, "rec-batches"), 4)


@query("top_ranked_users")
def top_ranked_users(spark, sf):
    return rounded(G.top_ranked(_ranked_fixed(_edge_graph(spark, sf)), 20))


@query("core_subgraph_nodes")
def core_subgraph_nodes(spark, sf):
    g = _edge_graph(spark, sf)
    return G.core_subgraph_nodes(_ranked_fixed(g), g.medges, 20)  # parallel follows make no difference to the nodes


@query("core_subgraph_edges")
def core_subgraph_edges(spark, sf):
    g = _edge_graph(spark, sf)
    return G.core_subgraph(_ranked_fixed(g), g.edges(), 20)[1]


@query("recommend_subgraph_edges")
def recommend_subgraph_edges(spark, sf):
    g = _edge_graph(spark, sf)
    ranked = _ranked_fixed(g)
    rec = G.follow_recommend(G.two_hop_weights(ranked, g.medges, per_user=True))
    return G.core_subgraph(ranked, rec, 20)[1]


@query("ego_network")
def ego_network(spark, sf):
    return G.ego_network(A.follow_docs(Tables(spark, sf), users=["u1"]), "u1")


# ---------------------------------------------------------------- ratings and ML


def _rated(t: Tables) -> DataFrame:
    return R.action_rating(R.weighted_actions(A.actions(t)), R.follow_rates(A.question_follows(t)))


def _ratings(t: Tables) -> DataFrame:
    return R.to_ratings(_rated(t), A.id_map(t))


@query("action_weight")
def action_weight(spark, sf):
    return R.weighted_actions(A.actions(Tables(spark, sf)))


@query("required_keys_filter")
def required_keys_filter(spark, sf):
    return R.required_keys(A.actions_with_gaps(Tables(spark, sf)))


@query("tolerant_int_filter")
def tolerant_int_filter(spark, sf):
    q = A.question_id_texts(Tables(spark, sf))
    return q.select("event_id", X.tolerant_int("qtext").alias("id")).where(F.col("id").isNotNull())


@query("too_large_ids")
def too_large_ids(spark, sf):
    """Question ids that Python's ``int`` reads and 64 bits do not hold, as the ratings job's reject table has them."""
    q = A.question_id_texts(Tables(spark, sf))
    long = q.withColumn("qtext", F.when(F.col("event_id") % 8 == 7, F.concat("qtext", F.lit("0" * 19))).otherwise(F.col("qtext")))
    return long.where(X.too_large_int("qtext")).select("event_id", "qtext")


@query("action_rating")
def action_rating(spark, sf):
    return _rated(Tables(spark, sf))


@query("last_doc_per_user")
def last_doc_per_user(spark, sf):
    last = R.last_doc_per_user(A.follow_docs(Tables(spark, sf)))
    return last.select("urlToken", "_id", F.concat_ws(",", "following.urlToken").alias("following"))


@query("user_id_lookup")
def user_id_lookup(spark, sf):
    t = Tables(spark, sf)
    return R.user_id_lookup(A.actions(t), A.id_map(t, gaps=True))


@query("rating_upsert")
def rating_upsert(spark, sf):
    r = _ratings(Tables(spark, sf))
    mix = (F.col("UId").cast("long") * 7 + F.col("QId")) % 4
    old = r.where(mix != 0).withColumn("rate", F.col("rate") - F.lit(1.0))
    new = r.where(mix != 1)
    return rounded(R.upsert(old, new))


@query("rating_upsert_bucketed")
def rating_upsert_bucketed(spark, sf):
    """``rating_upsert`` through the bucketed table: the first version, then the new rows."""
    r = _ratings(Tables(spark, sf))
    mix = (F.col("UId").cast("long") * 7 + F.col("QId")) % 4
    table = BucketedTable(spark, scratch_path(spark, "ratings-table"), RATING_SCHEMA, buckets=default_parallelism(spark))
    table.upsert(r.where(mix != 0).withColumn("rate", F.col("rate") - F.lit(1.0)))
    table.upsert(r.where(mix != 1))
    return rounded(table.read())


@query("hash_split")
def hash_split(spark, sf):
    return rounded(M.hash_split(_ratings(Tables(spark, sf))))


@query("rmse_metric")
def rmse_metric(spark, sf):
    s = M.hash_split(_ratings(Tables(spark, sf)))
    train = s.where(F.col("part") == "train")
    test = s.where(F.col("part") == "test")
    return rounded(M.rmse(M.mean_rate_predictor(train, test)))


@query("topk_per_group")
def topk_per_group(spark, sf):
    r = _ratings(Tables(spark, sf))
    return rounded(M.topk_per_group(r, "UId", [F.col("rate").desc(), F.col("QId").asc()], 10)
                   .select("UId", "QId", "rate", "position"))


def _als(spark, sf):
    s = M.hash_split(_ratings(Tables(spark, sf)))
    train = s.where(F.col("part") == "train").drop("part")
    test = s.where(F.col("part") == "test").drop("part")
    return M.fit_als(train, seed=42), test


@query("als_predict")
def als_predict(spark, sf):
    model, test = _als(spark, sf)
    return M.predict(model, test).select("UId", "QId", "rate", F.col("prediction").cast("double"))


@query("als_rmse")
def als_rmse(spark, sf):
    """RMSE of the ALS predictions on the held-out part (the reference's printed metric)."""
    model, test = _als(spark, sf)
    return M.rmse(M.predict(model, test))


@query("als_topk_recs")
def als_topk_recs(spark, sf):
    model, _ = _als(spark, sf)
    return M.top_items(model, 10)


@query("recs_preview")
def recs_preview(spark, sf):
    model, _ = _als(spark, sf)
    return M.preview_users(model, 10, 10)


# What has a plain SQL form about the same fits: which rows come out, not their numbers.

@query("als_predict_rows")
def als_predict_rows(spark, sf):
    model, test = _als(spark, sf)
    p = F.col("prediction").cast("double")
    return rounded(M.predict(model, test).select(
        "UId", "QId", "rate", (p.isNotNull() & ~F.isnan(p) & (F.abs(p) < 1e9)).alias("finite")))


@query("als_rmse_n")
def als_rmse_n(spark, sf):
    model, test = _als(spark, sf)
    return M.rmse(M.predict(model, test)).select("n", ((F.col("rmse") >= 0) & (F.col("rmse") < 100)).alias("sane"))


@query("als_topk_rows")
def als_topk_rows(spark, sf):
    """Per user: recommendations, different items among them, whether any lacks a rating, and whether the ratings fall by position."""
    model, _ = _als(spark, sf)
    found = M.named_items(model, M.pruned_search(model, 10))
    by_place = F.array_sort(F.collect_list(F.struct("position", "Rating")))
    return found.groupBy("UId").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("QId").alias("items"),
        F.max(F.isnan("Rating") | F.col("Rating").isNull()).alias("unrated"), by_place.alias("r")).select(
        "UId", "n", "items", "unrated",
        F.aggregate("r", F.struct(F.lit(True).alias("ok"), F.lit(float("inf")).alias("last"), F.lit(0).alias("at")),
                    lambda s, x: F.struct((s["ok"] & (x["Rating"] <= s["last"]) & (x["position"] == s["at"] + 1)).alias("ok"),
                                          x["Rating"].alias("last"), x["position"].alias("at")), lambda s: s["ok"]).alias("falling"))


@query("als_topk_pairs")
def als_topk_pairs(spark, sf):
    """All pairs of users and items, and whether the exact search for each user's best item scored fewer.

    Blocks of ten items, as the tables hold about a hundred; for ten items of a hundred the norms exclude next to nothing."""
    model, _ = _als(spark, sf)
    rounds = M.pruned_search(model, 1, block_items=10).rounds.agg(F.sum("pairs").alias("scored"))
    users = model.users.agg(F.count(F.lit(1)).alias("users"))
    items = model.items.agg(F.count(F.lit(1)).alias("items"))
    return users.join(items).join(rounds).select((F.col("users") * F.col("items")).alias("all_pairs"),
                                                 (F.col("scored") < F.col("users") * F.col("items")).alias("fewer"))


@query("als_solved")
def als_solved(spark, sf):
    """Per trained user: its ratings, and whether its factors solve the normal equations of the last half-step."""
    s = M.hash_split(_ratings(Tables(spark, sf)))
    train = s.where(F.col("part") == "train").drop("part")
    return M.normal_residuals(M.fit_als(train, seed=42), train).select("UId", "n_ratings", (F.col("residual") < 1e-5).alias("solved"))


@query("als_rmse_recomputed")
def als_rmse_recomputed(spark, sf):
    """Held-out rows, and whether the error recomputed from the factors is the printed one."""
    model, test = _als(spark, sf)
    own = M.rmse(M.dot_predictions(model, test)).select("n", F.col("rmse").alias("own"))
    return own.join(M.rmse(M.predict(model, test)).select("rmse")).select(
        "n", (F.abs(F.col("own") - F.col("rmse")) <= F.col("rmse") * 1e-5).alias("agrees"))


@query("recs_preview_rows")
def recs_preview_rows(spark, sf):
    model, _ = _als(spark, sf)
    return M.preview_users(model, 10, 10).groupBy("UId").agg(F.count(F.lit(1)).alias("n"))


@query("doc_action_rating")
def doc_action_rating(spark, sf):
    """Ratings from answer actions and from the questions of the users' last follow documents."""
    t = Tables(spark, sf)
    return R.action_rating(R.weighted_actions(A.actions(t)), R.followed_questions(A.follow_docs(t)))


# ---------------------------------------------------------------- pages and text


@query("strip_tags")
def strip_tags(spark, sf):
    return Tables(spark, sf).pages.select("page_id", X.strip_tags("html").alias("text"))


@query("url_route")
def url_route(spark, sf):
    return A.crawl_urls(Tables(spark, sf)).select("url", X.url_route("url").alias("route"))


@query("url_token")
def url_token(spark, sf):
    return A.crawl_urls(Tables(spark, sf)).select("url", X.url_token("url").alias("token"))


@query("url_query_params")
def url_query_params(spark, sf):
    return Tables(spark, sf).pages.select(
        "page_id", X.tolerant_int(X.query_param("url", "page")).cast("int").alias("page"),
        X.query_param("url", "ref").alias("ref"))


@query("api_paging_params")
def api_paging_params(spark, sf):
    """``offset`` and ``limit`` of every crawled URL as integers; null where there are none."""
    return A.crawl_urls(Tables(spark, sf)).select(
        "url", *[X.tolerant_int(X.query_param("url", p)).alias(p) for p in ("offset", "limit")])


@query("org_token")
def org_token(spark, sf):
    rows = A.follow_rows(Tables(spark, sf))
    raw = F.when(F.col("l_suppkey") % 13 == 0,
                 F.concat(F.lit(A.HOST), F.lit("/org/"), A.token("l_suppkey"))).otherwise(A.token("l_suppkey"))
    return rows.select("l_orderkey", "l_linenumber", X.org_token(raw).alias("token"))


@query("page_link_extract")
def page_link_extract(spark, sf):
    return P.page_links(A.link_pages(Tables(spark, sf)))


@query("api_follow_extract")
def api_follow_extract(spark, sf):
    return P.api_follows(A.api_follow_pages(Tables(spark, sf)))


@query("embedded_json_extract")
def embedded_json_extract(spark, sf):
    e = P.embedded_user_json(A.profile_pages(Tables(spark, sf)))
    u = F.from_json("json", P.RAW_PROFILE_SCHEMA)
    return e.select("urlToken", u.alias("u")).select(
        "urlToken", F.col("u.id").alias("id"), F.col("u.name").alias("name"),
        F.col("u.followerCount").alias("followerCount"))


@query("profile_flatten")
def profile_flatten(spark, sf):
    p = P.flatten_profile(A.raw_profile_json(Tables(spark, sf), positions=True))
    return p.select(
        *[c for c in p.columns if c not in ("badge", "locations", "educations")],
        F.concat_ws(",", "badge").alias("badge"),
        F.concat_ws("|", "locations").alias("locations"),
        F.concat_ws("|", F.transform("educations", lambda e: F.concat(e["school"], F.lit("/"), e["major"])))
        .alias("educations"))


@query("profile_quarantine")
def profile_quarantine(spark, sf):
    return P.quarantine(A.raw_profile_json(Tables(spark, sf))).select("urlToken", "status")


@query("profile_ledger")
def profile_ledger(spark, sf):
    return P.profile_ledger(A.raw_profile_json(Tables(spark, sf)))


@query("delimited_encode")
def delimited_encode(spark, sf):
    return _encoded(A.follow_rows(Tables(spark, sf)))


def _encoded(rows: DataFrame) -> DataFrame:
    line = X.encode_record(
        ("id", A.token("l_suppkey")),
        ("url", F.concat(F.lit(A.HOST), F.lit("/people/"), A.token("l_suppkey"))),
        ("name", F.concat(F.lit("User-"), F.col("l_suppkey").cast("string"))),
        ("gender", F.lit(-1)))
    return rows.select("l_orderkey", "l_linenumber", line.alias("line"))


@query("delimited_decode")
def delimited_decode(spark, sf):
    path = scratch_path(spark, "follow-lines")
    IO.write_lines(_encoded(A.follow_rows(Tables(spark, sf))), path)
    m = X.decode_record(F.col("value"))
    return spark.read.text(path).select(
        m["id"].alias("id"), m["name"].alias("name"), X.tolerant_int(m["gender"]).cast("int").alias("gender"))


# ---------------------------------------------------------------- crawl bookkeeping


def _discovered(t: Tables) -> DataFrame:
    return A.follow_rows(t).select(A.token("l_suppkey").alias("user"), "l_orderkey", "l_linenumber")


@query("frontier_pending")
def frontier_pending(spark, sf):
    t = Tables(spark, sf)
    return C.pending(_discovered(t), A.done_ledger(t))


@query("frontier_next")
def frontier_next(spark, sf):
    """The crawler's next user: the first pending one in discovery order."""
    t = Tables(spark, sf)
    return C.next_pending(_discovered(t), A.done_ledger(t))


@query("follow_totals")
def follow_totals(spark, sf):
    return C.follow_totals(A.follow_rows(Tables(spark, sf)).select(A.token("o_custkey").alias("user")))


@query("follow_cap")
def follow_cap(spark, sf):
    rows = A.follow_rows(Tables(spark, sf)).select(
        A.token("o_custkey").alias("user"), A.token("l_suppkey").alias("followed"),
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    return C.follow_cap(rows, 10).select("user", "followed", "pos")


@query("global_cap")
def global_cap(spark, sf):
    return C.global_cap(_discovered(Tables(spark, sf)), 50)


# ---------------------------------------------------------------- sinks and streams


@query("sink_roundtrip")
def sink_roundtrip(spark, sf):
    path = scratch_path(spark, "business-snapshot")
    IO.save_snapshot(counts.business_count(A.profiles(Tables(spark, sf), locations=False)), path)
    return IO.read_json(spark, path, "business string, count bigint")


@query("incremental_export")
def incremental_export(spark, sf):
    t = Tables(spark, sf)
    ledger = scratch_path(spark, "export-ledger")
    done = t.customer.where(F.col("c_custkey") % 3 == 0).select(A.object_id("c_custkey").alias("value"))
    done.write.text(ledger)
    exported = IO.incremental_export(A.profiles(t), ledger, scratch_path(spark, "export-run"))
    return exported.select("_id", "name", "business")


def _profile_json_dir(spark, sf, educations: bool, files: int | None = None) -> str:
    path = scratch_path(spark, "profiles-json")
    prof = A.profiles(Tables(spark, sf), educations)
    (prof.repartition(files) if files else prof).write.json(path)
    return path


def _stream_session(spark):
    # a few state partitions suffice for counts keyed by school or business
    return S.streaming_session(spark, default_parallelism(spark))


@query("stream_school_count")
def stream_school_count(spark, sf):
    ss = _stream_session(spark)
    src = S.profile_stream(ss, _profile_json_dir(spark, sf, True))
    return S.run_once(ss, counts.school_count(src), "count_schools", scratch_path(spark, "stream-school"))[0]


@query("stream_business_count")
def stream_business_count(spark, sf):
    ss = _stream_session(spark)
    src = S.profile_stream(ss, _profile_json_dir(spark, sf, False))
    return S.run_once(ss, counts.business_count(src), "count_businesses",
                      scratch_path(spark, "stream-business"))[0]


@query("stream_drip_count")
def stream_drip_count(spark, sf):
    # as many files as the cluster has cores (8 at least), read over about four triggers
    path = _profile_json_dir(spark, sf, True, files=max(8, default_parallelism(spark)))
    n_files = len(spark.read.text(path).inputFiles())
    ss = _stream_session(spark)
    src = S.profile_stream(ss, path, max_files_per_trigger=max(1, n_files // 4))
    return S.run_once(ss, counts.school_count(src), "drip_schools", scratch_path(spark, "stream-drip"))[0]


@query("stream_service_counts")
def stream_service_counts(spark, sf):
    """Both sinks of the service (one pass over the profile files): (count_of, key, count)."""
    out = scratch_path(spark, "stream-service")
    for q in S.start_service(spark, _profile_json_dir(spark, sf, True), out, {"availableNow": True}, default_parallelism(spark)):
        q.awaitTermination()
    tables = [spark.read.parquet(os.path.join(out, name, "table")).select(
        F.lit(name).alias("count_of"), F.col(column).alias("key"), "count") for name, column in S.SERVICE_COUNTS.items()]
    return tables[0].unionByName(tables[1])
