"""Oracle SQL (DuckDB) for the registered queries.

Each string restates, in plain SQL over the driver's tables, both the
adapter rule (``asklens.sources.adapters``) and the operator.  Doubles are
rounded to 6 decimals, integer sums cast to BIGINT (DuckDB widens them).
"""

from __future__ import annotations

from asklens.schemas import PROFILE_COUNTERS

ORACLE: dict[str, str] = {}


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


# ---------------------------------------------------------------- adapter CTEs

EDU = """edu AS (
  SELECT o_custkey AS c_custkey, nullif(o_orderpriority, '5-LOW') AS school, o_orderstatus AS major, o_orderkey,
         (o_orderkey::BIGINT % 4294967296 * 1640531527 % 4294967296
           * ((count(*) OVER (PARTITION BY o_custkey) + 19) // 20) // 4294967296)::BIGINT AS page
  FROM orders)"""

EDU_PLACED = """edu AS (
  SELECT o_custkey AS c_custkey, nullif(o_orderpriority, '5-LOW') AS school, o_orderstatus AS major, o_orderkey,
         ((row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) // 20)::BIGINT AS page
  FROM orders)"""

EDU_KEPT = """edu_kept AS (
  SELECT c_custkey, school, major FROM edu JOIN customer USING (c_custkey)
  WHERE c_custkey % 10 NOT IN (0, 1))"""

FOLLOWS = """follows AS MATERIALIZED (
  SELECT concat('u', o_custkey) AS src, concat('u', l_suppkey) AS dst, l_orderkey, l_linenumber,
         l_partkey, l_suppkey, o_custkey, o_orderpriority,
         ((row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_suppkey, l_partkey) - 1) // 20)
           ::BIGINT AS page
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

VERTICES = """vertices AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY node) - 1)::BIGINT AS id, node
  FROM (SELECT src AS node FROM follows UNION SELECT dst FROM follows))"""

EDGES = """edges AS MATERIALIZED (
  SELECT v1.id AS srcId, v2.id AS dstId, 'following' AS relation
  FROM follows f JOIN vertices v1 ON f.src = v1.node JOIN vertices v2 ON f.dst = v2.node)"""

MEDGES = """medges AS MATERIALIZED (
  SELECT srcId, dstId, count(*)::BIGINT AS m FROM edges GROUP BY srcId, dstId)"""

GRAPH = (FOLLOWS, VERTICES, EDGES, MEDGES)


def ranks_ctes(rounds: int = 10) -> tuple[str, ...]:
    out = ["""w AS MATERIALIZED (
  SELECT e.srcId, e.dstId, e.m::DOUBLE / d.d AS w
  FROM medges e JOIN (SELECT srcId, sum(m)::BIGINT AS d FROM medges GROUP BY srcId) d USING (srcId))""",
           "r0 AS MATERIALIZED (SELECT id, 1.0::DOUBLE AS rank FROM vertices)"]
    for k in range(1, rounds + 1):
        out.append(f"""r{k} AS MATERIALIZED (
  SELECT v.id, 0.15 + 0.85 * coalesce(s.s, 0.0) AS rank
  FROM vertices v LEFT JOIN (
    SELECT w.dstId, sum(p.rank * w.w) AS s FROM w JOIN r{k - 1} p ON p.id = w.srcId GROUP BY w.dstId
  ) s ON s.dstId = v.id)""")
    out.append(f"""ranks AS MATERIALIZED (
  SELECT id, rank * (SELECT count(*) FROM r{rounds})::DOUBLE / (SELECT sum(rank) FROM r{rounds}) AS rank
  FROM r{rounds})""")
    return tuple(out)


RANKS = ranks_ctes(10)

RANKED = """ranked AS MATERIALIZED (SELECT v.id, v.node, r.rank FROM vertices v JOIN ranks r USING (id))"""

TWO_HOP = """two_hop AS MATERIALIZED (
  SELECT e1.srcId AS id, e2.dstId AS sn_id, r.rank AS sn_rank,
         sum(e1.m * e2.m)::BIGINT AS count, r.rank * sum(e1.m * e2.m)::BIGINT AS weight
  FROM medges e1 JOIN medges e2 ON e1.dstId = e2.srcId JOIN ranks r ON r.id = e2.dstId
  GROUP BY e1.srcId, e2.dstId, r.rank)"""

RECOMMEND = """rec AS MATERIALIZED (
  SELECT id AS srcId, sn_id AS dstId, 'recommend' AS relation FROM (
    SELECT id, sn_id, row_number() OVER (PARTITION BY id ORDER BY 8193.0::DOUBLE * weight - (8193.0::DOUBLE * weight - weight) DESC, sn_id) AS rn
    FROM two_hop) WHERE rn = 1)"""

CORE = """core AS MATERIALIZED (
  SELECT id, node, rank FROM ranked ORDER BY round(rank, 9) DESC, id LIMIT 20)"""


def subgraph_ctes(edge_table: str) -> tuple[str, ...]:
    return (
        f"""touch AS (SELECT srcId, dstId FROM {edge_table}
  WHERE srcId IN (SELECT id FROM core) OR dstId IN (SELECT id FROM core))""",
        "ends AS (SELECT srcId AS id FROM touch UNION SELECT dstId FROM touch)",
        "nodes AS (SELECT id FROM core UNION SELECT id FROM ends)",
    )


# ---------------------------------------------------------------- counts

ORACLE["school_count"] = _with(EDU, EDU_KEPT) + """
SELECT school, count(*)::BIGINT AS "count" FROM edu_kept GROUP BY school"""

ORACLE["business_count"] = """
SELECT nullif(c_mktsegment, 'FURNITURE') AS business, count(*)::BIGINT AS "count"
FROM customer GROUP BY 1"""

ORACLE["location_count"] = """
SELECT n_name AS location, count(*)::BIGINT AS "count"
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey GROUP BY 1"""

ORACLE["nested_path_project"] = _with(EDU, EDU_KEPT) + """
SELECT lpad(hex(c_custkey), 24, '0') AS _id, school FROM edu_kept"""

# ---------------------------------------------------------------- graph

ORACLE["vertex_ids"] = _with(FOLLOWS, VERTICES) + "SELECT id, node FROM vertices"

ORACLE["vertex_dictionary"] = _with(FOLLOWS, """first AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY node) - 1)::BIGINT AS id, node FROM (
    SELECT src AS node FROM follows WHERE o_custkey % 2 = 0 UNION SELECT dst FROM follows WHERE o_custkey % 2 = 0))""") + """
SELECT id, node, 1 AS version FROM first
UNION ALL
SELECT (SELECT count(*) FROM first) + row_number() OVER (ORDER BY node) - 1, node, 2 FROM (
  SELECT src AS node FROM follows UNION SELECT dst FROM follows) WHERE node NOT IN (SELECT node FROM first)"""

ORACLE["follow_edges"] = _with(FOLLOWS, VERTICES, EDGES) + "SELECT srcId, dstId, relation FROM edges"

ORACLE["in_degree"] = _with(*GRAPH) + """
SELECT dstId AS id, sum(m)::BIGINT AS in_degree FROM medges GROUP BY dstId"""

ORACLE["out_degree"] = _with(*GRAPH) + """
SELECT srcId AS id, sum(m)::BIGINT AS out_degree FROM medges GROUP BY srcId"""

ORACLE["collect_neighbors"] = _with(*GRAPH, """pg AS (
  SELECT srcId, dstId, m, ((row_number() OVER (PARTITION BY srcId ORDER BY dstId) - 1) // 1000)::BIGINT AS page
  FROM medges)""") + """
SELECT v.id, coalesce(p.page, 0)::BIGINT AS page, coalesce(p.n, 0)::BIGINT AS n_neighbors,
       coalesce(p.s, '') AS neighbors
FROM vertices v LEFT JOIN (
  SELECT srcId, page, sum(m) AS n, string_agg(concat(dstId, 'x', m), ',' ORDER BY dstId) AS s
  FROM pg GROUP BY srcId, page) p ON p.srcId = v.id"""

ORACLE["pagerank_fixed"] = _with(*GRAPH, *RANKS) + "SELECT id, round(rank, 6) AS rank FROM ranks"

ORACLE["ranked_vertices"] = _with(*GRAPH, *RANKS, RANKED) + """
SELECT id, node, round(rank, 6) AS rank FROM ranked"""

ORACLE["rank_degrees"] = _with(*GRAPH, *RANKS, RANKED) + """
SELECT r.id, r.node, round(r.rank, 6) AS rank, i.in_degree, o.out_degree
FROM ranked r
JOIN (SELECT dstId AS id, sum(m)::BIGINT AS in_degree FROM medges GROUP BY dstId) i USING (id)
JOIN (SELECT srcId AS id, sum(m)::BIGINT AS out_degree FROM medges GROUP BY srcId) o USING (id)"""

ORACLE["two_hop_weights"] = _with(*GRAPH, *RANKS, TWO_HOP) + """
SELECT id, sn_id, round(sn_rank, 6) AS sn_rank, count, round(weight, 6) AS weight FROM two_hop"""

ORACLE["two_hop_summary"] = _with(*GRAPH, *RANKS, TWO_HOP, RECOMMEND) + """
SELECT t.*, rec.dstId AS best FROM (
  SELECT id, count(*)::BIGINT AS candidates, sum(count)::BIGINT AS paths, round(sum(weight), 4) AS weight
  FROM two_hop GROUP BY id) t JOIN rec ON rec.srcId = t.id"""

ORACLE["follow_recommend"] = _with(*GRAPH, *RANKS, TWO_HOP, RECOMMEND) + """
SELECT srcId, dstId, relation FROM rec"""

ORACLE["top_ranked_users"] = _with(*GRAPH, *RANKS, RANKED, CORE) + """
SELECT id, node, round(rank, 6) AS rank FROM core"""

ORACLE["core_subgraph_nodes"] = _with(*GRAPH, *RANKS, RANKED, CORE, *subgraph_ctes("edges")) + """
SELECT id, node, floor(rank / 1000.0 * 80.0)::BIGINT AS size, 'core' AS kind FROM core
UNION ALL
SELECT id, node, greatest(floor(least(rank, 50.0) / 50.0 * 12.0)::BIGINT, 3)::BIGINT AS size,
       'neighbour' AS kind
FROM ranked WHERE id IN (SELECT id FROM ends) AND id NOT IN (SELECT id FROM core)"""

ORACLE["core_subgraph_edges"] = _with(*GRAPH, *RANKS, RANKED, CORE, *subgraph_ctes("edges")) + """
SELECT srcId, dstId FROM edges
WHERE srcId IN (SELECT id FROM nodes) AND dstId IN (SELECT id FROM nodes)"""

ORACLE["follow_recommend_tiered"] = ORACLE["follow_recommend"]

ORACLE["follow_recommend_paths"] = _with(*GRAPH, *RANKS, TWO_HOP) + """
SELECT sum("count")::BIGINT AS total_paths, true AS fewer FROM two_hop"""

ORACLE["recommend_subgraph_edges"] = _with(*GRAPH, *RANKS, RANKED, TWO_HOP, RECOMMEND, CORE,
                                           *subgraph_ctes("rec")) + """
SELECT srcId, dstId FROM rec
WHERE srcId IN (SELECT id FROM nodes) AND dstId IN (SELECT id FROM nodes)"""

ORACLE["ego_network"] = _with(FOLLOWS) + """
SELECT 'u1' AS source, dst AS target, concat('User#', l_suppkey) AS label, 'user' AS kind
FROM follows WHERE src = 'u1'
UNION ALL
SELECT 'u1', CAST(l_orderkey AS VARCHAR), o_orderpriority, 'question'
FROM (SELECT DISTINCT l_orderkey, page AS page, o_orderpriority FROM follows WHERE src = 'u1')
UNION ALL
SELECT 'u1', CAST(l_partkey AS VARCHAR), concat('Topic#', l_partkey), 'topic'
FROM follows WHERE src = 'u1'"""


# ---------------------------------------------------------------- ratings

ACTIONS = """actions AS (
  SELECT event_id, concat('u', user_id) AS userUrlToken, json_extract_string(props, '$.k') AS questionId,
         CASE event_type WHEN 'click' THEN 'answer_approve' WHEN 'purchase' THEN 'answer_collect'
              WHEN 'view' THEN 'answer_comment' ELSE 'answer_publish' END AS actType
  FROM events WHERE event_type <> 'error')"""

WEIGHTED = """weighted AS (
  SELECT *, (CASE actType WHEN 'answer_approve' THEN 1.0
                          WHEN 'answer_collect' THEN 1.5 ELSE 2.5 END)::DOUBLE AS rate
  FROM actions)"""

ARATING = """arating AS (
  SELECT userUrlToken, questionId, sum(DISTINCT rate) AS rate FROM (
    SELECT userUrlToken, questionId, rate FROM weighted
    WHERE userUrlToken IS NOT NULL AND questionId IS NOT NULL AND actType IS NOT NULL
    UNION ALL
    SELECT concat('u', user_id), json_extract_string(props, '$.k'), 5.0::DOUBLE FROM events
    WHERE event_type = 'error' AND json_extract_string(props, '$.k') IS NOT NULL)
  GROUP BY userUrlToken, questionId)"""

_IDMAP = """idmap AS (
  SELECT lpad(hex(c_custkey), 24, '0') AS _id, concat('u', c_custkey) AS urlToken,
         CAST(c_custkey AS VARCHAR) AS UId
  FROM customer WHERE c_custkey % 9 <> {gap}
  UNION ALL
  SELECT lpad(hex(c_custkey + 1000000000), 24, '0'), concat('u', c_custkey), CAST(c_custkey + 500000 AS VARCHAR)
  FROM customer WHERE c_custkey % 9 <> {gap} AND c_custkey % 5 = 0)"""
IDMAP = _IDMAP.replace("{gap}", "9")  # everybody
IDMAP_GAPS = _IDMAP.replace("{gap}", "4")

INT_RE = r"'^\s*[+-]?[0-9]+\s*$'"

LOOKUP = f"""lookup AS (
  SELECT urlToken AS userUrlToken,
         CASE WHEN regexp_matches(arg_min(UId, _id), {INT_RE}) THEN TRY_CAST(trim(arg_min(UId, _id)) AS BIGINT) END AS UId
  FROM idmap GROUP BY urlToken)"""

RATINGS = f"""ratings AS MATERIALIZED (
  SELECT * FROM (
    SELECT l.UId AS UId,
           CASE WHEN regexp_matches(a.questionId, {INT_RE}) THEN TRY_CAST(trim(a.questionId) AS BIGINT) END AS QId,
           a.rate
    FROM arating a JOIN lookup l USING (userUrlToken) WHERE l.UId IS NOT NULL)
  WHERE UId IS NOT NULL AND QId IS NOT NULL)"""

RATING_CTES = (ACTIONS, WEIGHTED, ARATING, IDMAP, LOOKUP, RATINGS)

SPLIT = """split AS (
  SELECT UId, QId, rate,
         CASE WHEN (UId::BIGINT * 31 + QId) % 10 < 8 THEN 'train' ELSE 'test' END AS part
  FROM ratings)"""

ORACLE["action_weight"] = _with(ACTIONS, WEIGHTED) + """
SELECT event_id, userUrlToken, questionId, actType, rate FROM weighted"""

ORACLE["required_keys_filter"] = _with(ACTIONS) + """
SELECT * FROM (
  SELECT event_id,
         CASE WHEN event_id % 7 = 3 THEN NULL ELSE userUrlToken END AS userUrlToken,
         CASE WHEN event_id % 11 = 4 THEN NULL ELSE questionId END AS questionId,
         CASE WHEN event_id % 13 = 5 THEN NULL ELSE actType END AS actType
  FROM actions)
WHERE userUrlToken IS NOT NULL AND questionId IS NOT NULL AND actType IS NOT NULL"""

ORACLE["tolerant_int_filter"] = f"""
WITH k AS (SELECT event_id, json_extract_string(props, '$.k') AS k FROM events),
t AS (
  SELECT event_id,
         CASE WHEN event_id % 4 = 1 THEN ' ' || k || ' '
              WHEN event_id % 4 = 2 THEN k || '.5'
              WHEN event_id % 8 = 3 THEN '+' || k
              ELSE k END AS qtext
  FROM k)
SELECT event_id, TRY_CAST(trim(qtext) AS BIGINT) AS id FROM t
WHERE regexp_matches(qtext, {INT_RE}) AND TRY_CAST(trim(qtext) AS BIGINT) IS NOT NULL"""

ORACLE["too_large_ids"] = """
WITH k AS (SELECT event_id, json_extract_string(props, '$.k') || repeat('0', 19) AS k FROM events WHERE event_id % 8 = 7)
SELECT event_id, qtext FROM (SELECT event_id, CASE WHEN event_id % 8 = 3 THEN '+' || k ELSE k END AS qtext FROM k)
WHERE regexp_matches(qtext, '^[+-]?[0-9]+$') AND TRY_CAST(qtext AS HUGEINT) NOT BETWEEN -9223372036854775808 AND 9223372036854775807"""

ORACLE["action_rating"] = _with(ACTIONS, WEIGHTED, ARATING) + """
SELECT userUrlToken, questionId, rate FROM arating"""

ORACLE["user_id_lookup"] = _with(ACTIONS, IDMAP_GAPS, LOOKUP) + """
SELECT DISTINCT a.userUrlToken, l.UId FROM actions a JOIN lookup l USING (userUrlToken)
WHERE l.UId IS NOT NULL"""

ORACLE["rating_upsert"] = _with(*RATING_CTES, """old AS (
  SELECT UId, QId, rate - 1.0 AS rate FROM ratings WHERE (UId::BIGINT * 7 + QId) % 4 <> 0)""",
                                """new AS (SELECT UId, QId, rate FROM ratings WHERE (UId::BIGINT * 7 + QId) % 4 <> 1)""") + """
SELECT UId, QId, round(rate, 6) AS rate FROM new
UNION ALL
SELECT UId, QId, round(rate, 6) FROM old o
WHERE NOT EXISTS (SELECT 1 FROM new n WHERE n.UId = o.UId AND n.QId = o.QId)"""

ORACLE["rating_upsert_bucketed"] = ORACLE["rating_upsert"]

ORACLE["hash_split"] = _with(*RATING_CTES, SPLIT) + """
SELECT UId, QId, round(rate, 6) AS rate, part FROM split"""

ORACLE["rmse_metric"] = _with(*RATING_CTES, SPLIT, """means AS (
  SELECT QId, avg(rate) AS prediction FROM split WHERE part = 'train' GROUP BY QId)""") + """
SELECT round(sqrt(avg((s.rate - m.prediction) * (s.rate - m.prediction))), 6) AS rmse, count(*)::BIGINT AS n
FROM split s JOIN means m USING (QId) WHERE s.part = 'test'"""

ORACLE["topk_per_group"] = _with(*RATING_CTES) + """
SELECT UId, QId, round(rate, 6) AS rate, position FROM (
  SELECT *, (row_number() OVER (PARTITION BY UId ORDER BY rate DESC, QId))::INTEGER AS position FROM ratings)
WHERE position <= 10"""

ORACLE["last_doc_per_user"] = _with(FOLLOWS, """docs AS (
  SELECT src AS urlToken, l_orderkey, page AS page,
         string_agg(dst, ',' ORDER BY l_linenumber, l_suppkey, l_partkey) AS following
  FROM follows GROUP BY src, l_orderkey, page)""") + """
SELECT urlToken, concat(lpad(hex(l_orderkey), 20, '0'), lpad(hex(page), 4, '0')) AS _id, following
FROM (SELECT *, row_number() OVER (PARTITION BY urlToken ORDER BY l_orderkey DESC, page DESC) AS rn FROM docs)
WHERE rn = 1"""

# ---------------------------------------------------------------- crawl bookkeeping

FIRSTS = """firsts AS (
  SELECT user, l_orderkey AS first_order, l_linenumber AS first_line FROM (
    SELECT dst AS user, l_orderkey, l_linenumber,
           row_number() OVER (PARTITION BY dst ORDER BY l_orderkey, l_linenumber) AS rn
    FROM follows)
  WHERE rn = 1)"""

LEDGER = """ledger AS (
  SELECT CASE WHEN c_custkey % 9 = 0 THEN concat('u', c_custkey, ':::ERROR')
              WHEN c_custkey % 2 = 0 THEN concat('u', c_custkey, ':::', c_custkey % 7)
              ELSE concat('u', c_custkey) END AS value
  FROM customer WHERE c_custkey % 3 = 0)"""

ORACLE["frontier_pending"] = _with(FOLLOWS, FIRSTS, LEDGER) + """
SELECT user, first_order, first_line FROM firsts
WHERE user NOT IN (SELECT split_part(trim(value), ':::', 1) FROM ledger)"""

ORACLE["frontier_next"] = _with(FOLLOWS, FIRSTS, LEDGER) + """
SELECT user, first_order, first_line FROM firsts
WHERE user NOT IN (SELECT split_part(trim(value), ':::', 1) FROM ledger)
ORDER BY first_order, first_line, user LIMIT 1"""

ORACLE["follow_totals"] = _with(FOLLOWS) + """
SELECT src AS user, count(*)::BIGINT AS follow_total_count FROM follows GROUP BY ROLLUP (src)"""

ORACLE["follow_cap"] = _with(FOLLOWS) + """
SELECT user, followed, pos FROM (
  SELECT src AS user, dst AS followed,
         (row_number() OVER (PARTITION BY src ORDER BY l_orderkey, l_linenumber, l_suppkey, l_partkey))::INTEGER AS pos
  FROM follows)
WHERE pos <= 10"""

ORACLE["global_cap"] = _with(FOLLOWS, FIRSTS) + """
SELECT user, first_order, first_line FROM firsts ORDER BY first_order, first_line, user LIMIT 50"""

# ---------------------------------------------------------------- pages and text


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


HOST = "https://www.example.com"

URLS = f"""urls AS (
  SELECT url FROM pages
  UNION ALL
  SELECT concat('{HOST}/people/u', c_custkey, '/following') FROM customer
  UNION ALL
  SELECT concat('{HOST}/api/v4/members/u', o_custkey, '/followees?include=data&offset=', page * 20, '&limit=20')
  FROM (SELECT DISTINCT o_custkey, l_orderkey, page AS page FROM follows))"""

PROFILE_RE = "'/people/.*/following$'"
API_RE = "'/members/.*/followees?'"

# the crawler's tag class in RE2's own terms: word characters, white space and these marks
_TAG = r"""<(?:[\p{L}\p{N}_]|[\s\x0B\x1C-\x1F\x{85}\p{Z}]|[;:'",./?!@#$%^&*()=+-])+/*>"""

ORACLE["strip_tags"] = f"""
SELECT page_id, regexp_replace(html, {_lit(_TAG)}, '', 'g') AS text FROM pages"""

ORACLE["url_route"] = _with(FOLLOWS, URLS) + f"""
SELECT url, CASE WHEN regexp_matches(url, {PROFILE_RE}) THEN 'profile'
                 WHEN regexp_matches(url, {API_RE}) THEN 'follow_api'
                 ELSE 'other' END AS route
FROM urls"""

ORACLE["url_token"] = _with(FOLLOWS, URLS) + f"""
SELECT url, CASE WHEN regexp_matches(url, {PROFILE_RE})
                 THEN split_part(string_split(url, '/people/')[-1], '/following', 1)
                 WHEN regexp_matches(url, {API_RE})
                 THEN split_part(string_split(url, '/members/')[-1], '/followees?', 1) END AS token
FROM urls"""

ORACLE["url_query_params"] = """
SELECT page_id,
       TRY_CAST(nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS INTEGER) AS page,
       nullif(regexp_extract(url, '[?&]ref=([^&#]*)', 1), '') AS ref
FROM pages"""

ORACLE["org_token"] = _with(FOLLOWS) + """
SELECT l_orderkey, l_linenumber, concat('u', l_suppkey) AS token FROM follows"""

ORACLE["page_link_extract"] = """
WITH a AS (
  SELECT page_id, url, list_transform(regexp_extract_all(html, '<a href="([^"]*)">[^<]*</a>', 1),
             lambda h: CASE WHEN page_id % 10 = 5 AND starts_with(h, '/') THEN '../x/..' ELSE '' END
                       || CASE WHEN page_id % 9 = 4 AND starts_with(h, '/') THEN '/people' || h ELSE h END) AS raw_hrefs,
         list_transform(regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1),
             lambda x: CASE WHEN page_id % 10 = 5 THEN x || ' &amp; éé' ELSE x END) AS raw_texts
  FROM pages),
d AS (SELECT page_id, url, list_transform(raw_hrefs, lambda x: replace(replace(replace(replace(
                 x, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')) AS hrefs,
             list_transform(raw_texts, lambda x: replace(replace(replace(replace(
                 x, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')) AS texts FROM a),
b AS (SELECT page_id, url, hrefs, texts, unnest(generate_series(1, len(hrefs))) AS i FROM d)
SELECT page_id, (i - 1)::INTEGER AS pos, hrefs[i] AS href, texts[i] AS text,
       CASE WHEN regexp_matches(hrefs[i], '^[A-Za-z][A-Za-z0-9+.-]*:') THEN hrefs[i]
            WHEN starts_with(hrefs[i], '//') THEN concat(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*:)', 1), hrefs[i])
            WHEN starts_with(hrefs[i], '../x/../')
            THEN concat(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1), regexp_replace('/' || regexp_extract(
                 regexp_replace(url, '[?#].*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/]+/(.*/)?[^/]*$', 1), '[^/]+/$', ''), substr(hrefs[i], 9))
            WHEN starts_with(hrefs[i], '/')
            THEN concat(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]+)', 1), hrefs[i])
            WHEN hrefs[i] = '' THEN url
            WHEN starts_with(hrefs[i], '?') THEN concat(regexp_replace(url, '[?#].*$', ''), hrefs[i])
            WHEN starts_with(hrefs[i], '#') THEN concat(regexp_replace(url, '#.*$', ''), hrefs[i])
            WHEN regexp_matches(regexp_replace(url, '[?#].*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/]+$')
            THEN concat(regexp_replace(url, '[?#].*$', ''), '/', hrefs[i])
            ELSE concat(regexp_extract(regexp_replace(url, '[?#].*$', ''), '^(.*/)', 1), hrefs[i]) END AS abs_url,
       nullif(regexp_extract(hrefs[i], '/people/([^/?#]+)', 1), '') AS id, -1 AS gender
FROM b WHERE texts[i] <> ''"""

ORACLE["api_follow_extract"] = _with(FOLLOWS) + f"""
SELECT src AS user, dst AS id, concat('{HOST}/people/', dst) AS url, concat('User#', l_suppkey) AS name,
       (l_suppkey % 3 - 1)::INTEGER AS gender
FROM follows WHERE l_linenumber <> 3 AND l_orderkey % 7 <> 3"""

ORACLE["embedded_json_extract"] = _with(EDU) + """
SELECT concat('u', c_custkey) AS urlToken, md5(CAST(c_custkey AS VARCHAR)) AS id, c_name AS name,
       ((c_custkey * 3) % 1000)::BIGINT AS followerCount
FROM customer LEFT JOIN (SELECT DISTINCT c_custkey, page FROM edu) USING (c_custkey)"""

_COUNTER_SQL = ",\n       ".join(
    f"((c_custkey * {i + 3}) % {1000 + i})::BIGINT AS {name}" for i, name in enumerate(PROFILE_COUNTERS))

ORACLE["profile_flatten"] = _with(EDU_PLACED) + f"""
SELECT md5(CAST(c_custkey AS VARCHAR)) AS id, concat('u', c_custkey) AS urlToken, c_name AS name,
       (c_custkey % 13 = 0) AS isOrg,
       CASE WHEN c_custkey % 13 = 0 THEN 'organization' ELSE 'people' END AS type,
       concat('{HOST}/people/u', c_custkey) AS url,
       concat(c_mktsegment, c_name) AS headline,
       1::BIGINT AS isActive,
       concat(c_name, c_mktsegment) AS description,
       (c_custkey % 3 - 1)::INTEGER AS gender,
       {_COUNTER_SQL},
       c_mktsegment AS business,
       coalesce(n_name, '') AS locations,
       coalesce(e.edus, '') AS educations,
       '' AS badge
FROM customer
LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN (SELECT c_custkey, page,
                  string_agg(school || '/' || major, '|' ORDER BY o_orderkey) FILTER (school IS NOT NULL) AS edus
           FROM edu GROUP BY c_custkey, page) e USING (c_custkey)
WHERE NOT (c_custkey % 17 = 3 OR c_custkey % 19 = 5)"""

ORACLE["profile_quarantine"] = _with(EDU) + """
SELECT concat('u', c_custkey) AS urlToken,
       CASE WHEN c_custkey % 17 = 3 OR c_custkey % 19 = 5 THEN 'ERROR' ELSE 'ok' END AS status
FROM customer LEFT JOIN (SELECT DISTINCT c_custkey, page FROM edu) USING (c_custkey)"""

ORACLE["delimited_encode"] = _with(FOLLOWS) + f"""
SELECT l_orderkey, l_linenumber,
       concat('id:::u', l_suppkey, '---url:::{HOST}/people/u', l_suppkey, '---name:::User-', l_suppkey,
              '---gender:::-1') AS line
FROM follows"""

ORACLE["delimited_decode"] = _with(FOLLOWS) + """
SELECT concat('u', l_suppkey) AS id, concat('User-', l_suppkey) AS name, (-1)::INTEGER AS gender FROM follows"""

# ---------------------------------------------------------------- sinks and streams

ORACLE["sink_roundtrip"] = ORACLE["business_count"]
ORACLE["stream_business_count"] = ORACLE["business_count"]
ORACLE["stream_school_count"] = ORACLE["school_count"]
ORACLE["stream_drip_count"] = ORACLE["school_count"]

# a user with several pages of educations has a profile document for each
ORACLE["stream_service_counts"] = _with(EDU, EDU_KEPT) + """
SELECT 'count_schools' AS count_of, school AS key, count(*)::BIGINT AS "count" FROM edu_kept GROUP BY school
UNION ALL
SELECT 'count_businesses', nullif(c_mktsegment, 'FURNITURE'), count(*)
FROM customer LEFT JOIN (SELECT DISTINCT c_custkey, page FROM edu) USING (c_custkey) GROUP BY 2"""

ORACLE["incremental_export"] = """
SELECT lpad(hex(c_custkey), 24, '0') AS _id, c_name AS name, nullif(c_mktsegment, 'FURNITURE') AS business
FROM customer WHERE c_custkey % 3 <> 0"""


def converged_ranks_ctes(max_rounds: int = 200, tol: float = 1e-4) -> tuple[str, ...]:
    """Delta PageRank unrolled ``max_rounds`` times: once a round sends nothing every
    later round is empty, so any bound above the rounds actually needed is exact."""
    out = [ranks_ctes(0)[0],  # w: edge weights m / outdeg
           "m0 AS MATERIALIZED (SELECT id, 0.15::DOUBLE AS d FROM vertices)"]
    for k in range(1, max_rounds + 1):
        out.append(f"""m{k} AS MATERIALIZED (
  SELECT w.dstId AS id, 0.85 * sum(s.d * w.w) AS d
  FROM w JOIN m{k - 1} s ON s.id = w.srcId WHERE s.d > {tol} GROUP BY w.dstId)""")
    union = "\n  UNION ALL ".join(f"SELECT id, d FROM m{k}" for k in range(1, max_rounds + 1))
    out.append(f"""conv AS MATERIALIZED (
  SELECT v.id, 0.15 + coalesce(t.d, 0.0) AS rank
  FROM vertices v LEFT JOIN (SELECT id, sum(d) AS d FROM (
  {union}) GROUP BY id) t USING (id))""")
    out.append("""cranks AS (
  SELECT id, rank * (SELECT count(*) FROM conv)::DOUBLE / (SELECT sum(rank) FROM conv) AS rank FROM conv)""")
    return tuple(out)


ORACLE["pagerank_converged"] = _with(*GRAPH, *converged_ranks_ctes()) + """
SELECT id, round(rank, 6) AS rank FROM cranks"""

ORACLE["follow_recommend_batched"] = ORACLE["follow_recommend"]

SEEN = """seen AS (
  SELECT t.UId, t.QId, t.rate FROM split t
  WHERE t.part = 'test' AND t.UId IN (SELECT UId FROM split WHERE part = 'train')
    AND t.QId IN (SELECT QId FROM split WHERE part = 'train'))"""

ORACLE["als_predict_rows"] = _with(*RATING_CTES, SPLIT, SEEN) + """
SELECT UId, QId, round(rate, 6) AS rate, true AS finite FROM seen"""

ORACLE["als_rmse_n"] = _with(*RATING_CTES, SPLIT, SEEN) + """
SELECT count(*)::BIGINT AS n, true AS sane FROM seen"""

ORACLE["als_topk_rows"] = _with(*RATING_CTES, SPLIT) + """
SELECT DISTINCT UId, least(10, (SELECT count(DISTINCT QId) FROM split WHERE part = 'train'))::BIGINT AS n,
       least(10, (SELECT count(DISTINCT QId) FROM split WHERE part = 'train'))::BIGINT AS items, false AS unrated, true AS falling
FROM split WHERE part = 'train'"""

ORACLE["als_topk_pairs"] = _with(*RATING_CTES, SPLIT) + """
SELECT count(DISTINCT UId) * count(DISTINCT QId) AS all_pairs, true AS fewer FROM split WHERE part = 'train'"""

ORACLE["als_solved"] = _with(*RATING_CTES, SPLIT) + """
SELECT UId, count(*)::BIGINT AS n_ratings, true AS solved FROM split WHERE part = 'train' GROUP BY UId"""

ORACLE["als_rmse_recomputed"] = _with(*RATING_CTES, SPLIT, SEEN) + """
SELECT count(*)::BIGINT AS n, true AS agrees FROM seen"""

ORACLE["recs_preview_rows"] = _with(*RATING_CTES, SPLIT, """k AS (
  SELECT least(10, count(DISTINCT QId)) AS k FROM split WHERE part = 'train')""", """place AS (
  SELECT UId, row_number() OVER (ORDER BY UId) - 1 AS p FROM (SELECT DISTINCT UId FROM split WHERE part = 'train'))""") + """
SELECT UId, least(k, 10 - p * k)::BIGINT AS n FROM place, k WHERE p * k < 10"""

ORACLE["doc_action_rating"] = _with(ACTIONS, FOLLOWS, """wrows AS (
  SELECT userUrlToken, questionId, CASE actType WHEN 'answer_approve' THEN 1.0 WHEN 'answer_collect' THEN 1.5 ELSE 2.5 END AS rate
  FROM actions WHERE userUrlToken IS NOT NULL AND questionId IS NOT NULL AND actType IS NOT NULL
  UNION ALL
  SELECT src, max(l_orderkey)::VARCHAR, 5.0 FROM follows GROUP BY src)""") + """
SELECT userUrlToken, questionId, sum(DISTINCT rate)::DOUBLE AS rate FROM wrows GROUP BY userUrlToken, questionId"""

ORACLE["api_paging_params"] = _with(FOLLOWS, URLS) + """
SELECT url, TRY_CAST(nullif(regexp_extract(url, '[?&]offset=([^&#]*)', 1), '') AS BIGINT) AS "offset",
       TRY_CAST(nullif(regexp_extract(url, '[?&]limit=([^&#]*)', 1), '') AS BIGINT) AS "limit"
FROM urls"""

ORACLE["profile_ledger"] = _with(EDU) + """
SELECT concat('u', c_custkey, CASE WHEN c_custkey % 17 = 3 OR c_custkey % 19 = 5 THEN ':::ERROR' ELSE '' END) AS value
FROM customer LEFT JOIN (SELECT DISTINCT c_custkey, page FROM edu) USING (c_custkey)"""
