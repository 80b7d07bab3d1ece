"""DuckDB SQL of the conversation queries (op11, op12), over the table ``conversations``."""

from __future__ import annotations


def crc32_sql(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text, bit by bit; 3988292384 is the checksum's fixed polynomial."""
    return f"""xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(range(1, length({text}) + 1),
  lambda i: list_transform(range(8), lambda b: (ord(substr({text}, i, 1)) >> b) & 1)))),
  lambda a, b: xor(xor(a, b) >> 1, 3988292384::BIGINT * (xor(a, b) & 1))), 4294967295::BIGINT)"""


TRIE = f"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i
           FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT c, c - c % 5 AS base, {crc32_sql('s')} % 9 AS h FROM (SELECT DISTINCT c, c::VARCHAR AS s FROM t)),
r AS (SELECT k.c, i, role, text FROM k JOIN t ON t.c = k.base WHERE i <= h
      UNION ALL SELECT k.c, i, role, text FROM k JOIN t ON t.c = k.c WHERE i > h),
d AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY i) AS depth, strlen(text) AS n_bytes,
             length(role) || ':' || length(text) || ':' || role || text AS turn FROM r),
p AS (SELECT c, depth, n_bytes, string_agg(turn, '|') OVER (PARTITION BY c ORDER BY depth) AS node FROM d
      UNION ALL SELECT c, 0, 0, '' FROM k),
e AS (SELECT c, max(depth) AS depth FROM p GROUP BY c),
n AS (SELECT depth, node, min(c) AS c, count(*) AS n_convs, any_value(n_bytes) AS n_bytes FROM p GROUP BY depth, node),
u AS (SELECT n.*, m.c AS parent, m.node AS up FROM n LEFT JOIN p ON p.c = n.c AND p.depth = n.depth - 1
      LEFT JOIN n m ON m.depth = p.depth AND m.node = p.node),
g AS (SELECT depth - 1 AS depth, up AS node, count(*) AS n_children FROM u WHERE depth > 0 GROUP BY 1, 2),
s AS (SELECT p.depth, p.node, sum((n.n_convs - 1) * n.n_bytes) AS saved, count(*) FILTER (g.node IS NULL) AS leaves
      FROM n JOIN p ON p.c = n.c AND p.depth <= n.depth LEFT JOIN g ON g.depth = n.depth AND g.node = n.node GROUP BY 1, 2),
m AS (SELECT depth, node, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS digest FROM p JOIN e USING (c, depth) GROUP BY 1, 2)
SELECT u.c AS conv_id, depth, parent AS parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children, leaves AS n_leaves,
       saved::BIGINT AS saved_tokens, coalesce(digest, sha256('')) AS ends_sha256
FROM u JOIN s USING (depth, node) LEFT JOIN g USING (depth, node) LEFT JOIN m USING (depth, node)
"""

# A row's edits as (state before, state after, cost, word): N nothing, S system, U user, A assistant.
REPAIR = f"""
WITH RECURSIVE o AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS s FROM conversations),
h AS (SELECT *, {crc32_sql('s')} % 20 AS hit FROM o),
w AS (SELECT conv_id, turn, CASE WHEN hit = 4 THEN 'user' ELSE role END AS role,
             CASE hit WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(CASE WHEN hit = 3 THEN [0, 1] ELSE [0] END) AS copy FROM h WHERE hit <> 0),
q AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
             regexp_extract(text, '([^\\x20\\x09-\\x0D])[\\x20\\x09-\\x0D]*$', 1) AS shown, left(role, 1) AS c FROM w),
f AS (SELECT *, CASE WHEN shown = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                     WHEN shown NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
             lag(c) OVER (PARTITION BY conv_id ORDER BY i) || c NOT IN ('su', 'ua', 'au') AS illegal FROM q),
ins AS (SELECT * FROM (VALUES ('N', 'N', ''), ('N', 'U', 'I'), ('N', 'A', 'II'), ('S', 'S', ''), ('S', 'U', 'I'), ('S', 'A', 'II'),
    ('U', 'U', ''), ('U', 'A', 'I'), ('U', 'U', 'II'), ('A', 'A', ''), ('A', 'U', 'I'), ('A', 'A', 'II')) v(a, m, word)),
act AS (SELECT * FROM (VALUES ('N', 's', 'S', 'K'), ('N', 'u', 'U', 'K'), ('S', 'u', 'U', 'K'), ('U', 'a', 'A', 'K'), ('A', 'u', 'U', 'K'),
    ('N', '', 'U', 'R'), ('S', '', 'U', 'R'), ('U', '', 'A', 'R'), ('A', '', 'U', 'R'),
    ('N', '', 'N', 'D'), ('S', '', 'S', 'D'), ('U', '', 'U', 'D'), ('A', '', 'A', 'D')) v(m, c, z, letter)),
ways AS (SELECT a, z, c, letter, word || letter AS word, 5 * length(word) + CASE letter WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END AS price,
    CASE word WHEN '' THEN [] WHEN 'I' THEN [CASE a WHEN 'U' THEN 'assistant:' ELSE 'user:' END]
              ELSE CASE a WHEN 'U' THEN ['assistant:', 'user:'] ELSE ['user:', 'assistant:'] END END AS added FROM ins JOIN act USING (m)),
v AS (SELECT DISTINCT conv_id, 0::BIGINT AS i, 'N' AS state, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS out FROM f
  UNION ALL
  SELECT conv_id, i, state, cost, audit, out FROM (
    SELECT f.conv_id, f.i, x.z AS state, v.cost + x.price + CASE WHEN f.fault = 't' AND x.letter <> 'D' THEN 5 ELSE 0 END AS cost,
           v.audit || x.word AS audit,
           list_concat(list_concat(v.out, x.added), CASE x.letter WHEN 'D' THEN [] WHEN 'K' THEN [f.role || ':' || f.text]
                       ELSE [CASE x.z WHEN 'A' THEN 'assistant' ELSE 'user' END || ':' || f.text] END) AS out
    FROM v JOIN f ON f.conv_id IS NOT DISTINCT FROM v.conv_id AND f.i = v.i + 1
    JOIN ways x ON x.a = v.state AND (x.letter = 'D' OR (f.fault NOT IN ('b', 'd') AND (x.letter = 'R' OR x.c = f.c))))
  QUALIFY row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) = 1),
z AS (SELECT v.conv_id, cost + CASE state WHEN 'S' THEN 10 WHEN 'U' THEN 5 ELSE 0 END AS cost,
             audit || CASE state WHEN 'S' THEN 'II' WHEN 'U' THEN 'I' ELSE '' END AS audit,
             list_concat(out, CASE state WHEN 'S' THEN ['user:', 'assistant:'] WHEN 'U' THEN ['assistant:'] ELSE [] END) AS out
      FROM v JOIN (SELECT conv_id, max(i) AS n FROM f GROUP BY conv_id) l ON l.conv_id IS NOT DISTINCT FROM v.conv_id AND v.i = l.n
      QUALIFY row_number() OVER (PARTITION BY v.conv_id ORDER BY cost + CASE state WHEN 'S' THEN 10 WHEN 'U' THEN 5 ELSE 0 END,
                                 audit || CASE state WHEN 'S' THEN 'II' WHEN 'U' THEN 'I' ELSE '' END) = 1),
g AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
             count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
             count(*) FILTER (illegal) AS illegal FROM f GROUP BY conv_id),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
       sha256(coalesce(array_to_string(out, chr(10)), '')) AS repaired_sha256
FROM ids LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM ids.conv_id LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM ids.conv_id
"""
