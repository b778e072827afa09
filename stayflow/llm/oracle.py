"""SQL (DuckDB) for the operators that SQL can express."""

from __future__ import annotations


def crc32_table() -> list[int]:
    """The byte table of the reflected CRC-32, from its polynomial."""
    out = []
    for b in range(256):
        for _ in range(8):
            b = (b >> 1) ^ (0xEDB88320 if b & 1 else 0)
        out.append(b)
    return out


def crc32(text: str) -> str:
    """crc32 of an ASCII text."""
    codes = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    table = str(crc32_table())
    return (f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), "
            f"lambda x, c: xor(x >> 8, CAST({table}[CAST(xor(x, c) & 255 AS INTEGER) + 1] AS BIGINT))), "
            "CAST(4294967295 AS BIGINT))")


OP11 = rf"""
WITH RECURSIVE source AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32("concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS kind
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM source),
ended AS (SELECT *, right(regexp_replace(text, '[\x20\x09-\x0D]+\z', ''), 1) AS mark FROM damaged),
turns AS MATERIALIZED (
  SELECT conv_id, turn, role, text, substring(role, 1, 1) AS initial,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         CASE WHEN mark = '' THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 THEN 'duplicate'
              WHEN mark IN ('.', '!', '?') THEN 'fine' ELSE 'truncated' END AS fault
  FROM ended),
inserts(p, q, c, e, m) AS (VALUES ('-', '-', 0, '', ''), ('s', 's', 0, '', ''), ('u', 'u', 0, '', ''), ('a', 'a', 0, '', ''),
  ('-', 'u', 5, 'I', 'user:' || chr(10)), ('s', 'u', 5, 'I', 'user:' || chr(10)), ('a', 'u', 5, 'I', 'user:' || chr(10)),
  ('u', 'a', 5, 'I', 'assistant:' || chr(10)),
  ('-', 'a', 10, 'II', 'user:' || chr(10) || 'assistant:' || chr(10)),
  ('s', 'a', 10, 'II', 'user:' || chr(10) || 'assistant:' || chr(10))),
ways(conv_id, i, state, cost, edits, made) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), '-', 0, '', '' FROM conversations
  UNION ALL
  SELECT conv_id, i, to_state, to_cost, to_edits, to_made FROM (
    SELECT t.conv_id, t.i,
           CASE o WHEN 'D' THEN x.q WHEN 'K' THEN t.initial ELSE CASE x.q WHEN 'u' THEN 'a' ELSE 'u' END END AS to_state,
           w.cost + x.c + CASE o WHEN 'D' THEN 2 WHEN 'K' THEN 0 ELSE 1 END
             + CASE WHEN o <> 'D' AND t.fault = 'truncated' THEN 5 ELSE 0 END AS to_cost,
           w.edits || x.e || o AS to_edits,
           w.made || x.m || CASE o WHEN 'D' THEN '' WHEN 'K' THEN t.role || ':' || t.text || chr(10)
             ELSE CASE x.q WHEN 'u' THEN 'assistant:' ELSE 'user:' END || t.text || chr(10) END AS to_made
    FROM ways w JOIN turns t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.i = w.i + 1
      JOIN inserts x ON x.p = w.state CROSS JOIN (VALUES ('D'), ('K'), ('R')) op(o)
    WHERE (o = 'D' OR t.fault IN ('fine', 'truncated'))
      AND (o <> 'K' OR x.q || t.initial IN ('-s', '-u', 'su', 'ua', 'au'))
    QUALIFY row_number() OVER (PARTITION BY t.conv_id, to_state ORDER BY to_cost, to_edits) = 1)),
best AS (
  SELECT w.conv_id, w.i, w.cost + x.c AS cost, w.edits || x.e AS edits, w.made || x.m AS made
  FROM ways w JOIN inserts x ON x.p = w.state
  WHERE x.q IN ('-', 'a') AND NOT EXISTS (
    SELECT 1 FROM turns t WHERE t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.i > w.i)
  QUALIFY row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + x.c, w.edits || x.e) = 1),
pairs AS (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM turns),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM pairs GROUP BY conv_id)
SELECT b.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(cost AS BIGINT) AS cost, edits AS audit,
       sha256(CASE WHEN made = '' THEN '' ELSE made[:-2] END) AS repaired_sha256
FROM best b LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM b.conv_id"""


OP12 = f"""
WITH own AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns,
         {crc32("CAST(conv_id AS VARCHAR)")} % 9 AS h
  FROM conversations GROUP BY conv_id),
whole AS (
  SELECT o.conv_id, list_concat(coalesce(b.turns[1:o.h], []), o.turns[o.h + 1:]) AS turns
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5),
prefixes AS (
  SELECT conv_id, len(turns) AS n, d, turns[1:d] AS p FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM whole)),
node AS MATERIALIZED (
  SELECT d, p, min(conv_id) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
  FROM prefixes GROUP BY d, p),
kids AS (SELECT d - 1 AS d, p[1:d - 1] AS p, count(*) AS n_children FROM node WHERE d > 0 GROUP BY ALL),
full_node AS MATERIALIZED (
  SELECT node.*, coalesce(n_children, 0) AS n_children,
         CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * strlen(p[d].t) END AS saving
  FROM node LEFT JOIN kids USING (d, p)),
above AS (SELECT k AS d, p[1:k] AS p, saving, n_children FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM full_node)),
sums AS (SELECT d, p, count(*) FILTER (n_children = 0) AS n_leaves, sum(saving) AS saved_tokens FROM above GROUP BY d, p)
SELECT f.conv_id, f.d AS depth, u.conv_id AS parent_conv_id, f.n_convs, CAST(f.n_children AS BIGINT) AS n_children,
       CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM full_node f JOIN sums USING (d, p) LEFT JOIN node u ON u.d = f.d - 1 AND u.p = f.p[1:f.d - 1]"""


OP13 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""

ORACLE = {"op11_turn_repair": OP11, "op12_prefix_trie": OP12, "op13_chunk_dedup": OP13}
