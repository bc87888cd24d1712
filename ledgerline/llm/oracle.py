"""SQL for DuckDB of the queries that SQL can express."""

from __future__ import annotations

SQL = {
    "op7_exact_dedup": """
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS n,
                  regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS letters FROM documents),
g AS (SELECT doc_id, letters, first_value(doc_id) OVER (PARTITION BY letters ORDER BY n DESC, doc_id) AS keep_id,
             count(*) OVER (PARTITION BY letters) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(letters) AS text_sha256 FROM g""",
    "op10_ngram_jaccard_join": """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END)) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 90 * (p.n + q.n - k)),
reach(x, y) AS (SELECT x, y FROM link UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m.y, d.doc_id)) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN (SELECT x, min(y) AS y FROM reach GROUP BY x) m ON m.x = d.doc_id""",
    "op12_filter_audit": """
WITH w AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
l AS (SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id),
f AS (
  SELECT part, coalesce(l.quality = 1, false) AS good, coalesce(l.toxic = 1, false) AS toxic,
         CASE WHEN len(ws) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY t), false) THEN 'E' ELSE '' END AS fails
  FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
k AS (SELECT part, good, toxic, fails, count(*) AS n FROM f GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (
  SELECT a.c || b.c || d.c || e.c || g.c AS filter_order FROM x a, x b, x d, x e, x g
  WHERE a.c NOT IN (b.c, d.c, e.c, g.c) AND b.c NOT IN (d.c, e.c, g.c) AND d.c NOT IN (e.c, g.c) AND e.c <> g.c),
steps AS (SELECT filter_order, step, substr(filter_order, step, 1) AS letter, left(filter_order, step - 1) AS earlier
          FROM orders, (SELECT unnest(range(1, 6))::INTEGER AS step)),
o AS (
  SELECT part, filter_order, step, letter, n, good, toxic, fails, contains(fails, letter) AS fail,
         length(translate(earlier, fails, '')) < length(earlier) AS gone FROM k, steps),
r AS (
  SELECT part, filter_order, step, letter, sum(CASE WHEN NOT gone AND NOT fail THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN fail AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN fail AND gone THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN fails = letter THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN fail AND NOT gone AND good THEN n ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN fail AND NOT gone AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost FROM o GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       sum(removed) OVER (PARTITION BY part, letter)::BIGINT AS shapley FROM r""",
    "op13_prefix_trie": """
WITH tab AS (
  SELECT list_transform(range(0, 256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tb),
own AS (
  SELECT conv_id, length(coalesce(text, '')) AS chars,
         md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS m,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT conv_id, max(pos) AS n FROM own GROUP BY conv_id),
hs AS (
  SELECT conv_id, n, conv_id - conv_id % 100 AS donor,
         xor(list_reduce(list_concat([4294967295], list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
           lambda c, b: xor(c >> 8, tb[1 + (xor(c, b) & 255)])), 4294967295) % 6 AS h FROM convs, tab),
plan AS (SELECT hs.*, least(h, coalesce(d.n, 0)) AS head FROM hs LEFT JOIN convs d ON d.conv_id = hs.donor),
rebuilt AS (
  SELECT p.conv_id, o.pos AS d, o.m, o.chars FROM plan p JOIN own o ON o.conv_id = p.donor AND o.pos <= p.h
  UNION ALL
  SELECT p.conv_id, p.head + o.pos - p.h, o.m, o.chars FROM plan p JOIN own o ON o.conv_id = p.conv_id AND o.pos > p.h),
whole AS (
  SELECT p.conv_id, coalesce(r.path, []) AS path, coalesce(r.chars, []) AS chars FROM plan p LEFT JOIN (
    SELECT conv_id, list(m ORDER BY d) AS path, list(chars ORDER BY d) AS chars FROM rebuilt GROUP BY conv_id) r ON r.conv_id = p.conv_id),
pref AS (
  SELECT conv_id, d, len(path) AS k, array_to_string(path[1:d], '') AS key, array_to_string(path[1:d - 1], '') AS up,
         CASE WHEN d = 0 THEN 0 ELSE chars[d] END AS chars
  FROM (SELECT *, unnest(range(0, len(path) + 1)) AS d FROM whole)),
node AS (
  SELECT d, key, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs, max(chars) AS chars, max(k) = d AS leaf,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (k = d), '') AS ends FROM pref GROUP BY d, key),
kids AS (SELECT d - 1 AS d, up AS key, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
sums AS (
  SELECT a.d, a.key, sum(CASE WHEN v.leaf THEN 1 ELSE 0 END) AS n_leaves, sum((v.n_convs - 1) * v.chars) AS saved
  FROM node v JOIN pref a ON a.conv_id = v.conv_id AND a.d <= v.d GROUP BY a.d, a.key)
SELECT v.conv_id, v.d AS depth, u.conv_id AS parent_conv_id, v.n_convs, coalesce(kids.n, 0) AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM node v JOIN sums s ON s.d = v.d AND s.key = v.key LEFT JOIN kids ON kids.d = v.d AND kids.key = v.key
     LEFT JOIN node u ON v.d > 0 AND u.d = v.d - 1 AND u.key = v.up""",
}
