"""DuckDB SQL for the operators whose results SQL can express."""

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_OP4 = rf"""
WITH doc_words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
item_words AS (
  SELECT item_id, coalesce(regexp_extract_all(translate(text, {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p:p + least(len(w), 10) - 1], ' ') AS gram
  FROM item_words, unnest(range(1, greatest(len(w) - 9, 1) + 1)) t(p) WHERE len(w) > 0),
grams AS (
  SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS gram
  FROM doc_words, (SELECT DISTINCT n FROM windows) lengths, unnest(range(1, len(w) - n + 2)) t(p)),
hits AS (SELECT doc_id, item_id, p, g.n FROM grams g JOIN windows USING (n, gram)),
hit_words AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM hits, unnest(range(p, p + n)) t(q) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

_OP9 = rf"""
WITH RECURSIVE doc_words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, {_AZ}), '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + least(len(w), 5) - 1], ' ') AS s
  FROM doc_words, unnest(range(1, greatest(len(w) - 4, 1) + 1)) t(p) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
reach(doc_id, other) AS (
  SELECT a, b FROM links UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT d.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles,
       least(d.doc_id, coalesce(min(other), d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(min(other), d.doc_id)) AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN reach USING (doc_id) GROUP BY d.doc_id
"""

_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
                             lambda v, step: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END))))"""

_OP13 = f"""
WITH turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, c - c % 5 AS base, {_CRC32} % 9 AS h FROM (SELECT DISTINCT c FROM turns)),
parts AS (
  SELECT convs.c, 0 AS part, pos, r, x FROM convs JOIN turns ON turns.c = base AND pos < h
  UNION ALL SELECT c, 1, pos, r, x FROM convs JOIN turns USING (c) WHERE pos >= h),
prefixes AS (
  SELECT c, row_number() OVER w AS d, list({{'r': r, 'x': x}}) OVER w AS prefix, strlen(x) AS bytes
  FROM parts WINDOW w AS (PARTITION BY c ORDER BY part, pos)
  UNION ALL SELECT c, 0, [], 0 FROM convs),
paths AS (SELECT c, d, bytes, min(c) OVER (PARTITION BY prefix) AS m, max(d) OVER (PARTITION BY c) AS len FROM prefixes),
nodes AS (
  SELECT d, m, count(*) AS n_convs, any_value(bytes) AS bytes, bool_and(len = d) AS childless,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len = d), '')) AS ends_sha256
  FROM paths GROUP BY d, m),
parents AS (SELECT n.d, n.m, p.m AS parent FROM nodes n JOIN paths p ON p.c = n.m AND p.d = n.d - 1),
children AS (SELECT d - 1 AS d, parent AS m, count(*) AS n_children FROM parents GROUP BY ALL),
totals AS (
  SELECT p.d, p.m, sum(u.childless::INT) AS n_leaves, sum((u.n_convs - 1) * u.bytes) AS saved_tokens
  FROM nodes u JOIN paths p ON p.c = u.m AND p.d <= u.d GROUP BY ALL)
SELECT m AS conv_id, d::BIGINT AS depth, parent AS parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children,
       n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM nodes JOIN totals USING (d, m) LEFT JOIN parents USING (d, m) LEFT JOIN children USING (d, m)
"""

ORACLES = {
    "op4_benchmark_decontamination": _OP4,
    "op9_minhash_near_dedup": _OP9,
    "op13_prefix_trie": _OP13,
}
