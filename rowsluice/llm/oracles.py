"""DuckDB SQL with the rows of those queries that SQL can express."""

AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
ALNUM = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
WORD = r"'[^\x20\x09-\x0D]+'"

DECONTAMINATE = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), {AZ}), {ALNUM}) AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(coalesce(text, ''), {AZ}), {ALNUM}) AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(13, len(w)) AS size, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS g
  FROM (SELECT item, w, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS i FROM b WHERE len(w) > 0)),
dw AS (
  SELECT r, size, i, array_to_string(w[i : i + size - 1], ' ') AS g
  FROM (SELECT r, w, size, unnest(generate_series(1, len(w) - size + 1)) AS i
        FROM d, (SELECT DISTINCT size FROM bw) WHERE len(w) >= size)),
hit AS (SELECT r, dw.size, i, item FROM dw JOIN bw ON dw.g = bw.g AND dw.size = bw.size),
words AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(generate_series(i, i + size - 1)) AS p FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256,
       coalesce(words.n, 0) > 0 AND 20 * coalesce(words.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

QUALITY = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), {WORD}) AS w FROM documents),
l AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
lw AS (SELECT r, line, array_to_string(regexp_extract_all(
         regexp_replace(translate(line, {AZ}), '[0-9]', '0', 'g'), {WORD}), ' ') AS norm,
         len(regexp_extract_all(line, {WORD})) AS n FROM l WHERE len(regexp_extract_all(line, {WORD})) > 0),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM lw GROUP BY r),
g AS (SELECT r, i, array_to_string(w[i : i + 2], ' ') AS g
      FROM (SELECT r, w, unnest(generate_series(1, len(w) - 2)) AS i FROM d WHERE len(w) >= 3)),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (
          SELECT g.r, unnest([i, i + 1, i + 2]) AS p
          FROM g JOIN (SELECT r, g FROM g GROUP BY r, g HAVING count(*) > 1) m ON g.r = m.r AND g.g = m.g) GROUP BY r),
common AS (SELECT host, norm, min(doc_id) AS first_doc FROM lw JOIN d USING (r)
           GROUP BY host, norm HAVING count(DISTINCT t) > 100),
cut AS (SELECT r, sum(n) AS n FROM lw JOIN d USING (r) JOIN common USING (host, norm) WHERE doc_id <> first_doc GROUP BY r),
c AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
        CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, CAST(coalesce(cut.n, 0) AS BIGINT) AS n_line_words
      FROM d LEFT JOIN dup USING (r) LEFT JOIN rep USING (r) LEFT JOIN cut USING (r)),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM c)
SELECT *, NOT base_failed AND NOT (n_line_words > 0 AND 5 * (n_words - n_line_words) < n_words) AS kept FROM v
"""


def _leaf(text: str) -> str:
    values = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)
    return "sha256(concat(" + ", ".join(f"coalesce(strlen({x}) || ':' || {x}, '-')" for x in values) + "))"


# Levels by recursion; crc32 by its bits, as DuckDB has no such function.
MERKLE = f"""
WITH RECURSIVE d AS (
  SELECT *, row_number() OVER (PARTITION BY part ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY part) AS n
  FROM (SELECT doc_id, coalesce('=' || lang, '-') AS part, {_leaf('text')} AS leaf, {_leaf(f'translate(text, {AZ})')} AS changed,
          list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split_regex(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
            lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], [0, 0, 0, 0, 0, 0, 0, 0]),
              lambda x, y: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END))) AS crc
        FROM documents)),
t AS (
  SELECT 0 AS level, part, pos, n, leaf AS node FROM d
  UNION ALL
  SELECT level + 1, part, pos // 8, (n + 7) // 8, sha256(string_agg(node, '' ORDER BY pos))
  FROM t WHERE n > 1 GROUP BY level, part, pos // 8, n),
r AS (
  SELECT 0 AS level, row_number() OVER (ORDER BY part) - 1 AS pos, count(*) OVER () AS n, node FROM t WHERE n = 1
  UNION ALL
  SELECT level + 1, pos // 8, (n + 7) // 8, sha256(string_agg(node, '' ORDER BY pos)) FROM r WHERE n > 1 GROUP BY level, pos // 8, n),
sides AS (
  SELECT level, part, pos, string_agg(node, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l,
         string_agg(node, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS r
  FROM t WHERE n > 1 WINDOW w AS (PARTITION BY level, part, pos // 8 ORDER BY pos)),
rsides AS (
  SELECT level, pos, string_agg(node, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS l,
         string_agg(node, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS r
  FROM r WHERE n > 1 WINDOW w AS (PARTITION BY level, pos // 8 ORDER BY pos)),
tops AS (SELECT part, node AS subroot, row_number() OVER (ORDER BY part) - 1 AS rpos FROM t WHERE n = 1),
walk AS (
  SELECT d.part, d.pos AS leaf_pos, 0 AS level, d.pos, '' AS proof, CASE WHEN crc IS NOT NULL AND xor(crc, 4294967295) % 3 = 0 AND changed IS NOT NULL THEN changed ELSE leaf END AS node
  FROM d
  UNION ALL
  SELECT walk.part, leaf_pos, walk.level + 1, walk.pos // 8, proof || coalesce(l, '') || coalesce(r, ''), sha256(coalesce(l, '') || node || coalesce(r, ''))
  FROM walk JOIN sides ON walk.level = sides.level AND walk.part = sides.part AND walk.pos = sides.pos),
below AS (SELECT part, leaf_pos, max(level) AS level FROM walk GROUP BY part, leaf_pos),
up AS (
  SELECT walk.part, leaf_pos, 0 AS level, rpos AS pos, proof, node FROM walk JOIN below USING (part, leaf_pos, level) JOIN tops USING (part)
  UNION ALL
  SELECT up.part, leaf_pos, up.level + 1, up.pos // 8, proof || coalesce(l, '') || coalesce(r, ''), sha256(coalesce(l, '') || node || coalesce(r, ''))
  FROM up JOIN rsides ON up.level = rsides.level AND up.pos = rsides.pos),
over AS (SELECT part, leaf_pos, max(level) AS level FROM up GROUP BY part, leaf_pos)
SELECT doc_id, leaf, subroot, (SELECT node FROM r WHERE n = 1) AS root, sha256(proof) AS proof_sha256, up.node AS folded_root,
       up.node = (SELECT node FROM r WHERE n = 1) AS verified
FROM d JOIN tops USING (part) JOIN up ON up.part = d.part AND up.leaf_pos = d.pos JOIN over ON over.part = up.part AND over.leaf_pos = up.leaf_pos AND over.level = up.level
"""
