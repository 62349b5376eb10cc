"""DuckDB SQL for the ``opN_*`` queries that SQL can state, from the contracts."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ITEM_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP4 = f"""
WITH d AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark),
pat AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS m, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS p
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS i FROM b WHERE len(w) > 0)),
win AS (
  SELECT doc_id, i, m, array_to_string(w[i : i + m - 1], ' ') AS p
  FROM (SELECT doc_id, w, m, unnest(generate_series(1, len(w) - m + 1)) AS i
        FROM d, (SELECT DISTINCT m FROM pat) WHERE len(w) >= m)),
occ AS (SELECT doc_id, i, win.m, item_id FROM win JOIN pat ON win.p = pat.p AND win.m = pat.m),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit
        FROM (SELECT doc_id, unnest(generate_series(i, i + m - 1)) AS k FROM (SELECT DISTINCT doc_id, i, m FROM occ))
        GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)"""

OP10 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
win AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY p ORDER BY doc_id, i) AS place
  FROM (SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS p
        FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM d WHERE len(w) >= 20))),
gone AS (SELECT DISTINCT doc_id, k FROM (SELECT doc_id, unnest(generate_series(i, i + 19)) AS k FROM win WHERE place > 1)),
word AS (SELECT doc_id, unnest(w) AS x, unnest(generate_series(1, len(w))) AS k FROM d),
kept AS (SELECT doc_id, count(*) AS n_kept, string_agg(x, ' ' ORDER BY k) AS t
         FROM word ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

OP5 = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS hex FROM pages),
f AS (SELECT hex, min(page_id) AS first FROM p GROUP BY hex)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(generate_series(0, 31), lambda k:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + CAST((CAST('0x' || substr(hex, 1 + 5 * (k // 4), 5) AS BIGINT) >> (15 - 5 * (k % 4))) & 31 AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first THEN first END AS refers_to
FROM p JOIN f USING (hex)"""

ORACLE = {"op5_warc_chunks": OP5, "op4_decontaminate": OP4, "op10_substring_dedup": OP10}
