"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

SQL: dict[str, str] = {
    "op1_line_dedup": f"""
WITH split AS (
  SELECT row_number() OVER () AS uid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines,
         string_split({_LOWER}, chr(10)) AS low FROM documents),
line AS (
  SELECT uid, doc_id, unnest(lines) AS line, trim(unnest(low), {_SPACE}) AS key,
         unnest(range(len(lines))) AS pos FROM split),
common AS (
  SELECT key, max(doc_id) AS keep FROM line WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) + max(CAST(doc_id IS NULL AS INTEGER)) >= 3),
marked AS (
  SELECT l.uid, l.doc_id, l.line, l.pos, c.key IS NOT NULL AND c.keep IS DISTINCT FROM l.doc_id AS dropped
  FROM line l LEFT JOIN common c ON l.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY uid, doc_id""",
    "op2_warc": """
WITH page AS (
  SELECT page_id, coalesce(html, '') AS html FROM pages),
sized AS (
  SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest FROM page),
first AS (
  SELECT payload_digest, max(page_id) AS page_id FROM sized WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT s.page_id, s.payload_bytes, s.payload_digest,
       CASE WHEN f.page_id <> s.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.page_id <> s.page_id THEN f.page_id END AS refers_to, 'ok' AS status
FROM sized s LEFT JOIN first f ON s.payload_digest = f.payload_digest""",
    "op7_decontaminate": f"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
item AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
win AS (
  SELECT DISTINCT item_id, size, array_to_string(list_slice(ws, p, p + size - 1), ' ') AS gram
  FROM (SELECT item_id, ws, least(10, len(ws)) AS size,
               unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS p FROM item WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT size FROM win),
gram AS (
  SELECT doc_id, size, p, array_to_string(list_slice(ws, p, p + size - 1), ' ') AS gram
  FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS p
        FROM doc, sizes WHERE len(ws) >= size)),
hit AS (SELECT g.doc_id, g.size, g.p, w.item_id FROM gram g JOIN win w ON g.size = w.size AND g.gram = w.gram),
place AS (SELECT doc_id, count(DISTINCT pos) AS n_hit
          FROM (SELECT doc_id, unnest(range(p, p + size)) AS pos FROM hit) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS keys
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(p.n_hit, 0) AS n_hit,
       coalesce(f.n_items, 0) AS n_items, sha256(coalesce(f.keys, '')) AS items_sha256,
       p.n_hit IS NOT NULL AS contaminated
FROM doc d LEFT JOIN place p ON d.doc_id = p.doc_id LEFT JOIN found f ON d.doc_id = f.doc_id""",
    "op8_jaccard_join": f"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(ws, p, p + 4), ' ') AS gram
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(1, len(ws) - 4) + 1)) AS p FROM doc WHERE len(ws) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
pair AS (
  SELECT a.doc_id AS i, b.doc_id AS j, count(*) AS k
  FROM shingle a JOIN shingle b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
  SELECT i, j FROM pair JOIN size a ON a.doc_id = i JOIN size b ON b.doc_id = j
  WHERE 100 * k >= 80 * (a.n + b.n - k)),
reach AS (
  SELECT doc_id, doc_id AS seen FROM doc
  UNION SELECT r.doc_id, l.j FROM reach r JOIN link l ON r.seen = l.i)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
FROM doc d LEFT JOIN size s ON d.doc_id = s.doc_id
JOIN (SELECT doc_id, min(seen) AS component_id FROM reach GROUP BY doc_id) r ON d.doc_id = r.doc_id""",
    "op9_kd_trees": """
WITH vec AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM vec q JOIN vec c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5""",
    "op13_lexical_search": f"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
item AS (
  SELECT item_id, list_distinct(regexp_extract_all(
    {_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS ws FROM benchmark),
total AS (
  SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(len(ws)) AS BIGINT) AS l FROM doc WHERE len(ws) > 0),
held AS (
  SELECT doc_id, term, CAST(n AS BIGINT) AS n, count(*) AS tf
  FROM (SELECT doc_id, len(ws) AS n, unnest(ws) AS term FROM doc) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM held GROUP BY term),
weight AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * n + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM df, total),
asked AS (SELECT item_id, unnest(ws) AS term FROM item),
scored AS (
  SELECT a.item_id, h.doc_id,
         CAST(sum(w.w * ((1000000000 * h.tf) // (1000 * h.tf + 8 * (10 + (90 * h.n * t.n) // t.l)))) AS BIGINT) AS score
  FROM asked a JOIN weight w ON a.term = w.term JOIN held h ON a.term = h.term, total t
  GROUP BY a.item_id, h.doc_id),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
}
