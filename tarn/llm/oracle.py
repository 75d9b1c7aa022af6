"""DuckDB SQL of the corpus queries that SQL can express."""

#: Words, shingle sets, all pairs that share a shingle, exact Jaccard, and
#: the components by a recursive walk over links.
OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(CASE WHEN len(ws) < 4 THEN ws ELSE ws[i:i + 3] END, ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT a, b FROM shared JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT DISTINCT a AS doc_id, a AS r FROM edges
  UNION
  SELECT reach.doc_id, edges.b FROM reach JOIN edges ON reach.r = edges.a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, w.doc_id) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id
LEFT JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) c ON c.doc_id = w.doc_id
"""

#: Every 100-byte string with its first start; covered runs; the rest's hash.
OP9_SQL = """
WITH h AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
p AS (
  SELECT doc_id, i, substr(x, 2 * i + 1, 200) AS s FROM (SELECT doc_id, x, unnest(range(0, n - 99)) AS i FROM h WHERE n >= 100)),
f AS (SELECT doc_id, i FROM p QUALIFY row_number() OVER (PARTITION BY s ORDER BY doc_id, i) > 1),
g AS (
  SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run
  FROM (SELECT doc_id, i, CASE WHEN i > coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -1000) + 100 THEN 1 ELSE 0 END AS fresh FROM f)),
spans AS (SELECT doc_id, min(i) AS lo, max(i) + 100 AS hi FROM g GROUP BY doc_id, run),
cut AS (
  SELECT doc_id, string_agg(substr(x, 2 * before + 1, 2 * (lo - before)), '' ORDER BY lo) AS head, max(hi) AS last,
    sum(hi - lo) AS removed, count(*) AS spans
  FROM (SELECT s.*, h.x, coalesce(lag(hi) OVER (PARTITION BY s.doc_id ORDER BY lo), 0) AS before FROM spans s JOIN h ON h.doc_id = s.doc_id)
  GROUP BY doc_id)
SELECT h.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN cut.doc_id IS NULL THEN x ELSE head || substr(x, 2 * last + 1) END)) AS kept_sha256
FROM h LEFT JOIN cut ON cut.doc_id = h.doc_id
"""

#: Windows of an item's size at every shared shingle, and their weighted
#: similarity; no fingerprints.
OP4_SQL = r"""
WITH it AS (
  SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS ws FROM benchmark),
ig AS (
  SELECT item_id, len(ws) AS n, least(len(ws), 5) AS k, o, array_to_string(ws[o + 1:o + least(len(ws), 5)], ' ') AS g
  FROM (SELECT item_id, ws, unnest(range(0, len(ws) - least(len(ws), 5) + 1)) AS o FROM it WHERE len(ws) > 0)),
ic AS (SELECT item_id, k, g, count(*) AS c, 1.0 / count(*) OVER (PARTITION BY g) AS w FROM ig GROUP BY item_id, k, g),
total AS (SELECT item_id, sum(c * w) AS weight FROM ic GROUP BY item_id),
d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS ws FROM documents),
dg AS (
  SELECT doc_id, len(ws) AS len, k, p, array_to_string(ws[p + 1:p + k], ' ') AS g
  FROM (SELECT doc_id, ws, k, unnest(range(0, len(ws) - k + 1)) AS p FROM d, (SELECT DISTINCT k FROM ig) WHERE len(ws) >= k)),
win AS (
  SELECT DISTINCT doc_id, item_id, ig.k, least(n, len) AS size, greatest(0, least(p - o, len - least(n, len))) AS start
  FROM dg JOIN ig ON dg.g = ig.g AND dg.k = ig.k),
hit AS (
  SELECT win.doc_id, win.item_id, win.start, ic.g, ic.w, least(ic.c, count(*)) AS c
  FROM win JOIN dg ON dg.doc_id = win.doc_id AND dg.k = win.k AND dg.p BETWEEN win.start AND win.start + win.size - win.k
  JOIN ic ON ic.item_id = win.item_id AND ic.g = dg.g
  GROUP BY win.doc_id, win.item_id, win.start, ic.g, ic.w, ic.c),
sim AS (
  SELECT doc_id, item_id, start, round(sum(c * w) / any_value(weight), 9) AS similarity
  FROM hit JOIN total USING (item_id) GROUP BY doc_id, item_id, start)
SELECT doc_id, item_id, max(similarity) AS similarity FROM sim WHERE similarity >= 0.8 GROUP BY doc_id, item_id
"""
