"""DuckDB SQL of the operators that SQL can express (meant for small tables: it compares words and shingles as text)."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = r"[^\x20\x09-\x0D]+"
PLAIN = r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+"

SQL: dict[str, str] = {
    "op1_decontamination": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(text), '{PLAIN}') AS ws FROM documents WHERE text IS NOT NULL),
b AS (SELECT item_id, regexp_extract_all(lower(text), '{PLAIN}') AS ws FROM benchmark WHERE text IS NOT NULL),
ds AS (SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 4), ' ') AS s
       FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM d WHERE len(ws) >= 5)),
bs AS (SELECT item_id, i, array_to_string(list_slice(ws, i, i + 4), ' ') AS s
       FROM (SELECT item_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM b WHERE len(ws) >= 5)),
hit AS (SELECT DISTINCT doc_id, item_id, i + unnest(range(0, 5)) AS p FROM (SELECT doc_id, item_id, i FROM ds JOIN bs USING (s))),
share AS (SELECT doc_id, item_id, count(*) AS n FROM hit GROUP BY ALL)
SELECT doc_id, item_id, n / len(ws) AS question_overlap, 1.0::DOUBLE AS answer_overlap
FROM share JOIN b USING (item_id) WHERE n / len(ws) >= 0.8""",
    "op9_substring_dedup": rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 34), ' ') AS k
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35)),
again AS (SELECT doc_id, i FROM win JOIN (SELECT k FROM win GROUP BY k HAVING count(*) > 1) USING (k)),
gone AS (SELECT DISTINCT doc_id, i + unnest(range(0, 35)) AS p FROM again),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS body
         FROM (SELECT doc_id, unnest(ws) AS x, generate_subscripts(ws, 1) AS p FROM w) ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)""",
    "op10_jaccard_join": rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORDS}') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 4), ' ') AS k
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) >= 1)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM pairs JOIN n na ON na.doc_id = x JOIN n nb ON nb.doc_id = y WHERE 100 * c >= 80 * (na.n + nb.n - c)),
reach(x, y) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT w.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.y) AS component_id
FROM w LEFT JOIN n USING (doc_id) JOIN reach r ON r.x = w.doc_id GROUP BY w.doc_id""",
}
