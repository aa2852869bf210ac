"""DuckDB SQL for the corpus queries that SQL can express over whole tables.

The others have none: op1 scores by a fitted model, op3 and op10 by merges and segmentations,
op5 by places of matches, op6 by XXH64, op7 by cutoffs from labels, op9 by hash order. Tests
hold those against plain versions.
"""

from __future__ import annotations

WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLES: dict[str, str] = {
    "op2_exact_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * x::DOUBLE) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0 AND len(embedding) > 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e::DOUBLE[], c.e::DOUBLE[]) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s QUALIFY rank <= 20
""",
    "op4_line_dedup": f"""
WITH t AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
k AS (SELECT doc_id, pos, line, translate(trim(line, {WHITE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM (SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos FROM t)),
c AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
d AS (SELECT k.*, coalesce(k.doc_id < c.last, false) AS gone FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM d GROUP BY doc_id
""",
    "op8_substring_dedup": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
u AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i, len(w) AS n FROM w),
k AS (SELECT *, CASE WHEN i + 12 <= n THEN string_agg(x, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 12 FOLLOWING) END AS key FROM u),
m AS (SELECT key, min(doc_id) AS least FROM k WHERE key IS NOT NULL GROUP BY key),
f AS (SELECT k.*, coalesce(m.least < k.doc_id, false) AS hit FROM k LEFT JOIN m USING (key)),
g AS (SELECT *, max(hit::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) = 1 AS gone FROM f),
a AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE gone) AS r, coalesce(string_agg(x, ' ' ORDER BY i) FILTER (WHERE NOT gone), '') AS kept FROM g GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_words, coalesce(r, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM documents d LEFT JOIN a USING (doc_id)
""",
}
