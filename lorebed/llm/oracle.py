"""DuckDB SQL for those training-data queries that SQL can express on whole tables."""

from __future__ import annotations

from . import centroids, infill, licences, linededup, sharding, urlfilter

ORACLE: dict[str, str] = {}

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE["op9_decontamination"] = f"""
WITH b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
bw AS (
  SELECT item_id, w, least(len(w), 13) AS size, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS j FROM b WHERE len(w) > 0
),
bs AS (SELECT item_id, size, j, array_to_string(w[j:j + size - 1], ' ') AS s FROM bw),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
dw AS (
  SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, (SELECT DISTINCT size FROM bs) WHERE len(w) >= size
),
ds AS (SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS s FROM dw),
m AS (SELECT doc_id, item_id, size, i, j FROM ds JOIN bs USING (size, s)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM m) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM m) GROUP BY 1),
runs AS (
  SELECT doc_id, item_id, min(i) AS pos, max(i) - min(i) + max(size) AS words
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, item_id, i - j ORDER BY i) AS run FROM m) GROUP BY doc_id, item_id, i - j, run
),
best AS (SELECT doc_id, min(struct_pack(w := -words, id := item_id::VARCHAR, p := pos)) AS b FROM runs GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated, coalesce(-b.w, 0)::BIGINT AS longest, b.id AS longest_item,
  (b.p - 1)::BIGINT AS longest_at
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id) LEFT JOIN best USING (doc_id)
"""

ORACLE["op8_licences"] = licences.duckdb_sql()

ORACLE["op10_url_filter"] = urlfilter.duckdb_sql()

ORACLE["op4_line_dedup"] = linededup.duckdb_sql()

ORACLE["op11_sharding"] = sharding.duckdb_sql()

ORACLE["op12_infill"] = infill.duckdb_sql()

ORACLE["op13_centroids"] = centroids.duckdb_sql()
