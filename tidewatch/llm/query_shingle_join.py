from __future__ import annotations

from .book import query, table
from .shingle_join import grouped

SQL = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS ws
  FROM documents),
spot AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS p FROM doc WHERE len(ws) > 0),
shingle AS (SELECT DISTINCT doc_id, array_to_string(ws[p:p + 4], ' ') AS s FROM spot),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM shared JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
reach AS (SELECT doc_id, doc_id AS other FROM doc UNION SELECT reach.doc_id, link.b FROM reach JOIN link ON link.a = reach.other),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM doc JOIN least USING (doc_id) LEFT JOIN size USING (doc_id)
"""


@query("op6_combination_join", SQL)
def op6_combination_join(spark, sf_dir):
    """Components of documents whose 5-word shingles are 80 % the same."""
    return grouped(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")
