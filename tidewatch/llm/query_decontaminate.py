from __future__ import annotations

from pyspark.sql import functions as F

from .book import query, table
from .decontaminate import find

SQL = r"""
WITH doc AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
spot AS (
  SELECT item_id, ws, least(len(ws), 10) AS k, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS p FROM item WHERE len(ws) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(ws[p:p + k - 1], ' ') AS words FROM spot),
width AS (SELECT DISTINCT k FROM win),
place AS (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS p FROM doc, width WHERE len(ws) >= k),
held AS (SELECT doc_id, k, p, array_to_string(ws[p:p + k - 1], ' ') AS words FROM place),
hit AS (SELECT doc_id, p, k, item_id FROM held JOIN win USING (k, words)),
hit_word AS (SELECT doc_id, count(DISTINCT w) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS w FROM hit) GROUP BY doc_id),
hit_item AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit_word USING (doc_id) LEFT JOIN hit_item USING (doc_id)
"""


@query("op1_suffix_decontamination", SQL)
def op1_suffix_decontamination(spark, sf_dir):
    """Words of every document inside a benchmark window of ten words, and the items found."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )
