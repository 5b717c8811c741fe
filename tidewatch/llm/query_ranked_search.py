from __future__ import annotations

from .book import query, table
from .ranked_search import search

SQL = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ts
  FROM documents WHERE text IS NOT NULL),
total AS (SELECT count(*) AS big_n, CAST(sum(len(ts)) AS BIGINT) AS big_l FROM doc WHERE len(ts) > 0),
wanted AS (
  SELECT item_id, term, count(*) AS q FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term
    FROM benchmark WHERE text IS NOT NULL) GROUP BY ALL),
held AS (
  SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(ts) AS n, unnest(ts) AS term FROM doc)
  WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM held GROUP BY term), total),
scored AS (
  SELECT item_id, doc_id, CAST(sum(q * w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * big_n) // big_l)))) AS BIGINT) AS score
  FROM wanted JOIN held USING (term) JOIN weight USING (term), total GROUP BY item_id, doc_id),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@query("op11_ranked_search", SQL)
def op11_ranked_search(spark, sf_dir):
    """The ten best documents of every benchmark item."""
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
