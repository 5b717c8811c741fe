from __future__ import annotations

from .book import query, table
from .source_mix import mix

# first fit in the order of the id's hash, row by row; ids are taken as unique
SQL = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
    substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS h FROM documents),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM doc GROUP BY source),
step AS (
  SELECT 0 AS i, CAST(sum(source_size) AS BIGINT) AS free, CAST(sum(w) AS BIGINT) AS weight, 0 AS stopped FROM src
  UNION ALL
  SELECT i + 1, CAST((SELECT sum(source_size) FROM src) - sum(source_size * 3) FILTER (w * (free / weight) > source_size * 3) AS BIGINT),
    CAST(sum(w) FILTER (w * (free / weight) <= source_size * 3) AS BIGINT), count(*) FILTER (w * (free / weight) > source_size * 3)
  FROM step, src GROUP BY i, free, weight, stopped HAVING count(*) FILTER (w * (free / weight) > source_size * 3) > stopped),
aim AS (
  SELECT source, source_size, least(w * (free / weight), CAST(source_size * 3 AS DOUBLE)) AS target
  FROM src, (SELECT * FROM step ORDER BY i DESC LIMIT 1)),
plan AS (
  SELECT *, CAST(floor(target - copies * source_size) AS BIGINT) AS budget, CAST(floor(0.001 * target) AS BIGINT) AS near
  FROM (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS copies FROM aim)),
listed AS (SELECT source, list({'id': doc_id, 'size': size} ORDER BY h) AS docs FROM doc WHERE size > 0 GROUP BY source),
fit AS (
  SELECT p.source, docs, near, list_reduce(docs, lambda a, x:
    CASE WHEN a.stop OR x.size > a.most THEN a
      WHEN x.size <= a.rem THEN {'rem': a.rem - x.size, 'most': a.most, 'stop': a.stop, 'got': list_append(a.got, x.id)}
      ELSE {'rem': a.rem, 'most': a.rem, 'stop': a.rem <= near, 'got': a.got} END,
    {'rem': budget, 'most': budget, 'stop': budget <= near, 'got': CAST([] AS BIGINT[])}) AS r
  FROM plan p JOIN listed l ON p.source IS NOT DISTINCT FROM l.source),
other AS (SELECT *, list_filter(docs, lambda x: NOT list_contains(r.got, x.id)) AS rest FROM fit),
last AS (
  SELECT *, CASE WHEN len(rest) > 0 AND NOT r.stop AND r.rem > near THEN list_filter(rest, lambda x: x.size = list_min(list_transform(rest, lambda y: y.size)))[1] END AS one FROM other),
got AS (SELECT source, CASE WHEN one IS NOT NULL AND one.size - r.rem < r.rem THEN list_append(r.got, one.id) ELSE r.got END AS got FROM last)
SELECT d.doc_id, d.size, p.source_size, p.target, d.size * (p.copies + CASE WHEN coalesce(list_contains(g.got, d.doc_id), FALSE) THEN 1 ELSE 0 END) AS taken
FROM doc d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source LEFT JOIN got g ON d.source IS NOT DISTINCT FROM g.source
"""


@query("op12_source_mix", SQL)
def op12_source_mix(spark, sf_dir):
    """How many words of every document the mix of all sources takes."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
