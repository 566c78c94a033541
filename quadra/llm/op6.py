"""Query op6: near-duplicate documents by n-gram Jaccard similarity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quadra.llm.jaccard import near_duplicates
from quadra.session import table


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its class, and its number of links at a similarity of 0.8 or more over five-word n-grams."""
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {"op6_ngram_jaccard": op6_ngram_jaccard}

#: All pairs that share an n-gram, over the whole table; classes by the closure of the links.
SQL = {
    "op6_ngram_jaccard": r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+') AS w FROM documents),
g AS (SELECT DISTINCT r, w[i:i + k - 1] AS gram FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM (SELECT *, least(5, len(w)) AS k FROM d WHERE len(w) > 0))),
n AS (SELECT r, count(*) AS n FROM g GROUP BY r),
links AS (
  SELECT p.a, p.b FROM (SELECT a.r AS a, b.r AS b, count(*) AS shared FROM g a JOIN g b ON a.gram = b.gram AND a.r <> b.r GROUP BY ALL) p
  JOIN n x ON x.r = p.a JOIN n y ON y.r = p.b WHERE 5 * shared >= 4 * (x.n + y.n - shared)),
reach AS (SELECT r AS a, r AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT d.doc_id, (SELECT min(o.doc_id) FROM reach JOIN d o ON o.r = reach.b WHERE reach.a = d.r) AS class_id,
  (SELECT count(*) FROM links WHERE links.a = d.r) AS n_links,
  CASE WHEN len(d.w) > 0 THEN (SELECT count(*) FROM d o WHERE o.text = d.text) - 1 ELSE 0 END AS n_copies FROM d
"""
}
