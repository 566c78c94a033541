"""Query op1: archive the pages, read the archives back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadra.llm.warc import read_warc, write_warc
from quadra.session import shared_path, table


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per page: length and digest of the full payload, record type, and the page that a revisit refers to."""
    path = shared_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path)
    fields = {"bytes": F.octet_length("payload").cast("long"), "sha256": F.sha2("payload", 256)}
    read = read_warc(spark, path, fields)
    number = lambda c: F.regexp_extract(c, r"^urn:page:(-?[0-9]+)$", 1).try_cast("long")
    again = F.col("record_type") == "revisit"
    return read.select(
        number("record_id").alias("page_id"),
        F.when(again, F.col("payload_length")).otherwise(F.col("bytes")).alias("payload_bytes"),
        F.when(again, F.col("digest")).otherwise(F.col("sha256")).alias("payload_digest"),
        "record_type",
        F.when(again, number("refers_to")).alias("refers_to"),
    )


QUERIES = {"op1_warc": op1_warc}
SQL = {
    "op1_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
f AS (SELECT html, min(page_id) AS first FROM p WHERE strlen(html) >= 100 GROUP BY html)
SELECT p.page_id, CAST(strlen(p.html) AS BIGINT) AS payload_bytes, sha256(p.html) AS payload_digest,
       CASE WHEN f.first <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first <> p.page_id THEN f.first END AS refers_to
FROM p LEFT JOIN f ON p.html = f.html
"""
}
