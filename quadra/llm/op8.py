"""Query op8: fingerprints of documents and of their edited texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadra.llm.fingerprint import as_text, lanes, likeness, with_next
from quadra.session import table


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the fingerprint of its text and of the text whose last third comes from the next document."""
    docs = with_next(table(spark, sf_dir, "documents").select("doc_id", "text"))
    docs = docs.withColumn("text", F.coalesce("text", F.lit("")))
    docs = docs.withColumn("n_chars", F.char_length("text").cast("long"))
    keep = F.col("n_chars") - F.floor(F.col("n_chars") / 3)
    tail = F.substring(F.col("head_next"), F.lit(1), F.floor(F.col("n_chars") / 3).cast("int"))
    docs = docs.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), keep.cast("int")), tail))
    docs = docs.withColumns({"own": lanes(F.col("text")), "changed": lanes(F.col("edited"))})
    return docs.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_lanes")).alias("near_next"),
    )


QUERIES = {"op8_fingerprint": op8_fingerprint}
SQL: dict[str, str] = {}
