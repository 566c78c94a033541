"""Query op2: personal data in documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadra.llm.pii import find_pii
from quadra.session import table


def _joined(spans: Column) -> Column:
    parts = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string")))
    return F.concat_ws(",", parts)


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: spans by kind, the digest of the base spans, and all spans."""
    found = find_pii(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("pii", lambda s: s["base"] & (s["kind"] == kind))).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in ("email", "ip", "card", "phone")],
        F.sha2(_joined(F.filter("pii", lambda s: s["base"])), 256).alias("base_sha256"),
        _joined(F.col("pii")).alias("spans"),
    )


QUERIES = {"op2_pii": op2_pii}
SQL: dict[str, str] = {}
