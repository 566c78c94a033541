"""Query op9: toxicity of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadra.llm.toxicity import fit, learnable, score
from quadra.session import table


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its score, the prediction at 0.5, and the nearest labelled examples."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    scored = score(docs, model)
    return scored.select("doc_id", (~learnable()).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


QUERIES = {"op9_toxicity": op9_toxicity}
SQL: dict[str, str] = {}
