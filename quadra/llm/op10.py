"""Query op10: language-model scores of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quadra.llm.lm import fit, score
from quadra.session import table


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the unigram base score and the model's score, both as log10 of the text's probability."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model, counts = fit(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return score(docs, model, counts)


QUERIES = {"op10_lm_scoring": op10_lm_scoring}
SQL: dict[str, str] = {}
