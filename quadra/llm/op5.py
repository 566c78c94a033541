"""Query op5: token counts of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quadra.llm.token_count import count_tokens
from quadra.session import table


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its words and its tokens under the unigram vocabulary."""
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {"op5_token_counts": op5_token_counts}
SQL: dict[str, str] = {}
