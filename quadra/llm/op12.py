"""Query op12: alignment of two tokenisers over the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadra.llm.alignment import align, weigh
from quadra.session import stored, table


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: tokens of both sides, groups, links, how well known the links are over all documents, digest of the groups."""
    import public_tokenizers
    import sentencepiece

    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    size = sentencepiece.SentencePieceProcessor(model_file=b).get_piece_size()
    aligned = stored(align(table(spark, sf_dir, "documents"), a, b, digest=True), "aligned")
    return weigh(aligned, size).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256"))


QUERIES = {"op12_alignment": op12_alignment}
SQL: dict[str, str] = {}
