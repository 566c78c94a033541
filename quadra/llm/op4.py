"""Query op4: packing of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quadra.llm.packing import pack_documents
from quadra.session import table


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per piece: where it comes from, and where it lies. The ids themselves stay behind as their CRC-32."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    packed = pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), 4096, ids=False)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


QUERIES = {"op4_packing": op4_packing}
SQL: dict[str, str] = {}
