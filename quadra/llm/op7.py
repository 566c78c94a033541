"""Query op7: byte-level BPE of documents, there and back."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from quadra.llm.byte_bpe import encode_documents
from quadra.session import table


def _digests(codec, ids):
    return len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(codec.decode(ids)).hexdigest()


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: number of ids, and the digests of the ids and of the bytes decoded from them."""
    import public_tokenizers

    docs = table(spark, sf_dir, "documents")
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, derive=_digests, schema=schema)


QUERIES = {"op7_byte_bpe": op7_byte_bpe}
SQL: dict[str, str] = {}
