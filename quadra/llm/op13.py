"""Query op13: token files of the documents, written and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quadra.llm.token_files import crc32, read_token_files, write_token_files
from quadra.session import shared_path, table


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document, from the files: the ids before it, its own ids' number and CRC-32."""
    import public_tokenizers

    path = shared_path(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"))
    return read_token_files(spark, path, derive=crc32, schema="ids_crc32 long")


QUERIES = {"op13_token_files": op13_token_files}
SQL: dict[str, str] = {}
