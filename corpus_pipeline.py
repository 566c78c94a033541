"""The corpus pipeline: toxicity, quality rules, near duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir), works on all documents that its predecessor kept, and returns a DataFrame that is
written as Parquet and read again as the next one's docs. All but the last return the columns of ``documents``, whatever
their names: working columns get names that the documents do not have, or the documents travel inside a struct.

Null and empty texts are clean for toxicity and have no personal data; they fail the quality rules. Null keys and repeated
rows: of equal rows one stays at near duplicates; rows with a null key are judged by their texts as others are, and give way to rows
like them that have a key. Empty tables stay empty. Very long texts are worked on whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quadra.llm.jaccard import near_duplicates, text_node
from quadra.llm.packing import pack_documents
from quadra.llm.pii import find_pii, redact
from quadra.llm.quality import Limits, fit_references, judge, measure
from quadra.llm.toxicity import fit, score
from quadra.session import stored, table


def _free(docs: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores in front as it takes to differ from all columns."""
    out, taken = [], {c.lower() for c in docs.columns}
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.5 or more go."""
    into = _free(docs, "toxicity_score", "toxicity_evidence")
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model, columns=docs.columns, into=tuple(into)).where(F.col(into[0]) < 0.5).select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or diverge from their language go."""
    packed = docs.select(F.struct(*docs.columns).alias("document"), F.col("lang").alias("lang"), F.col("text").alias("text"))
    measured = stored(measure(packed).drop("text"), "measured")
    return judge(measured, fit_references(measured, Limits()), Limits()).where("kept").select("document.*")


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest doc_id stays (of null keys, that with the smallest digest of
    its text, if the class has no other keys); of repeated rows, one. A row stays by its key and its text, so that rows with a
    null key do not depend on others that are not like them."""
    first, node, own, n, digest = _free(docs, "first_id", "first_node", "node_of_text", "row_of_id", "digest_of_text")
    classes = near_duplicates(docs, leads=True).where("leads").select(F.col("doc_id").alias(first), F.col("node").alias(node)).distinct()
    marked = docs.withColumn(own, text_node(F.coalesce(F.col("text"), F.lit(""))))
    kept = marked.join(classes, (F.col(own) == F.col(node)) & F.col("doc_id").eqNullSafe(F.col(first)), "left_semi").drop(own)
    # rows of one key and text; a null key may have very many texts
    once = F.row_number().over(W.partitionBy("doc_id", digest).orderBy("doc_id"))
    return kept.withColumn(digest, F.sha2(F.col("text"), 256)).withColumn(n, once).where(F.col(n) == 1).select(*docs.columns)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by the name of its kind, and n_chars is counted again."""
    into = _free(docs, "pii")[0]
    found = find_pii(docs, into=into)
    clean = found.withColumn("text", F.when(F.col("text").isNotNull(), redact(F.col("text"), F.col(into))))
    return clean.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents, each with its sequence and place."""
    import public_tokenizers

    packed = pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), 4096, ids=False)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [("toxicity", toxicity), ("quality", quality), ("near_duplicate", near_duplicate), ("pii", pii), ("packing", packing)]

#: SQL expresses neither the trained scores nor the tokenizer; tests/llm/test_pipeline.py compares each stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict:
    return {"pipeline": run}


def oracle_sql() -> dict:
    return {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
