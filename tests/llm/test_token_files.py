import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quadra.llm import op13, token_files
from quadra.llm.token_files import crc32, read_document, read_token_files, write_token_files
from quadra.session import shared_path

PATH = P.path("word_bpe_49k.json")


def library(texts):
    return [e.ids + [2] for e in Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def wanted(docs):
    """docs in key order -> (key, start, n, crc32)."""
    start, out = 0, []
    for (k, _), ids in zip(docs, library([t for _, t in docs])):
        out.append((k, start, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = sorted(tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    assert sorted(tuple(r) for r in op13.op13_token_files(spark, sf).collect()) == wanted(docs)


def test_blocks_documents_and_keys(spark, monkeypatch):
    """Small blocks in several parts; documents by key, with the frames of others left alone."""
    monkeypatch.setattr(token_files, "BLOCK", 2_000)
    rng = random.Random(3)
    words = ["alpha", "Beta's", "gamma42", "ünï", "字", "x" * 30]
    docs = [(k * 3 - 500, " ".join(rng.choices(words, k=rng.randint(0, 300)))) for k in range(400)]
    shuffled = docs[:]
    rng.shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "doc_id long, text string").repartition(5)
    path = shared_path(spark, "tokens")
    write_token_files(df, path, PATH)
    assert sorted(tuple(r) for r in read_token_files(spark, path, derive=crc32, schema="ids_crc32 long").collect()) == wanted(docs)
    blocks = spark.read.parquet(f"{path}/blocks")
    assert blocks.count() > 20 and blocks.select("dictionary").distinct().count() == 1
    ids = dict(zip([k for k, _ in docs], library([t for _, t in docs])))
    for k in (-500, 1, 697):
        assert read_document(spark, path, k) == [ids[k]]
    assert read_document(spark, path, 2) == []
    some = [-500, -497, 100, 697, 698]
    got = read_token_files(spark, path, keys=spark.createDataFrame([(k,) for k in some], "doc_id int"))
    assert {r.doc_id: r.ids for r in got.collect()} == {k: ids[k] for k in some if k in ids}
    # frames are small because they share the dictionary
    plain = sum(len(ids[k]) * 2 for k in ids)
    assert blocks.agg(F.sum(F.octet_length("frames"))).first()[0] < plain / 2


def test_another_dictionary_is_an_error(spark):
    df = spark.createDataFrame([(k, f"text number {k} " * 20) for k in range(100)], "doc_id long, text string")
    one, two = shared_path(spark, "tokens"), shared_path(spark, "tokens")
    write_token_files(df, one, PATH)
    write_token_files(df.limit(2), two, PATH)
    spark.read.parquet(f"{two}/dictionary").write.mode("overwrite").parquet(f"{one}/dictionary")
    with pytest.raises(Exception, match="another dictionary"):
        read_token_files(spark, one).collect()


def test_edges(spark):
    texts = [None, "", " \n\t", "don't stop<|endoftext|>NOW\x1cé　É x y", "word " * 9000, "a" * 9000, "same text", "same text", "ΑΣ ΟΔΟΣ ΣΑΣ", "x\x85y z"]
    docs = list(enumerate(texts))
    df = spark.createDataFrame([(k, t, 1, "q") for k, t in docs], "doc_id long, text string, row int, frame string")
    path = shared_path(spark, "tokens")
    write_token_files(df, path, PATH)
    got = sorted((r.doc_id, r.start, r.n_tokens, zlib.crc32(np.asarray(r.ids, "<u4").tobytes())) for r in read_token_files(spark, path).collect())
    assert got == wanted(docs)
    rows = [(None, "x"), (None, None), (1, "same text"), (1, "same text"), (1, "other")]
    path = shared_path(spark, "tokens")
    write_token_files(spark.createDataFrame(rows, "doc_id long, text string"), path, PATH)
    found = read_token_files(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in found] == [None, None, 1, 1, 1]
    assert [r.start for r in found] == [sum(r.n_tokens for r in found[:k]) for k in range(5)]
    assert sorted(map(tuple, read_document(spark, path, 1))) == sorted(map(tuple, library(["same text", "same text", "other"])))
    path = shared_path(spark, "tokens")
    write_token_files(df.limit(0), path, PATH)
    assert read_token_files(spark, path).count() == 0 and read_document(spark, path, 1) == []
