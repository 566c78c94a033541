import hashlib

import numpy as np
import public_tokenizers as P
import tiktoken

from quadra.llm import op7
from quadra.llm.byte_bpe import codec, decode_documents, encode_documents, read_ranks

PATH = P.path("byte_bpe_50k.tiktoken")
ENC = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=read_ranks(PATH), special_tokens={})
HARD = ["", " ", "\x00\x01 \x1f", "don't  we'll\n\n\t x ", "é🙂 中文字符 ▁ ▁▁", "<unk> <|endoftext|>", "a" * 5000, "ab" * 3000, "!?" * 4000, "1" * 3000, "İßﬁ́é", " 　 ", "the the the"]


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op7.op7_byte_bpe(spark, sf).collect()
    assert len(rows) == len(text)
    for r in rows:
        ids = np.asarray(ENC.encode_ordinary(text[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def test_hard_texts():
    c = codec(PATH, P.PATTERN)
    for t in HARD:
        ids = c.encode(t)
        assert ids.tolist() == ENC.encode_ordinary(t)
        assert c.decode(ids) == t.encode()
    for entry in list(read_ranks(PATH))[::97]:
        t = entry.decode(errors="ignore")
        assert c.encode(t).tolist() == ENC.encode_ordinary(t)


def test_edges(spark):
    rows = [(1, None, 3), (1, "x y", 4), (1, "x y", 4), (None, "x", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    enc = encode_documents(df, PATH, P.PATTERN)
    dec = decode_documents(enc, PATH, P.PATTERN)
    assert sorted(bytes(r.bytes) for r in dec.collect()) == [b"", b"x", b"x y", b"x y"]
    assert encode_documents(df.limit(0), PATH, P.PATTERN).count() == 0
