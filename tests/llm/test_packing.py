import random
import zlib

import numpy as np
import public_tokenizers

from quadra.llm import op4
from quadra.llm.packing import combinations, nnls, pack_documents, plan

PATH = public_tokenizers.path("word_bpe_49k.json")


def encode(texts):
    from tokenizers import Tokenizer

    return [e.ids + [2] for e in Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check(rows, docs, window=4096):
    """docs: list of (doc_id, text), ids unique."""
    ids = dict(zip([i for i, _ in docs], encode([t for _, t in docs])))
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert pieces.keys() == ids.keys()
    for i, parts in pieces.items():
        at = 0
        for r in sorted(parts, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids[i])
            assert r.ids_crc32 == zlib.crc32(np.asarray(ids[i][at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids[i])
    padding = total = 0
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
        total += at
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding / (total + padding)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert check(op4.op4_packing(spark, sf).collect(), docs) < 0.03


def test_edges(spark, tmp_path):
    texts = [None, "", " \n\t", "don't stop<|endoftext|>NOW\x1cé　É x y", "word " * 9000, "a" * 9000, "same text", "ΑΣ ΟΔΟΣ ΣΑΣ", "x\x85y z"]
    docs = list(enumerate(texts))
    df = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, row int, start int")
    check(pack_documents(df.select("doc_id", "text"), PATH).collect(), docs)
    full = pack_documents(df, PATH).collect()
    assert all(len(r.ids) == r.length for r in full)
    assert pack_documents(df.limit(0), PATH).count() == 0
    twice = spark.createDataFrame([(1, "same text")] * 5 + [(None, "same text")], "doc_id long, text string")
    got = pack_documents(twice, PATH).collect()
    assert len(got) == 6 and sorted(r.offset for r in got) == [3 * k for k in range(6)]


def test_plan_places_every_piece_once():
    rng = random.Random(1)
    for _ in range(30):
        hist = {rng.randint(1, 32): rng.randint(1, 500) for _ in range(rng.randint(1, 32))}
        rows = plan(hist, 32, 3)
        fill, seen = {}, {c: [] for c in hist}
        for c, a, b, first, place in rows:
            seen[c] += range(a, b)
            for s in range(first, first + b - a):
                fill.setdefault(s, []).append((place, c))
        assert all(sorted(seen[c]) == list(range(n)) for c, n in hist.items())
        for parts in fill.values():
            assert sum(c for _, c in parts) <= 32 and sorted(p for p, _ in parts) == list(range(len(parts)))


def test_nnls_and_combinations():
    assert set(combinations(6, 2)) == {(6,), (5, 1), (4, 2), (3, 3)}
    a = np.array([[1.0, 0, 1], [0, 2, 1], [1, 1, 0]])
    x = np.array([2.0, 0, 3])
    assert np.allclose(nnls(a, a @ x, 5000), x, atol=1e-3)


def test_small_caches_change_nothing():
    from quadra.llm.pretokens import Encoded

    calls = []
    c = Encoded(lambda ts: calls.append(len(ts)) or [t.encode() for t in ts], 5, {"": b""})
    for text in ("a b c d", "e f g a", "a b c d e f g h i"):
        assert c.ids(text.split()) == text.replace(" ", "").encode()
    assert c.ids([]) == b"" and len(calls) == 3
    c.ensure(iter("xyz"))
    assert c["x"] == b"x" and c[""] == b""
