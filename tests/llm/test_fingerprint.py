import hashlib
import math
import re

import xxhash
from pyspark.sql import functions as F

from quadra.llm import op8
from quadra.llm.fingerprint import as_text, combine, lanes, likeness, with_next


def edited(docs):
    ids = sorted({i for i, _ in docs}, reverse=True)
    text = {i: min(t or "" for k, t in docs if k == i) for i in ids}
    after = dict(zip(ids, ids[1:] + ids[:1]))
    out = []
    for i, t in docs:
        t = t or ""
        k = len(t) // 3
        out.append((i, len(t), hashlib.sha256((t[: len(t) - k] + text[after[i]][:k]).encode()).hexdigest()))
    return out


def plain(text):
    """(fingerprint as text, sketch as signed numbers)."""
    exact, sketch = [0] * 8, [0] * 64
    for p in filter(None, text.split("\n")):
        d = hashlib.sha512(p.encode()).digest()
        exact = [(x + int.from_bytes(d[4 * k : 4 * k + 4], "big")) % 2**32 for k, x in enumerate(exact)]
    for s in re.split(r"[.!?|\n]+", text):
        s = s.strip(" ")
        if s:
            h = xxhash.xxh64_intdigest(s.encode(), seed=42)
            for k in range(32):
                sketch[2 * k] += 1 if h >> k & 1 else -1
                sketch[2 * k + 1] += 1 if h >> (k + 32) & 1 else -1
    return "".join(f"{x:08x}" for x in exact) + "".join(f"{x % 2**24:06x}" for x in sketch), sketch


def like(a, b):
    if a[0] == b[0]:
        return 1.0
    dot = lambda x, y: sum(p * q for p, q in zip(x, y))
    aa, bb = dot(a[1], a[1]), dot(b[1], b[1])
    return max(0.0, min(1.0, dot(a[1], b[1]) / math.sqrt(aa * bb))) if aa and bb else 0.0


def test_fingerprints_against_plain_code(spark):
    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    text = {i: t or "" for i, t in docs}
    ids = sorted(text, reverse=True)
    after = dict(zip(ids, ids[1:] + ids[:1]))
    for r in op8.op8_fingerprint(spark, sf).collect():
        t, n = text[r.doc_id], text[after[r.doc_id]]
        k = len(t) // 3
        own, changed, other = plain(t), plain(t[: len(t) - k] + n[:k]), plain(n)
        assert (r.fingerprint, r.edited_fingerprint) == (own[0], changed[0])
        assert abs(r.near_edited - like(own, changed)) < 1e-9 and abs(r.near_next - like(own, other)) < 1e-9


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    rows = op8.op8_fingerprint(spark, sf).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == sorted(edited(docs))
    text = dict(docs)
    by_text, by_print = {}, {}
    for r in rows:
        assert by_text.setdefault(text[r.doc_id], r.fingerprint) == r.fingerprint
        by_print.setdefault(r.fingerprint, set()).add(tuple(sorted(filter(None, text[r.doc_id].split("\n")))))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert all(len(v) == 1 for v in by_print.values())
    long = [r for r in rows if r.n_chars > 600]
    near = sum(r.near_edited for r in long) / len(long)
    far = sum(r.near_next for r in long) / len(long)
    assert near > 0.5 and far < 0.2


def test_edges(spark, tmp_path):
    docs = [(5, "a\nb c. d\n"), (4, None), (3, ""), (9, "é🙂x" * 7), (9, "other text"), (9, "other text"), (1, "p. q. r")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = op8.op8_fingerprint(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == sorted(edited(docs))
    nulls = spark.createDataFrame([(None, "a"), (3, "bcdefg")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.head_next) for r in with_next(nulls).collect()) == [(0, ""), (3, "a")]
    spark.createDataFrame([], "doc_id long, text string").write.parquet(str(tmp_path / "none" / "documents.parquet"))
    assert op8.op8_fingerprint(spark, str(tmp_path / "none")).count() == 0


def test_homomorphism(spark):
    rows = [("one. two\nthree\nfour. five", "three\nfour. five\none. two", "one. two\nfour. five", "three")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string")
    a, b, c, d = (lanes(F.col(x)) for x in "abcd")
    r = df.select((a == b).alias("same"), (combine(c, d) == a).alias("plus"), (combine(a, d, -1) == c).alias("minus"), as_text(a).alias("t"), likeness(a, b).alias("l"), likeness(a, c).alias("m")).first()
    assert r.same and r.plus and r.minus and len(r.t) == 8 * 8 + 64 * 6 and r.l == 1.0 and r.m > 0.4
