import hashlib
import re

from pyspark.sql import functions as F

from quadra.llm import op2
from quadra.llm.pii import find_pii, redact


def luhn(d):
    s = 0
    for i, c in enumerate(reversed(d)):
        n = int(c)
        if i % 2:
            n = n * 2 - 9 * (n > 4)
        s += n
    return s % 10 == 0


def brute(text):
    text = text or ""
    out = []
    for kind, pattern in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def check(rows, docs):
    assert len(rows) == len(docs)
    texts = {}
    for i, t in docs:
        texts.setdefault(i, t)
    for r in rows:
        want = brute(texts[r.doc_id])
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), (r, want)
        for k in ("email", "ip", "card", "phone"):
            assert r[f"n_{k}"] == sum(x[0] == k for x in want)
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    check(op2.op2_pii(spark, sf).collect(), docs)


def test_hard_texts(spark, tmp_path):
    texts = [
        None,
        "",
        "a@b.c_x@foo.com @x.y a@b a@b. a@b.c.d.",
        "é🙂 x.y+z@mail-1.example.com, 1.2.3.4.5 256.1.1.1 0255.001.02.3 1.2.3 9.9.9.9999",
        "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 1234 5 4111111111111111222",
        "+1 (017) 555-7713 +49 +1+2 +123456789012345678 +1.....(2 +12345678",
        "x" * 60000 + "@a.b " + "1" * 60000 + " " + "a@b" + ".c" * 20000 + " +1" + "(" * 60000,
        "a@b.c " * 3000,
        "my iban DE89 3704 0044 0532 0130 00 and XX89370400440532013000. visa card 378282246310005, 378282246310005",
    ]
    docs = list(enumerate(texts)) + [(2, texts[2])]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = op2.op2_pii(spark, str(tmp_path)).collect()
    check(rows, docs)
    last = next(r for r in rows if r.doc_id == 8)
    assert re.findall("iban|card", last.spans) == ["card", "card", "iban"] or "iban:8:35" in last.spans


def test_redaction_and_clashing_columns(spark):
    df = spark.createDataFrame([(1, "mail a@b.c now", 5), (2, None, 6)], "kind int, text string, start int")
    got = find_pii(df).withColumn("clean", redact(F.coalesce("text", F.lit("")), F.col("pii"))).orderBy("kind").collect()
    assert [r.clean for r in got] == ["mail [EMAIL] now", ""]
    assert find_pii(df.limit(0)).count() == 0


def test_words_in_capitals_after_an_iban(spark):
    ibans = ["DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB29 NWBK 6016 1331 9268 19", "NO9386011117947"]
    rows = [(i, f"IBAN {iban} {after}") for i, (iban, after) in enumerate((a, b) for a in ibans for b in ("Bitte zahlen", "USD", "BIC X", "and", "2 Euro"))]
    got = find_pii(spark.createDataFrame(rows, "doc_id int, text string")).collect()
    for r in got:
        iban = ibans[r.doc_id // 5]
        assert [(s.start, s.stop) for s in r.pii if s.kind == "iban"] == [(5, 5 + len(iban))], r.text


def test_time_is_linear_in_matches(spark):
    """A valid card among many numbers: both passes run over all of them."""
    import time

    def text(n):
        return " ".join(f"{i:09d}" for i in range(n)) + "\n4111 1111 1111 1111\n" + "mail a@b.cd " * (n // 20)

    def took(n):
        df = spark.createDataFrame([(1, text(n))], "doc_id int, text string")
        began = time.time()
        row = find_pii(df).select("pii", redact(F.col("text"), F.col("pii")).alias("clean")).first()
        assert len(row.pii) == 1 + n // 20 and row.clean.count("[CARD]") == 1 and row.clean.count("[EMAIL]") == n // 20
        assert sorted((s.kind, s.start, s.stop) for s in row.pii) == sorted(brute(text(n)))
        return time.time() - began

    took(100)
    took(20_000)
    assert took(80_000) < 30


def test_many_overlapping_spans(spark):
    """More spans than a part holds, some of them over others."""
    t = " ".join(f"+4917{i:07d} x{i}@y.zz 4111111111111111 +49 4111111111111111" for i in range(400))
    df = spark.createDataFrame([(1, t)], "doc_id int, text string")
    row = find_pii(df).withColumn("clean", redact(F.col("text"), F.col("pii"))).first()
    assert {(k, a, b) for k, a, b in brute(t)} <= {(s.kind, s.start, s.stop) for s in row.pii}
    at, out = 0, []
    for a, b, k in sorted((s.start, s.stop, s.kind) for s in row.pii):
        if a >= at:
            out += [t[at:a], f"[{k.upper()}]"]
        at = max(at, b)
    assert row.clean == "".join(out) + t[at:]
