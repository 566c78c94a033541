import hashlib
import random
import re

from quadra.llm import op11
from quadra.llm.fim import fill_in_middle, restore
from pyspark.sql import functions as F
from tests.llm.oracle import same

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def plain_code(key, text, rate=50):
    text = text or ""
    units = UNIT.findall(text)
    n, h = len(units), hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


def compare(spark, rows, rate):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    made = fill_in_middle(df, rate=rate)
    got = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in made.withColumn("back", restore(F.col("output"), F.col("form"))).collect()]
    want = [(k, *plain_code(k, t, rate), t or "") for k, t in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_query(spark):
    same(op11.op11_fill_in_middle(spark, "/root/testdata/sf0.01"), op11.SQL["op11_fill_in_middle"], "/root/testdata/sf0.01")


def test_random_and_hard_texts(spark):
    rng = random.Random(7)
    alphabet = ["a", "b", "é", "字", "🙂", " ", "\t", "\n", "\r", "\x0b", "\x0c", "\x00", "\x08", "\x0e", "\x1f", "!", "\x85", "\xa0", " ", "\x7f", "<", ">", "S", "P"]
    rows = [(k, "".join(rng.choices(alphabet, k=rng.randint(0, 40)))) for k in range(600)]
    rows += [(600, "<S"), (601, "< P>x <"), (602, "say <M> x"), (603, " "), (604, "\n\n x"), (605, "x " * 70_000), (606, "é" * 50_000), (607, " " * 9_000)]
    for rate in (50, 100):
        compare(spark, rows, rate)


def test_edges(spark):
    compare(spark, [(1, None), (1, None), (2, ""), (None, "a b c"), (None, "a b c"), (None, None), (3, "same text here"), (3, "same text here")], 100)
    extra = spark.createDataFrame([(5, "x y", 1, "q")], "doc_id long, text string, n int, output string")
    assert fill_in_middle(extra).columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    assert fill_in_middle(extra.limit(0)).count() == 0
    assert [r.doc_id for r in fill_in_middle(extra.select(F.lit("k1").alias("doc_id"), "text")).collect()] == ["k1"]
