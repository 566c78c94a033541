import collections
import math
import re

import pytest
from pyspark.sql import functions as F

from quadra.llm import op3
from quadra.llm.quality import COMMON, COMMON_WORDS, FUNCTION, Limits, fit_references, judge, measure
from quadra.session import stored
from tests.llm.oracle import same


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n = len(words)
    return (
        n,
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
        n < 50 or 100 * len(covered) > 50 * n,
    )


def histograms(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    upper, digit, stop, symbol = (len(re.findall(p, text)) for p in ("[A-Z]", "[0-9]", "[.,;:!?]", r"[#*$%&|<>]"))
    space = len(text) - sum(map(len, words))
    wide = sum(c > "\x7f" for c in text)
    chars = [upper, digit, stop, symbol, space, wide, len(text) - upper - digit - stop - symbol - space - wide]
    counts = [words.count(w) for w in COMMON]
    bare = [re.sub("[.,;:!?]+$", "", w).lower() for w in words]
    functions = [bare.count(w) for w in FUNCTION]
    return chars, counts + [len(words) - sum(counts)], functions + [len(words) - sum(functions)]


def distance(counts, q):
    total = sum(counts)
    out = 0.0
    for x, y in zip(counts, q):
        p = x / total
        m = (p + y) / 2
        out += ((p * math.log2(p / m) if p else 0) + (y * math.log2(y / m) if y else 0)) / 2
    return math.sqrt(max(0, out))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()


def test_query_against_brute_force(spark, docs):
    got = {r.doc_id: r for r in op3.op3_quality(spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == len(docs)
    limits = Limits()
    sums = {k: ([0] * 7, [0] * (len(COMMON) + 1), [0] * (len(FUNCTION) + 1)) for k in COMMON_WORDS}
    prose = set()
    for d in docs:
        b = brute(d.text)
        assert tuple(got[d.doc_id][c] for c in [*op3.COUNTS, "base_failed"]) == b
        if not b[5] and 100 * b[2] <= 5 * b[0]:
            prose.add(d.doc_id)
            for mine, new in zip(sums[d.lang], histograms(d.text)):
                mine[:] = [x + y for x, y in zip(mine, new)]
    refs = [[[x / sum(h) for x in h] for h in hs] for hs in sums.values() if sum(hs[0])]
    far = {d.doc_id: [min(distance(h, q[k]) for q in refs) if sum(h) else None for k, h in enumerate(histograms(d.text))] for d in docs}
    size = {i: int(math.log2(max(1, got[i].n_words))) for i in got}
    # the limit for function words by length class: the 99.9th percentile of the prose, and not more than 0.95 of none at all
    none = min(distance([0] * len(FUNCTION) + [1], q[2]) for q in refs)
    limit = {}
    for k in set(size.values()):
        own = sorted(far[i][2] for i in prose if size[i] == k and got[i].n_words >= limits.least_words)
        limit[k] = min(own[math.ceil(0.999 * len(own)) - 1] if own else 9, 0.95 * none)
    for d in docs:
        r, chars, (dc, dw, df) = got[d.doc_id], len(d.text or ""), far[d.doc_id]
        if chars:
            assert abs(r.char_distance - dc) < 1e-6
        long = r.n_words >= limits.least_words
        bad = (chars >= limits.least_chars and dc > limits.chars + limits.chars_noise / math.sqrt(chars)) or (long and dw > limits.words) or (long and df > limit[size[d.doc_id]] + 1e-9)
        assert r.kept == (not r.base_failed and not bad)


def test_other_languages(spark):
    """A language with enough prose has a reference of its own; without one, nothing but the base rules is judged."""
    import random

    rng = random.Random(4)
    greek, thai = "αβγδεζηθικλμνξοπρστυφχψω", "กขคงจชซญดตถทนบปผพฟมยรลวส"
    prose = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) + rng.choice(["", "", ".", ","]) for _ in range(150))
    junk = "".join(rng.choice("0123456789 .,;:!?") for _ in range(2500))
    rows = [(i, "el", prose(greek)) for i in range(60)] + [(100 + i, "th", prose(thai)) for i in range(3)]
    rows += [(200, "el", " ".join("".join(rng.choice("0123456789!?;:") for _ in range(6)) for _ in range(400))), (201, None, prose(thai)), (202, "th", junk)]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text").withColumn("doc_id", -1 - F.col("doc_id"))
    m = stored(measure(docs.unionByName(spark.createDataFrame(rows, docs.schema))), "m")
    got = {r.doc_id: r for r in judge(m, fit_references(m, Limits())).where("doc_id >= 0").collect()}
    assert len(got) == len(rows)
    assert all(got[i].kept for i in [*range(60), 100, 101, 102, 202]) and not got[200].kept and not got[201].kept
    assert all("__own" not in r.asDict() for r in got.values())


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.01"
    same(op3.op3_quality(spark, sf), op3.SQL["op3_quality"], sf)


def test_good_documents_stay(spark):
    sf = "/root/testdata/sf0.1"
    rows = op3.op3_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("not base_failed").select("kept", "quality").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.999 * len(good)
    assert sum(bad) <= 0.1 * len(bad)


def test_edges(spark):
    texts = [None, "", " \n\t ", "a", "a b c a b c", "x y z x y z\nx y z x y z\n\nx y z x y z", "\x0b\x0cé  ü\r\n", "the " * 30000, "w " * 2 + "v"]
    rows = [(i, "en", t, "clash", 3) for i, t in enumerate(texts)] + [(4, "en", texts[4], "clash", 3)]
    df = spark.createDataFrame(rows, "doc_id int, lang string, text string, kind string, i int")
    m = stored(measure(df), "m")
    got = judge(m, fit_references(m, Limits())).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r[c] for c in [*op3.COUNTS, "base_failed"]) == brute(r.text), r.text
    assert judge(measure(df.limit(0)), {}).count() == 0


def test_texts_without_function_words_go(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang", "text")
    stems = ["Granit", "lampu", "vorkel", "simtar", "brodek", "plonis", "hazwer", "mintol", "kerrab", "dulvan"]
    salad = [" ".join(f"{stems[(i * 7 + k) % 10]}{stems[(i * i + k) % 10]}{i}" + (". " if i % 12 == 11 else "") for i in range(n)) for k, n in enumerate((100, 130, 400, 2000))]
    planted = spark.createDataFrame([(-1 - k, "en", t) for k, t in enumerate(salad)], docs.schema)
    m = stored(measure(docs), "m")
    references = fit_references(m, Limits())
    got = judge(measure(planted), references, Limits()).collect()
    assert len(got) == 4 and not any(r.base_failed or r.kept for r in got)
    assert all(r.word_distance <= Limits().words for r in got)
