import random
import re

from quadra.llm import jaccard, op6
from quadra.llm.components import connected
from quadra.llm.jaccard import near_duplicates
from tests.llm.oracle import same as sql


def brute(docs):
    grams = []
    for _, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        k = min(5, len(w))
        grams.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set())
    n = len(docs)
    root, links, copies = list(range(n)), [0] * n, [0] * n
    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    where = {}
    for i, g in enumerate(grams):
        for x in g:
            where.setdefault(x, []).append(i)
    for i in range(n):
        near = {j for x in grams[i] for j in where[x] if j > i}
        for j in near:
            inter = len(grams[i] & grams[j])
            if 5 * inter >= 4 * (len(grams[i]) + len(grams[j]) - inter):
                links[i] += 1
                links[j] += 1
                if docs[i][1] == docs[j][1]:
                    copies[i] += 1
                    copies[j] += 1
                a, b = sorted((find(i), find(j)))
                root[b] = a
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return [(docs[i][0], least.get(find(i)), links[i], copies[i]) for i in range(n)]


def same(df, docs):
    got = [tuple(r) for r in df.select("doc_id", "class_id", "n_links", "n_copies").collect()]
    assert sorted(got, key=repr) == sorted(brute(docs), key=repr)


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    same(op6.op6_ngram_jaccard(spark, sf), docs)


def test_query_against_sql(spark):
    sf = "/root/testdata/sf0.001"
    sql(op6.op6_ngram_jaccard(spark, sf), op6.SQL["op6_ngram_jaccard"], sf)


def family(seed, size, words=120, edits=3):
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(words)]
    out = []
    for _ in range(size):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(words)] = f"e{rng.randint(0, 300)}"
        out.append(" ".join(w))
    return out


def test_large_groups_in_parts(spark, monkeypatch):
    """Buckets and families that are larger than a block are dealt out in pairs of parts."""
    monkeypatch.setattr(jaccard, "BLOCK", 20)
    docs = list(enumerate(family(1, 90) + family(2, 30) + family(3, 1) * 25))
    same(near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")), docs)


def test_edges(spark):
    texts = [None, "", " \n", "a", "a", "b", "a b", "a b c d", "a b c d e", "a b c d e", "x " * 4000, "x " * 4000 + "y", "a\tb\nc d", "a b c d"]
    docs = [*enumerate(texts), (None, "q w e r t y"), (None, "q w e r t y"), (3, "other words that are not in any of these")]
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in docs], "doc_id long, text string, node string, weight int")
    same(near_duplicates(df), docs)
    assert near_duplicates(df.limit(0)).count() == 0


def test_components(spark):
    edges = [(i + 1, i) for i in range(40)] + [(100, 90), (95, 100), (7, 7)]
    got = dict(tuple(r) for r in connected(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {**{i: 0 for i in range(41)}, 100: 90, 95: 90, 90: 90}
