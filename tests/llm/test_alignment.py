import hashlib
import json
from collections import Counter

import public_tokenizers as P
import sentencepiece
from tokenizers import Tokenizer

from quadra.llm import op12
from quadra.llm.alignment import align, weigh
from quadra.session import stored

A_PATH, B_PATH = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def libraries():
    a, b = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    a.encode_special_tokens = True
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in seen)}
    a_bytes = {i: bytes(chars[c] for c in t) for t, i in json.load(open(A_PATH))["model"]["vocab"].items()}
    b_bytes = {i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in range(b.get_piece_size())}
    return a, b, a_bytes, b_bytes


def plain_code(texts):
    """Whole texts through the libraries, groups by sets of offsets, links as a list."""
    a, b, a_bytes, b_bytes = libraries()
    docs, counts = [], Counter()
    for text in texts:
        text = text or ""
        x = a.encode(" " + text, add_special_tokens=False).ids if text else []
        y = b.encode(text)
        want = (" " + text).encode()
        if b"".join(a_bytes[i] for i in x) != want or b"".join(b_bytes[i] for i in y) != want:
            x, y = [], []
        def ends(ids, spelled):
            at, out = 0, []
            for i in ids:
                at += len(spelled[i])
                out.append(at)
            return out
        xe, ye = ends(x, a_bytes), ends(y, b_bytes)
        groups, i, k = [], 0, 0
        for at in sorted(set(xe) & set(ye)):
            j, m = xe.index(at, i) + 1, ye.index(at, k) + 1
            groups.append((x[i:j], y[k:m]))
            i, k = j, m
        links = [(p, q) for g, h in groups for p in g for q in h]
        counts.update(set(links))
        docs.append((x, y, groups, links))
    best = {}
    for (p, _), n in counts.items():
        best[p] = max(best.get(p, 0), n)
    out = []
    for x, y, groups, links in docs:
        text = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((len(x), len(y), len(groups), len(links), sum(counts[q] == best[q[0]] for q in links), sum(counts[q] for q in links), hashlib.sha256(text.encode()).hexdigest() if x else "", text))
    return out


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    want = {d.doc_id: w[:7] for d, w in zip(docs, plain_code([d.text for d in docs]))}
    got = {r.doc_id: tuple(r)[1:] for r in op12.op12_alignment(spark, sf).collect()}
    assert got == want


HARD = [
    "", " ", "  ", "a  b", "  a", "a ", "a   ", "\ta\n b", "é🙂 　x ﬁ", "a▁b", "▁", "x ▁y", "<s> x</s> <|endoftext|> <0x0A>", "\x00 \x1c a \x1c b", "a\r\nb", "a\xa0b \xa0c",
    "don't  we'll\n\n\t x ", "中文字符 没有 空格 " * 20, "a" * 3000, "ab " * 2000, "!? " * 50 + "x", "1234567 89  9", "naïve café ÀÉ", "x\x85 y \x85z", "🙂🙃" * 300, "same text", "same text",
]


def test_hard_texts(spark):
    docs = list(enumerate([*HARD, None]))
    df = spark.createDataFrame([(k, t, 7, "q") for k, t in docs], "doc_id long, text string, row int, groups string")
    made = weigh(stored(align(df, A_PATH, B_PATH), "aligned"), 32_000).collect()
    want = dict(enumerate(plain_code([t for _, t in docs])))
    for r in made:
        w = want[r.doc_id]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) == (*w[:6], w[7]), docs[r.doc_id]
    assert len(made) == len(docs)


def test_nulls_repeats_and_empty_table(spark):
    rows = [(1, "the cat"), (1, "the cat"), (None, "the cat"), (None, None), (2, "the")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    made = weigh(stored(align(df, A_PATH, B_PATH, digest=True), "aligned"), 32_000).collect()
    want = plain_code([t for _, t in rows])
    assert sorted((str(r.doc_id), r.n_links, r.n_best, r.count_sum, r.groups) for r in made) == sorted((str(k), w[3], w[4], w[5], w[6]) for (k, _), w in zip(rows, want))
    assert weigh(stored(align(df.limit(0), A_PATH, B_PATH), "aligned"), 32_000).count() == 0
