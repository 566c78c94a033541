import base64
import collections
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken

from quadra.llm import op10
from quadra.llm.attention import OVERLAP, WINDOW, Attention, windows_once
from quadra.llm.hot import lookup
from quadra.llm.lm import Settings, fit, score
from quadra.llm.subwords import Vocabulary, digests, distinct, endings, split
from quadra.llm.subwords import phrases as hashed

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER)) + [None]


def base(docs):
    c = collections.Counter(t for i, x in docs if not held(i) for t in tokens(x))
    n, v = sum(c.values()), len(c)
    out = []
    for i, x in docs:
        ts = tokens(x)
        out.append((i, held(i), len(ts), sum(c[t] > 0 for t in ts), n, sum(math.log10((c[t] + 1) / (n + v + 1)) for t in ts)))
    return out


def same(rows, docs):
    got = sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows), key=repr)
    want = sorted(base(docs), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9, atol=1e-9)


# ---------------------------------------------------------------- the whole score once more, a text and a word at a time


def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def phrases(words):
    out = []
    for w in words:
        if not out or len(out[-1]) == 32 or out[-1][-1][-1] in ".!?":
            out.append(())
        out[-1] += (w,)
    return out


def brute_scores(docs, model):
    own_encoding = encoding()
    s, p = model.subwords_of, {k: v.astype(float) for k, v in model.attention.p.items()}
    known, seen = {}, collections.Counter()
    counts = collections.Counter(w for i, x in docs if not held(i) for w in tokens(x)[:-1])
    for i, x in docs:
        if not held(i):
            seen.update(phrases(tokens(x)[:-1]))
    total = sum(seen.values())
    memory = min(0.9, max(0.001, sum(c for c in seen.values() if c > 1) / total))

    def word(w):
        if w not in known:
            rows = [s.rows[k] for k in own_encoding.encode_ordinary(" " + w)]
            style = 0 if w[-1].isalnum() else 1 if w[-1] in ".,;:!?" else 2
            known[w] = int(s.cluster[rows[0]]) * 3 + style, np.mean([p["e"][r] for r in rows], axis=0)
        return known[w]

    mass = collections.Counter()
    for w, c in counts.items():
        mass[word(w)[0]] += c
    out = []
    for i, x in docs:
        ws = tokens(x)[:-1]
        inputs = [p["e"][-1], *[word(w)[1] for w in ws]]
        targets = [*[word(w)[0] for w in ws], (s.clusters + 1) * 3]
        at = []
        for pos, y in enumerate(targets):
            first = 0 if pos < WINDOW else ((pos - WINDOW) // (WINDOW - OVERLAP) + 1) * (WINDOW - OVERLAP)
            x_ = np.array(inputs[first : pos + 1])
            a = (x_ @ p["k"]) @ (x_[-1] @ p["q"]) / 4 + p["b"][: len(x_)][::-1]
            a = np.exp(a - a.max())
            z = np.r_[x_[-1], a @ (x_ @ p["v"]) / a.sum()] @ p["o"] + p["c"]
            at.append((z[y] - z.max() - math.log(np.exp(z - z.max()).sum())) / math.log(10))
        own, place, score_, recalled = collections.Counter(phrases(ws)), 0, at[-1], 0
        for phrase in phrases(ws):
            spelled = 0.0
            for w in phrase:
                c = counts[w]
                spelled += at[place] + math.log10((max(c - 0.75, 0) + 0.375) / max(mass[word(w)[0]], 1))
                place += 1
            others = seen[phrase] - (0 if held(i) else own[phrase])
            spelled += math.log10(1 - memory)
            if others > 0:
                whole = math.log10(memory * others / total)
                top = max(spelled, whole)
                spelled = top + math.log10(10 ** (spelled - top) + 10 ** (whole - top))
                recalled += 1
            score_ += spelled
        out.append((i, score_, recalled))
    return out


def test_scores_of_whole_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    df = df.unionByName(spark.createDataFrame([(None, "Null key. Null key. One more"), (-5, None), (-6, "x " * 200)], df.schema))
    docs = [tuple(r) for r in df.collect()]
    # a small table of common words, so that most counts come from the join
    model, table = fit(df, PATH, Settings(common=50, rows=600, shared=20))
    assert 0 < model.common.num_rows <= 50
    rows = score(df, model, table).collect()
    same(rows, docs)
    got = sorted(((r.doc_id, r.score, r.n_recalled) for r in rows), key=lambda r: (r[0] is None, r[0] or 0))
    want = sorted(brute_scores(docs, model), key=lambda r: (r[0] is None, r[0] or 0))
    assert [(g[0], g[2]) for g in got] == [(w[0], w[2]) for w in want]
    assert np.allclose([g[1] for g in got], [w[1] for w in want], rtol=2e-5, atol=2e-3)
    model.common = model.common.slice(0, 0)
    again = {r.doc_id: r.score for r in score(df, model, table).collect()}
    assert np.allclose([again[g[0]] for g in got], [g[1] for g in got], rtol=1e-9)


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    rows = op10.op10_lm_scoring(spark, sf).collect()
    same(rows, docs)
    out = [r for r in rows if r.held_out]
    assert sum(r.score for r in out) > 0.9 * sum(r.base_score for r in out)
    assert all(r.score < 0 for r in rows)
    # texts that the corpus holds twice are told from the others, by score a token
    text, per = dict(docs), {r.doc_id: r.score / r.n_tokens for r in rows if r.n_tokens > 20}
    times = collections.Counter(t for i, t in docs if i in per)
    once = sorted(v for i, v in per.items() if times[text[i]] == 1)
    twice = [v for i, v in per.items() if times[text[i]] == 2]
    limit = once[int(0.9 * len(once))]
    assert sum(v > limit for v in twice) > 0.7 * len(twice)


# ---------------------------------------------------------------- parts


def test_pieces():
    v, e = Vocabulary(PATH), encoding()
    words = ["house", "houses", "zzqqxjw", "été", "🙂🙂", "a" * 300, "foo.bar,baz!", "x", "\x00\uffff", "house", "1234", "'s"]
    ids, n = v.pieces(pa.array(words))
    assert len(n) == len(words) and v.pieces(pa.array([], pa.string()))[1].tolist() == []
    for word, own in zip(words, np.split(ids, np.cumsum(n)[:-1]), strict=True):
        assert own.tolist() == e.encode_ordinary(" " + word)
    odd = ["a\u00a0", "\u2003", "\u00a0\u00a0", "b"]  # white space of other kinds: each word has a piece
    ids, n = v.pieces(pa.array(odd))
    assert (n > 0).all() and len(ids) == n.sum()


def test_words_and_phrases():
    texts = ["A b.  c\x0b\x0cD! e", None, " ", "b. c d! " * 30, "x " * 100, "É\u00a0Z"]
    words, n = split(pa.array(texts))
    assert n.tolist() == [len(tokens(t)) - 1 for t in texts] and words.to_pylist() == [w for t in texts for w in tokens(t)[:-1]]
    kinds, at = distinct(words)
    starts, hashes = hashed(digests(kinds)[at], endings(kinds)[1][at], n)
    want = [p for t in texts for p in phrases(tokens(t)[:-1])]
    assert np.diff(np.r_[starts, len(words)]).tolist() == [len(p) for p in want]
    named = {}
    assert all(named.setdefault(h, p) == p for h, p in zip(hashes.tolist(), want, strict=True)) and len(named) == len(set(want))


def test_each_position_is_scored_once():
    for n in [*range(1, 200), 5000]:
        assert set(windows_once(n)) == {1}


def test_probabilities_sum_to_one_and_are_causal():
    a = Attention(50, 9)
    x = np.random.default_rng(0).standard_normal((3, WINDOW, 16)).astype(np.float32)
    z = a.log_probabilities(x)
    assert np.allclose(np.exp(z).sum(2), 1, atol=1e-4)
    x2 = x.copy()
    x2[:, 20:] += 1
    assert np.allclose(a.log_probabilities(x2)[:, :20], z[:, :20], atol=1e-5)


def test_gradients():
    a = Attention(20, 5, d=4)
    a.p = {k: v.astype(np.float64) for k, v in a.p.items()}
    r = np.random.default_rng(1)
    x, y = r.standard_normal((2, 6, 4)), r.integers(-1, 5, (2, 6))
    _, g, dx = a.gradients(x, y)
    eps = 1e-4
    for name in ("q", "k", "v", "o", "c", "b"):
        for _ in range(4):
            i = tuple(r.integers(0, s) for s in a.p[name].shape)
            if name == "b":
                i = (int(r.integers(0, 6)),)
            old = a.p[name][i]
            a.p[name][i] = old + eps
            up = a.gradients(x, y)[0]
            a.p[name][i] = old - eps
            down = a.gradients(x, y)[0]
            a.p[name][i] = old
            assert g[name][i] == pytest.approx((up - down) / (2 * eps), abs=2e-4)
    i = (1, 3, 2)
    up, down = x.copy(), x.copy()
    up[i] += eps
    down[i] -= eps
    assert dx[i] == pytest.approx((a.gradients(up, y)[0] - a.gradients(down, y)[0]) / (2 * eps), abs=2e-4)


def test_training_learns():
    """The next class follows from the last word; after some steps the loss is far below that of guessing."""
    r, a = np.random.default_rng(2), Attention(30, 6)
    state, losses = a.fresh(), []
    for _ in range(60):
        words = r.integers(0, 30, (32, WINDOW))
        at = np.concatenate([np.full((32, 1), -1), words[:, :-1]], axis=1)
        y = np.concatenate([np.full((32, 1), -1), words[:, :-1] % 6], axis=1)
        losses.append(a.train(at, y, np.arange(30), np.ones(30, np.int64), state))
    assert losses[0] > 1.5 and losses[-1] < 0.3


def test_edges(spark):
    docs = [(1, None), (1, ""), (2, " \n"), (None, "A b"), (3, "ÉA é a\x0bb"), (4, "z " * 5000), (5, "q" * 30000), (4, "z " * 5000)]
    df = spark.createDataFrame([(i, t, 1.0, "k", [1]) for i, t in docs], "doc_id long, text string, score double, uid string, hashes array<int>")
    model, table = fit(df, PATH)
    same(score(df, model, table).collect(), docs)
    empty = df.limit(0)
    assert score(empty, model, table).count() == 0
    model, table = fit(empty, PATH)
    assert score(empty, model, table).count() == 0
    got = score(df, model, table).collect()
    assert len(got) == len(docs) and all(r.n_known == 0 and math.isfinite(r.score) for r in got)


def test_all_documents_train_the_attention(spark):
    """Each of 30 documents among 1,200 others has a word of its own; all of them that are not held out are trained on."""
    own = "water house river stone music paper light green horse north winter summer garden bridge doctor market window mother father silver island forest circle letter dinner school church castle soldier engine".split()
    rows = [(i, "plain words here. " * 5) for i in range(1200)] + [(5000 + i, f"plain {w} here.") for i, w in enumerate(own)]
    model, _ = fit(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), PATH)
    s = model.subwords_of
    fresh = Attention(s.n, s.classes)
    pieces, _ = s.pieces(pa.array([w for i, w in enumerate(own) if not held(5000 + i)]))
    moved = (model.attention.p["e"] != fresh.p["e"]).any(axis=1)
    assert moved[pieces].all()


def test_hot_keys_are_looked_up_apart(spark):
    """A key with most of the rows is broadcast, all others are joined; the result is that of a plain join."""
    rows = spark.range(4000).selectExpr("if(id % 4 = 0, id % 50, 7) as k", "id").withColumnRenamed("id", "v")
    rows = rows.unionByName(spark.createDataFrame([(None, -1)], "k long, v long"))
    table = rows.where("k < 40").groupBy("k").count()
    total = 4000
    for how in ("inner", "left"):
        got = sorted(map(tuple, lookup(rows, table, "k", "count", total, how).collect()), key=repr)
        assert got == sorted(map(tuple, rows.join(table, "k", how).collect()), key=repr)


def test_training_windows_hold_every_position():
    """Each word and each end is predicted once, from the word before it, whatever the length of the text."""
    from quadra.llm.lm import WINDOW, _windows

    n = np.array([0, 1, WINDOW - 1, WINDOW, 0, 5 * WINDOW + 3, 2 * WINDOW])
    rows = np.arange(n.sum())
    classes = rows + 1000
    at, y = _windows(rows, n, classes, 7)
    got = [(a, c) for a, c in zip(at.ravel().tolist(), y.ravel().tolist(), strict=True) if a != -2]
    want, first = [], 0
    for k in n.tolist():
        words = list(range(first, first + k))
        want += zip([-1, *words], [*(w + 1000 for w in words), 7], strict=True)
        first += k
    assert got == want and ((at == -2) == (y == -1)).all()
    empty = np.empty(0, np.int64)
    assert _windows(empty, np.array([0]), empty, 7)[1][0, 0] == 7 and len(_windows(empty, empty, empty, 7)[0]) == 0
