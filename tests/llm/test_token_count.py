import re

import public_tokenizers

from quadra.llm import op5, token_count
from quadra.llm.token_count import MARK, Trie, count_tokens, read_vocabulary

PATH = public_tokenizers.path("piece_bpe_32k.model")
VOCAB = read_vocabulary(PATH)
BYTE = min(VOCAB.values()) - 10.0


def brute(word, vocab=VOCAB, byte=BYTE):
    """Best segmentation of one pre-token, alone."""
    text = MARK + word
    best = [(0.0, 0)] + [None] * len(text)
    for end in range(1, len(text) + 1):
        n = len(text[end - 1].encode())
        options = [(best[end - 1][0] + n * byte, best[end - 1][1] + n)]
        for start in range(end):
            if text[start:end] in vocab:
                options.append((best[start][0] + vocab[text[start:end]], best[start][1] + 1))
        best[end] = min(options, key=lambda x: (-x[0], x[1]))
    return best[-1][1]


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    known = {}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r.doc_id: (r.n_pretokens, r.n_tokens) for r in op5.op5_token_counts(spark, sf).collect()}
    assert len(got) == len(docs)
    for d in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", d.text)
        for w in words:
            if w not in known:
                known[w] = brute(w)
        assert got[d.doc_id] == (len(words), sum(known[w] for w in words))


def test_prefixes_are_shared_and_resets_change_nothing(monkeypatch):
    vocab = {MARK: -3.0, "a": -2.0, "ab": -2.5, "b": -2.0, MARK + "a": -2.2, "abc": -9.0}
    trie = Trie(vocab)
    words = ["abab", "abac", "ab", "é", "abcabc", "aaaa", "b" * 40]
    want = [brute(w, vocab, min(vocab.values()) - 10) for w in words]
    assert [trie.add(w) for w in words] == want
    done = trie.computed
    assert trie.add("aba") == brute("aba", vocab, -19.0) and trie.computed == done
    monkeypatch.setattr(token_count, "NODES", 5)
    monkeypatch.setattr(token_count, "WORDS", 3)
    trie = Trie(vocab)
    assert [trie.count(" ".join(words))[1] for _ in range(2)] == [sum(want)] * 2


def test_edges(spark):
    rows = [(1, None, 9), (1, "", 9), (2, " \n\t", 9), (None, "x", 9), (3, "word\x0bword", 9), (4, "é🙂中", 9), (5, "z" * 30000, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = [(r.doc_id, r.n_pretokens) for r in count_tokens(df, PATH).collect()]
    assert sorted(got, key=repr) == sorted([(1, 0), (1, 0), (2, 0), (None, 1), (3, 2), (4, 1), (5, 1)], key=repr)
    assert count_tokens(df.limit(0), PATH).count() == 0
