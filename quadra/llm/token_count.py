"""Token counts under a unigram vocabulary, by dynamic programming over a trie of the distinct pre-tokens.

A pre-token is a word ``[^\\x20\\x09-\\x0D]+`` with the word mark in front. Its tokens are the segmentation into vocabulary
pieces of the best total score (ties: fewer tokens); a character that no piece covers falls back to its UTF-8 bytes. The
forward score of a prefix does not depend on what follows, so that distinct pre-tokens are put into a trie and the
score of each node is computed once for all words below it; the node of a whole word keeps the count.

Vocabulary: the pieces of a sentencepiece model with its ranks; a piece of rank r has the score -log(r + ZIPF), the
shape of a frequency list. Nothing is trained.

Each task keeps its trie; it starts anew at ``NODES`` nodes, which costs time and changes no result. Texts are counted
where they are read, and nothing is shuffled.

Null, empty and blank texts have no tokens; null keys keep their row. Repeated rows are counted each. Very long texts are counted
whole. Empty tables give no rows; columns besides key and text are not read and clash with nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame

from quadra.llm.pretokens import hold
from quadra.llm.text import pieces, small_batches

MARK = "▁"
ZIPF = 2.7
NODES = 700_000
WORDS = 400_000


def read_vocabulary(path: str) -> dict[str, float]:
    """Normal pieces of a sentencepiece model file with their scores."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    normal = [i for i in range(sp.get_piece_size()) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
    ordered = sorted(normal, key=lambda i: (-sp.get_score(i), i))
    return {sp.id_to_piece(i): -math.log(rank + ZIPF) for rank, i in enumerate(ordered)}


class Trie:
    """Pre-tokens with forward (score, -tokens) of each prefix; children live in one dictionary."""

    def __init__(self, vocabulary: dict[str, float]):
        self.vocabulary = vocabulary
        self.longest = max(map(len, vocabulary), default=1)
        self.byte = min(vocabulary.values(), default=0.0) - 10.0  # the score of a byte that stands for itself
        self.words: dict[str, int] = {"": 0}
        self.computed = 0
        self._clear()

    def _clear(self) -> None:
        self.child: dict[int, int] = {}  # node * 2^21 + code point -> node
        self.score, self.tokens = [0.0], [0]

    def add(self, word: str) -> int:
        """Insert a word (without the mark) and return its number of tokens."""
        if len(self.score) > NODES:
            self._clear()
        if len(self.words) > WORDS:
            self.words = {"": 0}
        text, path = MARK + word, [0]
        node, vocabulary, longest, child = 0, self.vocabulary, self.longest, self.child
        score, tokens = self.score, self.tokens
        for end, c in enumerate(text, 1):
            key = node << 21 | ord(c)
            nxt = child.get(key)
            if nxt is None:
                before = path[end - 1]
                best, count = score[before] + len(c.encode()) * self.byte, tokens[before] + len(c.encode())
                for start in range(max(0, end - longest), end):
                    piece = vocabulary.get(text[start:end])
                    if piece is not None:
                        p = path[start]
                        s, k = score[p] + piece, tokens[p] + 1
                        if s > best or (s == best and k < count):
                            best, count = s, k
                nxt = len(score)
                child[key] = nxt
                score.append(best)
                tokens.append(count)
                self.computed += 1
            node = nxt
            path.append(node)
        self.words[word] = tokens[node]
        return tokens[node]

    def count(self, text: str | None) -> tuple[int, int]:
        """(pre-tokens, tokens) of a whole text."""
        ps = pieces(text)
        try:
            total = sum(map(self.words.__getitem__, ps))
        except KeyError:
            new = sorted({p for p in ps if p not in self.words})  # neighbours share prefixes
            if len(self.words) + len(new) > WORDS:
                self.words = {"": 0}
                new = sorted({p for p in ps if p})
            own = {p: self.add(p) for p in new}
            total = sum(own[p] if p in own else self.words[p] for p in ps)
        return sum(map(bool, ps)), total


_tries: dict[str, Trie] = {}


def count_tokens(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_pretokens, n_tokens) of each row; null and blank texts have none. ``vocabulary``: path of a model file."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hold("token_count", _tries)
        if vocabulary not in _tries:
            _tries[vocabulary] = Trie(read_vocabulary(vocabulary))
        trie = _tries[vocabulary]
        for batch in batches:
            found = [trie.count(t if isinstance(t, str) else None) for t in batch[text]]
            yield pd.DataFrame({key: batch[key], "n_pretokens": [a for a, _ in found], "n_tokens": [b for _, b in found]})

    return small_batches(docs).select(key, text).mapInPandas(run, f"{key} {dict(docs.dtypes)[key]}, n_pretokens long, n_tokens long")
