"""Words of many texts at once, their subword ids, and the phrases they make. Arrow splits texts and finds the distinct words;
what follows is done once for each of these."""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from quadra.llm.text import SPACES

SENTENCE_ENDS = ".!?"


def slices(texts: pa.Array, size: int):
    """Numbers (from, to) of texts that have about ``size`` bytes together, one text at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    a = 0
    while a < len(ends):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + size, "right")))
        yield a, b
        a = b


def split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(words ``[^\\x20\\x09-\\x0D]+`` of all texts joined, A-Z in lower case; their number in each text)."""
    texts = pc.ascii_lower(pc.fill_null(texts, ""))
    for c in SPACES:
        if c != " ":
            texts = pc.replace_substring(texts, c, " ")
    lists = pc.split_pattern(texts, " ")
    words = lists.flatten()
    real = pc.greater(pc.binary_length(words), 0)
    before = np.r_[0, np.cumsum(real.to_numpy(zero_copy_only=False))]
    return words.filter(real), np.diff(before[lists.offsets.to_numpy() - lists.offsets[0].as_py()])


def distinct(words: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(the different words, the number of each word's among them)."""
    found = words.dictionary_encode()
    return found.dictionary, found.indices.to_numpy(zero_copy_only=False)


def digests(words: pa.Array) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh64_intdigest, words.to_numpy(zero_copy_only=False)), np.uint64, len(words))


def endings(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(style, stop): how words end, with 0 a letter or digit, 1 punctuation, 2 another character; and whether they end a
    sentence."""
    last = pc.utf8_slice_codeunits(words, -1).dictionary_encode()
    chars, at = last.dictionary.to_pylist(), last.indices.to_numpy(zero_copy_only=False)
    style = np.array([0 if c.isalnum() else 1 if c in ".,;:!?" else 2 for c in chars], np.int64)
    return style[at], np.array([c in SENTENCE_ENDS for c in chars], bool)[at]


class Vocabulary:
    """Subwords of words by a public byte-level vocabulary (ranks); each word is encoded with a blank before it."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
        self.size = max(ranks.values()) + 1
        self.length = np.zeros(self.size, np.int64)
        for piece, i in ranks.items():
            self.length[i] = len(piece)
        self.encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def pieces(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(subword ids of all words joined, number of each word's). A subword belongs to the word that holds its last byte; a
        word that shares all of its subwords with the next one has one of id 0."""
        size = pc.binary_length(words).to_numpy(zero_copy_only=False).astype(np.int64) + 1
        joined = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), " ")[0].as_py() if len(words) else ""
        ids = np.array(self.encoding.encode_ordinary(" " + joined) if len(words) else [], np.int64)
        owner = np.searchsorted(np.cumsum(size), np.cumsum(self.length[ids]) - 1, "right")
        n = np.bincount(owner, minlength=len(words))
        if not n.all():
            none = np.flatnonzero(n == 0)
            ids = np.insert(ids, np.searchsorted(owner, none), 0)
            n[none] = 1
        return ids, n


def chosen(flat: np.ndarray, n: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of lists that are joined in ``flat``, ``n`` long, those numbered ``which``, joined, and their lengths."""
    first, size = (np.cumsum(n) - n)[which], n[which]
    return flat[np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())], size


#: Longest phrase, in words.
PHRASE = 32
_STEP = (np.arange(1, PHRASE + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ** 2 | np.uint64(1)


def phrases(digest: np.ndarray, stop: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, 64-bit hashes) of the phrases of joined texts of ``n`` words, given the words' hashes and whether they end a
    sentence: a phrase ends with a sentence, after PHRASE words, or with its text."""
    if not len(digest):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    new = np.zeros(len(digest), bool)
    new[1:] = stop[:-1]
    new[(np.cumsum(n) - n)[n > 0]] = True
    starts = np.flatnonzero(new)
    place = np.arange(len(digest)) - np.repeat(starts, np.diff(np.r_[starts, len(digest)]))
    starts = np.flatnonzero(place % PHRASE == 0)
    h = np.add.reduceat(digest * _STEP[place % PHRASE], starts)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xFF51AFD7ED558CCD)
    h += np.diff(np.r_[starts, len(digest)]).astype(np.uint64)
    return starts, (h ^ (h >> np.uint64(29))).view(np.int64)
