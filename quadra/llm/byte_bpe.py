"""Byte-level BPE with a sentencepiece model made from the rank file.

The model is written as it is, field by field (its public protobuf schema): one piece for each vocabulary entry, its
bytes mapped to the characters U+0100 + byte, its score the negative rank, and the identity normaliser. Merging the
adjacent pair with the best score, leftmost first, is then the same as merging by rank. Text is split by the pattern
first; each pre-token is encoded on its own, and a pre-token that is a vocabulary entry is that entry. Decoding looks
ids up in the inverse mapping. No model is trained, and the vocabulary is read from its file on each executor.

Tasks keep encoded pre-tokens, see :mod:`quadra.llm.pretokens`.

Null texts are empty texts, without ids. Null keys keep their row, repeated rows are encoded each, very long texts are encoded
whole, a pre-token at a time. Empty tables give no rows; columns besides key and text are not read and clash with nothing.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from quadra.llm.pretokens import Encoded, hold
from quadra.llm.text import small_batches

CACHE = 400_000
_SHIFT = {b: 0x100 + b for b in range(256)}
_codecs: dict[tuple[str, str], "Codec"] = {}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _varint(n: int) -> bytes:
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def _field(number: int, kind: int, body: bytes) -> bytes:
    return _varint(number << 3 | kind) + (_varint(len(body)) if kind == 2 else b"") + body


def as_pieces(data: bytes) -> str:
    return data.decode("latin-1").translate(_SHIFT)


def model_bytes(ranks: dict[bytes, int]) -> bytes:
    """The serialised ModelProto. Piece i is the i-th entry by rank; the last piece is the obligatory unknown one."""
    out = []
    for entry, rank in sorted(ranks.items(), key=lambda x: x[1]):
        out.append(_field(1, 2, _field(1, 2, as_pieces(entry).encode()) + _field(2, 5, struct.pack("<f", -float(rank)))))
    out.append(_field(1, 2, _field(1, 2, b"<unk>") + _field(3, 0, _varint(2))))
    no = lambda n: _field(n, 0, _varint(0))
    out.append(_field(2, 2, _field(3, 0, _varint(2)) + _field(4, 0, _varint(len(ranks) + 1)) + _field(40, 0, _varint(len(ranks)))))
    out.append(_field(3, 2, _field(1, 2, b"identity") + no(3) + no(4) + no(5)))
    return b"".join(out)


class Codec:
    """Encoder and decoder of one vocabulary and pattern."""

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        ranks = read_ranks(path)
        self.by_order = [e for e, _ in sorted(ranks.items(), key=lambda x: x[1])]
        order = np.asarray([ranks[e] for e in self.by_order], "<u4")
        model = sentencepiece.SentencePieceProcessor(model_proto=model_bytes(ranks))
        self.decoded = {ranks[e]: e for e in self.by_order}
        self.find = regex.compile(pattern).findall

        def encode(tokens: list[str]) -> list[bytes]:
            raw = [t.encode() for t in tokens]
            found = {}
            hard = [r for r in raw if r not in ranks]
            for r, ids in zip(hard, model.encode([as_pieces(r) for r in hard], num_threads=1), strict=True):
                found[r] = order[ids].tobytes()
            return [found[r] if r in found else struct.pack("<I", ranks[r]) for r in raw]

        self.cache = Encoded(encode, CACHE)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text as unsigned 32-bit integers."""
        return np.frombuffer(self.cache.ids(self.find(text)), "<u4")

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.decoded.__getitem__, ids.tolist()))


def codec(path: str, pattern: str) -> Codec:
    """One codec a Python worker, vocabulary and pattern."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text", derive=None, schema: str = "ids array<int>") -> DataFrame:
    """(key, ids) by document: whole texts, null is the empty text, rows keep their number.

    ``derive(codec, ids)`` may return other columns instead, named by ``schema``, made while the ids are at hand, so that
    they need not be carried. Each row is encoded where it is read; nothing is shuffled."""
    names = [c.split()[0] for c in schema.split(",")]
    make = derive or (lambda _, ids: (ids.astype("int32"),))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hold("byte_bpe", _codecs)
        c = codec(path, pattern)
        for batch in batches:
            if not len(batch):
                continue
            rows = [make(c, c.encode(t if isinstance(t, str) else "")) for t in batch[text]]
            out = pd.DataFrame(rows, columns=names)
            out.insert(0, key, batch[key].to_numpy())
            yield out

    return small_batches(docs).select(key, text).mapInPandas(run, f"{key} {dict(docs.dtypes)[key]}, {schema}")


def decode_documents(encoded: DataFrame, path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """(key, bytes binary) of encoded documents."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = codec(path, pattern)
        for batch in batches:
            yield pd.DataFrame({key: batch[key], "bytes": [c.decode(np.asarray(i)) for i in batch["ids"]]})

    return encoded.select(key, "ids").mapInPandas(run, f"{key} {dict(encoded.dtypes)[key]}, bytes binary")
