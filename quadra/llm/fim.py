"""Fill-in-middle transformation: documents are cut at two unit ends and written with the middle last.

A unit is a word with the white space before it, or the white space that ends a text (white space: space and 0x09 to 0x0D).
Texts are never split into units. The UTF-8 bytes of many texts lie side by side and are viewed as 64-bit words:

1. arithmetic on whole words flags each byte that ends a unit (no white space, and white space or the text's end follows; or the
   text's last byte), eight bytes at a time;
2. ``bitwise_count`` of each word and a cumulative sum give the number of units before any byte;
3. the k-th unit's end is found by a search in that sum for its word, and then in the word: a multiplication makes running
   counts in its eight bytes, and a comparison of all eight tells which byte has the count that is asked for.

Characters before a byte are counted the same way, from the bytes that continue no character.

Null and empty texts have no units and stay plain, as do texts that contain a sentinel. Equal keys get equal cuts, so repeated rows give equal
rows; a null key counts as the empty string. A text is worked on whole, however long; a task holds one slice of SLICE bytes of texts
(or one longer text) at a time. Empty tables give no rows; columns besides key and text are not read and clash with nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadra.llm.subwords import slices

#: Bytes of texts that are marked together.
SLICE = 8 << 20
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

_ONES = np.uint64(0x0101010101010101)
_HIGH = np.uint64(0x8080808080808080)
_LOW = np.uint64(0x7F7F7F7F7F7F7F7F)
_1, _7, _8, _56 = (np.uint64(x) for x in (1, 7, 8, 56))


def _each(byte: int) -> np.uint64:
    """A word with the same value in all bytes."""
    return np.uint64(byte * 0x0101010101010101)


class Flags:
    """One flag a byte (its highest bit) in 64-bit words, with rank and select."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.before = np.r_[0, np.cumsum(np.bitwise_count(words), dtype=np.int64)]

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Number of flags below each byte offset."""
        word, rest = at >> 3, (at & 7).astype(np.uint64)
        part = self.words[word] & ((_1 << (rest * _8)) - _1)
        return self.before[word] + np.bitwise_count(part)

    def select(self, k: np.ndarray) -> np.ndarray:
        """Byte offset of the k-th flag, from 0."""
        word = np.searchsorted(self.before, k, "right") - 1
        running = (self.words[word] >> _7) * _ONES  # in byte i: flags in bytes 0 to i
        wanted = (k - self.before[word] + 1).astype(np.uint64) * _ONES
        reached = ((running | _HIGH) - wanted) & _HIGH
        return word * 8 + 8 - np.bitwise_count(reached).astype(np.int64)


def white(words: np.ndarray) -> np.ndarray:
    """Flags of the bytes that are white space."""
    low = words & _LOW
    blank = ~((low ^ _each(0x20)) + _LOW)
    control = (low + _each(0x80 - 0x09)) & ~(low + _each(0x80 - 0x0E))
    return (blank | control) & ~words & _HIGH


def unit_ends(words: np.ndarray, last: np.ndarray) -> Flags:
    """Flags of the bytes that end units; ``last``: offsets of the texts' last bytes. One word of zeros must end ``words``."""
    space = white(words)
    following = space >> _8
    following[:-1] |= space[1:] << _56
    ends = ~space & following & _HIGH
    ends.view(np.uint8)[last] |= 0x80
    return Flags(ends)


def characters(words: np.ndarray) -> Flags:
    """Flags of the bytes that start characters: all but 10xxxxxx."""
    return Flags((~words | words << _1) & _HIGH)


def _draws(key: object, seed: int) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).digest()
    return [int.from_bytes(digest[a : a + 4], "big") for a in (0, 4, 8, 12)]


def _transform(keys: list, texts: pa.Array, seed: int, rate: int, spm_rate: int) -> tuple[list, ...]:
    """Columns n, form, prefix_chars, middle_chars, output of one slice of texts without nulls."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    start, end = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
    size = int(end[-1]) if len(end) else 0
    data = np.zeros(size // 8 * 8 + 16, np.uint8)
    if size:
        data[:size] = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    words = data.view("<u8")
    ends, chars = unit_ends(words, (end - 1)[end > start]), characters(words)
    first = ends.rank(start)
    n = ends.rank(end) - first
    draws = np.array([_draws(k, seed) for k in keys], np.int64).reshape(-1, 4)
    cuts = np.sort(draws[:, :2] % (n + 1)[:, None], axis=1)
    marked = pc.or_(pc.or_(pc.match_substring(texts, PREFIX), pc.match_substring(texts, SUFFIX)), pc.match_substring(texts, MIDDLE))
    plain = (n == 0) | marked.to_numpy(zero_copy_only=False) | (draws[:, 2] % 100 >= rate)
    spm = draws[:, 3] % 100 < spm_rate
    at = np.where(plain[:, None] | (cuts == 0), start[:, None], 0)
    some = ~plain[:, None] & (cuts > 0)
    at[some] = ends.select((first[:, None] + cuts - 1)[some]) + 1
    lengths = np.diff(chars.rank(np.c_[start, at]), axis=1)
    body = data[:size].tobytes()
    p, s, m = PREFIX.encode(), SUFFIX.encode(), MIDDLE.encode()
    output = []
    for a, (x, y), b, keep, swap in zip(start, at, end, plain, spm, strict=True):
        if keep:
            output.append(body[a:b])
        elif swap:
            output.append(b"".join((s, body[y:b], p, body[a:x], m, body[x:y])))
        else:
            output.append(b"".join((p, body[a:x], s, body[y:b], m, body[x:y])))
    form = np.where(plain, "plain", np.where(spm, "spm", "psm"))
    return n, form, np.ma.array(lengths[:, 0], mask=plain), np.ma.array(lengths[:, 1], mask=plain), output


def fill_in_middle(docs: DataFrame, seed: int = 42, rate: int = 50, spm_rate: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n units, form, prefix_chars, middle_chars, output): of the documents that can be cut, ``rate`` in a hundred are, and
    ``spm_rate`` of these have the suffix first. Cuts and forms are drawn from the SHA-256 of ``seed:key``. Nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pc.fill_null(batch.column(1).cast(pa.large_string()), "")
            for a, b in slices(texts, SLICE):
                keys = batch.column(0).slice(a, b - a)
                n, form, prefix, middle, output = _transform(keys.to_pylist(), texts.slice(a, b - a), seed, rate, spm_rate)
                counts = [pa.array(c.data, pa.int64(), mask=np.ma.getmaskarray(c)) for c in (prefix, middle)]
                columns = [keys, pa.array(n, pa.int64()), pa.array(form.tolist(), pa.string()), *counts, pa.array(output, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "n", "form", "prefix_chars", "middle_chars", "output"])

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = f"key {dict(docs.dtypes)[key]}, n long, form string, prefix_chars long, middle_chars long, output string"
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def restore(output: Column, form: Column) -> Column:
    """The text, from its output and form alone: a cut text holds no sentinel of its own, so each stands once in the output."""
    part = lambda c, sentinel, k: F.split_part(c, F.lit(sentinel), F.lit(k))
    psm = F.concat(part(part(output, PREFIX, 2), SUFFIX, 1), part(output, MIDDLE, 2), part(part(output, SUFFIX, 2), MIDDLE, 1))
    spm = F.concat(part(part(output, PREFIX, 2), MIDDLE, 1), part(output, MIDDLE, 2), part(part(output, SUFFIX, 2), PREFIX, 1))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
