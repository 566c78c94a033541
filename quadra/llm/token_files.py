"""Token files: ids of documents in key order, each compressed on its own with a zstandard dictionary that all share.

A folder holds

* ``dictionary``: one row, the dictionary and its SHA-256, trained on serialised id arrays of a sample of documents;
* ``blocks``: Parquet files whose rows are blocks of consecutive documents of about BLOCK bytes: ``frames`` (the documents' zstandard
  frames, one after the other), the offset index (``keys``, ``ends`` of the frames, ``tokens``), the block's ``first`` and ``last`` key,
  its place (``part``, ``number``), the ids of its part ``before`` it, the width of an id in bytes and the dictionary's hash;
* ``parts``: the number of ids before each part.

Spark writes and reads all files, so that they may lie in any store that Spark knows, and lost tasks leave nothing behind. A document is
read by its block's statistics, its frame's offsets and one small decompression; its neighbours stay compressed.

Writing: documents are encoded and compressed where they are read and stored; what is stored is small and is dealt out by ranges of the
key, so that parts follow each other; sums over the parts give each its start.

The dictionary is trained on at most SAMPLE documents of up to SAMPLE_CHARS characters, those with the smallest hashes of key and
text among all; it decides sizes only. Where there is too little to train on there is none.

Null texts are empty texts; a document has its end id at least. Null keys come first, equal keys stay apart in the order in which they
were read. A text is encoded whole, however long. Empty tables give a folder without blocks; columns besides key and text are not
read and clash with nothing.
"""

from __future__ import annotations

import hashlib
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quadra.llm.packing import _byte_chars, _simple
from quadra.llm.pretokens import Recent, hold
from quadra.llm.subwords import chosen, distinct, slices
from quadra.llm.text import SPACES
from quadra.session import stored

#: Bytes of frames in a block; bytes of texts that are encoded together; compression level.
BLOCK, SLICE, LEVEL = 1 << 20, 4 << 20, 3
#: Words and pre-tokens that a Python worker remembers. Words of these letters only change their case before they are split.
CACHE, PARTS, PLAIN = 200_000, 400_000, "^[\\x21-\\x7e\\x{a1}-\\x{ac}\\x{ae}-\\x{17f}]*$"
#: Sample and size of the dictionary.
SAMPLE, SAMPLE_CHARS, DICTIONARY = 2_000, 20_000, 64 << 10


def _words(texts: pa.Array) -> pa.ListArray:
    """Texts split at white space; empty words stay."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)
    first, last = int(offsets[texts.offset]), int(offsets[texts.offset + len(texts)])
    raw = texts.buffers()[2].slice(first, last - first).to_pybytes() if last > first else b""
    for c in SPACES:
        if c != " " and c.encode() in raw:
            texts = pc.replace_substring(texts, c, " ")
    return pc.split_pattern(texts, " ")


class Words:
    """Ids of different words. Words and pre-tokens that were met before are looked up; CACHE and PARTS bound what is remembered."""

    def __init__(self, path: str):
        import os

        import regex

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok, pattern, self.chars = Tokenizer.from_file(path), _simple(path), _byte_chars()
        self.model, self.find = self.tok.model, regex.compile(f"{pattern}|\n").findall if pattern else None
        self.words, self.parts = Recent(CACHE), Recent(PARTS)

    def _merged(self, part: str) -> bytes:
        return array("I", [x.id for x in self.model.tokenize(part.encode().decode("latin-1").translate(self.chars))]).tobytes()

    def _plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids joined, number of each word's) of printable words of Latin letters, whose pre-tokens are found in one text of all of
        them, and merged once each."""
        parts, at = distinct(pa.array(self.find("\n".join(words).lower()), pa.large_string()))
        names = parts.to_pylist()
        got = self.parts.get_all(names)
        for k, x in enumerate(got):
            if x is None:
                got[k] = b"" if names[k] == "\n" else self._merged(names[k])
                self.parts.put(names[k], got[k])
        ids, n = chosen(np.frombuffer(b"".join(got), "<u4"), np.array([len(x) // 4 for x in got], np.int64), at)
        ends = at == names.index("\n") if len(words) > 1 else np.zeros(len(at), bool)
        return ids, np.bincount(np.cumsum(ends), weights=n, minlength=len(words)).astype(np.int64)

    def encode(self, words: pa.Array, often: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids joined, numbers of ids, where each word is among these). Words that are met ``often`` are remembered."""
        plain = pc.match_substring_regex(words, PLAIN) if self.find else pa.array(np.zeros(len(words), bool))
        plain = pc.and_(plain, pc.invert(pc.match_substring(words, "<|"))).to_numpy(zero_copy_only=False)
        names = words.to_pylist()
        got = self.words.get_all(names)
        known = np.array([x is not None for x in got], bool)
        easy, hard = np.flatnonzero(~known & plain), np.flatnonzero(~known & ~plain)
        ids, n = self._plain([names[k] for k in easy.tolist()]) if len(easy) else (np.empty(0, "<u4"), np.empty(0, np.int64))
        others = [np.array(e.ids, "<u4") for e in self.tok.encode_batch_fast([names[k] for k in hard.tolist()], add_special_tokens=False)] if len(hard) else []
        have = [got[k] for k in np.flatnonzero(known).tolist()]
        flat = np.concatenate([np.frombuffer(b"".join(have), "<u4"), ids, *others])
        size = np.r_[np.array([len(x) // 4 for x in have], np.int64), n, np.array([len(x) for x in others], np.int64)]
        order = np.r_[np.flatnonzero(known), easy, hard]
        place = np.empty(len(names), np.int64)
        place[order] = np.arange(len(names))
        keep = np.flatnonzero(often & ~known)
        ends, raw = 4 * np.cumsum(size), flat.tobytes()
        for k, e, m in zip(keep.tolist(), ends[place[keep]].tolist(), (4 * size[place[keep]]).tolist(), strict=True):
            self.words.put(names[k], raw[e - m : e])
        return flat, size, place


_known: dict[str, Words] = {}


def encode_slice(texts: pa.Array, tokenizer: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts joined, number of each text's), each with its end id. A word of the slice is looked up once."""
    if tokenizer not in _known:
        _known[tokenizer] = Words(tokenizer)
    lists = _words(texts)
    words, at = distinct(lists.flatten())
    flat, size, place = _known[tokenizer].encode(words, np.bincount(at, minlength=len(words)) > 1)
    ids, lengths = chosen(flat, size, place[at])
    before = np.r_[0, np.cumsum(lengths)]
    ends = before[lists.offsets.to_numpy()[1:] - lists.offsets[0].as_py()]
    return np.insert(ids, ends, end_id), np.diff(ends, prepend=0) + 1


def _compressor(dictionary: bytes):
    import zstandard

    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=False)


def _decompressor(dictionary: bytes):
    import zstandard

    return zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)


def width_of(tokenizer: str) -> int:
    """Bytes of a serialised id: two where all ids of the vocabulary fit."""
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(tokenizer).get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4


def _texts(batch: pa.RecordBatch, column: int) -> pa.Array:
    return pc.fill_null(batch.column(column).cast(pa.large_string()), "")


def train(docs: DataFrame, tokenizer: str, width: int, end_id: int = 2, key: str = "doc_id", text: str = "text") -> bytes:
    """The dictionary; empty where the sample is too small to train on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        hold("token_files", _known)
        samples = []
        for batch in batches:
            for a, b in slices(texts := _texts(batch, 0), SLICE):
                ids, n = encode_slice(texts.slice(a, b - a), tokenizer, end_id)
                raw, ends = ids.astype(f"<u{width}").tobytes(), np.cumsum(n) * width
                samples += [raw[e - m * width : e] for e, m in zip(ends.tolist(), n.tolist(), strict=True)]
        made = b""
        if len(samples) >= 8 and sum(map(len, samples)) > 8 * 1024:
            try:
                made = zstandard.train_dictionary(min(DICTIONARY, sum(map(len, samples)) // 8), samples).as_bytes()
            except zstandard.ZstdError:  # samples that are all alike have nothing to share
                made = b""
        yield pa.RecordBatch.from_arrays([pa.array([made], pa.binary())], ["dictionary"])

    body = F.col(text).cast("string")
    rows = docs.where(F.length(body).between(1, SAMPLE_CHARS)).select(body.alias("text"), F.xxhash64(F.col(key), body).alias("hash"))
    sample = rows.orderBy("hash").limit(SAMPLE).select("text").coalesce(1)
    found = sample.mapInArrow(run, "dictionary binary").collect()  # one row at most
    return bytes(found[0][0]) if found else b""


def compress(docs: DataFrame, tokenizer: str, dictionary: bytes, width: int, end_id: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, row, tokens, frame) by document, where it is read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        hold("token_files", _known)
        pack, row = _compressor(dictionary).compress, TaskContext.get().partitionId() << 36
        for batch in batches:
            for a, b in slices(texts := _texts(batch, 1), SLICE):
                ids, n = encode_slice(texts.slice(a, b - a), tokenizer, end_id)
                raw, ends = memoryview(ids.astype(f"<u{width}").tobytes()), np.cumsum(n) * width
                frames = [pack(raw[e - m * width : e]) for e, m in zip(ends.tolist(), n.tolist(), strict=True)]
                columns = [batch.column(0).slice(a, b - a), pa.array(np.arange(row, row + b - a)), pa.array(n, pa.int64()), pa.array(frames, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["key", "row", "tokens", "frame"])
                row += b - a

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"key {dict(docs.dtypes)[key]}, row long, tokens long, frame binary")


def _blocks(width: int, digest: str, kind: str):
    """Consecutive documents of a part to blocks."""
    fields = ["part", "number", "before", "first", "last", "width", "dictionary", "keys", "tokens", "ends", "frames"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, before = TaskContext.get().partitionId(), 0, 0
        key_type: list[pa.DataType] = []
        keys: list = []
        tokens: list[int] = []
        frames: list[bytes] = []
        size = 0

        def block() -> pa.RecordBatch:
            ends = np.cumsum([len(f) for f in frames])
            known = [k for k in keys if k is not None]
            row = [part, number, before, known[0] if known else None, known[-1] if known else None, width, digest, keys, tokens, ends.tolist(), b"".join(frames)]
            types = [pa.int32(), pa.int64(), pa.int64(), key_type[0], key_type[0], pa.int32(), pa.string(), pa.list_(key_type[0]), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types, strict=True)], fields)

        for batch in batches:
            key_type[:] = [batch.column(0).type]
            for k, n, f in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if frames and size + len(f) > BLOCK:
                    yield block()
                    number, before = number + 1, before + sum(tokens)
                    keys, tokens, frames, size = [], [], [], 0
                keys.append(k)
                tokens.append(n)
                frames.append(f)
                size += len(f)
        if frames:
            yield block()

    schema = f"part int, number long, before long, first {kind}, last {kind}, width int, dictionary string, keys array<{kind}>, tokens array<long>, ends array<long>, frames binary"
    return run, schema


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, key: str = "doc_id", text: str = "text") -> None:
    """Encode whole texts, append ``end_id``, and write the ids in ascending order of the key."""
    spark, width = docs.sparkSession, width_of(tokenizer)
    dictionary = train(docs, tokenizer, width, end_id, key, text)
    digest = hashlib.sha256(dictionary).hexdigest()
    spark.createDataFrame([(digest, bytearray(dictionary))], "hash string, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")
    frames = stored(compress(docs, tokenizer, dictionary, width, end_id, key, text), "frames")
    # Parts are numbered from the smallest key on; equal keys are parted by row, so that no key fills a part.
    order = [F.col("key").asc_nulls_first(), F.col("row")]
    ordered = frames.repartitionByRange(*order).sortWithinPartitions(*order)
    run, schema = _blocks(width, digest, dict(docs.dtypes)[key])
    ordered.select("key", "tokens", "frame").mapInArrow(run, schema).write.option("compression", "none").parquet(f"{path}/blocks")
    total = F.aggregate("tokens", F.lit(0).cast("long"), lambda a, x: a + x)
    parts = spark.read.parquet(f"{path}/blocks").groupBy("part").agg(F.sum(total).alias("total"))  # one row a part of the shuffle
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base")).coalesce(1).write.parquet(f"{path}/parts")


def _dictionary(spark: SparkSession, path: str) -> tuple[str, bytes]:
    digest, dictionary = spark.read.parquet(f"{path}/dictionary").first()
    if hashlib.sha256(bytes(dictionary)).hexdigest() != digest:
        raise ValueError("the dictionary is not the one that was written")
    return digest, bytes(dictionary)


def read_token_files(spark: SparkSession, path: str, keys: DataFrame | None = None, key: str = "doc_id", derive: Callable | None = None, schema: str = "ids array<int>") -> DataFrame:
    """(key, start, n_tokens, ids) by document: ``start`` counts the ids of all documents before it. ``derive(ids)`` may return other
    columns, named by ``schema``, from the unsigned ids.

    ``keys``: a table of keys of which only these documents are read: a block that holds none stays unread, and of the others only
    the frames asked for are decompressed. A dictionary other than the one the blocks were written with is an error."""
    digest, dictionary = _dictionary(spark, path)
    names = [c.split()[0] for c in schema.split(",")]
    make = derive or (lambda ids: (ids.astype("int32"),))
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["first"].dataType.simpleString()
    if keys is not None:
        asked = keys.select(F.col(key).cast(kind).alias("asked")).where("asked is not null").distinct()
        blocks = _blocks_of(blocks, asked)
    else:
        blocks = blocks.withColumn("asked", F.lit(None).cast(f"array<{kind}>"))
    based = blocks.join(spark.read.parquet(f"{path}/parts"), "part")
    places = based.select((F.col("base") + F.col("before")).alias("start"), "width", "dictionary", "keys", "tokens", "ends", "frames", "asked")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = _decompressor(dictionary).decompress
        for batch in batches:
            for block in range(batch.num_rows):
                start, width, used, held, tokens, ends, frames, asked = (batch.column(c)[block] for c in range(8))
                if used.as_py() != digest:
                    raise ValueError("the block was written with another dictionary")
                held, tokens, ends = held.values, tokens.values.to_numpy(), ends.values.to_numpy()
                want = np.arange(len(tokens)) if not asked.is_valid else np.flatnonzero(pc.is_in(held, asked.values).to_numpy(zero_copy_only=False))
                data, starts, begins = frames.as_buffer(), start.as_py() + np.cumsum(tokens) - tokens, np.r_[0, ends[:-1]]
                rows = []
                for i in want.tolist():
                    ids = np.frombuffer(unpack(memoryview(data)[begins[i] : ends[i]]), f"<u{width.as_py()}").astype("<u4")
                    if len(ids) != tokens[i]:
                        raise ValueError("a frame has another number of ids than its index says")
                    rows.append(make(ids))
                columns = [held.take(pa.array(want)), pa.array(starts[want]), pa.array(tokens[want])]
                made = list(zip(*rows, strict=True)) or [[] for _ in names]
                yield pa.RecordBatch.from_arrays([*columns, *[pa.array(list(v), t) for v, t in zip(made, types, strict=True)]], ["key", "start", "n_tokens", *names])

    from pyspark.sql.pandas.types import to_arrow_schema

    types = [f.type for f in to_arrow_schema(spark.createDataFrame([], schema).schema)]
    return places.mapInArrow(run, f"key {kind}, start long, n_tokens long, {schema}").withColumnRenamed("key", key)


def _blocks_of(blocks: DataFrame, asked: DataFrame) -> DataFrame:
    """The blocks that hold keys that are asked for, with these keys. The index alone is joined with them; frames are read after it."""
    index = blocks.select("part", "number", F.explode("keys").alias("asked"))
    found = index.join(asked, "asked").groupBy("part", "number").agg(F.collect_set("asked").alias("asked"))
    return blocks.join(found, ["part", "number"])


def read_document(spark: SparkSession, path: str, key: object) -> list[list[int]]:
    """The ids of one document (of each, where several have the key). Blocks are chosen by their statistics, its frame by its offsets."""
    name = "wanted"
    blocks = spark.read.parquet(f"{path}/blocks").where((F.col("first") <= F.lit(key)) & (F.col("last") >= F.lit(key)))
    at = F.explode(F.filter(F.sequence(F.lit(1), F.size("keys")), lambda i: F.col("keys")[i - 1].eqNullSafe(F.lit(key)))).alias(name)
    begin = lambda i: F.when(i > 1, F.col("ends")[i - 2]).otherwise(0)
    frames = blocks.select("*", at).select("width", "dictionary", _bytes(F.col("frames"), begin(F.col(name)), F.col("ends")[F.col(name) - 1]).alias("frame")).collect()
    digest, dictionary = _dictionary(spark, path)
    if any(f.dictionary != digest for f in frames):
        raise ValueError("the block was written with another dictionary")
    return [np.frombuffer(_decompressor(dictionary).decompress(bytes(f.frame)), f"<u{f.width}").tolist() for f in frames]


def _bytes(data: Column, begin: Column, end: Column) -> Column:
    return F.substring(data, (begin + 1).cast("int"), (end - begin).cast("int"))


def crc32(ids: np.ndarray) -> tuple[int]:
    """CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return (zlib.crc32(ids.tobytes()),)
