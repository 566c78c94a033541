"""Packing of token sequences by non-negative least squares over the histogram of piece lengths.

A document's ids are cut into full windows and a rest; a full window is a sequence of its own. Rests are counted by
size class (a class holds ``width`` lengths). Shallow combinations of up to ``depth`` classes that fill the window
exactly are enumerated; non-negative least squares finds how often each is used so that together they use up the
histogram; the counts are rounded down, and what is left over is packed greedily, largest first, class by class.

The histogram and the plan are bounded by the window (window/width classes), whatever the data, so that they are made
on the driver; which piece goes where is decided on the executors: pieces get a number inside their class (counted in
salted parts, since one length may be very common), and the plan says for each range of numbers which combination,
place and sequence it is.

A null or empty text is its end token alone. Null keys keep their pieces; repeated rows are packed each. Very long texts fill as many
windows as they need. Empty tables give no rows; columns besides key and text are not read and clash with nothing.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quadra.llm.pretokens import Encoded, hold
from quadra.llm.text import pieces as words_of
from quadra.llm.text import small_batches
from quadra.session import stored

#: Entries of the cache of encoded words in each Python worker.
CACHE = 400_000
_encoders: dict[str, Encoded] = {}


def _byte_chars() -> dict[int, int]:
    """The characters that stand for bytes in byte-level vocabularies: visible Latin-1 ones stand for themselves, the
    other bytes take the characters from U+0100 on, in order."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(seen)]
    return {b: b for b in seen} | {b: 256 + k for k, b in enumerate(rest)}


def _simple(path: str) -> str | None:
    """The split pattern, if the tokenizer is: NFC, white space joined, lower case; split by a pattern; byte level."""
    with open(path, encoding="utf-8") as f:
        conf = json.load(f)
    norm = [n["type"] for n in (conf.get("normalizer") or {}).get("normalizers", [])]
    pre = (conf.get("pre_tokenizer") or {}).get("pretokenizers", [])
    if norm != ["NFC", "Replace", "Lowercase"] or [x["type"] for x in pre] != ["Split", "ByteLevel"] or pre[1]["add_prefix_space"] or pre[1]["use_regex"]:
        return None
    return pre[0]["pattern"].get("Regex") if pre[0]["behavior"] == "Removed" and pre[0]["invert"] else None


def _encoder(path: str) -> Encoded:
    """Words of the text are encoded by the tokenizers library. Its pattern has no match that holds white space, so
    that the ids of a text are those of its parts between spaces, tabs and line ends.

    For printable words of Latin letters the normaliser does nothing but lower the case, so that the library's model is
    given their pre-tokens directly (each once); all others go through the library's whole chain."""
    if path not in _encoders:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        pattern, chars = _simple(path), _byte_chars()
        find, model = (regex.compile(pattern).findall, tok.model) if pattern else (None, None)

        def merge(tokens: list[str]) -> list[bytes]:
            mapped = [t.encode().decode("latin-1").translate(chars) for t in tokens]
            return [pack_ids([x.id for x in model.tokenize(m)]) for m in mapped]

        pack_ids = lambda ids: struct.pack(f"<{len(ids)}I", *ids)
        merged = Encoded(merge, CACHE // 2)

        def encode(words: list[str]) -> list[bytes]:
            out, hard, easy, parts = [b""] * len(words), [], [], []
            for k, w in enumerate(words):
                if find and w.isprintable() and (w.isascii() or max(w) < "\u0180") and "<|" not in w:
                    easy.append(k)
                    parts.append(find(w.lower()))
                else:
                    hard.append(k)
            merged.ensure(chain.from_iterable(parts))
            get = merged.__getitem__
            for k, p in zip(easy, parts, strict=True):
                out[k] = get(p[0]) if len(p) == 1 else b"".join(map(get, p))
            for k, e in zip(hard, tok.encode_batch_fast([words[k] for k in hard], add_special_tokens=False), strict=True):
                out[k] = np.asarray(e.ids, "<u4").tobytes()
            return out

        _encoders[path] = Encoded(encode, CACHE, {"": b""})
    return _encoders[path]


def token_pieces(docs: DataFrame, tokenizer: str, window: int = 4096, end_id: int = 2, key: str = "doc_id", text: str = "text", ids: bool = True) -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens and (with ``ids``) the ids themselves.

    Encodes the whole text (null: empty) and appends ``end_id``; pieces are full windows and the rest. Repeated rows
    give repeated pieces. ``row`` tells the input row, so that equal keys stay apart."""
    key_type = dict(docs.dtypes)[key]
    schema = f"{key} {key_type}, row long, start long, length long, ids_crc32 long, doc_tokens long" + (", ids array<int>" if ids else "")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        hold("packing", _encoders)
        encoder, end = _encoder(tokenizer), np.asarray([end_id], "<u4").tobytes()
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            out = []
            for doc, body in zip(batch[key], batch[text], strict=True):
                data = encoder.ids(words_of(body if isinstance(body, str) else "")) + end
                total = len(data) // 4
                for a in range(0, total, window):
                    part = data[4 * a : 4 * (a + window)]
                    rec = (doc, row, a, len(part) // 4, zlib.crc32(part), total)
                    out.append((*rec, np.frombuffer(part, "<u4").astype("int32")) if ids else rec)
                row += 1
            names = [key, "row", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * ids]
            if out:
                yield pd.DataFrame(out, columns=names)

    return small_batches(docs).select(key, text).mapInPandas(run, schema)


# ---------------------------------------------------------------- plan


def combinations(classes: int, depth: int) -> list[tuple[int, ...]]:
    """Non-increasing tuples of up to ``depth`` class sizes (1 to ``classes``) that sum to ``classes``."""
    out: list[tuple[int, ...]] = []

    def grow(rest: int, most: int, left: int, sofar: tuple[int, ...]) -> None:
        if rest == 0:
            out.append(sofar)
        elif left:
            for c in range(min(rest, most), (rest - 1) // left, -1):
                grow(rest - c, c, left - 1, (*sofar, c))

    grow(classes, classes, depth, ())
    return out


def nnls(a: np.ndarray, b: np.ndarray, steps: int = 400) -> np.ndarray:
    """min |a x - b| for x >= 0, by projected gradient with momentum (a is small and non-negative)."""
    gram, rhs = a.T @ a, a.T @ b
    v = np.ones(len(gram))
    for _ in range(30):
        v = gram @ v
        v /= np.linalg.norm(v) or 1.0
    bound = float(v @ gram @ v) * 1.05 or 1.0
    x = y = np.zeros(len(gram))
    t = 1.0
    for _ in range(steps):
        new = np.maximum(0.0, y - (gram @ y - rhs) / bound)
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t2 * (new - x)
        x, t = new, t2
    return x


def plan(histogram: dict[int, int], classes: int, depth: int) -> list[tuple[int, int, int, int, int]]:
    """Rows (class, from, upto, first sequence, place): the pieces of a class numbered from..upto-1 go to the sequences
    first, first+1, ... at that place. Each piece has exactly one range; a sequence's classes sum to at most ``classes``."""
    left = np.zeros(classes + 1, dtype=np.int64)
    for c, n in histogram.items():
        left[c] += n
    used = np.zeros(classes + 1, dtype=np.int64)
    rows: list[tuple[int, int, int, int, int]] = []
    sequence = 0

    def put(parts: list[int], times: int) -> None:
        nonlocal sequence
        for place, c in enumerate(parts):
            rows.append((c, int(used[c]), int(used[c] + times), sequence, place))
            used[c] += times
            left[c] -= times
        sequence += times

    present = {c for c in range(1, classes + 1) if left[c]}
    combos = [c for c in combinations(classes, depth) if set(c) <= present]
    if combos:
        a = np.zeros((classes, len(combos)))
        for j, combo in enumerate(combos):
            for c in combo:
                a[c - 1, j] += 1
        scale = float(left.sum())
        repeats = nnls(a, left[1:] / scale) * scale
        for j in np.argsort(-repeats, kind="stable"):
            need = np.bincount(combos[j], minlength=classes + 1)
            times = int(min(np.floor(repeats[j] + 1e-9), *(left[c] // need[c] for c in set(combos[j]))))
            if times > 0:
                put(list(combos[j]), times)
    while left.any():  # greedy: a pattern led by the largest class left, used as often as it goes; each round ends a class
        parts, room, spare = [], classes, left.copy()
        while True:
            fits = np.flatnonzero(spare[1 : room + 1])
            if not len(fits):
                break
            c = int(fits[-1]) + 1
            parts.append(c)
            spare[c] -= 1
            room -= c
        need = np.bincount(parts, minlength=classes + 1)
        put(parts, int(min(left[c] // need[c] for c in set(parts))))
    return rows


# ---------------------------------------------------------------- assignment


def _numbered(df: DataFrame, by: str, order: list[str]) -> DataFrame:
    """Adds ``number``: 0, 1, ... inside each value of ``by``. Counted in parts of a hash of the row, so that a very
    common value is spread: a window inside each part, and running sums over the (few) parts."""
    parts = max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    df = df.withColumn("__part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    inside = df.withColumn("__in", F.row_number().over(W.partitionBy(by, "__part").orderBy(*order)))
    sums = df.groupBy(by, "__part").agg(F.count(F.lit(1)).alias("__n"))
    before = W.partitionBy(by).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select(by, "__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"))
    return inside.join(sums, [by, "__part"]).withColumn("number", F.col("__base") + F.col("__in") - 1).drop("__part", "__in", "__base")


def pack(pieces: DataFrame, window: int = 4096, width: int = 32, depth: int = 3, key: str = "doc_id") -> DataFrame:
    """Adds sequence_id and offset to pieces (key, row, start, length, ...), at most ``window`` tokens a sequence.

    ``pieces`` should be stored: it is read for the histogram and again for the assignment. An empty table gives an
    empty one. Offsets are gapless: pieces of a sequence follow each other by place."""
    spark = pieces.sparkSession
    classes = window // width
    cls = F.ceil(F.col("length") / width).cast("int")
    rest = pieces.where(F.col("length") < window).withColumn("__class", cls)
    histogram = {r[0]: r[1] for r in rest.groupBy("__class").count().collect()}  # at most window/width rows
    rows = plan(histogram, classes, depth)
    by_class: dict[int, list] = {}
    for c, a, b, first, place in rows:
        by_class.setdefault(c, []).append((a, first, place))
    tables = {c: tuple(np.asarray(x, dtype=np.int64) for x in zip(*sorted(v), strict=True)) for c, v in by_class.items()}
    shared = spark.sparkContext.broadcast(tables)  # bounded by the combinations, whatever the data

    @F.pandas_udf("struct<sequence_id:long,place:int>")
    def where(c: pd.Series, number: pd.Series) -> pd.DataFrame:
        sequence, place = np.zeros(len(c), np.int64), np.zeros(len(c), np.int32)
        cs, ns = c.to_numpy(), number.to_numpy()
        for k in np.unique(cs):
            at = np.flatnonzero(cs == k)
            starts, first, places = shared.value[int(k)]
            i = np.searchsorted(starts, ns[at], side="right") - 1
            sequence[at] = first[i] + ns[at] - starts[i]
            place[at] = places[i]
        return pd.DataFrame({"sequence_id": sequence, "place": place})

    planned = max((first + b - a for _, a, b, first, _ in rows), default=0)
    order = ["row", "start"]
    numbered = _numbered(rest, "__class", order).withColumn("__at", where("__class", "number"))
    before = W.partitionBy("sequence_id").orderBy("__place").rowsBetween(W.unboundedPreceding, -1)
    shared_seq = (
        numbered.withColumns({"sequence_id": F.col("__at.sequence_id"), "__place": F.col("__at.place")})
        .withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long"))
        .drop("__class", "number", "__at", "__place")
    )
    full = pieces.where(F.col("length") >= window).withColumn("__all", F.lit(0))
    full = _numbered(full, "__all", order).withColumns({"sequence_id": F.col("number") + planned, "offset": F.lit(0).cast("long")}).drop("__all", "number")
    return shared_seq.unionByName(full)


def pack_documents(docs: DataFrame, tokenizer: str, window: int = 4096, ids: bool = True, **kw) -> DataFrame:
    """Documents to packed pieces: tokens, pieces (stored), plan, places."""
    made = stored(token_pieces(docs, tokenizer, window, ids=ids, **kw), "pieces")
    return pack(made, window, key=kw.get("key", "doc_id"))
