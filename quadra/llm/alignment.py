"""Alignment of two tokenisers' tokens: which token of one stands for which of the other.

A is a byte-level BPE vocabulary of the tokenizers library, B a sentencepiece BPE model with byte fallback; A reads space + text, B
reads the text and adds the space itself. Both token rows then spell the same bytes; offsets where tokens of both end cut a
document into groups, and all A and B tokens of a group are linked.

1. Full tokenisation. Neither tokeniser joins anything across a single space that stands between two characters which are no white
   space (A's pattern starts a pre-token there, no piece of B has a space behind another character), so that a document's
   tokens are those of its parts between such spaces, and each different part of a batch is encoded once.
2. Anchors: offsets at which both an A token and a B token start, both marked by a space. The token before ends there on both sides. A
   part that spells its text on both sides starts at one; others stand only in parts that hold further spaces, and are found from
   the cumulative token lengths.
3. Anchors cut the documents into windows. What a window aligns to depends on its two id tuples alone and is looked up by them; windows
   that are new are aligned together.
4. Counts of linked pairs over all documents: each document has its different pairs once, with how often it links them. Pairs that
   more than 1/COMMON of all rows hold (at most COMMON pairs, whatever the data) are sent to all tasks, all others are joined by a
   shuffle, see :mod:`quadra.llm.hot`. The highest count of each A id is one row an id of A's vocabulary.

Documents without tokens: null and empty texts, and texts whose joined B bytes differ from space + text (B reads U+2581 as a space).
Repeated rows count as documents of their own; null keys keep their row. Texts are worked on whole: a task holds a slice of SLICE bytes
of texts or one longer text; the links of one group are counted by different ids, not listed. Empty tables give no rows; columns besides
key and text are not read and clash with nothing.
"""

from __future__ import annotations

import hashlib
import json
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadra.llm.hot import lookup
from quadra.llm.packing import _byte_chars
from quadra.llm.pretokens import Recent, hold
from quadra.llm.subwords import chosen, distinct, slices
from quadra.session import stored

#: Bytes of texts that are aligned together; entries of each cache of a Python worker; tokens of a window that is remembered.
SLICE, CACHE, WINDOW = 4 << 20, 160_000, 64
#: Fixed value: how A's text is split into pre-tokens, that of byte-level vocabularies of its kind.
A_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The most pairs whose counts are sent to all tasks.
COMMON = 250_000
#: White space in the widest sense: at a space before one of these no part starts.
_WIDE = " \t-\r\x1c-\x1f\x85\xa0  -     　"
_SHAPES = "n_a long, n_b long, n_groups long, n_links long"
_aligners: dict[tuple[str, str], "Aligner"] = {}


class Aligner:
    """Both tokenisers, and what their parts and windows came to."""

    def __init__(self, a_path: str, b_path: str):
        import os

        import regex
        import sentencepiece

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        with open(a_path, encoding="utf-8") as f:
            vocabulary = json.load(f)["model"]["vocab"]
        byte = {chr(c): b for b, c in _byte_chars().items()}
        self.a_length = np.zeros(max(vocabulary.values()) + 1, np.int64)
        self.a_marked = np.zeros(len(self.a_length), bool)
        for token, i in vocabulary.items():
            self.a_length[i], self.a_marked[i] = len(token), byte.get(token[0]) == 0x20
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece has a space behind another character")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.b_length = np.array([len(x) for x in self.b_bytes], np.int64)
        self.b_marked = np.array([x[:1] == b" " for x in self.b_bytes])
        self.a_lengths, self.b_lengths, self.b_size = self.a_length.tolist(), self.b_length.tolist(), len(pieces)
        # an id as text, with what follows it inside a group or at the end of the group's side
        self.b_texts = 2 * len(self.a_length)
        self.texts = [b"%d%s" % (i, c) for n, ends in ((len(self.a_length), (b",", b"|")), (len(pieces), (b",", b";"))) for i in range(n) for c in ends]
        self.cut = regex.compile(rf"(?<! ) (?=[^{_WIDE}])").split
        self.find, self.model, self.chars = regex.compile(A_PATTERN).findall, self.a.model, _byte_chars()
        self.tokens, self.parts, self.windows = Recent(CACHE), Recent(CACHE), Recent(CACHE)

    # ------------------------------------------------------------ parts

    def _merged(self, pretokens: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(A ids joined, number of each pre-token's) of different pre-tokens."""
        names, known = pretokens.to_pylist(), self.tokens
        got = known.get_all(names)
        for k, t in enumerate(names):
            if got[k] is None:
                got[k] = array("i", [x.id for x in self.model.tokenize(t.encode().decode("latin-1").translate(self.chars))]).tobytes()
                known.put(t, got[k])
        return np.frombuffer(b"".join(got), np.int32), np.array([len(x) // 4 for x in got], np.int64)

    def _a_ids(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(A ids joined, number of each part's) of parts with a space before them. Parts without white space at their start and spaces inside
        are split together, as one text with a space before each, which is where a part's first pre-token starts."""
        lone = [bool(p) and not p[0].isspace() and " " not in p for p in parts]
        texts = [p for p, x in zip(parts, lone, strict=True) if x]
        found = self.find(" " + " ".join(texts)) if texts else []
        rest = [self.find(" " + p) for p, x in zip(parts, lone, strict=True) if not x]
        pretokens, at = distinct(pa.array([*found, *chain.from_iterable(rest)], pa.large_string()))
        flat, size = self._merged(pretokens)
        first = pc.starts_with(pretokens, " ").to_numpy(zero_copy_only=False)[at[: len(found)]]
        owner = np.r_[np.cumsum(first) - 1, np.repeat(np.arange(len(texts), len(parts)), [len(r) for r in rest])].astype(np.int64)
        ids, n = chosen(flat, size, at)
        number = np.bincount(owner, weights=n, minlength=len(parts)).astype(np.int64)
        if len(number) != len(parts):
            raise ValueError("pre-tokens do not start where parts do")
        place = np.empty(len(parts), np.int64)
        lone = np.array(lone, bool)
        place[np.flatnonzero(lone)], place[np.flatnonzero(~lone)] = np.arange(len(texts)), np.arange(len(texts), len(parts))
        return chosen(ids, number, place)

    def encoded(self, parts: list[str], often: np.ndarray) -> list[tuple[tuple[bytes, bytes], bool]]:
        """((A ids, B ids), whether both spell the part) of different parts without the space before them; those that stand more than
        once here are remembered."""
        got = self.parts.get_all(parts)
        new = [k for k, x in enumerate(got) if x is None]
        if not new:
            return got
        texts = [parts[k] for k in new]
        raw = [b" " + p.encode() for p in texts]
        a, an = self._a_ids(texts)
        lists = self.b.encode(texts, num_threads=1)
        b, bn = np.array(array("i", chain.from_iterable(lists)), np.int32), np.array(list(map(len, lists)), np.int64)
        length = np.array(list(map(len, raw)), np.int64)
        spelled = lambda ids, n, sizes: np.bincount(np.repeat(np.arange(len(n)), n), weights=sizes[ids], minlength=len(n)) == length
        same = spelled(a, an, self.a_length) & spelled(b, bn, self.b_length)
        if b"".join(map(self.b_bytes.__getitem__, b.tolist())) != b"".join(raw):
            same &= np.array([b"".join(map(self.b_bytes.__getitem__, y)) == r for y, r in zip(lists, raw, strict=True)], bool)
        x, y, i, j = a.tobytes(), b.tobytes(), [0, *(4 * np.cumsum(an)).tolist()], [0, *(4 * np.cumsum(bn)).tolist()]
        for k, n, ok, o in zip(new, range(len(new)), same.tolist(), often[new].tolist(), strict=True):
            got[k] = made = (x[i[n] : i[n + 1]], y[j[n] : j[n + 1]]), ok
            if o:
                self.parts.put(texts[n], made)
        return got

    def split(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """(parts of all texts joined, their number in each text). Where every space stands alone before a visible character,
        parts are what lies between spaces; other texts are cut by a pattern."""
        odd = pc.match_substring_regex(texts, f"^ | ( |$|[{_WIDE}])").to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(texts, " ")
        if not odd.any():
            return lists.flatten(), np.diff(lists.offsets.to_numpy())
        rows = [self.cut(t) if o else w for t, o, w in zip(texts.to_pylist(), odd, lists.to_pylist(), strict=True)]
        return pa.array([p for r in rows for p in r], pa.large_string()), np.array([len(r) for r in rows], np.int64)

    # ------------------------------------------------------------ windows

    def _align(self, a_ids: bytes, b_ids: bytes) -> tuple[bytes, int, int, bytes]:
        """(groups as text, their number, number of links, pairs with their numbers) of one window."""
        a, b, size = array("i", a_ids), array("i", b_ids), self.b_size
        a_long, b_long = self.a_lengths, self.b_lengths
        text, links, pairs = [], 0, []
        i = k = 0
        while i < len(a):
            j, m = i + 1, k + 1
            ahead = a_long[a[i]] - b_long[b[k]]  # bytes that A's tokens of this group have more than B's
            while ahead:
                if ahead < 0:
                    ahead += a_long[a[j]]
                    j += 1
                else:
                    ahead -= b_long[b[m]]
                    m += 1
            if j - i == 1 == m - k:
                text.append(f"{a[i]}|{b[k]}")
                pairs.append((a[i] * size + b[k]) << 32 | 1)
                links += 1
            else:
                x, y = a[i:j], b[k:m]
                text.append(",".join(map(str, x)) + "|" + ",".join(map(str, y)))
                links += len(x) * len(y)
                yn = Counter(y).items()
                pairs += [(p * size + q) << 32 | n * o for p, n in Counter(x).items() for q, o in yn]
            i, k = j, m
        return ";".join(text).encode(), len(text), links, array("q", pairs).tobytes()

    def _align_many(self, keys: list[tuple[bytes, bytes]]) -> list[tuple[bytes, int, int, bytes]]:
        """The same for many short windows at once."""
        a, b = (np.frombuffer(b"".join(k[s] for k in keys), np.int32).astype(np.int64) for s in (0, 1))
        an, bn = (np.array([len(k[s]) // 4 for k in keys], np.int64) for s in (0, 1))
        a_end, b_end = np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b])
        at = np.searchsorted(b_end, a_end)
        a_last = b_end[at] == a_end  # tokens that end a group
        b_last = np.zeros(len(b), bool)
        b_last[at[a_last]] = True
        a_group, b_group = np.cumsum(a_last) - a_last, np.cumsum(b_last) - b_last
        na, nb = np.bincount(a_group), np.bincount(b_group)
        window = np.repeat(np.arange(len(keys)), an)[a_last]
        groups = np.bincount(window, minlength=len(keys))
        links = np.bincount(window, weights=na * nb, minlength=len(keys)).astype(np.int64)
        times = nb[a_group]  # each A token with all B tokens of its group
        other = np.repeat((np.cumsum(nb) - nb)[a_group] - np.cumsum(times) + times, times) + np.arange(times.sum())
        pairs = ((np.repeat(a, times) * self.b_size + b[other]) << 32 | 1).tobytes()
        order = np.argsort(np.r_[a_group, b_group], kind="stable")  # A's tokens of a group, then B's
        words = np.r_[2 * a + a_last, self.b_texts + 2 * b + b_last][order].tolist()
        text, out, i, k = self.texts.__getitem__, [], 0, 0
        for n, g, m in zip((an + bn).tolist(), groups.tolist(), links.tolist(), strict=True):
            out.append((b"".join(map(text, words[i : i + n]))[:-1], g, m, pairs[k : k + 8 * m]))
            i, k = i + n, k + 8 * m
        return out

    def aligned(self, keys: list[tuple[bytes, bytes]], often: np.ndarray) -> list[tuple[bytes, int, int, bytes]]:
        """What windows align to, by their id tuples. Those that stand more than once here are remembered."""
        got = self.windows.get_all(keys)
        missing = [n for n, w in enumerate(got) if w is None]
        new = dict.fromkeys(keys[n] for n in missing)
        short = [k for k in new if len(k[0]) + len(k[1]) <= 4 * WINDOW]
        if short:
            new.update(zip(short, self._align_many(short), strict=True))
        for k, w in new.items():
            if w is None:
                new[k] = self._align(*k)
        for n, o in zip(missing, often[missing].tolist(), strict=True):
            key = keys[n]
            got[n] = new[key]
            if o and len(key[0]) <= 4 * WINDOW:
                self.windows.put(key, got[n])
        return got

    def cut_at_anchors(self, a_ids: bytes, b_ids: bytes) -> list[tuple[bytes, bytes]]:
        """The windows of a part: from each offset at which tokens of both sides start with a space to the next."""
        a, b = np.frombuffer(a_ids, np.int32), np.frombuffer(b_ids, np.int32)
        a_start, b_start = (np.cumsum(n[ids]) - n[ids] for n, ids in ((self.a_length, a), (self.b_length, b)))
        both = np.intersect1d(a_start[self.a_marked[a]], b_start[self.b_marked[b]])
        i, k = ([*(4 * np.searchsorted(start, both)).tolist(), 4 * len(start)] for start in (a_start, b_start))
        return [(a_ids[x:y], b_ids[u:v]) for x, y, u, v in zip(i, i[1:], k, k[1:], strict=False)]

    # ------------------------------------------------------------ documents

    def documents(self, texts: pa.Array) -> dict[str, object]:
        """Columns of a slice of texts: n_a, n_b, n_groups, n_links, groups (bytes), pairs and their numbers (lists)."""
        total = len(texts)
        parts, n = self.split(texts)
        words, at = distinct(parts)
        often = np.bincount(at, minlength=len(words)) > 1
        found = self.encoded(words.to_pylist(), often)
        # a part starts at an anchor: its space marks a token of both sides; only a part that holds further spaces has others
        spaced = pc.match_substring(words, " ").to_numpy(zero_copy_only=False)
        keys, size = [x[0] for x in found], np.ones(len(words), np.int64)
        if spaced.any():
            lists = [self.cut_at_anchors(*k) if s and ok else [k] for (k, ok), s in zip(found, spaced.tolist(), strict=True)]
            keys, size = [k for r in lists for k in r], np.array([len(r) for r in lists], np.int64)
        ok = np.array([x[1] for x in found], bool)
        wrong = np.bincount(np.repeat(np.arange(total), n)[~ok[at]], minlength=total) > 0
        good = ~wrong & ~pc.equal(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
        # windows of parts that do not spell their text are empty, and no document that stays has them
        usable = np.repeat(ok, size)
        windows = self.aligned([k if u else (b"", b"") for k, u in zip(keys, usable.tolist(), strict=True)], np.repeat(often, size))
        doc = np.repeat(np.arange(total), np.where(good, n, 0))
        which, times = chosen(np.arange(len(keys)), size, at[np.repeat(good, n)])
        doc = np.repeat(doc, times)
        count = lambda values: np.bincount(doc, weights=np.array(values, np.float64)[which], minlength=total).astype(np.int64)
        ends, text = np.cumsum(np.bincount(doc, minlength=total)).tolist(), [w[0] for w in windows].__getitem__
        order = which.tolist()
        made = {"n_a": count([len(k[0]) // 4 for k in keys]), "n_b": count([len(k[1]) // 4 for k in keys]), "n_groups": count([w[1] for w in windows]), "n_links": count([w[2] for w in windows])}
        made["groups"] = [b";".join(map(text, order[i:j])) for i, j in zip([0, *ends], ends, strict=False)]
        return made | self._pairs(windows, which, doc, total)

    def _pairs(self, windows: list, which: np.ndarray, doc: np.ndarray, total: int) -> dict[str, pa.Array]:
        """Each document's different pairs, and how often it links them. A document's equal windows are counted first."""
        seen, often = np.unique(doc << 32 | which, return_counts=True)
        links, n = chosen(np.frombuffer(b"".join(w[3] for w in windows), np.int64), np.array([len(w[3]) // 8 for w in windows], np.int64), seen & 0xFFFFFFFF)
        key = np.repeat(seen >> 32, n) << 32 | links >> 32
        order = np.argsort(key)
        key, times = key[order], ((links & 0xFFFFFFFF) * np.repeat(often, n))[order]
        new = np.flatnonzero(np.diff(key, prepend=-1))
        times = np.add.reduceat(times, new) if len(new) else times
        offsets = pa.array(np.r_[0, np.cumsum(np.bincount(key[new] >> 32, minlength=total))], pa.int32())
        lists = lambda v: pa.ListArray.from_arrays(offsets, pa.array(v, pa.int32()))
        return {"pairs": lists(key[new] & 0xFFFFFFFF), "times": lists(times)}


def align(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """(key, row, n_a, n_b, n_groups, n_links, groups, pairs, times) by document. ``groups`` is ``a1,a2|b1;a3|b2,b3``: the ids of both
    sides, group after group, or with ``digest`` the SHA-256 of it ('' without tokens). ``pairs`` are the different linked id
    pairs, as A id * size of B + B id, ``times`` how often each is linked here. ``row`` tells input rows apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        hold("alignment", _aligners)
        if (a_path, b_path) not in _aligners:
            _aligners[a_path, b_path] = Aligner(a_path, b_path)
        aligner, row = _aligners[a_path, b_path], TaskContext.get().partitionId() << 36
        for batch in batches:
            texts = pc.fill_null(batch.column(1).cast(pa.large_string()), "")
            for i, j in slices(texts, SLICE):
                made = aligner.documents(texts.slice(i, j - i))
                groups = made.pop("groups")
                if digest:
                    groups = [hashlib.sha256(g).hexdigest() if g else "" for g in groups]
                counts = [pa.array(made[k], pa.int64()) for k in ("n_a", "n_b", "n_groups", "n_links")]
                columns = [batch.column(0).slice(i, j - i), pa.array(np.arange(row, row + j - i)), *counts, pa.array(groups, pa.string() if digest else pa.binary()).cast(pa.string()), made["pairs"], made["times"]]
                yield pa.RecordBatch.from_arrays(columns, ["key", "row", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"])
                row += j - i

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = f"key {dict(docs.dtypes)[key]}, row long, {_SHAPES}, groups string, pairs array<int>, times array<int>"
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)


def pair_counts(aligned: DataFrame, b_size: int) -> DataFrame:
    """(pair, docs, best): in how many documents each pair is linked, and whether no pair of its A id is in more."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("docs"))
    counts = stored(counts.withColumn("a", (F.col("pair") / b_size).cast("int")), "pair_counts")
    highest = counts.groupBy("a").agg(F.max("docs").alias("highest"))  # at most one row an id of A's vocabulary
    return counts.join(F.broadcast(highest), "a").select("pair", "docs", (F.col("docs") == F.col("highest")).alias("best"))


def weigh(aligned: DataFrame, b_size: int) -> DataFrame:
    """Adds n_best (links whose pair is its A id's most frequent one, ties included) and count_sum (documents that hold each link's
    pair, summed over links) to the stored result of :func:`align`."""
    counts = stored(pair_counts(aligned, b_size), "pair_weights")
    total = counts.agg(F.coalesce(F.sum("docs"), F.lit(0))).first()[0]
    links = aligned.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select("row", F.col("link.pairs").alias("pair"), F.col("link.times").alias("times"))
    met = lookup(links, counts, "pair", "docs", total, hot=COMMON, least=2)
    times = F.col("times").cast("long")
    sums = met.groupBy("row").agg(F.sum(F.when(F.col("best"), times).otherwise(0)).alias("n_best"), F.sum(times * F.col("docs")).alias("count_sum"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return aligned.join(sums, "row", "left").select(*aligned.columns, zero("n_best"), zero("count_sum"))
