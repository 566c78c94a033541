"""Toxicity by nearest labelled examples: exact TF-IDF cosine with a block-max inverted index.

Fitting takes a bounded sample of the labelled rows (``per_class`` of each label, the first by a hash of the key);
the bound is a parameter, so that what is broadcast is bounded too. Terms are lower-case words and word beginnings. Every
term of the sample that speaks for label 1 (in ``least_toxic`` examples of it, z-score of the two proportions at least
``least_z``) has posting lists of its own, however many there are; all other words of a text count as one more term, so
that a stray term in a long text weighs little.

The index keeps the examples in blocks of BLOCK; a term's posting list names the examples that hold it, block by block, with
the largest weight of each block. A query's upper bound for a block is the sum over its terms of these maxima; blocks are
opened from the best bound on, until the next bound is below the k-th best cosine found. The result is the exact list
of the k nearest; all examples that tie for the k-th place share the votes left for it, so that no key decides.

Votes are weighted by cosine and by how many labelled rows an example stands for, and calibrated by a logistic curve
fitted to leave-one-out votes of the examples. The nearest examples are the evidence. A labelled row of the sample that is
scored finds itself among its neighbours, and votes: to leave it out, its key would have to be looked at, and keys are no input of a score.

Null texts are empty texts. Texts without a term of the index, empty ones too, are all alike and have one score. Null keys
are never learned from. Repeated rows are scored alike, and count once as examples. Very long texts are read whole. Without
labels all scores are below 0.5; empty tables give no rows. Added columns are named by the caller, so that no column of the
input is replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quadra.llm.pretokens import hold
from quadra.llm.text import pieces, small_batches
from quadra.session import stored

BLOCK = 64
PREFIXES = (4, 5, 6)
CACHE = 300_000


@dataclass(frozen=True)
class Settings:
    per_class: int = 4000
    least_toxic: int = 4
    least_z: float = 4.0
    k: int = 15
    rest_weight: float = 1.0


def learnable(key: str = "doc_id"):
    """Rows whose labels may be learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 5 != 0, F.lit(False))


# ---------------------------------------------------------------- terms


def _terms_column(text):
    """Distinct terms of a text, for the statistics of the sample."""
    ws = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}]+"), lambda w: w != "")
    start = lambda n: F.transform(F.filter(ws, lambda w: F.char_length(w) > n), lambda w: F.concat(F.lit("^"), F.substring(w, 1, n)))
    return F.array_distinct(F.concat(ws, *map(start, PREFIXES)))


class Terms:
    """Term counts of texts over a fixed vocabulary; words are looked at once and remembered."""

    def __init__(self, vocabulary: list[str]):
        import regex

        self.index = {t: i for i, t in enumerate(vocabulary)}
        self.find = regex.compile(r"\p{L}+").findall
        self.runs: dict[str, int] = {"": 0}
        self.hits: dict[str, tuple[int, ...]] = {}

    def _learn(self, piece: str) -> int:
        found, own = self.find(piece.lower()), []
        for w in found:
            for t in (w, *("^" + w[:n] for n in PREFIXES if len(w) > n)):
                if t in self.index:
                    own.append(self.index[t])
        if own:
            self.hits[piece] = tuple(own)
        self.runs[piece] = len(found)
        return len(found)

    def count(self, text: str | None) -> tuple[tuple[tuple[int, int], ...], int]:
        """((term, times), ...) in order, and the number of words."""
        ps = pieces(text)
        try:
            n = sum(map(self.runs.__getitem__, ps))
        except KeyError:
            if len(self.runs) > CACHE:
                self.runs, self.hits = {"": 0}, {}
            n = sum(self.runs[p] if p in self.runs else self._learn(p) for p in ps)
        tf: dict[int, int] = {}
        hits = self.hits
        for p in filter(hits.__contains__, ps):
            for t in hits[p]:
                tf[t] = tf.get(t, 0) + 1
        return tuple(sorted(tf.items())), n


# ---------------------------------------------------------------- index


class BlockMaxIndex:
    """Exact nearest neighbours by cosine among sparse unit vectors (terms, weights); the last term is in all of them."""

    #: Blocks that are opened first; their k-th best cosine tells which others can be left closed.
    FIRST = 4

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], terms: int, k: int):
        n, self.k = len(vectors), k
        # similar examples share blocks, so that bounds are tight: ordered by their strongest term besides the last
        strongest = np.array([t[w[:-1].argmax()] if len(t) > 1 else -1 for t, w in vectors], int)
        self.order = np.lexsort((np.arange(n), strongest))
        place = np.empty(n, np.int64)
        place[self.order] = np.arange(n)
        size = [len(t) for t, _ in vectors]
        term = np.concatenate([t for t, _ in vectors]) if n else np.empty(0, np.int64)
        weight = np.concatenate([w for _, w in vectors]) if n else np.empty(0)
        example = np.repeat(place, size)
        by = np.lexsort((example, term))
        term, self.example, self.weight = term[by], example[by], weight[by]
        # one list for each term and block that holds it
        block = self.example // BLOCK
        first = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (block[1:] != block[:-1])]) if n else np.empty(0, np.int64)
        self.begin = np.r_[first, len(term)]
        self.block, self.maxima = block[first], np.maximum.reduceat(self.weight, first) if n else weight
        self.lists = np.searchsorted(term[first], np.arange(terms + 1))
        self.n, self.blocks, self.opened = n, -(-n // BLOCK), 0

    def _lists(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(posting lists of all the terms, one a block; number of each term's)."""
        a = self.lists[terms]
        n = self.lists[terms + 1] - a
        return np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum()), n

    def _cosines(self, blocks: np.ndarray, lists: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(examples of the blocks, their cosines) by posting lists and the query's weight for each."""
        self.opened += len(blocks)
        wanted = np.zeros(self.blocks, bool)
        wanted[blocks] = True
        use = wanted[self.block[lists]]
        lo = self.begin[lists[use]]
        size = self.begin[lists[use] + 1] - lo
        at = np.repeat(lo - np.cumsum(size) + size, size) + np.arange(size.sum())
        cos = np.bincount(self.example[at], self.weight[at] * np.repeat(x[use], size), minlength=self.n)
        rows = (np.sort(blocks)[:, None] * BLOCK + np.arange(BLOCK)).ravel()
        rows = rows[rows < self.n]
        return self.order[rows], np.round(cos[rows], 9)

    def nearest(self, terms: np.ndarray, q: np.ndarray, skip: int = -1) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(example numbers, cosines, shares) for a sparse query, best first; ``skip`` is left out. All examples with the k-th
        best cosine come in, and share the votes that are left: k less the number of better ones. Shares sum to k."""
        lists, n = self._lists(terms)
        x = np.repeat(q, n)
        bounds = np.bincount(self.block[lists], self.maxima[lists] * x, minlength=self.blocks)
        best = np.argpartition(-bounds, self.FIRST)[: self.FIRST] if len(bounds) > self.FIRST else np.arange(len(bounds))
        ids, cos = self._cosines(best, lists, x)
        known = cos[ids != skip]
        kth = np.partition(known, len(known) - self.k)[len(known) - self.k] if len(known) >= self.k else -1.0
        more = bounds >= kth - 1e-8
        more[best] = False
        if more.any():
            more_ids, more_cos = self._cosines(np.flatnonzero(more), lists, x)
            ids, cos = np.r_[ids, more_ids], np.r_[cos, more_cos]
        keep = (cos >= kth) & (ids != skip)
        ids, cos = ids[keep], cos[keep]
        if len(cos) > self.k:
            last = np.partition(cos, len(cos) - self.k)[len(cos) - self.k]
            ids, cos = ids[cos >= last], cos[cos >= last]
        first = np.lexsort((ids, -cos))
        ids, cos = ids[first], cos[first]
        share = np.ones(len(cos))
        if len(cos) > self.k:
            tied = cos == cos[-1]
            share[tied] = (self.k - np.count_nonzero(~tied)) / np.count_nonzero(tied)
        return ids, cos, share


@dataclass
class Model:
    """All that scoring needs; bounded by Settings."""

    settings: Settings
    vocabulary: list[str]
    idf: np.ndarray
    keys: np.ndarray
    labels: np.ndarray
    weights: np.ndarray
    counts: list
    slope: float = 1.0
    shift: float = 0.0

    def vector(self, tf, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(terms, weights) of a text by its counts; the last term stands for all words."""
        terms = np.array([*(t for t, _ in tf), len(self.vocabulary)], np.int64)
        w = np.array([*((1 + math.log(times)) * self.idf[t] for t, times in tf), self.settings.rest_weight * (1 + math.log1p(n))])
        return terms, w / np.linalg.norm(w)

    def index(self) -> BlockMaxIndex:
        return BlockMaxIndex([self.vector(tf, n) for tf, n in self.counts], len(self.vocabulary) + 1, self.settings.k)

    def vote(self, ids: np.ndarray, cos: np.ndarray, share: np.ndarray) -> float:
        w = cos * self.weights[ids] * share
        return float((w * self.labels[ids]).sum() / w.sum()) if w.sum() > 0 else 0.0

    def calibrated(self, vote: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * vote + self.shift))))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Fit from labelled rows that :func:`learnable` lets in. Null labels do not count; of several labels of a key the
    largest does. With no label of one kind the model has nothing to vote for and scores by the labels it has."""
    marks = labels.where(learnable(key) & F.col(label).isin(0, 1)).groupBy(key).agg(F.max(label).cast("int").alias("y"))
    totals = {r["y"]: r["n"] for r in marks.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    sample = [r for y in (0, 1) for r in marks.where(F.col("y") == y).orderBy(F.xxhash64(key), key).limit(settings.per_class).collect()]
    spark = docs.sparkSession
    chosen = spark.createDataFrame([tuple(r) for r in sample], f"__k {dict(labels.dtypes)[key]}, y int")  # at most 2 x per_class rows
    joined = docs.join(F.broadcast(chosen), docs[key] == chosen["__k"]).groupBy("__k", "y").agg(F.min(F.coalesce(F.col(text), F.lit(""))).alias("t"))
    seen = joined.select("__k", "y", "t", _terms_column(F.col("t")).alias("terms"))
    seen = stored(seen, "examples")
    size = {r["y"]: r["n"] for r in seen.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    stats = seen.select("y", F.explode("terms").alias("term")).groupBy("term").agg(F.sum("y").cast("double").alias("a"), F.sum(1 - F.col("y")).cast("double").alias("b"))
    p = (F.col("a") + F.col("b")) / max(n1 + n0, 1)
    z = (F.col("a") / max(n1, 1) - F.col("b") / max(n0, 1)) / F.sqrt(p * (1 - p) * (1 / max(n1, 1) + 1 / max(n0, 1)) + 1e-12)
    top = stats.withColumn("z", z).where((F.col("a") >= settings.least_toxic) & (F.col("z") >= settings.least_z))
    top = top.orderBy(F.desc("z"), "term").collect()  # terms of the sample, which Settings bounds
    vocabulary = [r["term"] for r in top]
    df = np.array([r["a"] + r["b"] for r in top])
    idf = np.log((1 + n1 + n0) / (1 + df)) + 1 if len(top) else np.empty(0)

    def counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        terms = Terms(vocabulary)
        for batch in batches:
            found = [terms.count(t) for t in batch["t"]]
            yield pd.DataFrame({"k": batch["__k"], "y": batch["y"], "ts": [[t for t, _ in tf] for tf, _ in found], "fs": [[f for _, f in tf] for tf, _ in found], "n": [n for _, n in found]})

    rows = seen.mapInPandas(counts, f"k {dict(labels.dtypes)[key]}, y int, ts array<int>, fs array<int>, n long").orderBy("ts", "fs", "n", "y", "k").collect()  # by content, so that keys change no sum
    weight = {y: totals.get(y, 0) / max(size.get(y, 0), 1) for y in (0, 1)}
    model = Model(
        settings, vocabulary, idf, np.array([r["k"] for r in rows]), np.array([r["y"] for r in rows], float),
        np.array([weight[r["y"]] for r in rows]), [(tuple(zip(r["ts"], r["fs"])), r["n"]) for r in rows],
    )
    _calibrate(model)
    return model


def _calibrate(model: Model) -> None:
    """Logistic curve through the leave-one-out votes, by Newton steps with a small ridge."""
    if not len(model.labels) or len(set(model.labels)) < 2:
        model.slope, model.shift = 20.0, -10.0
        return
    index, known = model.index(), {}
    votes = np.empty(len(model.labels))
    for i, (tf, n) in enumerate(model.counts):
        # examples without any term share one query; leaving out one of their many equal neighbours changes nothing
        shared = (tf, n) if tf else ()
        if tf or shared not in known:
            known[shared] = model.vote(*index.nearest(*model.vector(tf, n), i if tf else -1))
        votes[i] = known[shared]
    x = np.c_[votes, np.ones(len(votes))]
    beta = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (model.weights * (model.labels - p)) - 1e-2 * beta
        hess = (x * (model.weights * p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        beta = beta + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    if beta[0] > 0:
        model.slope, model.shift = float(beta[0]), float(beta[1])
    else:
        model.slope, model.shift = 20.0, -10.0


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", columns: list[str] | None = None, into: tuple[str, str] = ("score", "evidence")) -> DataFrame:
    """(key, [columns], score, evidence), the last two named by ``into``: every row is scored where it is read; the broadcast
    model is bounded. evidence: the three nearest examples as (key, cosine, label). Null texts are empty texts; key and
    columns only pass through. Labelled rows of the sample are scored with themselves among the examples."""
    columns = [key] if columns is None else columns
    if set(into) & set(columns):
        raise ValueError(f"columns have the names of added ones: {sorted(set(into) & set(columns))}")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    types = dict(docs.dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in columns] + [f"`{into[0]}` double", f"`{into[1]}` array<struct<key:{types[key]},cosine:double,label:int>>"])

    asked = list(dict.fromkeys([*columns, text]))
    near_type = pa.list_(pa.struct([("key", to_arrow_type(docs.schema[key].dataType)), ("cosine", pa.float64()), ("label", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("toxicity")
        m = shared.value
        index, terms, known = m.index(), Terms(m.vocabulary), {}
        for batch in (whole.slice(a, 500) for whole in batches for a in range(0, whole.num_rows, 500)):
            scores, evidence = [], []
            for t in batch.column(asked.index(text)).to_pylist():
                tf, n = terms.count(t)
                query = (tf, n) if tf else ()  # texts without a term are all alike
                if query not in known:
                    if len(known) > 5_000:
                        known.clear()
                    ids, cos, share = index.nearest(*m.vector(tf, n))
                    near = [{"key": m.keys[i].item(), "cosine": float(c), "label": int(m.labels[i])} for i, c in zip(ids[:3], cos[:3], strict=True)]
                    known[query] = m.calibrated(m.vote(ids, cos, share)), near
                s, near = known[query]
                scores.append(s)
                evidence.append(near)
            made = [pa.array(scores, pa.float64()), pa.array(evidence, near_type)]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(columns))] + made, names=[*columns, *into])

    return small_batches(docs).select(*asked).mapInArrow(run, schema)
