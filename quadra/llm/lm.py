"""Language-model scores: attention predicts the class of the next word, corpus counts give the word inside its class, and
a memory of the corpus's phrases gives whole phrases.

Tokens are the words ``[^\\x20\\x09-\\x0D]+`` of a text in lower case (A-Z only), then one end. A text is a row of phrases (a
phrase ends with a sentence, after 32 words, or with the text). Each phrase is either recalled or spelled out word by word:

    p(phrase) = memory * c / N  +  (1 - memory) * product of p(class | words before) * p(word | class)

* The class of a word follows from its first subword (a cluster) and from how it ends. Subword ids are those of a public
  byte-level vocabulary; the ``rows`` most frequent of them have an embedding of their own, the others share ``shared`` more.
  Clusters come from the neighbours of words. Clusters and the attention model are learned in Spark from all words of all
  learnable documents: every position of a document is predicted once in each of ``epochs`` rounds; each task passes over its own
  windows and the parameters are averaged. Only parameters reach the driver.
* p(word | class) comes from the counts of all learnable documents: absolute discounting, (max(c - D, 0) + D / 2) / C.
  What is taken off is shared evenly by the seen words of the class and as many unseen ones; the base model has no spelling
  for unseen words either.
* c is how often the learnable documents hold the phrase, N is the number of their phrases, and ``memory`` is the share of
  these that occur more than once. A document that was learned from does not count its own phrases in c, so that only
  what other documents say is recalled.

Counts are one aggregation with map-side combine. The ``common`` most frequent words at most (a bound) are broadcast with
their counts; only the other words of a text are joined with the count table, by word, and its phrases by hash. The
base score is a unigram model with add-one smoothing over the same word counts.

Null texts are empty texts: one end. Null keys are never held out. Repeated rows are documents of their own, in counts and
in scores. Very long texts are scored whole, in windows, some thousand words at a time. Empty tables give no rows, and a
model without learnable documents knows no word. Columns besides the key and the text are not read and clash with nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadra.llm.attention import WINDOW, Attention
from quadra.llm.hot import lookup
from quadra.llm.pretokens import hold
from quadra.llm.subwords import Vocabulary, chosen, digests, distinct, endings, phrases, slices, split
from quadra.llm.text import small_batches
from quadra.session import stored

DISCOUNT, BYTES = 0.75, 750_000
#: An odd number that spreads small numbers over all bits of a long.
_SPREAD = np.int64(-7046029254386353131)


@dataclass(frozen=True)
class Settings:
    clusters: int = 12
    common: int = 250_000
    rows: int = 4096
    shared: int = 256
    epochs: int = 1


def held_out(key: str) -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string")) % 7 == 2, F.lit(False))


# ---------------------------------------------------------------- counts


def count(texts: DataFrame) -> DataFrame:
    """(word, phrase, c): words with a null phrase, phrase hashes with a null word, over all texts ``t``. Each task adds up
    what it reads together before anything is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("lm_count")
        for batch in batches:
            for a, b in slices(batch.column(0), BYTES):
                words, n = split(batch.column(0).slice(a, b - a))
                kinds, at = distinct(words)
                times = np.bincount(at, minlength=len(kinds))
                yield pa.record_batch([kinds, pa.nulls(len(kinds), pa.int64()), pa.array(times, pa.int64())], ["word", "phrase", "c"])
                _, hashes = phrases(digests(kinds)[at], endings(kinds)[1][at], n)
                h, c = np.unique(hashes, return_counts=True)
                yield pa.record_batch([pa.nulls(len(h), pa.string()), pa.array(h, pa.int64()), pa.array(c, pa.int64())], ["word", "phrase", "c"])

    return small_batches(texts).mapInArrow(run, "word string, phrase long, c long").groupBy("word", "phrase").agg(F.sum("c").alias("c"))


# ---------------------------------------------------------------- classes


_vocabularies: dict[str, Vocabulary] = {}


def _vocabulary(path: str) -> Vocabulary:
    if path not in _vocabularies:
        _vocabularies[path] = Vocabulary(path)
    return _vocabularies[path]


@dataclass
class Subwords:
    """Which embedding a subword has, and the class of a word."""

    tokenizer: str
    rows: np.ndarray  # by subword id
    n: int
    cluster: np.ndarray  # by embedding
    clusters: int

    @property
    def classes(self) -> int:
        return (self.clusters + 1) * 3 + 1

    @property
    def end(self) -> int:
        return self.classes - 1

    def pieces(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(embeddings of the subwords of all words joined, number of each word's)."""
        ids, n = _vocabulary(self.tokenizer).pieces(words)
        return self.rows[ids], n

    def classes_of(self, words: pa.Array, pieces: np.ndarray, n: np.ndarray) -> np.ndarray:
        return self.cluster[pieces[np.cumsum(n) - n]] * 3 + endings(words)[0] if len(n) else np.empty(0, np.int64)


def _summed(rows: DataFrame, run, width: int, size: int) -> np.ndarray:
    """size x width sums of what tasks give as (r, v); a bounded table, the only thing that reaches the driver."""
    parts = rows.mapInArrow(run, "r int, v array<double>")
    got = parts.groupBy("r").agg(F.array(*[F.sum(F.get("v", i)) for i in range(width)]).alias("v")).toArrow()
    out = np.zeros((size, width))
    if got.num_rows:
        out[got["r"].to_numpy()] = np.asarray(pc.list_flatten(got["v"]).to_numpy()).reshape(-1, width)
    return out


def _emit(table: np.ndarray, use: np.ndarray) -> pa.RecordBatch:
    width = table.shape[1]
    v = pa.ListArray.from_arrays(pa.array(np.arange(len(use) + 1) * width, pa.int32()), pa.array(table[use].ravel(), pa.float64()))
    return pa.record_batch([pa.array(use, pa.int32()), v], ["r", "v"])


def _windows(rows: np.ndarray, n: np.ndarray, classes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """All windows of texts of ``n`` words each: (the word that is the input at each position, the class to predict there). ``rows``:
    the words of all texts, by number; ``classes``: by number. A text of n words has n + 1 positions: the input of the first is its
    start, -1, the last predicts its ``end``. Each position is in one window; where a window has no more of them the input is -2 and the
    class -1."""
    count = n // WINDOW + 1
    owner = np.repeat(np.arange(len(n)), count)
    at = ((np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)) * WINDOW)[:, None] + np.arange(WINDOW)
    begin, size = (np.cumsum(n) - n)[owner][:, None], n[owner][:, None]
    padded = np.r_[rows, 0]
    word = lambda p: padded[np.clip(begin + p, 0, len(rows))]
    inputs = np.where(at > size, -2, np.where(at == 0, -1, word(at - 1)))
    told = np.r_[classes, 0][word(at)] if len(classes) else np.zeros(at.shape, np.int64)
    return inputs, np.where(at > size, -1, np.where(at == size, end, told))


DIMS = 128


def learn_subwords(texts: DataFrame, counts: DataFrame, tokenizer: str, settings: Settings) -> Subwords:
    """Embedding rows by the frequency of subwords, clusters of them by their neighbours (k-means on hashed counts)."""
    size, total = _vocabulary(tokenizer).size, settings.rows + settings.shared

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, seen = _vocabulary(tokenizer), np.zeros((size, 1))
        for batch in batches:
            ids, n = vocabulary.pieces(batch.column(0))
            seen[:, 0] += np.bincount(ids, np.repeat(batch.column(1).to_numpy(), n), minlength=size)
        yield _emit(seen, np.flatnonzero(seen[:, 0]))

    weight = _summed(counts.select("word", "c"), weigh, 1, size)[:, 0]
    rows = settings.rows + np.arange(size) % settings.shared
    top = np.lexsort((np.arange(size), -weight))[: settings.rows]
    rows[top] = np.arange(len(top))
    found = Subwords(tokenizer, rows.astype(np.int32), total, np.full(total, settings.clusters), settings.clusters)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hold("lm_near", _vocabularies)
        sums, half = np.zeros(total * (DIMS + 1)), DIMS // 2
        for batch in batches:
            for a, b in slices(batch.column(0), BYTES):
                words, n = split(batch.column(0).slice(a, b - a))
                kinds, at = distinct(words)
                pieces, size_ = found.pieces(kinds)
                f = pieces[np.cumsum(size_) - size_].astype(np.int64)[at]
                inner = np.ones(len(f), bool)
                inner[(np.cumsum(n) - n)[n > 0]] = False
                j = np.flatnonzero(inner)  # j - 1 and j are neighbours
                h = (f * 2654435761 % 4294967291) // 64 % half
                keys = [f * (DIMS + 1) + DIMS, f[j] * (DIMS + 1) + h[j - 1], f[j - 1] * (DIMS + 1) + half + h[j]]
                sums += np.bincount(np.concatenate(keys), minlength=len(sums))
        table = sums.reshape(total, DIMS + 1)
        yield _emit(table, np.flatnonzero(table[:, DIMS]))

    table = _summed(small_batches(texts), near, DIMS + 1, total)
    often = np.flatnonzero(table[:, DIMS] >= 3)
    feats = np.sqrt(table[often, :DIMS])
    feats /= np.linalg.norm(feats, axis=1, keepdims=True) + 1e-9
    k = min(settings.clusters, len(often))
    if k:
        centre = feats[np.argsort(-table[often, DIMS], kind="stable")[:: max(1, len(often) // (4 * k))][:k]]
        for _ in range(20):
            label = (feats @ centre.T).argmax(1)
            centre = np.array([feats[label == j].mean(0) if (label == j).any() else centre[j] for j in range(len(centre))])
            centre /= np.linalg.norm(centre, axis=1, keepdims=True) + 1e-9
        found.cluster[often] = label
    return found


def train_attention(texts: DataFrame, subwords_of: Subwords, settings: Settings, batch_of: int = 256) -> Attention:
    """Each round every task passes once over all windows of its own texts, from the parameters and Adagrad's state
    of the round before; then they are averaged. A subword's row counts by how often a task saw it, all else by windows."""
    attention = Attention(subwords_of.n, subwords_of.classes)
    state, d = attention.fresh(), attention.d
    rest = [n for n in attention.p if n != "e"]
    first = len(attention.p["e"])  # rows from here on hold the other parameters, d numbers a row

    def flat(p: dict) -> np.ndarray:
        z = np.concatenate([p[n].ravel() for n in rest])
        return np.concatenate([p["e"], np.r_[z, np.zeros(-len(z) % d, np.float32)].reshape(-1, d)])

    size = len(flat(attention.p))
    for _ in range(settings.epochs):
        shared = texts.sparkSession.sparkContext.broadcast((attention.p, state))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            hold("lm_train", _vocabularies)
            p, s = ({n: v.copy() for n, v in x.items()} for x in shared.value)
            mine = Attention(subwords_of.n, subwords_of.classes, p=p)
            seen, windows = np.zeros(first), 0
            for batch in batches:
                for a, b in slices(batch.column(0), BYTES):
                    words, n = split(batch.column(0).slice(a, b - a))
                    kinds, rows = distinct(words)
                    pieces, times = subwords_of.pieces(kinds)
                    at, y = _windows(rows, n, subwords_of.classes_of(kinds, pieces, times), subwords_of.end)
                    for lo in range(0, len(at), batch_of):
                        some = at[lo : lo + batch_of]
                        known = some >= 0
                        unique, back = np.unique(some[known], return_inverse=True)
                        own, size_ = chosen(pieces, times, unique)
                        some[known] = back
                        mine.train(some, y[lo : lo + batch_of], own, size_, s)
                        seen += np.bincount(own, minlength=first)
                        seen[-1] += (some == -1).sum()
                    windows += len(at)
            if windows:
                both = np.concatenate([flat(mine.p), flat(s)], axis=1).astype(float)
                w = np.r_[seen, np.full(len(both) - first, float(windows))]
                yield _emit(np.c_[both * w[:, None], w], np.flatnonzero(w))

        data = _summed(small_batches(texts), run, 2 * d + 1, size)
        now = np.concatenate([flat(attention.p), flat(state)], axis=1)
        at = np.flatnonzero(data[:, -1] > 0)
        now[at] = data[at, :-1] / data[at, -1:]
        for p, half in ((attention.p, now[:, :d]), (state, now[:, d:])):
            z, used = half[first:].ravel(), 0
            p["e"] = half[:first].astype(np.float32)
            for n in rest:
                p[n] = z[used : used + p[n].size].reshape(p[n].shape).astype(np.float32)
                used += p[n].size
    return attention


# ---------------------------------------------------------------- model


@dataclass
class Model:
    subwords_of: Subwords
    attention: Attention
    tokens: int  # all learned tokens, ends included
    kinds: int  # different learned tokens
    ends: int
    mass: np.ndarray  # counts by class
    common: pa.Table  # word, c
    phrases: int  # all learned phrases
    memory: float

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 1.0) / (self.tokens + self.kinds + 1.0))

    def inside(self, c: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """log10 p(word | class)."""
        return np.log10((np.maximum(c - DISCOUNT, 0) + DISCOUNT / 2) / self.mass[classes])


def _common(counts: DataFrame, most: int) -> pa.Table:
    """(word, c) of the words above the smallest count that leaves at most ``most`` of them."""
    rank = F.floor(F.log2("c") * 16)
    steps = counts.groupBy(rank.alias("k")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("least")).collect()  # some hundred rows
    have, least = 0, None
    for r in sorted(steps, key=lambda r: -r["k"]):
        have += r["n"]
        if have > most:
            break
        least = r["least"]
    some = counts.where(F.col("c") >= least) if least is not None else counts.where("false")
    return some.select("word", "c").toArrow()


def fit(docs: DataFrame, tokenizer: str, settings: Settings = Settings(), key: str = "doc_id", text: str = "text") -> tuple[Model, DataFrame]:
    """The model and the stored count table (word, phrase, c), from the rows that are not held out."""
    train = docs.where(~held_out(key))
    texts = train.select(F.coalesce(F.col(text), F.lit("")).alias("t"))
    table = stored(count(texts), "counts")
    counts = table.where("word is not null").select("word", "c")
    subwords_of = learn_subwords(texts, counts, tokenizer, settings)
    attention = train_attention(texts, subwords_of, settings)

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((subwords_of.classes, 2))
        for batch in batches:
            cs = subwords_of.classes_of(batch.column(0), *subwords_of.pieces(batch.column(0)))
            sums[:, 0] += np.bincount(cs, batch.column(1).to_numpy(), minlength=len(sums))
            sums[:, 1] += np.bincount(cs, minlength=len(sums))
        yield _emit(sums, np.flatnonzero(sums[:, 1]))

    mass, types = _summed(counts, classify, 2, subwords_of.classes).T
    again = F.sum(F.when(F.col("c") > 1, F.col("c")).otherwise(0))
    known, repeated = table.where("phrase is not null").agg(F.coalesce(F.sum("c"), F.lit(0)), F.coalesce(again, F.lit(0))).first()
    memory = min(0.9, max(0.001, repeated / known)) if known else 0.001
    ends = train.count()
    tokens, kinds = int(mass.sum()) + ends, int(types.sum()) + (ends > 0)
    mass = np.maximum(mass, 1.0)  # a class that was never seen has one unseen word
    common = _common(counts, settings.common)
    return Model(subwords_of, attention, tokens, kinds, ends, mass, common, known, memory), table


# ---------------------------------------------------------------- scores


class _Table:
    """What the model says of words: embedding, class, base, inside, hash, whether they end a sentence; ``known``: 1 if they
    are common, else -1, their count is not here and base and inside are 0."""

    def __init__(self, model: Model):
        self.m = model
        self.common = model.common["word"].combine_chunks()
        c = model.common["c"].to_numpy().astype(float)
        self.all = self.look(self.common)
        cls = self.all["cls"]
        self.all |= {"base": model.base(c), "inside": model.inside(c, cls), "known": np.ones(len(c), np.int8)}

    def look(self, words: pa.Array) -> dict[str, np.ndarray]:
        pieces, n = self.m.subwords_of.pieces(words)
        zero = np.zeros(len(words))
        return {
            "x": self.m.attention.embed(pieces, n), "cls": self.m.subwords_of.classes_of(words, pieces, n), "hash": digests(words), "stop": endings(words)[1],
            "base": zero, "inside": zero, "known": np.full(len(words), -1, np.int8),
        }

    def find(self, kinds: pa.Array) -> dict[str, np.ndarray]:
        at = pc.fill_null(pc.index_in(kinds, value_set=self.common), -1).to_numpy(zero_copy_only=False)
        rare = at < 0
        new = self.look(kinds.filter(pa.array(rare)))
        out = {}
        for name, values in self.all.items():
            out[name] = values[at] if len(values) else np.empty((len(at), *values.shape[1:]), values.dtype)
            out[name][rare] = new[name]
        return out


_tables: dict[str, _Table] = {}


def _table(name: str, model: Model) -> _Table:
    """The table of the current model; a worker keeps it from task to task, and drops that of another model."""
    if name not in _tables:
        _tables.clear()
        _tables[name] = _Table(model)
    return _tables[name]


_LISTS = {"hashes": pa.int64(), "own": pa.int32(), "spelled": pa.float64(), "words": pa.string(), "times": pa.int32(), "classes": pa.int32(), "at": pa.int32()}


def _partial_scores(docs: DataFrame, model: Model, key: str, text: str) -> DataFrame:
    """Per row: what needs no further count; its phrases (hash, how often the row has it, log10 of it spelled out) and the
    words whose count is not here (times, class, number of the phrase)."""
    from pyspark.sql.pandas.types import to_arrow_type

    shared, name = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    kinds = {"hashes": "array<long>", "own": "array<int>", "spelled": "array<double>", "words": "array<string>", "times": "array<int>", "classes": "array<int>", "at": "array<int>"}
    schema = f"uid long, `{key}` {dict(docs.dtypes)[key]}, held_out boolean, n_tokens long, n_known long, base double, score double, " + ", ".join(f"{k} {v}" for k, v in kinds.items())
    key_type = to_arrow_type(docs.schema[key].dataType)

    def lists(kind: str, values, ends: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.r_[0, ends], pa.int32()), values if isinstance(values, pa.Array) else pa.array(values, _LISTS[kind]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        hold("lm", _tables, _vocabularies)
        m = shared.value
        table, uid = _table(name, m), TaskContext.get().partitionId() << 36
        end_base, end_known = float(m.base(np.array([m.ends]))[0]), int(m.ends > 0)
        for batch in batches:
            for a, b in slices(batch.column(2), BYTES):
                words, n = split(batch.column(2).slice(a, b - a))
                kinds, at = distinct(words)
                w = table.find(kinds)
                texts, owner = len(n), np.repeat(np.arange(len(n)), n)
                begin, place = np.cumsum(n) - n, np.arange(len(at)) + owner  # of a word among positions: a text has one more, its end
                inputs, targets = np.empty((len(at) + texts, m.attention.d), np.float32), np.full(len(at) + texts, m.subwords_of.end)
                inputs[place + 1] = w["x"][at]
                inputs[begin + np.arange(texts)] = m.attention.p["e"][-1]
                targets[place] = w["cls"][at]
                per = m.attention.positions(inputs, n + 1, targets).astype(float)
                ends, spelled = per[begin + n + np.arange(texts)], per[place] + w["inside"][at]
                by_text = lambda v: np.bincount(owner, v, minlength=texts)
                starts, hashes = phrases(w["hash"][at], w["stop"][at], n)
                sums = np.add.reduceat(spelled, starts) if len(starts) else np.empty(0)
                whose = owner[starts]
                _, back, own = np.unique(hashes ^ (whose * _SPREAD), return_inverse=True, return_counts=True)  # by text and phrase
                # rare words once for each phrase that holds them
                number = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(at)]))
                known = w["known"][at]
                rare = known < 0
                keys, times = np.unique(number[rare] * len(kinds) + at[rare], return_counts=True)
                phrase, word = np.divmod(keys, max(len(kinds), 1))
                n_phrases, n_rare = np.bincount(whose, minlength=texts), np.bincount(whose[phrase], minlength=texts)
                stop, stop_rare = np.cumsum(n_phrases), np.cumsum(n_rare)
                yield pa.record_batch(
                    [
                        pa.array(uid + np.arange(texts)), batch.column(0).slice(a, texts).cast(key_type), batch.column(1).slice(a, texts),
                        pa.array(n + 1, pa.int64()), pa.array((by_text(known > 0) + end_known).astype(np.int64)), pa.array(by_text(w["base"][at]) + end_base), pa.array(by_text(spelled) + ends),
                        lists("hashes", hashes, stop), lists("own", own[back.ravel()], stop), lists("spelled", sums, stop),
                        lists("words", kinds.take(pa.array(word, pa.int64())), stop_rare), lists("times", times, stop_rare), lists("classes", w["cls"][word], stop_rare), lists("at", phrase - (stop - n_phrases)[whose[phrase]], stop_rare),
                    ],
                    ["uid", key, "held_out", "n_tokens", "n_known", "base", "score", *_LISTS],
                )
                uid += texts

    return small_batches(docs).select(key, held_out(key).alias("held_out"), text).mapInArrow(run, schema)


def score(docs: DataFrame, model: Model, table: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: key, held_out, n_tokens, n_known, train_tokens, base_score, score (log10), n_recalled (phrases
    that other learnable documents hold)."""
    made = stored(_partial_scores(docs, model, key, text), "partial")
    mine = made.select("uid", "held_out", F.posexplode(F.arrays_zip("hashes", "own", "spelled")).alias("at", "p")).select(
        "uid", "at", F.col("p.hashes").alias("phrase"), F.when(F.col("held_out"), 0).otherwise(F.col("p.own")).alias("own"), F.col("p.spelled").alias("spelled")
    )
    learned = table.where("phrase is not null").select("phrase", F.col("c").alias("seen"))
    recalled = lookup(mine, learned, "phrase", "seen", model.phrases).where("seen > own")
    recalled = recalled.select("uid", "at", "spelled", (F.col("seen") - F.col("own")).alias("others"), *[F.lit(None).cast(t).alias(c) for c, t in (("n", "int"), ("k", "int"), ("c", "double"))])
    rare = made.select("uid", F.explode(F.arrays_zip("words", "times", "classes", "at")).alias("r")).select(
        "uid", F.col("r.at").alias("at"), F.col("r.words").alias("word"), F.col("r.times").alias("n"), F.col("r.classes").alias("k")
    )
    counted = rare.join(table.where("word is not null").select("word", "c"), "word", "left").select(
        "uid", "at", F.lit(None).cast("double").alias("spelled"), F.lit(None).cast("long").alias("others"), "n", "k", F.coalesce("c", F.lit(0)).cast("double").alias("c")
    )
    mass = F.get(F.array(*[F.lit(float(v)) for v in model.mass]), F.col("k"))
    p = (F.greatest(F.col("c") - DISCOUNT, F.lit(0.0)) + DISCOUNT / 2) / mass
    by_phrase = recalled.unionByName(counted).repartition("uid").groupBy("uid", "at").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n"))).alias("known"),
        F.sum(F.col("n") * F.log10((F.col("c") + 1) / F.lit(model.tokens + model.kinds + 1.0))).alias("b"),
        F.sum(F.col("n") * F.log10(p)).alias("m"), F.max("spelled").alias("spelled"), F.max("others").alias("others"),
    )
    zero = lambda c: F.coalesce(c, F.lit(0))
    # spelled out: with the words that were counted just now
    alone = F.lit(float(np.log10(1 - model.memory))) + F.col("spelled") + zero("m")
    whole = F.log10(F.col("others") * (model.memory / max(model.phrases, 1)))
    gain = F.greatest(alone, whole) + F.log10(1 + F.pow(F.lit(10.0), -F.abs(alone - whole))) - alone
    sums = by_phrase.groupBy("uid").agg(
        F.sum("known").alias("known"), F.sum("b").alias("b"), F.sum(zero("m") + F.when(F.col("others") > 0, gain).otherwise(0.0)).alias("m"), F.count("others").alias("n_recalled")
    )
    spelled = F.col("score") + F.size("hashes") * float(np.log10(1 - model.memory))
    return made.withColumn("score", spelled).drop(*_LISTS).join(sums, "uid", "left").select(
        key, "held_out", "n_tokens", (F.col("n_known") + zero("known")).cast("long").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), (F.col("base") + zero("b")).alias("base_score"), (F.col("score") + zero("m")).alias("score"),
        zero("n_recalled").cast("long").alias("n_recalled"),
    )
