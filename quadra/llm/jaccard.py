"""N-gram Jaccard self-join by MinHash banding, with exact verification on full n-gram sets.

1. Equal texts are one node (128 bits of SHA-256), with the number of its documents.
2. Each text gives BANDS x ROWS MinHash values of its word n-grams; a band's values make one hash. With 30 bands of 5
   rows a pair at similarity 0.8 shares a band but for a chance of (1 - 0.8^5)^30 = 7e-6, and one above it less.
3. Nodes that share a band hash meet in a bucket. Which of them are alike is told by all BANDS x ROWS values (8 bits of
   each); a bucket gives a spanning forest of its pairs with at least ``screen`` agreement, no pair list. True pairs
   fall below the screen with a chance of about 1e-9. Pairs that only share a passage do not pass, so that common
   passages do not tie the corpus together.
4. Components of these edges are families. The full n-gram sets of a family's texts are brought together and every
   pair of them is verified exactly, block by block; what leaves is a count for each node and a spanning forest of the
   links, again no pair list.
5. Components of the verified links are the classes.

Large buckets and families are dealt out in parts of about BLOCK nodes, one group for each pair of parts; families also by
n-grams, so that a part holds about GRAMS of them. Nodes, roots and band hashes with very many rows are looked up by
:mod:`quadra.llm.hot`. Sets hold 64-bit hashes of n-grams; two different n-grams of a pair share one with a chance of
2^-64.

A text of fewer than ``n`` words is one n-gram of all its words. Texts without words (also null) have no n-grams, no
links, and each is a class of its own. Very long texts are read whole. Empty tables give no rows; columns besides key and
text are not read and clash with nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadra.llm.components import connected
from quadra.llm.hot import lookup
from quadra.llm.pretokens import hold
from quadra.llm.text import pieces, small_batches
from quadra.session import cut, stored

BANDS, ROWS, BLOCK, GRAMS = 30, 5, 1024, 2_000_000
CACHE = 200_000
_words: dict[str, int] = {}


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_STEP = _mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)
_A = _mix(np.arange(1000, 1000 + BANDS * ROWS, dtype=np.uint64)) | np.uint64(1)
_B = _mix(np.arange(5000, 5000 + BANDS * ROWS, dtype=np.uint64))


def ngrams(text: str | None, n: int) -> np.ndarray:
    """64-bit hashes of the word n-grams, in order, with repeats; n is at most 64."""
    import xxhash

    words = [w for w in pieces(text) if w]
    if not words:
        return np.empty(0, np.uint64)
    if len(_words) > CACHE:
        _words.clear()
    get = _words.get
    ids = [get(w) for w in words]
    if None in ids:
        for k, v in enumerate(ids):
            if v is None:
                ids[k] = _words[words[k]] = xxhash.xxh64_intdigest(words[k].encode())
    h = np.array(ids, dtype=np.uint64)
    k = min(n, len(h))
    out = np.zeros(len(h) - k + 1, np.uint64)
    for j in range(k):
        out += h[j : j + len(out)] * _STEP[j]
    return _mix(out + np.uint64(k))


def minhash(grams: np.ndarray) -> np.ndarray:
    """BANDS x ROWS smallest values of multiply-shift hashes, as 32-bit integers."""
    best = np.full(BANDS * ROWS, 0xFFFFFFFF, np.uint64)
    for a in range(0, len(grams), 1024):
        v = _A[:, None] * grams[None, a : a + 1024]
        v += _B[:, None]
        np.minimum(best, v.min(axis=1) >> np.uint64(32), out=best)
    return best.astype(np.uint32)


def band_hashes(values: np.ndarray) -> np.ndarray:
    v = values.reshape(BANDS, ROWS).astype(np.uint64)
    h = np.arange(BANDS, dtype=np.uint64) * _STEP[ROWS]
    for r in range(ROWS):
        h = h + v[:, r] * _STEP[r]
        h = h ^ (h >> np.uint64(29))
    return _mix(h).view(np.int64)


def text_node(text):
    """What stands for a text: half of its SHA-256."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def _signatures(docs: DataFrame, n: int) -> DataFrame:
    """(node, bands array<bigint>, sig binary): one row per different text with n-grams."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hold("jaccard", _words)
        for batch in batches:
            batch = batch.drop_duplicates("node")
            nodes, bands, sigs = [], [], []
            for node, text in zip(batch["node"], batch["__t"], strict=True):
                grams = ngrams(text, n)
                if len(grams):
                    values = minhash(grams)
                    nodes.append(node)
                    bands.append(band_hashes(values))
                    sigs.append(values.astype(np.uint8).tobytes())
            if nodes:
                yield pd.DataFrame({"node": nodes, "bands": bands, "sig": sigs})

    made = small_batches(docs).select("node", "__t").mapInPandas(run, "node binary, bands array<bigint>, sig binary")
    return made.dropDuplicates(["node"])


def _parts(rows: DataFrame, key: list[str], parts) -> DataFrame:
    """Deals groups out in ``parts`` parts: adds i <= j, and for rows in several pairs of parts a row for each; ``part`` is
    the row's own part."""
    k = F.greatest(F.ceil(parts), F.lit(1)).cast("int")
    rows = rows.withColumn("__k", k).withColumn("part", F.pmod(F.xxhash64("node"), F.col("__k")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("__k") - 1), lambda o: F.struct(F.least(o, F.col("part")).alias("i"), F.greatest(o, F.col("part")).alias("j")))
    return rows.withColumn("__p", F.explode(pairs)).withColumns({"i": F.col("__p.i"), "j": F.col("__p.j")}).drop("__p", "__k")


def _runs(batches: Iterator[pd.DataFrame], key: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of a partition that is sorted by key, each once and whole."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if not len(batch):
            continue
        change = (batch[key] != batch[key].shift()).any(axis=1).to_numpy()
        if held and tuple(held[-1][key].iloc[-1]) == tuple(batch[key].iloc[0]):
            change[0] = False
        cuts = [*np.flatnonzero(change), len(batch)]
        if cuts[0] > 0:
            held.append(batch.iloc[: cuts[0]])
        for a, b in zip(cuts, cuts[1:]):
            if held:
                yield pd.concat(held) if len(held) > 1 else held[0]
            held = [batch.iloc[a:b]]
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def _forest(alike) -> list[tuple[int, int]]:
    """Spanning forest over 0..m-1; ``alike(i, others)`` tells which of others are alike to i. Pairs inside one tree are
    not asked for again, and one tree of all ends it."""
    m = alike.size
    label = np.arange(m)
    trees, edges = m, []
    for i in range(m):
        if trees == 1:
            break
        others = np.flatnonzero(label != label[i])
        for j in others[alike(i, others)]:
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                edges.append((i, int(j)))
                trees -= 1
    return edges


class _Screen:
    def __init__(self, sigs, least: float):
        self.sigs = np.frombuffer(b"".join(sigs), np.uint8).reshape(len(sigs), -1)
        self.size, self.least = len(sigs), least

    def __call__(self, i, others):
        return (self.sigs[others] == self.sigs[i]).mean(axis=1) >= self.least


def candidate_edges(signatures: DataFrame, screen: float) -> DataFrame:
    """Distinct (a, b): a spanning forest of the screened pairs of each bucket."""
    bands = signatures.select("node", F.posexplode("bands").alias("band", "hash"))
    counts = bands.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = lookup(bands, counts, ["band", "hash"], "n", BANDS * signatures.count())
    rows = _parts(members.join(signatures.select("node", "sig"), "node"), ["band", "hash"], F.col("n") / BLOCK)
    key = ["band", "hash", "i", "j"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a, b, seen = [], [], set()
        for group in _runs(batches, key):
            nodes, sigs = group["node"].tolist(), group["sig"].tolist()
            for i, j in _forest(_Screen(sigs, screen)):
                edge = (nodes[i], nodes[j])
                if edge not in seen:
                    seen.add(edge)
                    a.append(edge[0])
                    b.append(edge[1])
            if len(seen) > 200_000:
                seen.clear()
            if len(a) > 20_000:
                yield pd.DataFrame({"a": a, "b": b})
                a, b = [], []
        if a:
            yield pd.DataFrame({"a": a, "b": b})

    dealt = rows.repartition(*key).sortWithinPartitions(*key, "node").select(*key, "node", "sig")
    return dealt.mapInPandas(run, "a binary, b binary").distinct()


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by products of 0/1 matrices over the n-grams that occur more than once."""
    m = len(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    tokens = np.concatenate(sets)
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    first = np.r_[True, tokens[1:] != tokens[:-1]]
    column = np.cumsum(first) - 1
    common = np.bincount(column)[column] > 1
    owner, column = owner[common], column[common]
    out = np.zeros((m, m), np.float32)
    if len(column):
        column = np.cumsum(np.r_[True, column[1:] != column[:-1]]) - 1
        width = max(64, min(4096, (1 << 23) // m))
        for a in range(0, int(column[-1]) + 1, width):
            lo, hi = np.searchsorted(column, [a, a + width])
            block = np.zeros((m, width), np.float32)
            block[owner[lo:hi], column[lo:hi] - a] = 1
            out += block @ block.T
    return out


def verified(texts: DataFrame, n: int, threshold: float) -> DataFrame:
    """texts (family, members, node, weight, __t) -> (node, root, links): for each family block the node's number of
    linked documents and its smallest linked-together node."""
    ratio = Fraction(threshold).limit_denominator(10_000)
    top, bottom = ratio.numerator, ratio.denominator

    def grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sets = [np.unique(ngrams(t, n)) for t in batch["__t"]]
            yield batch.drop(columns="__t").assign(size=[len(g) for g in sets], grams=[g.tobytes() for g in sets])

    made = stored(texts.mapInPandas(grams, "family binary, members long, node binary, weight long, size long, grams binary"), "grams")
    total = made.groupBy("family").agg(F.sum("size").alias("all"), F.first("members").alias("members"))
    rows = lookup(made.drop("members"), total, "family", "members", made.count())
    rows = _parts(rows, ["family"], F.greatest(F.col("members") / BLOCK, F.col("all") / GRAMS))
    key = ["family", "i", "j"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in _runs(batches, key):
            sets = [np.frombuffer(g, np.uint64) for g in group["grams"]]
            size = np.array([len(s) for s in sets], np.int64)
            inter = _overlaps(sets).astype(np.int64)
            linked = bottom * inter >= top * (size[:, None] + size[None, :] - inter)
            part, nodes = group["part"].to_numpy(), group["node"].tolist()
            across = group["i"].iloc[0] != group["j"].iloc[0]
            if across:
                linked &= part[:, None] != part[None, :]
            np.fill_diagonal(linked, False)
            links = linked.astype(np.int64) @ group["weight"].to_numpy()
            label = np.arange(len(nodes))
            order = np.argsort(np.array(nodes, dtype=object), kind="stable")
            rank = np.empty(len(nodes), np.int64)
            rank[order] = label
            root = rank.copy()
            while True:
                new = np.where(linked, root[None, :], len(nodes)).min(axis=1, initial=len(nodes))
                new = np.minimum(root, new)
                new = np.minimum(new, new[order[new]])
                if (new == root).all():
                    break
                root = new
            yield pd.DataFrame({"node": nodes, "root": [nodes[order[r]] for r in root], "links": links})

    dealt = rows.repartition(*key).sortWithinPartitions(*key, "node").select(*key, "part", "node", "weight", "grams")
    return dealt.mapInPandas(run, "node binary, root binary, links long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", n: int = 5, threshold: float = 0.8, screen: float = 0.6, leads: bool = False) -> DataFrame:
    """One row per document: key, class_id (the smallest key of its class), n_links (other documents at similarity
    ``threshold`` or more, equal texts included) and n_copies (other documents with the same text).

    A class is a component of the links. Null keys keep their row; a class of null keys only has a null class_id.
    Repeated rows count as documents of their own. With ``leads`` also ``node``, what stands for the row's text, and ``leads``:
    whether the row has the key and text that its class is known by, which are those of the smallest key, or where all keys are
    null the smallest node."""
    rows = docs.select(F.col(key).alias("__id"), F.coalesce(F.col(text), F.lit("")).alias("__t")).withColumn("node", text_node(F.col("__t")))
    blank = ~F.col("__t").rlike("[^ \\t-\\r]")
    nodes = stored(rows.groupBy("node").agg(F.min("__id").alias("rep"), F.count(F.lit(1)).alias("weight"), F.min(blank).alias("blank")), "nodes")
    signatures = stored(_signatures(rows, n), "signatures")
    families = connected(candidate_edges(signatures, screen))
    members = families.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    families = lookup(families, members, "root", "members", families.count()).select("node", F.col("root").alias("family"), "members")
    # one text for each node of a family, that of its smallest key: by node and key, since one text may have very many rows
    wanted = families.join(nodes.select("node", "weight", "rep"), "node").withColumnsRenamed({"node": "__node", "rep": "__rep"})
    texts = rows.join(wanted, (F.col("node") == F.col("__node")) & F.col("__id").eqNullSafe(F.col("__rep"))).dropDuplicates(["node"])
    checked = stored(verified(texts.select("family", "members", "node", "weight", "__t"), n, threshold), "links")
    classes = connected(checked.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = checked.groupBy("node").agg(F.sum("links").alias("links"))
    known = nodes.join(links, "node", "left").join(classes, "node", "left").select("node", "rep", "weight", "blank", "links", F.coalesce("root", "node").alias("root"))
    known = cut(known)
    first = [F.min(F.struct(F.col("rep").isNull(), "rep", "node"))["node"].alias("first")] if leads else []
    tops = known.groupBy("root").agg(F.min("rep").alias("class_id"), F.count(F.lit(1)).alias("n"), *first)
    known = cut(lookup(known, cut(tops), "root", "n", known.count()))
    out = lookup(rows.select("__id", "node"), known.drop("n"), "node", "weight", docs.count())
    copies = F.when(F.col("blank"), F.lit(0)).otherwise(F.col("weight") - 1)
    return out.select(
        F.col("__id").alias(key),
        F.when(F.col("blank"), F.col("__id")).otherwise(F.col("class_id")).alias("class_id"),
        (copies + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
        copies.cast("long").alias("n_copies"),
        *([F.col("node"), (F.col("blank") | ((F.col("node") == F.col("first")) & F.col("__id").eqNullSafe(F.col("class_id")))).alias("leads")] if leads else []),
    )
