"""Document fingerprints: a homomorphic multiset hash of paragraphs.

DataFrame functions only. A fingerprint is a vector of lanes, each a sum modulo a power of two:

* EXACT lanes of 32 bits sum the paragraphs' SHA-512, cut into words (the first 256 bits; paragraphs are the non-empty
  lines). Equal multisets of paragraphs have equal sums, in any order; two multisets that are not made to collide have
  equal sums with a chance of 2^-256.
* SKETCH lanes of 24 bits sum signs (+1 or -1) that each paragraph gives: the sum, over its sentences, of signs taken
  from the sentence's hash. Their inner product estimates how many sentences two documents share. Signs are sums modulo
  2^24, so that likeness holds for texts of up to 2^23 sentences.

Sums make it incremental: the fingerprint of a text with a paragraph more or less is the lane-wise sum or difference
(:func:`combine`), without a look at the rest of the text.

Null texts are empty texts; both, and texts of blank lines only, have zeros in all sketch lanes. Very long texts are read
whole. Equal texts have equal fingerprints, so do repeated rows. An empty table gives no rows. Columns besides key and text
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from quadra.session import cut

EXACT = 8
SKETCH = 64
_LOW = 0xFFFFFFFF
_SKETCH_SIZE = 1 << 24


def _sum(values: Column, f) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda acc, x: acc + f(x))


def lanes(text: Column) -> Column:
    """array<bigint> of EXACT + SKETCH lanes. A null or blank text has zeros everywhere."""
    paragraphs = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda p: p != "")
    sentences = F.filter(F.split(F.coalesce(text, F.lit("")), "[.!?|\n]+", -1), lambda p: F.btrim(p) != "")
    hashed = F.transform(sentences, lambda s: F.xxhash64(F.btrim(s)))

    digests = F.transform(paragraphs, lambda p: F.sha2(p, 512))
    word = lambda d, k: F.conv(F.substring(d, 8 * k + 1, 8), 16, 10).cast("long")

    def parts(ps: Column, hs: Column) -> Column:
        exact = [F.pmod(_sum(ps, lambda d, k=k: word(d, k)), F.lit(1 << 32)) for k in range(EXACT)]
        # Two sign bits are summed at once, in the two 32-bit halves of a long: at most 2^31 sentences a text.
        pairs = [_sum(hs, lambda h, k=k: F.shiftrightunsigned(h, k).bitwiseAND(F.lit(0x100000001))) for k in range(SKETCH // 2)]
        n = F.size(hs).cast("long")
        fold = lambda ones: F.pmod(2 * ones - n, F.lit(_SKETCH_SIZE))
        halves = F.flatten(F.transform(F.array(*pairs), lambda v: F.array(fold(v.bitwiseAND(F.lit(_LOW))), fold(F.shiftrightunsigned(v, 32)))))
        return F.concat(F.array(*exact), halves)

    # the two arrays are bound once, as a struct that the inner expressions read
    bound = F.transform(F.array(F.struct(digests.alias("p"), hashed.alias("h"))), lambda b: parts(b["p"], b["h"]))
    return F.get(bound, 0)


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """Lanes of the union (sign 1) or the difference (sign -1) of two paragraph multisets."""
    both = F.zip_with(a, b, lambda x, y: x + sign * y)
    return F.transform(both, lambda x, i: F.pmod(x, F.when(i < EXACT, F.lit(1 << 32)).otherwise(F.lit(_SKETCH_SIZE))))


def as_text(v: Column) -> Column:
    """Lower-case hex, lane after lane: 8 digits for exact lanes, 6 for sketch lanes."""
    return F.lower(F.array_join(F.transform(v, lambda x, i: F.lpad(F.hex(x), F.when(i < EXACT, 8).otherwise(6), F.lit("0"))), ""))


def likeness(a: Column, b: Column) -> Column:
    """Cosine of the sketch lanes, from 0 to 1; 1 for equal fingerprints. A text without sentences is like no other."""
    signed = lambda v: F.transform(F.slice(v, EXACT + 1, SKETCH), lambda x: (x - F.when(x >= _SKETCH_SIZE // 2, _SKETCH_SIZE).otherwise(0)).cast("double"))
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda acc, z: acc + z)
    pair = F.transform(F.array(F.struct(signed(a).alias("a"), signed(b).alias("b"))), lambda s: F.struct(dot(s["a"], s["b"]).alias("ab"), dot(s["a"], s["a"]).alias("aa"), dot(s["b"], s["b"]).alias("bb")))
    cosine = F.get(F.transform(pair, lambda s: F.when((s["aa"] > 0) & (s["bb"] > 0), F.greatest(F.lit(0.0), F.least(F.lit(1.0), s["ab"] / F.sqrt(s["aa"] * s["bb"])))).otherwise(F.lit(0.0))), 0)
    return F.when(a == b, F.lit(1.0)).otherwise(cosine)


def next_ids(ids: DataFrame, key: str, extra: str) -> DataFrame:
    """(key, extra, next): for each row the next key in descending order, and the first key after the last one.

    ``ids`` has distinct keys. The keys are dealt out by range and numbered by part; the order inside a part comes from
    a window over the part, and the step from one part to the next from a table with one row per part."""
    dealt = cut(ids.select(key, extra).repartitionByRange(F.col(key).desc_nulls_last()).withColumn("part", F.spark_partition_id()))
    order = W.partitionBy("part").orderBy(F.col(key).desc_nulls_last())
    inside = dealt.withColumn("next", F.lead(F.struct(F.col(key).alias("id"))).over(order))
    first = dealt.groupBy("part").agg(F.max(F.struct(F.col(key).isNotNull().alias("set"), F.col(key).alias("id"))).alias("top"))
    parts = W.orderBy("part")  # one row per part
    around = first.select("part", F.coalesce(F.lead("top").over(parts), F.first("top").over(parts.rowsBetween(W.unboundedPreceding, W.unboundedFollowing))).alias("wrap"))
    joined = inside.join(around, "part")
    return joined.select(key, extra, F.coalesce(F.col("next"), F.struct(F.col("wrap.id").alias("id")))["id"].alias("next"))


#: Stands for a null key in joins.
_NULL = -(1 << 63)


def with_next(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, head_next, next_lanes): head_next is the first floor(n/3) code points of the next document's text, n
    the own length. The next document is that with the next smaller key; after the last comes the first. Repeated keys
    are one document in that order, read as the smallest of their texts; a null key (also -2^63) comes last. Keys are
    integers; a null text is the empty one.

    Texts are dealt out by key once, and both sides of the join read that exchange; only lanes and the prefixes that
    are asked for move a second time."""
    whole = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(_NULL)).alias("__k"), F.coalesce(F.col(text), F.lit("")).alias("__t"))
    sizes = whole.groupBy("__k").agg(F.max(F.floor(F.char_length("__t") / 3)).cast("int").alias("need"))
    after = next_ids(sizes, "__k", "need")
    asked = after.select(F.col("__k").alias("__user"), "need", F.col("next").alias("__k"))
    dealt = whole.repartition("__k")
    smallest = F.row_number().over(W.partitionBy("__k").orderBy("__t"))
    one = dealt.withColumn("__n", smallest).where("__n = 1")
    lent = one.join(asked, "__k").select(
        F.col("__user").alias("__k"), F.substring(F.col("__t"), F.lit(1), F.col("need")).alias("head_next"), lanes(F.col("__t")).alias("next_lanes")
    )
    joined = dealt.join(lent, "__k")
    return joined.select(F.nullif("__k", F.lit(_NULL)).alias(key), F.col("__t").alias(text), "head_next", "next_lanes")
