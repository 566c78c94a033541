"""Quality rules: simple base rules, then the distribution divergence from language references.

DataFrame functions only. Per document three histograms are taken: character classes, the most common words of the
languages, and their function words in lower case without punctuation. Each is compared with the reference of every
language by the Jensen-Shannon distance (base 2, between 0 and 1); the nearest language counts. A document diverges if
one of its distances exceeds its limit; short documents, whose histograms say little, are not judged (minimum-length
guards).

The limit for function words is learned: by length class, the ``function_quantile`` of the prose's own distances, and
never more than ``function_share`` of the distance of a text that has no function word at all.

References come from the documents themselves: sums over the prose of each language that passes the base rules, one row per
language. Languages with known words are a fixed list. Any other language with ``least_documents`` of prose has a reference for
its characters only, which counts for its own documents, and meets them in a join on the language (a language with many
rows is sent to all tasks, the others are shuffled); documents of a language without a reference are not judged. Documents without a language are judged by the fixed list.

Null texts have no words and fail the base rules; so do empty texts. Very long texts are measured whole. Repeated rows
are judged alike. An empty table gives no rows. Columns of the input that have the name of an added one are
replaced, so that :func:`measure` should get only the columns it needs, or others inside a struct; all else is left alone.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadra.llm.hot import lookup
from quadra.llm.text import words
from quadra.session import cut

#: Frequent function words, by language.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "it"],
    "de": ["der", "die", "und", "den", "von", "das", "mit", "sich"],
    "fr": ["le", "des", "et", "les", "du", "une", "que", "pour"],
    "es": ["el", "los", "las", "una", "por", "con", "para", "y"],
}
COMMON = [w for ws in COMMON_WORDS.values() for w in ws]
#: Function words for the folded histogram: lower case, without punctuation at the end.
FUNCTION_WORDS = {
    "en": "the of and to in is that it a for was on with be as by this are or an at from not he his have which but had they".split(),
    "de": "der die und den von das mit sich in zu des auf für ist nicht im dem ein eine als er es an auch werden aus hat dass sie nach".split(),
    "fr": "le des et les du une que pour de la en un est qui dans par pas au sur avec il ne se ce plus son aux ou sont cette".split(),
    "es": "el los las una por con para y de la que en se del un no su al es lo como más o pero sus le ha este sin sobre".split(),
}
FUNCTION = list(dict.fromkeys(w for ws in FUNCTION_WORDS.values() for w in ws))
#: What stands between words without the punctuation at their ends. It starts where no punctuation precedes, so that a run of it
#: is looked at once.
_BETWEEN = r"(?<![.,;:!?])(?:[.,;:!?]*+[ \t-\r]++|[.,;:!?]++\z)"
CLASSES = ["upper", "digit", "stop", "symbol", "space", "wide", "other"]


@dataclass(frozen=True)
class Limits:
    """Base rules and guards. ``chars`` and ``words``: largest Jensen-Shannon distances. That of characters is for very
    long texts; for n characters ``chars_noise / sqrt(n)`` is added, since short histograms scatter. ``least_*``: a text
    with fewer characters or words is not judged by that histogram."""

    base_words: int = 50
    base_repeat_percent: int = 50
    chars: float = 0.12
    chars_noise: float = 2.5
    words: float = 0.4
    function_quantile: float = 0.999
    function_share: float = 0.95
    least_chars: int = 300
    least_words: int = 100
    reference_symbols_percent: int = 5
    least_documents: int = 50
    languages: list = field(default_factory=lambda: list(COMMON_WORDS))


def _repeated(w: Column, n: Column) -> Column:
    """Words inside 3-word windows that occur at least twice. Windows are compared by their 64-bit hash, which two
    different windows of one text share with a chance of 2^-64 a pair."""
    return F.when(n < 3, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.slice(w, 1, F.greatest(n - 2, F.lit(1))), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))
    )


def _covered(h: Column) -> Column:
    ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

    def places(s: Column) -> Column:
        twice = F.filter(s, lambda x, i: (x["h"] == F.get(s, i + 1)["h"]) | (x["h"] == F.get(s, F.when(i > 0, i - 1))["h"]))
        return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

    return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(F.get(F.transform(F.array(ordered), places), 0))


def _times(found: Column, names: list[str]) -> Column:
    """How often each of the names is in an array of them. The array is bound once; names that are not in it cost a look only."""
    each = lambda b: lambda w: F.when(F.array_contains(b["kinds"], w), F.size(b["all"]) - F.size(F.array_remove(b["all"], w))).otherwise(0).cast("double")
    both = F.transform(F.array(found), lambda f: F.struct(f.alias("all"), F.array_distinct(f).alias("kinds")))
    return F.get(F.transform(both, lambda b: F.transform(F.array(*map(F.lit, names)), each(b))), 0)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), and the histograms ``char_hist``,
    ``word_hist`` and ``function_hist`` (array of double, counts)."""
    t = F.coalesce(F.col(text), F.lit(""))
    df = docs.withColumns({"__text": t, "__words": words(F.col(text))})
    df = df.withColumn("n_words", F.size("__words").cast("long"))
    lines = F.filter(F.split("__text", "\n", -1), lambda x: x.rlike("[^ \\t-\\r]"))
    df = df.withColumns({
        "__lines": lines,
        "__windows": _repeated(F.col("__words"), F.col("n_words").cast("int")),
        "__hits": F.filter("__words", lambda x: x.isin(COMMON)),
        "__function": F.filter(F.split(F.lower("__text"), _BETWEEN), lambda x: x.isin(FUNCTION)),
        "word_chars": F.char_length(F.regexp_replace("__text", "[ \\t-\\r]+", "")).cast("long"),
        "n_symbols": F.regexp_count("__text", F.lit("[#*$%&|<>]")).cast("long"),
    })
    count = lambda p: F.regexp_count("__text", F.lit(p)).cast("double")
    df = df.withColumns({
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": _covered(F.col("__windows")).cast("long"),
        "__upper": count("[A-Z]"),
        "__digit": count("[0-9]"),
        "__stop": count("[.,;:!?]"),
        "__space": (F.char_length("__text") - F.col("word_chars")).cast("double"),
        "__wide": count("[^\\x00-\\x7F]"),
        "__counts": _times(F.col("__hits"), COMMON),
        "__function_counts": _times(F.col("__function"), FUNCTION),
    })
    rest = F.char_length("__text") - F.col("__upper") - F.col("__digit") - F.col("__stop") - F.col("n_symbols") - F.col("__space") - F.col("__wide")
    char_hist = F.array("__upper", "__digit", "__stop", F.col("n_symbols").cast("double"), "__space", "__wide", rest)
    with_rest = lambda counts, hits: F.concat(counts, F.array((F.col("n_words") - F.size(hits)).cast("double")))
    df = df.withColumns({"char_hist": char_hist, "word_hist": with_rest("__counts", "__hits"), "function_hist": with_rest("__function_counts", "__function")})
    return df.drop("__text", "__words", "__lines", "__windows", "__hits", "__function", "__upper", "__digit", "__stop", "__space", "__wide", "__counts", "__function_counts")


def base_failed(limits: Limits) -> Column:
    return (F.col("n_words") < limits.base_words) | (100 * F.col("n_repeat_words") > limits.base_repeat_percent * F.col("n_words"))


class References(dict):
    """language -> (character, word, function-word histogram) as shares; the limits of the function-word distance by
    length class (see :func:`_length_class`); and ``others``, a table of languages without known words: __lang, __rows
    (documents), __own (character histogram as shares, null if there is too little prose)."""

    def __init__(self, histograms: dict, function_limits: dict[int, float], function_cap: float, others: DataFrame | None = None):
        super().__init__(histograms)
        self.function_limits, self.function_cap, self.others = function_limits, function_cap, others


def _length_class(n: Column) -> Column:
    """Lengths between two powers of two are a class."""
    return F.floor(F.log2(F.greatest(n, F.lit(1)))).cast("int")


def fit_references(measured: DataFrame, limits: Limits, lang: str = "lang") -> References:
    """The histograms of each language that has documents, as shares, and the limits that follow from the prose itself.
    ``measured`` should be a stored table, since this and :func:`judge` read it again."""
    prose = 100 * F.col("n_symbols") <= limits.reference_symbols_percent * F.col("n_words")
    every = measured.where(~base_failed(limits) & prose & F.col(lang).isNotNull())
    good = every.where(F.col(lang).isin(limits.languages))
    sums = lambda c, n: [F.sum(F.get(c, i)).alias(f"{c}_{i}") for i in range(n)]
    n, m, k = len(CLASSES), len(COMMON) + 1, len(FUNCTION) + 1
    used = F.coalesce(~base_failed(limits) & prose, F.lit(False))
    char_sums = [F.sum(F.when(used, F.get("char_hist", i))).alias(f"char_hist_{i}") for i in range(n)]
    others = measured.where(~F.col(lang).isin(limits.languages)).groupBy(F.col(lang).alias("__lang")).agg(F.count(F.lit(1)).alias("__rows"), F.count_if(used).alias("__n"), *char_sums)
    total = sum(F.col(f"char_hist_{i}") for i in range(n))
    own = F.when(F.col("__n") >= limits.least_documents, F.array(*[F.col(f"char_hist_{i}") / total for i in range(n)]))
    others = cut(others.select("__lang", "__rows", own.alias("__own")))
    rows = good.groupBy(lang).agg(*sums("char_hist", n), *sums("word_hist", m), *sums("function_hist", k)).orderBy(lang).collect()  # a row a language
    share = lambda xs: [x / max(sum(xs), 1.0) for x in xs]
    found = {r[0]: (share(r[1 : 1 + n]), share(r[1 + n : 1 + n + m]), share(r[1 + n + m :])) for r in rows}
    if not found:
        return References({}, {}, 1.0, others)
    own = good.where(F.col("n_words") >= limits.least_words).select(_length_class(F.col("n_words")).alias("k"), nearest("function_hist", found, 2).alias("d"))
    top = own.groupBy("k").agg(F.percentile_approx("d", limits.function_quantile, 10_000)).collect()  # a row a length class
    none = min(_distance_without_function_words(h[2][-1]) for h in found.values())
    return References(found, {r[0]: r[1] for r in top}, limits.function_share * none, others)


def _distance_without_function_words(rest: float) -> float:
    """Jensen-Shannon distance of a text of other words only from a reference whose share of these is ``rest``."""
    m = (1 + rest) / 2
    return math.sqrt(max(0.0, (-math.log2(m) + (1 - rest) + (rest * math.log2(rest / m) if rest else 0.0)) / 2))


def _distances(counts: Column, references: list[list[float] | Column]) -> Column:
    """The smallest Jensen-Shannon distance of a histogram of counts from several shares; null for an empty histogram. The
    histogram's own shares are computed once, not once a bin or reference."""
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    shares = F.get(F.transform(F.array(total), lambda t: F.transform(counts, lambda x: x / t)), 0)
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))

    def term(p, y):
        # a bin that the text does not have gives half of the reference's share
        return F.when(p > 0, (part(p, (p + y) / 2) + part(y, (p + y) / 2)) / 2).otherwise(y / 2)

    def distance(ps, reference):
        q = reference if isinstance(reference, Column) else F.array(*[F.lit(float(x)) for x in reference])
        return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(F.zip_with(ps, q, term), F.lit(0.0), lambda a, x: a + x)))

    every = F.transform(F.array(shares), lambda ps: F.array_min(F.array(*[distance(ps, r) for r in references])))
    return F.when(total > 0, F.get(every, 0))


def js_distance(counts: Column, reference: list[float] | Column) -> Column:
    """Jensen-Shannon distance of a histogram of counts from shares; null for an empty histogram."""
    return _distances(counts, [reference])


def nearest(hist: str, references: dict, k: int) -> Column:
    """Distance of a histogram from the nearest language, by the references' ``k``-th histogram; 1 for an empty one."""
    return F.coalesce(_distances(F.col(hist), [r[k] for r in references.values()]), F.lit(1.0)) if references else F.lit(0.0)


def judge(measured: DataFrame, references: dict, limits: Limits = Limits(), lang: str = "lang") -> DataFrame:
    """Adds char_distance, word_distance and function_distance (to the nearest language), base_failed and kept."""
    others, listed = getattr(references, "others", None), F.col(lang).isNull() | F.col(lang).isin(limits.languages)
    df = measured.withColumns({"__lang": F.lit(None).cast("string"), "__own": F.lit(None).cast("array<double>")})
    if others is not None and not others.isEmpty():
        rest = measured.where(~listed).withColumn("__lang", F.col(lang))
        met = lookup(rest, others, "__lang", "__rows", others.agg(F.sum("__rows")).first()[0], "left").drop("__rows")
        df = df.where(listed).unionByName(met)
    df = df.withColumns({
        "char_distance": nearest("char_hist", references, 0),
        "word_distance": nearest("word_hist", references, 1),
        "function_distance": nearest("function_hist", references, 2),
        "base_failed": base_failed(limits),
    })
    df = df.withColumn("char_distance", F.least("char_distance", F.when(F.col("__own").isNotNull(), js_distance(F.col("char_hist"), F.col("__own")))))
    judged = listed | F.col("__own").isNotNull()
    chars = F.aggregate("char_hist", F.lit(0.0), lambda a, x: a + x)
    long = F.col("n_words") >= limits.least_words
    far = judged & (chars >= limits.least_chars) & (F.col("char_distance") > limits.chars + limits.chars_noise / F.sqrt(chars))
    far = far | (listed & long & (F.col("word_distance") > limits.words))
    if isinstance(references, References) and references:
        limit, size = F.lit(references.function_cap), _length_class(F.col("n_words"))
        for k, d in references.function_limits.items():
            limit = F.when(size == k, min(d, references.function_cap)).otherwise(limit)
        far = far | (listed & long & (F.col("function_distance") > limit))
    return df.withColumn("kept", ~F.col("base_failed") & ~far).drop("__lang", "__own")
