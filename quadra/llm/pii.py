"""Personal data: patterns propose spans, checksums confirm them, context words move their score.

DataFrame functions only. Positions come from two passes of the same pattern: the gaps between the matches
(``split``) and the matches themselves (``regexp_extract_all``); running sums of their lengths are the offsets, in
code points. The second pass runs only for texts that hold a match which the validator confirms.

Patterns are written with possessive quantifiers and a start guard (a run's start, or the end of the previous match),
which leaves their matches as they are and keeps the time linear in the text, whatever the text. An IBAN takes as many
characters as its country says.

Kinds. Base kinds are ``email``, ``ip``, ``card`` (16 to 19 digits, Luhn) and ``phone``. The method adds ``card`` spans
of 13 to 15 digits (Luhn, and a word for cards nearby) and ``iban`` (mod 97). Each span has a score: a start value by
kind, more for a confirmed checksum, more for a context word within WINDOW characters before it. Base spans always
stay; added spans stay from ``threshold`` on.

Nulls are the empty text, which has no spans; empty texts and tables give no spans and no rows. Repeated rows give
repeated rows. Very long texts are read whole, in time linear in their length and in the number of their matches. Other
columns are left alone, except one that has the name ``into``, which is replaced: choose another name then.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW, PART = 40, 256
SPAN = "struct<start:int,stop:int,kind:string,score:double>"


@dataclass(frozen=True)
class Kind:
    """A pattern with its validator (over the match) and the words that speak for it."""

    name: str
    pattern: str
    hint: str  # a cheap pattern that any match contains
    valid: object
    context: str
    start: float
    checksum: float = 0.0
    base: bool = True
    nearby: float = 0.2


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _between(m: Column, low: int, high: int) -> Column:
    return F.length(_digits(m)).between(low, high)


def _luhn(m: Column) -> Column:
    return F.call_function("luhn_check", _digits(m))


def mod97(m: Column) -> Column:
    """ISO 7064: the first four characters go to the end, letters count from 10, the number is 1 modulo 97."""
    s = F.upper(F.regexp_replace(m, "[^A-Za-z0-9]", ""))
    s = F.concat(F.substring(s, 5, 1 << 20), F.substring(s, 1, 4))
    def step(acc, c):
        code = F.ascii(c)
        letter = code >= 65
        value = F.when(letter, code - 55).otherwise(code - 48)
        return ((acc * F.when(letter, 100).otherwise(10) + value) % 97).cast("int")
    return F.aggregate(F.split(s, ""), F.lit(0), lambda acc, c: F.when(c == "", acc).otherwise(step(acc, c))) == 1


_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_LOCAL = "[A-Za-z0-9._%+-]"
#: Length of an IBAN by country. It ends the match, so that a blank and a word in capitals may follow.
_IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE",
    31: "MT SC", 32: "LC", 33: "RU",
}
_IBAN_KNOWN = "|".join(c for cs in _IBAN_LENGTHS.values() for c in cs.split())
_IBAN = "|".join(
    [rf"(?:{'|'.join(cs.split())})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, cs in _IBAN_LENGTHS.items()]
    + [rf"(?!{_IBAN_KNOWN})[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]){{11,30}}+"]
)
KINDS = [
    Kind("email", rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", lambda m: F.lit(True), "mail|contact|write|address|schreib|courriel|correo", 0.8),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]", lambda m: m.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"), "ip|host|server|address|adresse", 0.7),
    Kind("card", r"[0-9](?:[ -]?[0-9])++", r"[0-9]", lambda m: _between(m, 16, 19) & _luhn(m), "card|visa|credit|karte|carte|tarjeta", 0.5, 0.3),
    Kind("phone", r"\+[0-9][ ().0-9-]+[0-9]", r"\+[0-9]", lambda m: _between(m, 8, 15), "phone|tel|call|mobile|fon|appel|llam", 0.7),
    Kind("card", r"[0-9](?:[ -]?[0-9])++", r"[0-9]", lambda m: _between(m, 13, 15) & _luhn(m), "card|visa|credit|karte|carte|tarjeta", 0.2, 0.3, False, 0.4),
    Kind("iban", rf"(?<![A-Za-z0-9])(?:{_IBAN})(?![A-Za-z0-9])", "[A-Z]{2}[0-9]{2}", mod97, "iban|account|konto|compte|cuenta", 0.3, 0.5, False),
]
ORDER = ["email", "ip", "card", "phone", "iban"]


def _collect(items: Column, state: Column, kind: str, step) -> Column:
    """Runs over ``items`` with a state and gives array<kind> of what ``step(state, item)`` = (new state, whether to add,
    value) adds. Values are gathered in parts of PART, so that the time is linear in their number."""
    one, many = (F.array().cast(t) for t in (f"array<{kind}>", f"array<array<{kind}>>"))

    def run(acc, x):
        new, add, value = step(acc["s"], x)
        to = lambda small, big: F.struct(new.alias("s"), small.alias("small"), big.alias("big"))
        full = to(F.array(value), F.concat(acc["big"], F.array(acc["small"])))
        more = F.when(F.size(acc["small"]) >= PART, full).otherwise(to(F.concat(acc["small"], F.array(value)), acc["big"]))
        return F.when(add, more).otherwise(to(acc["small"], acc["big"]))

    start = F.struct(state.alias("s"), one.alias("small"), many.alias("big"))
    return F.aggregate(items, start, run, lambda acc: F.concat(F.flatten(acc["big"]), acc["small"]))


def _spans(text: Column, kind: Kind) -> Column:
    """array<SPAN> of the confirmed matches of one kind."""
    none = F.array().cast(f"array<{SPAN}>")
    found = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))

    def place(x: Column) -> Column:
        """Offsets are sums over gaps and matches; the words before a match come along as the text's last characters."""
        pairs = F.zip_with(F.slice(x["gaps"], 1, F.size(x["matches"])), x["matches"], lambda g, m: F.struct(g.alias("gap"), m.alias("m")))

        def step(s, pair):
            before = F.right(F.concat(s["tail"], F.right(pair["gap"], F.lit(WINDOW))), F.lit(WINDOW))
            a = s["at"] + F.char_length(pair["gap"])
            b = a + F.char_length(pair["m"])
            score = F.lit(kind.start + kind.checksum) + F.when(F.lower(before).rlike(kind.context), kind.nearby).otherwise(0.0)
            span = F.struct(a.alias("start"), b.alias("stop"), F.lit(kind.name).alias("kind"), score.cast("double").alias("score"))
            tail = F.right(F.concat(before, F.right(pair["m"], F.lit(WINDOW))), F.lit(WINDOW))
            return F.struct(b.alias("at"), tail.alias("tail")), kind.valid(pair["m"]), span

        return _collect(pairs, F.struct(F.lit(0).alias("at"), F.lit("").alias("tail")), SPAN, step)

    # the matches, then the gaps, are bound once, as elements that the inner expressions read
    confirmed = F.filter(F.transform(F.array(F.lit(0)), lambda _: found), lambda ms: F.exists(ms, kind.valid))
    placed = F.transform(F.transform(confirmed, lambda ms: F.struct(ms.alias("matches"), F.split(text, kind.pattern, -1).alias("gaps"))), place)
    return F.when(text.rlike(kind.hint), F.coalesce(F.get(placed, 0), none)).otherwise(none)


def find_pii(docs: DataFrame, text: str = "text", threshold: float = 0.8, kinds: list[Kind] = KINDS, into: str = "pii") -> DataFrame:
    """Adds ``into``: array of (start, stop, kind, score, base), ordered by kind, start and stop; offsets in code points, stop
    exclusive. An added span that overlaps a base span of its kind is left out."""
    whole = F.coalesce(F.col(text), F.lit(""))
    temp = [f"__{into}_{i}" for i in range(len(kinds))]
    out = docs.withColumns({c: _spans(whole, k) for c, k in zip(temp, kinds, strict=True)})
    tag = lambda c, base: F.transform(c, lambda s: F.struct(F.array_position(F.array(*map(F.lit, ORDER)), s["kind"]).alias("rank"), s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"), s["score"].alias("score"), F.lit(base).alias("base")))
    base = reduce(F.concat, [tag(F.col(c), True) for c, k in zip(temp, kinds, strict=True) if k.base])
    out = out.withColumn(f"__{into}_base", base)
    spans = [F.col(f"__{into}_base")]
    for c, k in zip(temp, kinds, strict=True):
        if k.base:
            continue
        extra = tag(F.filter(F.col(c), lambda s: s["score"] >= threshold), False)
        # matches of one pattern do not overlap each other
        if any(b.base and b.name == k.name and b.pattern != k.pattern for b in kinds):
            extra = F.filter(extra, lambda s: ~F.exists(F.col(f"__{into}_base"), lambda b: (b["kind"] == s["kind"]) & (b["start"] < s["stop"]) & (s["start"] < b["stop"])))
        spans.append(extra)
    spans = reduce(F.concat, spans)
    ordered = F.transform(F.array_sort(spans), lambda s: F.struct(*[s[c].alias(c) for c in ("start", "stop", "kind", "score", "base")]))
    return out.withColumn(into, ordered).drop(*temp, f"__{into}_base")


def redact(text: Column, spans: Column) -> Column:
    """The text with each span replaced by ``[KIND]``; overlapping spans are merged into the first of them. The text is cut
    before every PART-th span first, since a cut costs time in proportion to what lies before it."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"), s["kind"].alias("kind"))))
    # what a mark replaces, or the rest of an overlapping span, which goes without one
    shape = "struct<start:int,stop:int,mark:string>"

    def apart(at, s):
        own = s["start"] >= at["at"]
        mark = F.when(own, F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise(F.lit(""))
        value = F.struct(F.greatest(s["start"], at["at"]).alias("start"), s["stop"].alias("stop"), mark.alias("mark"))
        return F.struct(F.greatest(at["at"], s["stop"]).alias("at")), own | (s["stop"] > at["at"]), value

    cuts = _collect(ordered, F.struct(F.lit(0).alias("at")), shape, apart)

    def part(all_cuts, i):
        some = F.slice(all_cuts, i * PART + 1, PART)
        first = F.when(i == 0, F.lit(0)).otherwise(F.get(some, 0)["start"])
        after = F.coalesce(F.get(all_cuts, (i + 1) * PART)["start"], F.char_length(text))
        piece = F.substring(text, first + 1, after - first)

        def fill(x):
            start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
            step = lambda acc, c: F.struct((c["stop"] - x["first"]).alias("at"), F.concat(acc["out"], F.substring(x["piece"], acc["at"] + 1, c["start"] - x["first"] - acc["at"]), c["mark"]).alias("out"))
            return F.aggregate(x["some"], start, step, lambda acc: F.concat(acc["out"], F.substring(x["piece"], acc["at"] + 1, F.char_length(x["piece"]))))

        return F.get(F.transform(F.array(F.struct(piece.alias("piece"), first.alias("first"), some.alias("some"))), fill), 0)

    whole = lambda all_cuts: F.array_join(F.transform(F.sequence(F.lit(0), F.floor((F.size(all_cuts) - 1) / PART).cast("int")), lambda i: part(all_cuts, i)), "")
    return F.when(F.size(spans) == 0, text).otherwise(F.get(F.transform(F.array(cuts), whole), 0))
