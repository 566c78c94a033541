"""Query op3: quality rules over documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadra.llm.quality import CLASSES, COMMON, COMMON_WORDS, FUNCTION, Limits, fit_references, judge, measure
from quadra.session import stored, table

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the counts of the base rules, their verdict, and whether the document is kept."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    # The measures are a few numbers a document; they are stored, since references and verdicts both read them.
    measured = stored(measure(docs).drop("text"), "measures")
    judged = judge(measured, fit_references(measured, Limits()), Limits())
    return judged.select("doc_id", *COUNTS, "base_failed", "kept", *[F.round(c, 6).alias(c) for c in ("char_distance", "word_distance")])


QUERIES = {"op3_quality": op3_quality}


def _sql() -> str:
    """The same over the whole table, for languages of the fixed list (the test tables have no others)."""
    x, names = Limits(), lambda ws: ", ".join("'" + w.replace("'", "''") + "'" for w in ws)
    langs, some = names(COMMON_WORDS), lambda p: f"length(regexp_replace(text, '[^{p}]', '', 'g'))"
    one = dict(zip(CLASSES, [some("A-Z"), some("0-9"), some(".,;:!?"), "n_symbols", "length(text) - word_chars", "length(regexp_replace(text, '[\\x00-\\x7F]', '', 'g'))"], strict=False))
    # histograms as rows (kind, bin, n), with a bin of its own for other words
    hist = lambda kind, w, ws: f"SELECT r, '{kind}', CASE WHEN {w} IN ({names(ws)}) THEN {w} ELSE '' END, count(*) FROM w GROUP BY ALL"
    bins = ", ".join(f"('char', '{c}')" for c in CLASSES) + ", " + ", ".join(f"('{k}', '{w}')" for k, ws in (("word", COMMON), ("function", FUNCTION)) for w in [*ws, ""])
    part = lambda p: f"CASE WHEN {p} > 0 THEN {p} * log2({p} / (({p} + {{o}}) / 2)) ELSE 0 END"
    return f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, i, ws[i] AS w, regexp_replace(lower(ws[i]), '[.,;:!?]+$', '') AS f FROM (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS i FROM (SELECT r, regexp_extract_all(text, '[^ \\t-\\r]+') AS ws FROM t))),
three AS (SELECT r, i, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
again AS (SELECT r, i FROM three WHERE w3 IS NOT NULL QUALIFY count(*) OVER (PARTITION BY r, w, w2, w3) > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r),
lines AS (SELECT r, count(*) - count(DISTINCT x) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS x FROM t) WHERE regexp_matches(x, '[^ \\t-\\r]') GROUP BY r),
m AS (SELECT t.*, coalesce(c.n, 0) AS n_words, coalesce(c.k, 0)::BIGINT AS word_chars, {some('#*$%&|<>')} AS n_symbols, coalesce(lines.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
  FROM t LEFT JOIN (SELECT r, count(*) AS n, sum(length(w)) AS k FROM w GROUP BY r) c USING (r) LEFT JOIN lines USING (r) LEFT JOIN covered USING (r)),
b AS (SELECT *, n_words < {x.base_words} OR 100 * n_repeat_words > {x.base_repeat_percent} * n_words AS base_failed FROM m),
prose AS (SELECT r, lang, n_words FROM b WHERE NOT base_failed AND 100 * n_symbols <= {x.reference_symbols_percent} * n_words AND lang IN ({langs})),
chars AS (SELECT r, kind, n FROM (SELECT r, {', '.join(f'{v} AS {k}' for k, v in one.items())}, length(text) AS every FROM b) UNPIVOT (n FOR kind IN ({', '.join(one)}, every))),
counts AS (SELECT r, 'char' AS kind, kind AS bin, n FROM chars WHERE kind <> 'every'
  UNION ALL SELECT r, 'char', 'other', sum(CASE WHEN kind = 'every' THEN n ELSE -n END) FROM chars GROUP BY r
  UNION ALL {hist('word', 'w', COMMON)} UNION ALL {hist('function', 'f', FUNCTION)}),
shares AS (SELECT *, n / sum(n) OVER (PARTITION BY r, kind) AS p FROM counts),
sums AS (SELECT lang, kind, bin, sum(n) AS n FROM counts JOIN prose USING (r) GROUP BY ALL),
refs AS (SELECT lang, kind, bin, coalesce(n, 0) / sum(n) OVER (PARTITION BY lang, kind) AS q FROM (SELECT DISTINCT lang FROM sums) CROSS JOIN (VALUES {bins}) v(kind, bin) LEFT JOIN sums USING (lang, kind, bin)),
far AS (SELECT r, kind, min(d) AS d FROM (
  SELECT r, kind, lang, sqrt(greatest(0, sum(({part('p').format(o='q')} + {part('q').format(o='p')}) / 2))) AS d
  FROM (SELECT a.r, x.kind, x.lang, x.q, coalesce(s.p, 0) AS p FROM (SELECT DISTINCT r, kind FROM shares WHERE p IS NOT NULL) a JOIN refs x ON x.kind = a.kind LEFT JOIN shares s ON s.r = a.r AND s.kind = a.kind AND s.bin = x.bin) GROUP BY ALL) GROUP BY ALL),
d AS (SELECT b.*, fc.d AS dc, fw.d AS dw, ff.d AS df, floor(log2(greatest(n_words, 1))) AS k FROM b LEFT JOIN far fc ON fc.r = b.r AND fc.kind = 'char' LEFT JOIN far fw ON fw.r = b.r AND fw.kind = 'word' LEFT JOIN far ff ON ff.r = b.r AND ff.kind = 'function'),
top AS (SELECT k, min(df) AS most FROM (SELECT k, df, row_number() OVER (PARTITION BY k ORDER BY df) AS i, count(*) OVER (PARTITION BY k) AS n FROM d JOIN prose USING (r) WHERE d.n_words >= {x.least_words}) WHERE i >= {x.function_quantile} * n GROUP BY k),
none AS (SELECT {x.function_share} * min(sqrt((-log2((1 + q) / 2) + 1 - q + CASE WHEN q > 0 THEN q * log2(q / ((1 + q) / 2)) ELSE 0 END) / 2)) AS cap FROM refs WHERE kind = 'function' AND bin = '')
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(length(text) >= {x.least_chars} AND dc > {x.chars} + {x.chars_noise} / sqrt(length(text)), false) AND NOT coalesce(n_words >= {x.least_words} AND dw > {x.words}, false)
  AND NOT coalesce(n_words >= {x.least_words} AND df > least(coalesce(most, cap), cap), false) AS kept, round(coalesce(dc, 1.0), 6) AS char_distance, round(coalesce(dw, 1.0), 6) AS word_distance
FROM d LEFT JOIN top USING (k) CROSS JOIN none
"""


SQL = {"op3_quality": _sql()}
