"""Small text helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The white space that separates words: space and 0x09 to 0x0D.
SPACES = " \t\n\x0b\x0c\r"
_TO_SPACE = [c for c in SPACES if c != " "]


def pieces(text: str | None) -> list[str]:
    """Split on SPACES. Empty strings stay where several of them meet: callers give them the value nothing."""
    if not text:
        return []
    for c in _TO_SPACE:
        if c in text:
            text = text.replace(c, " ")
    return text.split(" ")


def words(text: Column) -> Column:
    """Array of the words ``[^\\x20\\x09-\\x0D]+`` of a text column; null and blank texts have none."""
    inner = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, "[ \\t-\\r]+"))


def small_batches(docs: DataFrame) -> DataFrame:
    """The same rows; sees to it that Spark hands texts to Python in smaller batches than its default of 10,000 rows, which
    hold tens of megabytes of text each. A session that has set another size keeps it."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if docs.sparkSession.conf.get(name, "10000") == "10000":
        docs.sparkSession.conf.set(name, "2000")
    return docs


def whole(text: str = "text") -> Column:
    """The text column, with null as the empty text."""
    return F.coalesce(F.col(text), F.lit(""))
