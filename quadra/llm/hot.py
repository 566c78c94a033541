"""Joins with a table of unique keys where one key may hold a large share of the other side's rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys with more than a share of 1/HOT of all rows are sent to all tasks: there are fewer than HOT of them, whatever the data.
HOT, LEAST = 10_000, 256


def lookup(rows: DataFrame, table: DataFrame, key: str | list[str], n: str, total: int, how: str = "inner", hot: int = HOT, least: int = LEAST) -> DataFrame:
    """``rows`` with the columns of ``table`` (unique ``key``; ``n``: how many of ``rows`` have it, as far as is known;
    ``total``: the sum of n). ``how`` is inner or left.

    Hot keys, of n >= total / ``hot`` and n >= ``least``, are at most ``hot`` by counting and are broadcast; all other keys are
    joined by a shuffle, in which none of them is larger than that share. Null keys match nothing. Both inputs are read twice and
    should be stored tables or cheap."""
    least = max(total / hot, least)
    sent = F.broadcast(table.where(F.col(n) >= least))
    cold = table.where(F.col(n) < least)
    rest = rows.join(sent.select(*([key] if isinstance(key, str) else key)), key, "left_anti")
    return rows.join(sent, key).unionByName(rest.join(cold, key, how))
