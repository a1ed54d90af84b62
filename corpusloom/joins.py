"""Joins to a table with one row per key that no frequent key can hold up."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _key(columns: list[Column]) -> Column:
    """The columns as one value; null where one of them is."""
    whole = reduce(Column.__and__, [c.isNotNull() for c in columns])
    return F.when(whole, F.struct(*[c.alias(f"k{i}") for i, c in enumerate(columns)]))


def lookup_join(rows: DataFrame, table: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join ``rows`` to ``table``, which has one row per key; ``how`` keeps the left side's meaning.

    The columns are joined as one value. No earlier shuffle has that value for its key,
    so both sides are always shuffled for this join alone, and adaptive execution may
    split the rows of a frequent key by the tasks that wrote them, whatever the rows
    hold, or send round a table that it measured to be small. The table is not copied:
    each part of a split key reads the key's one row.
    """
    named = {c: f"_of_{c}" for c in on}
    other = table.withColumnsRenamed(named)
    same = _key([F.col(c) for c in on]) == _key([F.col(c) for c in named.values()])
    return rows.join(other, same, how).drop(*named.values())
