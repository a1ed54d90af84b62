"""Several words as one string, and back, whatever they hold.

A shuffled row costs 16 bytes and padding for every string. Words that travel together
are shuffled as one, which takes about 0.6 of the bytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATOR, ESCAPE = "\x1f", "\x1e"
NULL = ESCAPE + "0"
# What a word's own separators and escapes become; no packed word holds a bare one of either.
ESCAPES = ((ESCAPE, ESCAPE + "1"), (SEPARATOR, ESCAPE + "2"))


def _packed(word: Column) -> Column:
    plain = ~(F.contains(word, F.lit(ESCAPE)) | F.contains(word, F.lit(SEPARATOR)))
    escaped = word
    for found, instead in ESCAPES:
        escaped = F.replace(escaped, F.lit(found), F.lit(instead))
    return F.when(word.isNull(), NULL).when(plain, word).otherwise(escaped)


def pack(*words: str) -> Column:
    """One string of the words; different words, nulls among them, never give the same string."""
    return F.concat_ws(SEPARATOR, *[_packed(F.col(w)) for w in words])


def _part(packed: Column, at: int, of: int) -> Column:
    if at + 1 < of:
        packed = F.substring_index(packed, SEPARATOR, at + 1)
    return F.substring_index(packed, SEPARATOR, -1) if at else packed


def unpack(packed: Column, at: int, of: int, never_null: bool = False) -> Column:
    """Word ``at`` of ``of`` packed ones; ``never_null`` where none of them was null."""
    part = _part(packed, at, of)
    back = part
    for found, instead in reversed(ESCAPES):
        back = F.replace(back, F.lit(instead), F.lit(found))
    # Nearly no string has an escape, and those are taken apart at once.
    word = F.when(F.contains(packed, F.lit(ESCAPE)), F.when(part != NULL, back)).otherwise(part)
    return F.coalesce(word, F.lit("")) if never_null else word


def sum_by_words(rows: DataFrame, words: list[str], sums: dict[str, Column]) -> DataFrame:
    """``rows`` grouped by ``words``, which are shuffled as one string; nullable where they were."""
    null = {f.name: f.nullable for f in rows.schema.fields}
    gathered = rows.withColumn("_packed", pack(*words)).groupBy("_packed").agg(*[value.alias(name) for name, value in sums.items()])
    parts = [unpack(F.col("_packed"), i, len(words), not null[w]).alias(w) for i, w in enumerate(words)]
    return gathered.select(*parts, *sums)
