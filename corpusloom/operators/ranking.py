"""Ranking inside groups, with no group held by a single task."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from corpusloom.workspace import settle

# Executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of each group by a total ``order``.

    Spark limits each group to ``k`` rows before the shuffle, so even a group
    holding most of the table sends at most ``k`` rows per map task. It does so for
    ``k`` up to ``spark.sql.optimizer.windowGroupLimitThreshold``; raise that for
    more, or rank in full by :func:`rank_in_group`.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window).cast("bigint")).filter(F.col(rank) <= k)


def rank_in_group(df: DataFrame, keys: list[str], order: list[Column], rank: str = "rank") -> DataFrame:
    """Add the row number of each row in its group, for a total ``order``.

    Rows are dealt out in ranges of key and order, so a large group spreads over
    several ranges; that is the only shuffle. A row's number is its number in its range,
    counted while the sorted range is written, plus the group's rows in earlier ranges;
    only a group that crosses a border has any. The ranges come from a sample, so they
    are written once: a range computed again after a lost executor could have other borders.
    """
    by = [F.col(key) for key in keys]
    ranged = df.repartitionByRange(*by, *order).withColumn("_range", F.spark_partition_id()).sortWithinPartitions(*by, *order)
    schema = StructType([*ranged.schema.fields, StructField("_number", LongType(), False)])
    placed = settle(ranged.mapInArrow(_numberer(keys), schema), "ranking", keep=1)
    # First and last group of each range, one row a range.
    first, last = F.struct(*by), F.struct(*by, "_number")
    edges = placed.groupBy("_range").agg(F.min(first).alias("_first"), F.max(last).alias("_last"))
    asked = edges.select("_range", *[F.col(f"_first.{key}").alias(key) for key in keys], F.lit(0).cast("bigint").alias("_rows"), F.lit(True).alias("_ask"))
    given = edges.select("_range", *[F.col(f"_last.{key}").alias(key) for key in keys], F.col("_last._number").alias("_rows"), F.lit(False).alias("_ask"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rangeBetween(Window.unboundedPreceding, -1)
    offsets = asked.unionByName(given).withColumn("_before", F.sum("_rows").over(earlier)).filter("_ask AND _before > 0")
    offsets = offsets.select("_before", *[F.col(c).alias(f"_of_{c}") for c in ("_range", *keys)])
    same = reduce(Column.__and__, [placed[c].eqNullSafe(offsets[f"_of_{c}"]) for c in ("_range", *keys)])
    number = F.col("_number") + F.coalesce(F.col("_before"), F.lit(0))
    return placed.join(F.broadcast(offsets), same, "left").select(*df.columns, number.cast("bigint").alias(rank))


def _numberer(keys: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds to sorted rows ``_number``, their number among the rows of equal keys; groups may go on over batches."""

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, reached = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            new = np.zeros(batch.num_rows, dtype=bool)
            for key in keys:
                codes = batch.column(key).dictionary_encode(null_encoding="encode").indices.to_numpy()
                new[1:] |= codes[1:] != codes[:-1]
            head = [batch.column(key).slice(0, 1) for key in keys]
            new[0] = last is None or any(a.to_pylist() != b.to_pylist() for a, b in zip(head, last, strict=True))
            places = np.arange(batch.num_rows)
            starts = np.maximum.accumulate(np.where(new, places, -reached))
            numbers = places - starts + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())], [*batch.schema.names, "_number"])
            last, reached = [batch.column(key).slice(batch.num_rows - 1) for key in keys], int(numbers[-1])

    return numbered
