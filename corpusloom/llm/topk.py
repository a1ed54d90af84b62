"""Exact top-k inner products by vector-approximation files.

Every component of a vector is replaced by the number of a cell, one byte. Half of a
dimension's borders lie at quantiles of its values, the others at even distances, so that
no cell is wide, at the ends neither. Cells are a table of their own, a small
part of the vectors, and the searches scan it alone: cells bound a score from above and
below. A first scan, over some of the groups of rows, gives every query a score that k
rows reach for sure; a second, over all, leaves the rows whose upper bound is not below
it. Exact vectors are read for those only, in the order of their bounds: the kth exact
score of the first ones rules out most of the others, and the rest are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.joins import lookup_join
from corpusloom.llm.carried import Carried
from corpusloom.workspace import materialize

SCALE = 64
# Cells per dimension, and the vectors whose values place half of their borders.
CELLS = 256
SAMPLE = 8192
# Rows of a group, and the sides of one product.
GROUP_ROWS = 1 << 16
ROWS = 4096
QUERIES = 512
NONE = np.iinfo(np.int64).min


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, v): floor(64 * component) as long; vectors that are null or hold null, NaN or infinite components are left out."""
    v = F.transform(vector_col, lambda x: x.cast("double"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
    return rows.filter("v IS NOT NULL").filter(fine).select("id", F.transform("v", lambda x: F.floor(x * SCALE)).alias("v"))


class Borders(Carried):
    """For each length of vectors the least and the greatest value of every cell, as (dimension, cell).

    The outer cells reach to the least and the greatest component of all vectors. A
    length that is not in the sample has one cell for all values.
    """

    def __init__(self, sample: list[list[int]], least: int, most: int, cells: int = CELLS):
        self.least, self.most = least, most
        self.first: dict[int, list[np.ndarray]] = {}
        for dim in {len(v) for v in sample}:
            values = np.array([v for v in sample if len(v) == dim], np.int64).reshape(-1, dim)
            at = np.arange(1, cells // 2) * len(values) // (cells // 2)
            even = np.array([least + (most - least + 1) * i // (cells // 2) for i in range(cells // 2)], np.int64)
            # Every cell begins at another value, the first at the least there is.
            self.first[dim] = [np.unique(np.concatenate([even, column[at]])) for column in np.sort(values, axis=0).T]

    def cells(self, matrix: np.ndarray) -> np.ndarray:
        """Cell numbers of integer vectors of one length."""
        firsts = self.first.get(matrix.shape[1])
        if firsts is None:
            return np.zeros(matrix.shape, np.uint8)
        out = np.zeros(matrix.shape, np.uint8)
        for d, first in enumerate(firsts):
            out[:, d] = np.searchsorted(first, matrix[:, d], side="right") - 1
        return out

    def bounds(self, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and the greatest vector of given cells."""
        low = np.full(cells.shape, self.least, np.float64)
        high = np.full(cells.shape, self.most, np.float64)
        for d, first in enumerate(self.first.get(cells.shape[1], [])):
            low[:, d] = first[cells[:, d]]
            high[:, d] = np.append(first[1:] - 1, self.most)[cells[:, d]]
        return low, high


def score_bounds(borders: Borders, cells: np.ndarray, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, most) that the product of each query with a vector of the given cells can be.

    Products are made in doubles; a margin above what their rounding can amount to keeps
    the bounds safe for components of any size.
    """
    low, high = borders.bounds(cells)
    q = queries.astype(np.float64)
    up, down = np.maximum(q, 0.0), np.minimum(q, 0.0)
    least, most = up @ low.T + down @ high.T, up @ high.T + down @ low.T
    size = np.abs(q).sum(axis=1)[:, None] * max(abs(float(borders.least)), abs(float(borders.most)))
    margin = size * ((cells.shape[1] + 4) * 2.0**-52)
    return least - margin, most + margin


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of one length, pair by pair."""
    return np.einsum("ij,ij->i", a, b)


def _lists(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def _cell_maker(known):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        borders = known.value
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            out = np.empty(len(batch), object)
            for dim in np.unique(dims):
                own = np.flatnonzero(dims == dim)
                found = borders.cells(_lists(batch.column("v").take(pa.array(own)), int(dim)))
                out[own] = [row.tobytes() for row in found]
            names = [n for n in batch.schema.names if n != "v"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(out, pa.binary())], [*names, "cells"])

    return make


def _scanner(known, k: int, thresholds: bool):
    """Bounds of blocks of queries against the cells of a group; batches come by group and dimension, cells first.

    Without ``thresholds`` the k greatest lower bounds of each query are given, else the
    rows whose upper bound is not below the query's ``reach`` and the group's own kth.
    """

    def answer(held: tuple, block: pa.Table) -> Iterator[pa.RecordBatch]:
        reps, only, cells = held
        borders = known.value
        ids, q = block.column("id").to_numpy(), _lists(block.column("v").combine_chunks(), cells.shape[1])
        reach = block.column("reach").to_numpy() if thresholds else None
        tops, ups = [], []
        for low in range(0, len(reps), ROWS):
            some = slice(low, low + ROWS)
            least, most = score_bounds(borders, cells[some], q)
            # A vector that only the query's own id has is none of its candidates.
            least[ids[:, None] == only[some][None, :]] = -np.inf
            n = min(k, least.shape[1])
            tops.append(-np.partition(-least, n - 1, axis=1)[:, :n])
            if thresholds:
                most[ids[:, None] == only[some][None, :]] = -np.inf
                ups.append(most)
        best = np.concatenate(tops, axis=1)
        n = min(k, best.shape[1])
        best = -np.partition(-best, n - 1, axis=1)[:, :n]
        if not thresholds:
            told = best > -np.inf
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, told.sum(axis=1))), pa.array(best[told])], ["query_id", "least"])
            return
        if n == k:
            reach = np.maximum(reach, best.min(axis=1))
        for part, most in enumerate(ups):
            row, at = np.nonzero((most >= reach[:, None]) & (most > -np.inf))
            columns = [ids[row], reps[part * ROWS + at], most[row, at]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["query_id", "rep", "most"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, held, waiting = None, [], None, []

        def flush() -> Iterator[pa.RecordBatch]:
            if waiting and held is not None:
                yield from answer(held, pa.Table.from_batches(waiting))
            waiting.clear()

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("grp", "dim", "kind")], axis=1)
            starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)])) if len(keys) else []
            for low, high in zip(starts, [*starts[1:], len(keys)], strict=True):
                group, dim, kind = keys[low]
                if (group, dim) != at:
                    yield from flush()
                    at, parts, held = (group, dim), [], None
                part = batch.slice(low, high - low)
                if kind == 0:
                    cells = np.frombuffer(b"".join(part.column("cells").to_pylist()), np.uint8).reshape(len(part), dim)
                    parts.append((part.column("rep").to_numpy(), part.column("only").to_numpy(), cells))
                    continue
                if parts:
                    held, parts = tuple(np.concatenate(c) for c in zip(*parts, strict=True)), []
                for i in range(0, len(part), QUERIES):
                    waiting.append(part.slice(i, QUERIES))
                    if sum(map(len, waiting)) >= QUERIES:
                        yield from flush()
        yield from flush()

    return scan


def _scored(pairs: DataFrame, exact: DataFrame, asked: DataFrame) -> DataFrame:
    """(query_id, rep, most, score): exact scores of ``pairs`` (query_id, rep, most); only their vectors are read."""
    met = lookup_join(pairs, exact.select("rep", "v"), ["rep"])
    met = lookup_join(met, asked.select(F.col("id").alias("query_id"), F.col("v").alias("q")), ["query_id"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("v").value_lengths().to_numpy()
            out = np.zeros(len(batch), np.int64)
            for dim in np.unique(dims):
                own = pa.array(np.flatnonzero(dims == dim))
                out[own.to_numpy()] = _product(*(_lists(batch.column(c).take(own), int(dim)) for c in ("q", "v")))
            names = ["query_id", "rep", "most"]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], pa.array(out)], [*names, "score"])

    return met.mapInArrow(score, "query_id long, rep long, most double, score long")


def _met(cells: DataFrame, asked: DataFrame, groups: int, scanner, kind: str) -> DataFrame:
    """Blocks of the queries against the cells, which carry their group."""
    extra = ["id", "v", "reach"]
    types = dict(asked.dtypes)
    own = ["grp", "dim", "rep", "only", "cells"]
    left = cells.select(F.lit(0).alias("kind"), *own, *[F.lit(None).cast(types[c]).alias(c) for c in extra])
    copies = asked.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    nothing = {"rep": "long", "only": "long", "cells": "binary"}
    right = copies.select(F.lit(1).alias("kind"), "grp", "dim", *[F.lit(None).cast(t).alias(c) for c, t in nothing.items()], *extra)
    dealt = left.unionByName(right).repartition(groups, "grp").sortWithinPartitions("grp", "dim", "kind")
    return dealt.mapInArrow(scanner, kind)


def _kth(scores: DataFrame, value: str, k: int) -> DataFrame:
    """(query_id, reach): the kth greatest ``value`` of each query that has as many."""
    order = Window.partitionBy("query_id").orderBy(F.desc(value))
    return scores.withColumn("_at", F.row_number().over(order)).filter(F.col("_at") <= k).filter(F.col("_at") >= k).select("query_id", F.col(value).alias("reach"))


def classes(rows: DataFrame, k: int) -> DataFrame:
    """(v, ids): each different vector with its k + 1 smallest ids and how often each stands there, counted up to k.

    Of equal vectors no others can be among a query's k best.
    """
    counted = rows.groupBy("v", "id").agg(F.count(F.lit(1)).alias("n"))
    order = Window.partitionBy("v").orderBy("id")
    first = counted.withColumn("_at", F.row_number().over(order)).filter(F.col("_at") <= k + 1)
    return first.groupBy("v").agg(F.sort_array(F.collect_list(F.struct("id", F.least("n", F.lit(k)).alias("n")))).alias("ids"))


def top_k(vectors: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest integer inner products of each query, ties to the smaller vec_id.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows
    but those of the query's own id. A query with fewer candidates gets all of them.
    Vectors that take no part are named at :func:`integer_vectors`; vectors of another
    length than a query's are no candidates for it. Rows without an id take no part.
    Of several rows with one query id the smallest vector asks; repeated candidate rows
    are candidates each. Products beyond 64 bits are outside of what a score can hold.

    Queries are copied once per group of GROUP_ROWS rows and pass through it in blocks;
    nothing but the borders of the cells, from SAMPLE vectors, is broadcast.
    """
    spark = vectors.sparkSession
    rows = materialize(integer_vectors(vectors, id_col, vector_col).filter("id IS NOT NULL"), "vectors")
    asked = rows.filter(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))
    asked = materialize(asked.withColumn("dim", F.size("v")), "queries")
    exact = classes(rows, k).select(F.monotonically_increasing_id().alias("rep"), "v", F.size("v").alias("dim"), "ids")
    exact = materialize(exact, "exact")

    ends = exact.agg(F.count(F.lit(1)).alias("n"), F.min(F.array_min("v")).alias("least"), F.max(F.array_max("v")).alias("most")).first()
    chosen = exact.filter(F.pmod(F.xxhash64("rep"), F.lit(max(1, ends.n // SAMPLE))) == 0).limit(2 * SAMPLE).select("v").collect()
    known = spark.sparkContext.broadcast(Borders([r.v for r in chosen], ends.least or 0, ends.most or 0))
    groups = max(-(-ends.n // GROUP_ROWS), min(3 * spark.sparkContext.defaultParallelism, -(-ends.n // 1024)), 1)
    only = F.when(F.size("ids") == 1, F.col("ids")[0]["id"]).otherwise(F.lit(NONE))
    named = exact.select("rep", "dim", only.alias("only"), F.pmod(F.xxhash64("rep"), F.lit(groups)).cast("int").alias("grp"), "v")
    cells = materialize(named.mapInArrow(_cell_maker(known), "rep long, dim int, only long, grp int, cells binary"), "cells")

    first_groups = max(1, round(groups**0.5))
    unknown = asked.withColumn("reach", F.lit(float("-inf")))
    sure = _met(cells.filter(F.col("grp") < first_groups), unknown, first_groups, _scanner(known, k, False), "query_id long, least double")
    sure = materialize(_kth(sure, "least", k), "sure")
    reach = asked.join(sure.withColumnRenamed("query_id", "id"), "id", "left").withColumn("reach", F.coalesce("reach", F.lit(float("-inf"))))
    near = materialize(_met(cells, reach, groups, _scanner(known, k, True), "query_id long, rep long, most double"), "near")

    # The best by their bounds first; what they reach rules out most of the others.
    order = Window.partitionBy("query_id").orderBy(F.desc("most"), "rep")
    first = near.withColumn("_at", F.row_number().over(order)).filter(F.col("_at") <= 2 * k).drop("_at")
    read = materialize(_scored(first, exact, asked), "read")
    single = exact.select("rep", "ids")
    owned = lookup_join(read, single, ["rep"])
    mine = (F.size("ids") > 1) | (F.col("ids")[0]["id"] != F.col("query_id"))
    certain = _kth(owned.filter(mine).select("query_id", "score"), "score", k).withColumn("reach", F.col("reach").cast("double"))
    others = near.join(read.select("query_id", "rep"), ["query_id", "rep"], "left_anti")
    others = lookup_join(others, certain, ["query_id"], "left").filter("reach IS NULL OR most >= reach").select("query_id", "rep", "most")
    found = lookup_join(read.unionByName(_scored(others, exact, asked)), single, ["rep"])
    one = found.select("query_id", "score", F.explode("ids").alias("of")).filter("of.id <> query_id")
    each = one.select("query_id", "score", F.col("of.id").alias("vec_id"), F.explode(F.sequence(F.lit(1), F.col("of.n").cast("int"))).alias("_copy"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = each.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
