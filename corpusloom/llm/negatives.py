"""Hard negatives by exact integer scores from products modulo small primes.

Integer vectors are held as their remainders modulo several primes below 256. Products of
remainder matrices are exact in float32, and Chinese remaindering of the products gives
the signed score whenever the product of the primes exceeds twice the greatest score that
is possible. Anchors meet all rows in blocks: rows are dealt into groups of bounded size,
a task holds the remainders of one group, and blocks of anchors pass through it. The first
pass finds each anchor's positives, the second the best rows in the window that each
positive opens.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.workspace import materialize

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
# Rows whose remainders a task holds, and the sides of one product.
GROUP_ROWS = 1 << 16
ROWS = 4096
ANCHORS = 512
# Dimensions added up in float32 before the sum is reduced: 128 * 125**2 is exact, and its quotient by a prime rounds rightly.
SLICE = 128
NONE = np.iinfo(np.int64).min
# The largest primes below 256: halves of their remainders fit a byte.
PRIMES = [p for p in range(255, 2, -2) if all(p % d for d in range(3, 16, 2))]


def _reduced(x: np.ndarray, p: int) -> np.ndarray:
    """``x`` (float32, changed in place) modulo ``p``, between -p/2 and p/2."""
    x -= np.float32(p) * np.rint(x * np.float32(1 / p))
    return x


class Residues:
    """An integer matrix and its remainders by prime, between -p/2 and p/2."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        self.most = max(int(matrix.max(initial=0)), -int(matrix.min(initial=0)))
        self.by_prime: dict[int, np.ndarray] = {}

    def of(self, p: int) -> np.ndarray:
        if p not in self.by_prime:
            r = np.mod(self.matrix, p)
            self.by_prime[p] = np.where(r > p // 2, r - p, r).astype(np.int8)
        return self.by_prime[p]


def primes_for(bound: int) -> list[int]:
    """The fewest of the largest primes whose product tells all integers from -bound to bound apart."""
    chosen, product = [], 1
    for p in PRIMES:
        if product > 2 * bound:
            break
        chosen.append(p)
        product *= p
    return chosen


def _product_mod(a: np.ndarray, b: np.ndarray, p: int) -> np.ndarray:
    total = None
    for low in range(0, a.shape[1], SLICE):
        part = _reduced(a[:, low : low + SLICE].astype(np.float32) @ b[:, low : low + SLICE].astype(np.float32).T, p)
        total = part if total is None else _reduced(total + part, p)
    return np.zeros((len(a), len(b)), np.float32) if total is None else total


def scores(a: Residues, b: Residues, a_rows, b_rows) -> np.ndarray:
    """Exact inner products of the chosen rows as int64; NONE where one does not fit 64 bits.

    The remainders give the digits of the score in the mixed radix of the primes, each
    between -p/2 and p/2, so that the sign comes by itself.
    """
    bound = a.matrix.shape[1] * a.most * b.most
    digits: list[np.ndarray] = []
    total, rough, radix = None, None, 1
    primes = primes_for(bound)
    for k, p in enumerate(primes):
        left = _product_mod(a.of(p)[a_rows], b.of(p)[b_rows], p)
        weight = 1
        for digit, q in zip(digits, primes, strict=False):
            centred = weight - p if weight > p // 2 else weight
            left = _reduced(left - digit * np.float32(centred), p)
            weight = weight * q % p
        if k:
            inverse = pow(radix, -1, p)
            left = _reduced(left * np.float32(inverse - p if inverse > p // 2 else inverse), p)
        digits.append(left)
        # Sums wrap round in 64 bits; the result is right wherever it fits.
        part = left.astype(np.int64).view(np.uint64) * np.uint64(radix % (1 << 64))
        total = part if total is None else total + part
        if bound >= 1 << 63:
            rough = left * float(radix) if rough is None else rough + left.astype(np.float64) * float(radix)
        radix *= p
    if total is None:
        shape = (len(a.matrix[a_rows]), len(b.matrix[b_rows]))
        return np.zeros(shape, np.int64)
    out = total.view(np.int64)
    if rough is not None:
        out[np.abs(rough) >= 2.0**63] = NONE
    return out


def _best(found: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(scores, ids) of the k highest entries of each row, ties to the earlier column; ``found`` is changed."""
    out_s = np.full((len(found), k), NONE)
    out_i = np.zeros((len(found), k), np.int64)
    if not found.shape[1]:
        return out_s, out_i
    line = np.arange(len(found))
    for j in range(k):
        at = found.argmax(axis=1)
        out_s[:, j], out_i[:, j] = found[line, at], ids[at]
        found[line, at] = NONE
    return out_s, out_i


def _merged(s: np.ndarray, i: np.ndarray, more_s: np.ndarray, more_i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best of two lists per row, ties to the smaller id."""
    both_s, both_i = np.concatenate([s, more_s], axis=-1), np.concatenate([i, more_i], axis=-1)
    # Scores are negated by complement, which keeps their order at both ends.
    order = np.lexsort((both_i, ~both_s), axis=-1)[..., : s.shape[-1]]
    return np.take_along_axis(both_s, order, -1), np.take_along_axis(both_i, order, -1)


class Held:
    """Rows of one group and dimension: ids ascending, labels, remainders."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, matrix: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels, self.residues = ids[order], labels[order], Residues(matrix[order])

    def of_label(self, label: int) -> np.ndarray:
        return np.flatnonzero(self.labels == label)


def positives(held: Held, ids: np.ndarray, labels: np.ndarray, anchors: Residues, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(scores, ids), k per anchor: the best other rows of its label."""
    best_s, best_i = np.full((len(ids), k), NONE), np.zeros((len(ids), k), np.int64)
    for label in np.unique(labels):
        mine, rows = np.flatnonzero(labels == label), held.of_label(label)
        for low in range(0, len(rows), ROWS):
            some = rows[low : low + ROWS]
            found = scores(anchors, held.residues, mine, some)
            found[ids[mine][:, None] == held.ids[some][None, :]] = NONE
            best_s[mine], best_i[mine] = _merged(best_s[mine], best_i[mine], *_best(found, held.ids[some], k))
    return best_s, best_i


def negatives(held: Held, labels: np.ndarray, anchors: Residues, low_s: np.ndarray, high_s: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(scores, ids), k per anchor and window: the best rows of another label from ``low_s`` to ``high_s``."""
    best_s = np.full((*low_s.shape, k), NONE)
    best_i = np.zeros((*low_s.shape, k), np.int64)
    for low in range(0, len(held.ids), ROWS):
        some = slice(low, low + ROWS)
        found = scores(anchors, held.residues, slice(None), some)
        found[labels[:, None] == held.labels[some][None, :]] = NONE
        for j in range(low_s.shape[1]):
            inside = np.where((found >= low_s[:, j, None]) & (found <= high_s[:, j, None]), found, NONE)
            best_s[:, j], best_i[:, j] = _merged(best_s[:, j], best_i[:, j], *_best(inside, held.ids[some], k))
    return best_s, best_i


def window(positive: np.ndarray, low: tuple[int, int], high: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest integer between ``low`` and ``high`` parts of a score, without wide products."""

    def share(x: np.ndarray, part: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
        whole, rest = np.divmod(x, part[1])
        return whole * part[0] + rest * part[0] // part[1], rest * part[0] % part[1] > 0

    floor, over = share(positive, low)
    return floor + over, share(positive, high)[0]


def _matrix(column: pa.ListArray, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dim)


def _groups(batches: Iterator[pa.RecordBatch], answer: Callable) -> Iterator[pa.RecordBatch]:
    """Run ``answer(held, anchors)`` for each block of anchors; batches are sorted by group, dimension and kind, rows first."""
    held, at, parts, waiting = None, None, [], []

    def flush() -> Iterator[pa.RecordBatch]:
        if waiting and held is not None:
            yield from answer(held, pa.Table.from_batches(waiting).combine_chunks().to_batches()[0])
        waiting.clear()

    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in ("grp", "dim", "kind")], axis=1)
        starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)])) if len(keys) else []
        for low, high in zip(starts, [*starts[1:], len(keys)], strict=True):
            group, kind = tuple(keys[low, :2]), keys[low, 2]
            if group != at:
                yield from flush()
                held, at, parts = None, group, []
            part = batch.slice(low, high - low)
            if kind == 0:
                parts.append((part.column("id").to_numpy(), part.column("label").to_numpy(), _matrix(part.column("v"), int(group[1]))))
                continue
            if parts:
                held = Held(*[np.concatenate(c) for c in zip(*parts, strict=True)])
                parts = []
            if held is None:
                continue
            for i in range(0, len(part), ANCHORS):
                waiting.append(part.slice(i, ANCHORS))
                if sum(map(len, waiting)) >= ANCHORS:
                    yield from flush()
    yield from flush()


def _positive_finder(k: int):
    def answer(held: Held, block: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, labels = block.column("id").to_numpy(), block.column("label").to_numpy()
        dim = int(block.column("dim")[0].as_py())
        best_s, best_i = positives(held, ids, labels, Residues(_matrix(block.column("v"), dim)), k)
        told = best_s != NONE
        owner = np.repeat(ids, told.sum(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (owner, best_i[told], best_s[told])], ["anchor_id", "positive_id", "positive_score"])

    return lambda batches: _groups(batches, answer)


def _negative_finder(most_positives: int, k: int, low: tuple[int, int], high: tuple[int, int]):
    def answer(held: Held, block: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids, labels = block.column("id").to_numpy(), block.column("label").to_numpy()
        dim = int(block.column("dim")[0].as_py())
        lists = block.column("positives")
        sizes = lists.value_lengths().to_numpy()
        told = np.arange(most_positives)[None, :] < sizes[:, None]
        p_ids, p_scores = np.zeros(told.shape, np.int64), np.zeros(told.shape, np.int64)
        flat = lists.flatten()
        p_ids[told], p_scores[told] = flat.field("id").to_numpy(), flat.field("score").to_numpy()
        low_s, high_s = window(p_scores, low, high)
        high_s[~told] = NONE
        low_s[~told] = 0
        best_s, best_i = negatives(held, labels, Residues(_matrix(block.column("v"), dim)), low_s, high_s, k)
        owner, rank, j = np.nonzero(best_s != NONE)
        columns = [ids[owner], rank + 1, p_ids[owner, rank], p_scores[owner, rank], best_i[owner, rank, j], best_s[owner, rank, j]]
        names = ["anchor_id", "positive_rank", "positive_id", "positive_score", "negative_id", "negative_score"]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names)

    return lambda batches: _groups(batches, answer)


def integer_vectors(vectors: DataFrame, label: Column, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, label, v, dim): floor(scale * component) as long; rows that take no part in :func:`hard_negatives` are left out."""
    v = F.transform(vector_col, lambda x: x.cast("double"))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"), v.alias("v"))
    rows = rows.filter("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL")
    rows = rows.filter(F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))
    return rows.select("id", "label", F.transform("v", lambda x: F.floor(x * scale)).alias("v"), F.size("v").alias("dim"))


def _met(rows: DataFrame, anchors: DataFrame, groups: int, finder, kind: str) -> DataFrame:
    """Blocks of ``anchors`` against all ``rows``, which carry their group."""
    extra = [c for c in anchors.columns if c not in rows.columns]
    types = dict(anchors.dtypes)
    left = rows.select(F.lit(0).alias("kind"), *rows.columns, *[F.lit(None).cast(types[c]).alias(c) for c in extra])
    copies = anchors.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    right = copies.select(F.lit(1).alias("kind"), *rows.columns, *extra)
    dealt = left.unionByName(right).repartition(groups, "grp").sortWithinPartitions("grp", "dim", "kind")
    return dealt.mapInArrow(finder, kind)


def hard_negatives(
    rows: DataFrame,
    every: int = 50,
    most_positives: int = POSITIVES,
    most_negatives: int = NEGATIVES,
    low: tuple[int, int] = (50, 100),
    high: tuple[int, int] = (95, 100),
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of ``rows`` from :func:`integer_vectors`.

    Anchors are the rows whose id is divisible by ``every``; of several rows with an
    anchor's id the smallest label, then vector, asks. An anchor's positives are the
    ``most_positives`` rows of its label and of another id with the highest inner
    products, ties to the smaller id. For each the first ``most_negatives`` rows of
    another label are returned whose score lies between ``low`` and ``high`` (as
    fractions) of the positive's. Repeated rows are rows each, also as positives.
    Vectors of another length than the anchor's are neither positives nor negatives of
    it. Scores are exact; a pair whose score does not fit 64 bits takes no part, and a
    component beyond 64 bits counts as the nearest long. An anchor without positives or
    a positive without rows in its window has no rows here.

    Every anchor meets every row, in blocks: 2 % of the rows are copied once per group
    of GROUP_ROWS rows, and each task returns a few rows per anchor, so the merge is
    small. Groups are dealt by a hash of the row's place, whatever the ids.
    """
    spark = rows.sparkSession
    stored = materialize(rows, "vectors")
    count = stored.count()
    groups = max(-(-count // GROUP_ROWS), min(3 * spark.sparkContext.defaultParallelism, -(-count // 1024)), 1)
    place = F.xxhash64("id", F.monotonically_increasing_id())
    dealt = stored.select("*", F.pmod(place, F.lit(groups)).cast("int").alias("grp"))
    asked = stored.filter(F.col("id") % every == 0).groupBy("id").agg(F.min(F.struct("label", "v", "dim")).alias("row")).select("id", "row.*")
    asked = materialize(asked, "anchors")

    found = _met(dealt, asked, groups, _positive_finder(most_positives), "anchor_id long, positive_id long, positive_score long")
    best = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    first = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= most_positives)
    one = F.struct("rank", F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))
    lists = first.groupBy(F.col("anchor_id").alias("id")).agg(F.sort_array(F.collect_list(one)).alias("positives"))
    paired = materialize(asked.join(lists, "id"), "positives")

    schema = "anchor_id long, positive_rank long, positive_id long, positive_score long, negative_id long, negative_score long"
    near = _met(dealt, paired, groups, _negative_finder(most_positives, most_negatives, low, high), schema)
    best = Window.partitionBy("anchor_id", "positive_rank").orderBy(F.desc("negative_score"), "negative_id")
    ranked = near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= most_negatives)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
