"""Runs of periodic words, found by uniting suffix classes in descending order of LCP.

The suffixes of a text's words are sorted, and the classes of neighbours are united from
the longest common prefix downwards, as Kruskal's algorithm does with the heaviest edges.
Each class keeps its positions in order. When two positions become neighbours in a united
class, the current LCP is theirs; where it reaches their distance, the words between them
repeat, and the stretch from the first to the end of the common prefix has that distance
as its smallest period. Every maximal run is met so exactly once from its first word.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST_LENGTH = 6
LEAST_EXPONENT = 4
# Words handled at once; a longer text is handled alone and whole.
BLOCK_WORDS = 1 << 18
# Positions in one sorted block of a class.
BLOCK = 1024

RUNS_TYPE = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


class Positions:
    """An ordered set of integers in sorted blocks, so that an insertion moves few of them."""

    __slots__ = ("blocks", "firsts", "size")

    def __init__(self, only: int):
        self.blocks, self.firsts, self.size = [[only]], [only], 1

    def __iter__(self) -> Iterator[int]:
        for block in self.blocks:
            yield from block

    def insert(self, x: int) -> tuple[int | None, int | None]:
        """Add ``x`` and return the members before and after it."""
        at = max(bisect_right(self.firsts, x) - 1, 0)
        block = self.blocks[at]
        i = bisect_right(block, x)
        before = block[i - 1] if i else None
        after = block[i] if i < len(block) else (self.firsts[at + 1] if at + 1 < len(self.firsts) else None)
        block.insert(i, x)
        if not i:
            self.firsts[at] = x
        if len(block) > 2 * BLOCK:
            self.blocks[at : at + 1] = [block[:BLOCK], block[BLOCK:]]
            self.firsts[at : at + 1] = [block[0], block[BLOCK]]
        self.size += 1
        return before, after


def newly_adjacent(large: Positions, small: Positions) -> Iterator[tuple[int, int]]:
    """Move ``small`` into ``large`` and yield the neighbours of the united set that were in different ones."""
    moved = list(small)
    last = None
    for x, following in zip(moved, [*moved[1:], None], strict=True):
        before, after = large.insert(x)
        if before is not None and before != last:
            yield before, x
        if after is not None and (following is None or following > after):
            yield x, after
        last = x


def least_prefix(least_length: int, least_exponent: int) -> int:
    """The shortest common prefix that seeds a wanted run: its length less its period."""
    return min(max(least_length - q, (least_exponent - 1) * q) for q in range(1, least_length + 1))


def _dense(*keys: np.ndarray) -> np.ndarray:
    """Rank of each tuple, equal for equal ones, in lexicographic order."""
    rank = keys[0]
    for key in keys[1:]:
        rank = np.unique(rank * (int(key.max(initial=0)) + 1) + key, return_inverse=True)[1]
    return rank


def _gram_ranks(ids: np.ndarray, n: int) -> np.ndarray:
    """Lexicographic rank of the ``n`` ids from each position on; what lies beyond the end counts as 0."""
    rank, held = np.unique(ids, return_inverse=True)[1], 1
    while held < n:
        step = min(held, n - held)
        rank = _dense(rank, np.concatenate([rank[step:], np.zeros(step, rank.dtype)]))
        held += step
    return rank


def suffix_neighbours(ids: np.ndarray, text_no: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a, b, lcp): neighbours in the sorted suffixes of each text that share ``least`` ids or more.

    ``ids`` are positive, and each text is followed by ``least`` zeros. Suffixes whose
    first ids stand nowhere else in their text are left out before the sort.
    """
    rank = _dense(_gram_ranks(ids, least), text_no)
    count = np.bincount(rank)
    active = np.flatnonzero((count[rank] > 1) & (ids > 0))
    if not len(active):
        return active, active, active
    first_class = rank
    # The rank of a group is the place of its first member, so that it stays valid when others are refined.
    place = np.cumsum(count) - count
    ranks = [place[rank]]
    width, shared = least, active
    while len(active):
        now = ranks[-1]
        key = now[active] * len(ids) + now[np.minimum(active + width, len(ids) - 1)]
        order = np.argsort(key, kind="stable")
        active, key = active[order], key[order]
        old = now[active]
        new_group = np.concatenate([[True], key[1:] != key[:-1]])
        old_group = np.concatenate([[True], old[1:] != old[:-1]])
        at = np.arange(len(active))
        moved = np.maximum.accumulate(np.where(new_group, at, 0)) - np.maximum.accumulate(np.where(old_group, at, 0))
        after = now.copy()
        after[active] = old + moved
        ranks.append(after)
        alone = new_group & np.concatenate([new_group[1:], [True]])
        active, width = active[~alone], 2 * width
    order = shared[np.argsort(ranks[-1][shared], kind="stable")]
    a, b = order[:-1], order[1:]
    same = first_class[a] == first_class[b]
    a, b = a[same], b[same]
    lcp = np.zeros(len(a), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        held, top = ranks[level], len(ids) - 1
        equal = held[np.minimum(a + lcp, top)] == held[np.minimum(b + lcp, top)]
        lcp += np.where(equal, least << level, 0)
    for _ in range(least - 1):
        lcp += (ids[a + lcp] == ids[b + lcp]) & (ids[a + lcp] > 0)
    return a, b, lcp


def seeds(a: np.ndarray, b: np.ndarray, lcp: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(position, period, lcp) of neighbours at a distance within their LCP, from the greatest LCP down."""
    root: dict[int, int] = {}
    held: dict[int, Positions] = {}

    def find(x: int) -> int:
        top = x
        while (up := root.get(top, top)) != top:
            top = up
        while (up := root.get(x, x)) != x:
            root[x], x = top, up
        return top

    order = np.argsort(-lcp, kind="stable")
    for x, y, shared in zip(a[order].tolist(), b[order].tolist(), lcp[order].tolist(), strict=True):
        x, y = find(x), find(y)
        large, small = held.get(x), held.get(y)
        large, small = large or Positions(x), small or Positions(y)
        if large.size < small.size:
            x, y, large, small = y, x, small, large
        root[y] = x
        held.pop(y, None)
        held[x] = large
        for before, after in newly_adjacent(large, small):
            if after - before <= shared:
                yield before, after - before, shared


def runs_of(texts: list[np.ndarray], least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT) -> list[list[tuple[int, int, int]]]:
    """For each array of positive ids its maximal runs (start, length, period), by start, then period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not texts:
        return out
    least = least_prefix(least_length, least_exponent)
    gap = np.zeros(least, np.int64)
    ids = np.concatenate([part for t in texts for part in (t, gap)])
    sizes = np.array([len(t) + least for t in texts])
    text_no = np.repeat(np.arange(len(texts)), sizes)
    begins = np.cumsum(sizes) - sizes
    for x, period, shared in seeds(*suffix_neighbours(ids, text_no, least)):
        length = period + shared
        # A run is told from its first word; a seed further right belongs to a run already begun.
        if length >= max(least_length, least_exponent * period) and (x == 0 or ids[x - 1] != ids[x - 1 + period]):
            out[text_no[x]].append((int(x - begins[text_no[x]]), length, period))
    for found in out:
        found.sort(key=lambda r: (r[0], r[2]))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run repeats, joined by one space."""
    if not runs:
        return b" ".join(words)
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return b" ".join([words[i] for i in np.flatnonzero(keep)])


def _numbered(words: list[list[bytes]]) -> list[np.ndarray]:
    known: dict[bytes, int] = {}
    return [np.fromiter((known.setdefault(w, len(known) + 1) for w in text), np.int64, len(text)) for text in words]


def _finder(least_length: int, least_exponent: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            low, words, n = 0, [], 0
            for i in range(len(batch)):
                # bytes.split cuts at exactly the six ASCII white-space characters.
                words.append((texts[i].as_py() or b"").split())
                n += len(words[-1])
                if n >= BLOCK_WORDS or i + 1 == len(batch):
                    found = runs_of(_numbered(words), least_length, least_exponent)
                    runs = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in of_text] for of_text in found]
                    kept = pa.array(map(collapse, words, found), pa.binary()).cast(pa.string())
                    part = batch.slice(low, i + 1 - low)
                    columns = [c for c, name in zip(part.columns, part.schema.names, strict=True) if name != "text"]
                    names = [name for name in part.schema.names if name != "text"]
                    yield pa.RecordBatch.from_arrays(
                        [*columns, pa.array([len(w) for w in words], pa.int64()), pa.array(runs, RUNS_TYPE), kept],
                        [*names, "n_words", "runs", "collapsed"],
                    )
                    low, words, n = i + 1, [], 0

    return find


def find_runs(
    docs: DataFrame, least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) of every row of ``docs``.

    Words are separated by ASCII white space and numbered from 0. A run is a stretch of
    words with smallest period q, of ``least_length`` words and ``least_exponent`` * q
    words at least, that no word beside it extends; ``runs`` holds (start, length,
    period) by start, then period. ``collapsed`` is the text without the words that
    stand in a run after its first q words, joined by one space.

    A null text has no words, no runs and an empty ``collapsed``. Every row gets a row,
    repeated ones and those without an id too; other columns are not looked at. A text
    is handled whole in one task, in memory in proportion to its words.
    """
    if least_exponent < 2 or least_length < 2:
        raise ValueError("a run holds two periods and two words at least")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    kind = f"doc_id {id_type}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    return rows.mapInArrow(_finder(least_length, least_exponent), kind)


def longest_run(runs: Column) -> Column:
    """The longest of ``runs``, ties to the smallest start, then period; null if there is none."""
    ranked = F.array_max(F.transform(runs, lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("short"))))
    return F.struct((-ranked["back"]).alias("start"), ranked["length"].alias("length"), (-ranked["short"]).alias("period"))


def runs_text(runs: Column) -> Column:
    """Every run as a line `start,length,period`."""
    return F.array_join(F.transform(runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
