"""Benchmark decontamination: windows of test words in a broadcast hash set, scanned over training words.

Words are hashed in whole arrays: a prefix sum over a text's bytes gives every word's
polynomial hash, ten of those give a window's. A window whose hash is in the set is
then compared word by word with the windows of that hash, so a collision never hits
and, equal windows having equal hashes, nothing is missed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.carried import Carried, tidy

WORDS = 10
# Benchmark text broadcast at once; a larger benchmark is scanned in several blocks.
BLOCK_BYTES = 16 << 20
SLICE = 1 << 19

_CLASS = np.zeros(256, dtype=bool)
_CLASS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 32
_BASE, _STEP = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_WRAP = (1 << 64) - 1


class Powers:
    """Powers of a number modulo 2^64, as many as were asked for so far."""

    def __init__(self, base: int):
        self.base, self.known = np.uint64(base), np.ones(1, dtype=np.uint64)

    def first(self, n: int) -> np.ndarray:
        if len(self.known) < n:
            out = np.full(2 * n, self.base, dtype=np.uint64)
            out[0] = 1
            self.known = np.multiply.accumulate(out)
        return self.known[:n]


_UP, _DOWN = Powers(_BASE), Powers(pow(_BASE, -1, 1 << 64))


class Words:
    """Bounds and hashes of the words of a text's bytes."""

    def __init__(self, data: np.ndarray):
        self.data = data
        inside = np.zeros(len(data) + 2, dtype=bool)
        inside[1:-1] = _CLASS[data]
        change = np.flatnonzero(inside[1:] != inside[:-1])
        self.start, self.end = change[::2], change[1::2]
        self.hash = np.empty(len(self.start), dtype=np.uint64)
        # Slices begin at words, so that memory stays bounded for any length of text.
        low = 0
        while low < len(self.start):
            high = max(low + 1, int(np.searchsorted(self.end, self.start[low] + SLICE, side="right")))
            begin = self.start[low]
            part = _FOLD[data[begin : self.end[high - 1]]].astype(np.uint64)
            sums = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum((part + np.uint64(1)) * _DOWN.first(len(part)), out=sums[1:])
            a, b = self.start[low:high] - begin, self.end[low:high] - begin
            word = (sums[b] - sums[a]) * _UP.first(len(part))[a] + (b - a).astype(np.uint64)
            self.hash[low:high] = word ^ (word >> np.uint64(31))
            low = high

    def windows(self, n: int) -> np.ndarray:
        """Hash of the n words that begin at each word."""
        count = len(self.hash) - n + 1
        if count <= 0:
            return np.zeros(0, dtype=np.uint64)
        out = self.hash[:count].copy()
        for k in range(1, n):
            out *= np.uint64(_STEP)
            out += self.hash[k : k + count]
        return out

    def text(self, first: int, n: int) -> bytes:
        """n words from ``first``, in lower case, with one space between."""
        return b" ".join(_FOLD[self.data[self.start[i] : self.end[i]]].tobytes() for i in range(first, first + n))


def _bytes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode(), dtype=np.uint8)


class TestSet(Carried):
    """Windows of a block of items, by window length.

    Arrays only: sorted hashes, the place of each window in the words of all items, which
    are kept once as bytes, and the item. A window costs about 40 bytes and its first word.
    """

    __test__ = False

    def __init__(self, items: list[tuple[str | None, str | None]]):
        self.items = [item for item, _ in items]
        words = [Words(_bytes(text)) for _, text in items]
        # The words of all items in lower case, each followed by a space.
        self.words = b"".join(w.text(0, len(w.hash)) + b" " for w in words if len(w.hash))
        lengths = [w.end - w.start + 1 for w in words]
        ends = np.cumsum(np.concatenate([np.zeros(1, np.int64), *lengths]))
        first = np.cumsum([0, *(len(x) for x in lengths)])
        self.at = ends.astype(np.int64)
        self.by_length: dict[int, dict[str, np.ndarray]] = {}
        for n in sorted({min(WORDS, len(w.hash)) for w in words} - {0}):
            own = [i for i, w in enumerate(words) if min(WORDS, len(w.hash)) == n]
            hashes = np.concatenate([words[i].windows(n) for i in own])
            place = np.concatenate([first[i] + np.arange(len(words[i].hash) - n + 1) for i in own])
            owner = np.concatenate([np.full(len(words[i].hash) - n + 1, i) for i in own])
            order = np.argsort(hashes, kind="stable")
            hashes, place, owner = hashes[order], place[order], owner[order]
            self.by_length[n] = {"hash": hashes, "place": place, "owner": owner}
            flags = np.zeros(1 << 20, dtype=bool)
            flags[hashes >> np.uint64(44)] = True
            self.by_length[n]["coarse"] = flags

    def _text(self, place: int, n: int) -> bytes:
        return self.words[self.at[place] : self.at[place + n] - 1]

    def scan(self, texts: list[str]) -> list[tuple[int, list[int], list[int], set]]:
        """Of each text: number of words, first words and lengths of the verified windows, and the items that they are from."""
        raw = [t.encode() for t in texts]
        words = Words(np.frombuffer(b"\n".join(raw), dtype=np.uint8))
        bounds = np.cumsum([0, *(len(r) + 1 for r in raw)])
        edge = np.searchsorted(words.start, bounds)
        out = [(int(n), [], [], set()) for n in np.diff(edge)]
        for n, known in self.by_length.items():
            windows = words.windows(n)
            near = np.flatnonzero(known["coarse"][windows >> np.uint64(44)])
            low = np.searchsorted(known["hash"], windows[near], side="left")
            high = np.searchsorted(known["hash"], windows[near], side="right")
            hit = high > low
            near, low, high = near[hit], low[hit], high[hit]
            doc = np.searchsorted(edge, near, side="right") - 1
            for i, d, a, b in zip(near.tolist(), doc.tolist(), low.tolist(), high.tolist(), strict=True):
                if i + n > edge[d + 1]:
                    continue  # reaches into the next text
                text = words.text(i, n)
                owners = {self.items[known["owner"][k]] for k in range(a, b) if self._text(known["place"][k], n) == text}
                if owners:
                    _, first, length, items = out[d]
                    first.append(i - int(edge[d]))
                    length.append(n)
                    items |= owners
        return out


def _groups(texts: list[str]) -> Iterator[list[str]]:
    """Texts in groups of about 250,000 characters, longer ones alone."""
    group, size = [], 0
    for text in texts:
        if group and size + len(text) > 250_000:
            yield group
            group, size = [], 0
        group.append(text)
        size += len(text)
    yield group


def _scanner(known):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = known.value
        for batch in batches:
            found = []
            for low in range(0, batch.num_rows, 500):
                texts = batch.column("row").field("text").slice(low, 500).to_pylist()
                found += [row for group in _groups([t or "" for t in texts]) for row in tests.scan(group)]
            columns = {c: batch.column(c) for c in batch.schema.names}
            columns["n_words"] = pa.array([n for n, _, _, _ in found], pa.int64())
            columns["first"] = pa.array([x for _, x, _, _ in found], pa.list_(pa.int64()))
            columns["length"] = pa.array([x for _, _, x, _ in found], pa.list_(pa.int64()))
            columns["items"] = pa.array([sorted(x for x in items if x is not None) for _, _, _, items in found], pa.list_(pa.string()))
            yield pa.RecordBatch.from_pydict(columns)
        tidy()

    return scan


def covered(first: str, length: str) -> Column:
    """Words inside any of the spans of two array columns."""
    spans = F.array_sort(F.arrays_zip(F.col(first).alias("at"), F.col(length).alias("n")))
    nothing = F.struct(F.lit(0).cast("long").alias("words"), F.lit(0).cast("long").alias("end"))

    def add(sum_: Column, span: Column) -> Column:
        end = span["at"] + span["n"]
        new = F.greatest(F.lit(0), end - F.greatest(span["at"], sum_["end"]))
        return F.struct((sum_["words"] + new).cast("long").alias("words"), F.greatest(end, sum_["end"]).cast("long").alias("end"))

    return F.aggregate(spans, nothing, add, lambda sum_: sum_["words"])


def blocks_of(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> list[DataFrame]:
    """The benchmark in blocks of about ``block_bytes`` of text, by a hash of the item."""
    total = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // block_bytes) or 1
    if n == 1:
        return [benchmark]
    return [benchmark.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k) for k in range(n)]


def _found(docs: DataFrame, benchmark: DataFrame, block_bytes: int) -> DataFrame:
    """(row, n_words, first, length, items, n_hit): each row of ``docs`` as a struct, so that its names meet no others."""
    spark = docs.sparkSession
    found = docs.select(F.struct(*docs.columns).alias("row"))
    for k, block in enumerate(blocks_of(benchmark, block_bytes)):
        rows = block.select(F.col("item_id").cast("string"), "text").collect()
        known = spark.sparkContext.broadcast(TestSet([tuple(r) for r in rows]))
        if k:
            found = found.select("row", F.struct("n_words", "first", "length", "items").alias("before"))
        now = ", ".join(f"{c} {kind}" for c, kind in found.dtypes)
        found = found.mapInArrow(_scanner(known), now + ", n_words long, first array<long>, length array<long>, items array<string>")
        if k:
            found = found.select(
                "row",
                "n_words",
                *[F.concat(f"before.{c}", c).alias(c) for c in ("first", "length")],
                F.array_sort(F.array_union("before.items", "items")).alias("items"),
            )
    return found.withColumn("n_hit", covered("first", "length"))


def find_leaks(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",), block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``keep`` columns of ``docs`` with n_words, first and length of the hit windows, n_hit and the sorted item ids.

    A window is WORDS consecutive words of an item's text, or all words of an item
    with fewer. A null or empty text has no words; an item without words has no
    window. Items are known by item_id as text; an item without an id hits words but
    is not listed. Repeated rows of either table are looked at like any other. Columns
    in ``keep`` may not have the names of the others; those not kept may.

    The hash set is broadcast in blocks of at most about ``block_bytes`` of benchmark
    text (one item is never divided), each some ten times that in arrays; with one
    block, the usual case, documents pass through one scan, and each further block
    scans what the one before has left.
    """
    named = dict.fromkeys([*keep, "text"])
    found = _found(docs.select(*named), benchmark, block_bytes)
    return found.select(*[F.col("row")[c].alias(c) for c in keep], "n_words", "first", "length", "n_hit", "items")


def remove_leaks(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the documents in which any benchmark window occurs; columns, of any names, and other rows stay as they are."""
    found = _found(docs, benchmark, block_bytes).filter("n_hit = 0")
    return found.select(*[F.col("row")[c].alias(c) for c in docs.columns])
