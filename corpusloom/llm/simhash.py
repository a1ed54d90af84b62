"""Near-duplicates by SimHash: close fingerprints share blocks, are joined on them and verified.

64 bits are cut into ``bits + 2`` blocks. Fingerprints that differ in at most ``bits``
bits agree on two blocks at least, so each fingerprint is filed under every pair of
blocks, and only fingerprints under the same key are compared. A key's fingerprints
are linked by growing clusters, which gives a spanning forest of the links and not
all pairs. A key with very many fingerprints is divided again by pairs of agreeing
blocks among its remaining bits, so that what a task holds at once stays bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from corpusloom.llm.carried import tidy
from corpusloom.llm.components import connected_components, join_apart
from corpusloom.workspace import materialize

BITS = 4
SHINGLE = 4
CROWDED = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a text; 0 if it has no words."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    size = min(shingle, len(words))
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - size + 1]
    digest = xxhash.xxh64_intdigest
    total, n = np.zeros(64, dtype=np.int64), len(starts)
    for low in range(0, n, 1 << 16):
        high = min(low + (1 << 16), n)
        spans = zip(starts[low:high].tolist(), ends[size - 1 + low : size - 1 + high].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], 42) for a, b in spans], dtype="<u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * total > n).tolist())


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = np.array([fingerprint(t.as_py()) for t in batch.column("text")], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(prints.view(np.int64))], ["id", "print"])
    tidy()


def _masks(bits: list[int], blocks: int, agree: int) -> list[int]:
    """Bit masks of every choice of ``agree`` of ``blocks`` near-equal blocks of the given bit positions."""
    parts = [sum(1 << int(b) for b in part) for part in np.array_split(bits, blocks)]
    return [sum(chosen) for chosen in combinations(parts, agree)]


def masks(bits: int = BITS) -> list[int]:
    """Masks of two agreeing blocks of ``bits + 2``."""
    return _masks(list(range(64)), bits + 2, 2)


def finer_masks(mask: int, bits: int = BITS) -> list[int]:
    """For fingerprints that agree on ``mask``: masks with two more agreeing blocks of the remaining bits."""
    rest = [b for b in range(64) if not mask >> b & 1]
    return [mask | more for more in _masks(rest, bits + 2, 2)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def forest(prints: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links (position, position) that span the clusters of distinct fingerprints at ``bits`` or fewer differing bits."""
    out, left = [], np.arange(len(prints))
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            at = front.pop()
            near = np.bitwise_count(prints[left] ^ prints[at]) <= bits
            if near.any():
                met = left[near]
                out.extend((int(at), int(x)) for x in met)
                front.extend(met)
                left = left[~near]
    return out


def _linker(chosen: list[int], bits: int, crowded: int):
    """Rows (kind, a, b) of rows (c, print) sorted by c and by print & chosen[c].

    Kind 0: fingerprints a and b are close. Kind 1: fingerprint a belongs to a crowded
    key of mask b, which is not searched here.
    """
    mask = np.array(chosen, dtype=np.uint64)

    def out(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        kinds = pa.array(np.full(len(a), kind, dtype=np.int32))
        return pa.RecordBatch.from_arrays([kinds, pa.array(a.view(np.int64)), pa.array(b)], ["kind", "a", "b"])

    def runs(c: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
        key = prints & mask[c]
        cut = np.flatnonzero((np.diff(c) != 0) | (np.diff(key) != 0)) + 1
        edges = np.concatenate([[0], cut, [len(c)]])
        size = np.diff(edges)
        two = edges[:-1][size == 2]
        a, b = prints[two], prints[two + 1]
        near = np.bitwise_count(a ^ b) <= bits
        yield out(0, a[near], b[near].view(np.int64))
        for low, high in zip(edges[:-1][size > 2], edges[1:][size > 2], strict=True):
            part = prints[low:high]
            links = np.array(forest(part, bits), dtype=np.int64).reshape(-1, 2)
            if len(links):
                yield out(0, part[links[:, 0]], part[links[:, 1]].view(np.int64))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_c, held = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        flowing = None  # the crowded key that is passed on
        for batch in batches:
            c = batch.column("c").to_numpy().astype(np.int64)
            prints = batch.column("print").to_numpy().view(np.uint64)
            if flowing is not None and len(c):
                same = (c == flowing[0]) & (prints & mask[c] == flowing[1])
                yield out(1, prints[same], c[same])
                flowing = flowing if same.all() else None
                c, prints = c[~same], prints[~same]
            c, prints = np.concatenate([held_c, c]), np.concatenate([held, prints])
            if not len(c):
                continue
            key = prints & mask[c]
            last = (c == c[-1]) & (key == key[-1])
            yield from runs(c[~last], prints[~last]) if not last.all() else ()
            held_c, held = c[last], prints[last]
            if len(held) > crowded:
                yield out(1, held, held_c)
                flowing = (held_c[0], held[0] & mask[held_c[0]])
                held_c, held = held_c[:0], held[:0]
        if len(held):
            yield from runs(held_c, held)

    return link


def _linked(filed: DataFrame, chosen: list[int], bits: int, crowded: int) -> DataFrame:
    key = F.col("print").bitwiseAND(F.element_at(F.array(*[F.lit(_signed(m)) for m in chosen]), F.col("c") + 1))
    n = int(filed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = filed.repartition(n, "c", key).sortWithinPartitions("c", key)
    return dealt.mapInArrow(_linker(chosen, bits, crowded), "kind int, a long, b long")


def close_links(prints: DataFrame, bits: int = BITS, crowded: int = CROWDED, rows: int | None = None) -> DataFrame:
    """(a, b): links that span the clusters of distinct fingerprints (print: long) at ``bits`` or fewer differing bits.

    A key of more than ``crowded`` fingerprints is filed again under two more agreeing
    blocks of its remaining bits: of those bits again at most ``bits`` differ. ``rows``
    is about the number of fingerprints, if known.
    """
    chosen = masks(bits)
    filed = prints.select(F.explode(F.array(*[F.lit(c) for c in range(len(chosen))])).alias("c"), "print")
    first = materialize(_linked(filed, chosen, bits, crowded), "links", rows and rows * len(chosen))
    finer = [finer_masks(m, bits) for m in chosen]
    flat = [m for group in finer for m in group]
    again = first.filter("kind = 1").select(
        F.explode(F.sequence(F.col("b") * len(finer[0]), (F.col("b") + 1) * len(finer[0]) - 1)).alias("c"),
        F.col("a").alias("print"),
    )
    again = again.withColumn("c", F.col("c").cast("int"))
    # What agrees on four blocks of six and then of the rest has few bits left to differ in.
    second = _linked(again, flat, bits, 1 << 62)
    return first.filter("kind = 0").select("a", "b").union(second.select("a", "b"))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, print): the fingerprint of every row's whole text as a signed long."""
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    return rows.mapInArrow(_fingerprints, "id long, print long").withColumnRenamed("id", "doc_id")


def near_duplicates(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """(doc_id, print, component_id) of every row of ``docs`` (doc_id, text).

    Documents are linked when their fingerprints differ in at most ``bits`` bits;
    component_id is the smallest doc_id reachable over links, the own one included. A
    text without words (null, empty, white space) has fingerprint 0 and is linked like
    any other. Equal fingerprints are one node, so copies cost one row each. A row
    without a doc_id is linked, but its id is never the smallest; a component without
    any id has component_id null. Repeated rows stay. Other columns are not looked at.
    """
    return _components(docs, bits).drop("root")


def _components(docs: DataFrame, bits: int) -> DataFrame:
    """:func:`near_duplicates` with ``root``, the same for the rows of a component."""
    prints = materialize(fingerprints(docs), "prints")
    nodes = materialize(prints.groupBy("print").agg(F.min("doc_id").alias("least")), "print-nodes", prints.count())
    n = nodes.count()
    return name_components(prints, nodes, close_links(nodes.select("print"), bits, rows=n), n)


def name_components(prints: DataFrame, nodes: DataFrame, links: DataFrame, rows: int | None = None) -> DataFrame:
    """(doc_id, print, component_id, root) of ``prints`` (doc_id, print), from ``nodes`` (print, least; ``rows`` of them, if known) and ``links`` (a, b) of prints."""
    roots = connected_components(links, rows=rows)
    named = join_apart(nodes, roots.withColumnRenamed("node", "print"), "print", "left")
    named = materialize(named.select("print", "least", F.coalesce("root", "print").alias("root")), "print-roots", rows)
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = join_apart(named.select("print", "root"), least, "root").select("print", "component_id", "root")
    return join_apart(prints, classes, "print").select("doc_id", "print", "component_id", "root")


def one_of_each(docs: DataFrame, bits: int = BITS) -> DataFrame:
    """``docs`` with one row of each component only, of its smallest doc_id; rows without a doc_id are all kept."""
    of_text = F.arrow_udf(lambda texts: pa.array(np.array([fingerprint(t.as_py()) for t in texts], dtype=np.uint64).view(np.int64)), LongType())
    # Else the join's test for nulls has every print made a second time.
    of_text = of_text.asNondeterministic()
    return choose(docs, _components(docs, bits), of_text)


def choose(docs: DataFrame, found: DataFrame, of_text) -> DataFrame:
    """:func:`one_of_each` by components (doc_id, print, component_id, root) that are already found; ``of_text`` gives a text's print.

    A doc_id may stand in several components and keeps a row in each whose smallest it
    is. Of several rows with that id the smallest print is kept, then the smallest hash
    of the text.
    """
    chosen = found.filter("doc_id = component_id").groupBy("root").agg(F.first("component_id").alias("doc_id"), F.min("print").alias("print"))
    # The row is one value here, so that its names meet no others.
    whole = docs.select(F.struct(*docs.columns).alias("row"), "doc_id")
    rows = whole.filter("doc_id IS NOT NULL").withColumn("print", of_text(F.col("row")["text"]))
    kept = rows.join(chosen.select("doc_id", "print"), ["doc_id", "print"], "left_semi")
    one = kept.groupBy("doc_id", "print").agg(F.min_by("row", F.xxhash64(F.col("row")["text"])).alias("row")).select("row")
    both = one.union(whole.filter("doc_id IS NULL").select("row"))
    return both.select(*[F.col("row")[c].alias(c) for c in docs.columns])
