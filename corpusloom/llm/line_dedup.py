"""Removal of lines that many documents share, by a sharded minimal perfect hash.

1. Every line's key is hashed to 128 bits; documents and largest document are counted
   per distinct hash, pre-aggregated before each shuffle.
2. Distinct hashes are dealt into shards. A shard's task builds a minimal perfect hash
   and three compact arrays at its places: fingerprints, counts, largest documents.
3. Documents probe the arrays: their hashes travel to the shards, each shard's arrays
   are read once and the probes stream past them. No lines are joined with lines. A
   shard with more probes than the others (a hot line) is copied, and its probes are
   dealt over the copies.
4. Hashes to drop return to their documents, which are rewritten.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from corpusloom.llm.components import join_apart
from corpusloom.workspace import materialize

SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SHARD_LINES = 1 << 18
LEVELS = 24
# Counts stand in 32 bits.
MOST_DOCS = (1 << 32) - 1
INDEX = "shard int, n int, sizes array<int>, bits binary, rest binary, print binary, docs binary, last binary, load long"


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _place(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    step = np.uint64(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    return (_mix(h1 + step) ^ _mix(h2 ^ step)) % np.uint64(size)


class PerfectHash:
    """Minimal perfect hash of distinct (h1, h2): levels of bit arrays.

    A key takes the first level in which it is alone on its bit; its place is the
    number of bits set before. Keys still crowded after LEVELS levels are kept in a
    sorted list and take the places after all bits.
    """

    def __init__(self, sizes: list[int], bits: np.ndarray, rest: np.ndarray):
        self.sizes, self.bits, self.rest = sizes, bits, rest
        self.before = np.concatenate([[0], np.cumsum(bits, dtype=np.int64)])

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray) -> PerfectHash:
        sizes, levels = [], []
        for level in range(LEVELS):
            if not len(h1):
                break
            size = 2 * len(h1) + 1
            at = _place(h1, h2, level, size)
            alone = np.bincount(at.astype(np.int64), minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            left = ~alone[at]
            h1, h2 = h1[left], h2[left]
        rest = np.empty(len(h1), dtype=[("h1", "<u8"), ("h2", "<u8")])
        rest["h1"], rest["h2"] = h1, h2
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, bool), np.sort(rest))

    def places(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Places of keys; a key outside the set may get any place, or -1."""
        out = np.full(len(h1), -1, dtype=np.int64)
        open_, base = np.arange(len(h1)), 0
        for level, size in enumerate(self.sizes):
            at = base + _place(h1[open_], h2[open_], level, size).astype(np.int64)
            hit = self.bits[at]
            out[open_[hit]] = self.before[at[hit]]
            open_, base = open_[~hit], base + size
        if len(open_) and len(self.rest):
            key = np.empty(len(open_), dtype=self.rest.dtype)
            key["h1"], key["h2"] = h1[open_], h2[open_]
            at = np.minimum(np.searchsorted(self.rest, key), len(self.rest) - 1)
            out[open_[self.rest[at] == key]] = self.before[-1] + at[self.rest[at] == key]
        return out


def _unsigned(column) -> np.ndarray:
    return column.to_numpy().astype(np.int64).view(np.uint64)


def _build(table: pa.Table) -> pa.Table:
    """One index row of one shard of (shard, h1, h2, docs, last, load)."""
    h1, h2 = _unsigned(table["h1"]), _unsigned(table["h2"])
    perfect = PerfectHash.build(h1, h2)
    at = perfect.places(h1, h2)

    def laid(values: np.ndarray) -> bytes:
        out = np.empty_like(values)
        out[at] = values
        return out.tobytes()

    row = {
        "shard": table["shard"][0].as_py(),
        "n": len(h1),
        "sizes": perfect.sizes,
        "bits": np.packbits(perfect.bits).tobytes(),
        "rest": perfect.rest.tobytes(),
        "print": laid((h2 >> np.uint64(32)).astype(np.uint32)),
        "docs": laid(np.minimum(table["docs"].to_numpy(), MOST_DOCS).astype(np.uint32)),
        "last": laid(table["last"].fill_null(0).to_numpy().astype(np.int64)),
        "load": int(table["load"].to_numpy().sum()),
    }
    kinds = [pa.int32(), pa.int32(), pa.list_(pa.int32()), *[pa.binary()] * 5, pa.int64()]
    return pa.table({k: pa.array([v], type=t) for (k, v), t in zip(row.items(), kinds, strict=True)})


class _Shard:
    def __init__(self, row: dict):
        bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=sum(row["sizes"])).astype(bool)
        rest = np.frombuffer(row["rest"], dtype=[("h1", "<u8"), ("h2", "<u8")])
        self.perfect = PerfectHash(row["sizes"], bits, rest)
        self.print = np.frombuffer(row["print"], np.uint32)
        self.docs = np.frombuffer(row["docs"], np.uint32)
        self.last = np.frombuffer(row["last"], np.int64)


def _prober(least_docs: int):
    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = None
        for batch in batches:
            heads = np.flatnonzero(np.asarray(batch.column("n").is_valid()))
            edges = [0, *heads, batch.num_rows]
            for low, high in zip(edges, edges[1:], strict=False):
                part = batch.slice(low, high - low)
                if part.num_rows and low in heads:
                    shard = _Shard(part.slice(0, 1).to_pylist()[0])
                    part = part.slice(1)
                if not part.num_rows:
                    continue
                h1, h2 = _unsigned(part.column("h1")), _unsigned(part.column("h2"))
                at = shard.perfect.places(h1, h2)
                drop = (at >= 0) & (shard.print[at] == (h2 >> np.uint64(32))) & (shard.docs[at] >= least_docs)
                ids = part.column("id")
                own = np.asarray(ids.fill_null(0)) == shard.last[at]
                drop &= ~(own & np.asarray(ids.is_valid()))
                yield pa.RecordBatch.from_arrays([part.column(c).filter(pa.array(drop)) for c in ("row", "h1")], ["row", "h1"])

    return probe


def line_key(line: Column) -> Column:
    """A line without white space at its ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(SPACE)), UPPER, LOWER)


def line_hashes(docs: DataFrame, least_chars: int) -> DataFrame:
    """(id, row, h1, h2): one row per distinct long enough line key of each row of ``docs`` (id, row, text)."""
    keys = F.array_distinct(F.transform(F.split("text", "\n", -1), line_key))
    lines = docs.filter("text IS NOT NULL").select("id", "row", F.explode(keys).alias("key")).filter(F.char_length("key") >= least_chars)
    return lines.select("id", "row", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(2), "key").alias("h2"))


def build_index(hashes: DataFrame) -> tuple[DataFrame, int]:
    """Index rows by shard, and the number of shards."""
    spark = hashes.sparkSession
    # Counting distinct ids is pre-aggregated by (hash, id) and then again by hash.
    counts = hashes.groupBy("h1", "h2").agg(
        F.countDistinct("id").alias("docs"), F.max("id").alias("last"), F.count(F.lit(1)).alias("load")
    )
    counts = materialize(counts, "line-counts")
    n = counts.count()
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // SHARD_LINES))
    dealt = counts.withColumn("shard", F.pmod(F.hash("h1", "h2"), F.lit(shards)))
    return materialize(dealt.groupBy("shard").applyInArrow(_build, INDEX), "line-index", n), shards


def _probe(hashes: DataFrame, index: DataFrame, shards: int, least_docs: int) -> DataFrame:
    """(row, h1) of the lines that go."""
    loads = {r.shard: r.load for r in index.select("shard", "load").collect()}
    usual = 2 * max(1, sum(loads.values()) // shards)
    copies = F.array(*[F.lit(-(-loads.get(s, 0) // usual) or 1) for s in range(shards)])
    arrays = [c for c in index.columns if c not in ("shard", "load")]
    of = lambda df: F.element_at(copies, F.col("shard") + 1)
    heads = index.withColumn("copy", F.explode(F.sequence(F.lit(0), of(index) - 1)))
    heads = heads.select("shard", "copy", *[F.lit(None).cast("long").alias(c) for c in ("id", "row", "h1", "h2")], *arrays)
    asked = hashes.withColumn("shard", F.pmod(F.hash("h1", "h2"), F.lit(shards)))
    asked = asked.withColumn("copy", F.pmod(F.hash("row"), of(asked)))
    kinds = dict(index.dtypes)
    asked = asked.select("shard", "copy", "id", "row", "h1", "h2", *[F.lit(None).cast(kinds[c]).alias(c) for c in arrays])
    both = heads.unionByName(asked).repartition(shards, "shard", "copy")
    both = both.sortWithinPartitions("shard", "copy", F.col("n").isNull())
    return both.mapInArrow(_prober(least_docs), "row long, h1 long")


KEPT = StructType([StructField("n_dropped", LongType()), StructField("kept", StringType())])


@F.arrow_udf(KEPT)
def _rewrite(texts: pa.Array, gone: pa.Array) -> pa.Array:
    """Number of lines dropped, and the lines kept where any line is."""
    import xxhash

    counts, kept = [], []
    for text, hashes in zip(texts, gone, strict=True):
        n, lines = 0, None
        if hashes.is_valid and text.is_valid:
            drop, lines = {x & 0xFFFFFFFFFFFFFFFF for x in hashes.as_py()}, []
            for line in text.as_py().split("\n"):
                if xxhash.xxh64_intdigest(line.strip(SPACE).encode().lower(), 42) in drop:
                    n += 1
                else:
                    lines.append(line)
        counts.append(n)
        kept.append(None if lines is None else "\n".join(lines))
    return pa.StructArray.from_arrays([pa.array(counts, pa.int64()), pa.array(kept, pa.string())], ["n_dropped", "kept"])


# Else a filter on the result has every text rewritten a second time.
_rewrite = _rewrite.asNondeterministic()


def dedup_lines(docs: DataFrame, least_chars: int = 20, least_docs: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, n_lines, n_dropped, text) and the columns of ``keep``, a row per row of ``docs``.

    Lines end at \\n; a null or empty text is one empty line. A key (:func:`line_key`)
    of at least ``least_chars`` code points found in at least ``least_docs`` distinct
    doc_id loses all its lines except in the largest doc_id that holds it. text has
    the lines that stay; a document that loses all has an empty text. Rows with the
    same doc_id are one document and all keep their rows; a row without a doc_id
    counts as no document and is never the largest. Other columns are not looked at.
    """
    # A row's own key, so that rows without an id, or with one that repeats, meet their own lines alone.
    own = F.xxhash64(F.col("doc_id").cast("long"), "text").alias("row")
    plain = docs.select(F.col("doc_id").cast("long").alias("id"), own, "text")
    hashes = line_hashes(plain, least_chars)
    index, shards = build_index(hashes)
    gone = _probe(hashes, index, shards, least_docs)
    gone = gone.groupBy("row").agg(F.collect_set("h1").alias("gone"))
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), own, F.col("text").alias("text"), F.struct(*keep).alias("keep") if keep else F.lit(0).alias("keep"))
    joined = join_apart(rows, gone, "row", "left")
    text = F.coalesce("text", F.lit(""))
    done = joined.withColumn("new", F.when(F.col("gone").isNotNull(), _rewrite("text", "gone")))
    return done.select(
        F.col("id").alias("doc_id"),
        F.size(F.split(text, "\n", -1)).cast("long").alias("n_lines"),
        F.coalesce("new.n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce("new.kept", text).alias("text"),
        *[F.col(f"keep.{c}").alias(c) for c in keep],
    )
