"""Language identification by prediction by partial matching (PPM).

Every language has a tree of byte contexts of length 0 to ORDER with the bytes that
followed them in its training texts. A text's code length under a tree is the sum,
over its bytes, of -log2 of the byte's probability in the longest context that the
tree knows; each context that has not seen the byte costs its escape probability
(method C: distinct / (total + distinct)) before the next shorter one is asked, and
below the empty context all 256 bytes are alike. Statistics are frozen: coding a
text changes no count. The language with the shortest code wins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.carried import Carried, tidy

ORDER = 3
UNKNOWN = "und"
SLICE = 1 << 19
# Bytes counted at a time.
COUNTED = 1 << 21


@dataclass
class Trees(Carried):
    """The trees of all languages, as cost tables by context length.

    ``keys[k]`` are the sorted strings of k context bytes and one byte that any
    language knows, ``cost[k][lang]`` the bits of that byte after that context with
    all escapes included; ``contexts[k]`` and ``escape[k][lang]`` hold the escapes.
    """

    langs: list[str]
    keys: list[np.ndarray]
    cost: list[np.ndarray]
    contexts: list[np.ndarray]
    escape: list[np.ndarray]


def _grams(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each byte the number made of its ORDER predecessors in its text (0 where there are none) and itself."""
    gram = data.astype(np.uint32)
    for back in range(1, ORDER + 1):
        gram[back:] |= data[:-back].astype(np.uint32) << np.uint32(8 * back)
    for done in range(ORDER):
        at = starts + done
        gram[at[at < np.minimum(ends, len(data))]] &= np.uint32((1 << 8 * (done + 1)) - 1)
    return gram


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; nulls are empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def _tally(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, with the sums of their counts."""
    key, where = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(where, np.concatenate(counts), len(key)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n) of all texts of a task, counted in slices."""
    index: dict[str, int] = {}
    keys, counts, held = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], 0
    for batch in batches:
        data, at = _texts(batch.column("text"))
        names = batch.column("lang").dictionary_encode()
        number = np.array([index.setdefault(x, len(index)) for x in names.dictionary.to_pylist()], np.uint64)
        lang = number[names.indices.to_numpy()]
        for low in range(0, len(data), COUNTED):
            high = min(low + COUNTED, len(data))
            lead = max(0, low - ORDER)
            begins = slice(*np.searchsorted(at, [lead, high]))
            gram = _grams(data[lead:high], at[begins] - lead, at[begins.start + 1 : begins.stop + 1] - lead)[low - lead :]
            first, last = int(np.searchsorted(at, low, side="right")) - 1, int(np.searchsorted(at, high, side="left"))
            of = np.repeat(lang[first:last], np.diff(np.clip(at[first : last + 1], low, high)))
            key, n = np.unique(of << np.uint64(32) | gram, return_counts=True)
            keys.append(key)
            counts.append(n)
            held += len(key)
            if held > COUNTED:
                key, n = _tally(keys, counts)
                keys, counts, held = [key], [n], 0
    key, n = _tally(keys, counts)
    for low in range(0, len(key), 1 << 16):
        part = key[low : low + (1 << 16)]
        found = pa.array(list(index), pa.string()).take(pa.array((part >> np.uint64(32)).astype(np.int64)))
        grams = pa.array((part & np.uint64(0xFFFFFFFF)).astype(np.int64))
        yield pa.RecordBatch.from_arrays([found, grams, pa.array(n[low : low + (1 << 16)])], ["lang", "gram", "n"])
    tidy()


def build_trees(langs: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Trees:
    """Trees from counts of (language index, ORDER + 1 bytes)."""
    keys, cost, contexts, escape = [], [], [], []
    for k in range(ORDER + 1):
        short = gram & ((1 << 8 * (k + 1)) - 1)
        key, where = np.unique(short, return_inverse=True)
        count = np.zeros((len(langs), len(key)))
        np.add.at(count, (lang, where), n)
        context, inside = np.unique(key >> 8, return_inverse=True)
        total, distinct = np.zeros((len(langs), len(context))), np.zeros((len(langs), len(context)))
        np.add.at(total.T, inside, count.T)
        np.add.at(distinct.T, inside, (count > 0).T)
        with np.errstate(divide="ignore", invalid="ignore"):
            esc = np.where(total > 0, np.log2((total + distinct) / distinct), 0.0)
            seen = np.log2((total + distinct)[:, inside] / count)
        below = cost[-1][:, np.searchsorted(keys[-1], key & ((1 << 8 * k) - 1))] if k else 8.0
        keys.append(key.astype(np.uint32))
        cost.append(np.where(count > 0, seen, esc[:, inside] + below).astype(np.float32))
        contexts.append(context.astype(np.uint32))
        escape.append(esc.astype(np.float32))
    return Trees(langs, keys, cost, contexts, escape)


def _costs(trees: Trees, gram: np.ndarray, k: int) -> np.ndarray:
    """Bits by language of bytes with contexts, from order k down."""
    key = gram & np.uint32((1 << 8 * (k + 1)) - 1) if k < 3 else gram
    at = np.minimum(np.searchsorted(trees.keys[k], key), len(trees.keys[k]) - 1)
    out = trees.cost[k][:, at]
    missed = np.flatnonzero(trees.keys[k][at] != key)
    if len(missed):
        context = key[missed] >> np.uint32(8)
        near = np.minimum(np.searchsorted(trees.contexts[k], context), len(trees.contexts[k]) - 1)
        paid = np.where(trees.contexts[k][near] == context, trees.escape[k][:, near], 0.0)
        out[:, missed] = paid + (_costs(trees, gram[missed], k - 1) if k else 8.0)
    return out


def code_lengths(trees: Trees, column: pa.Array) -> np.ndarray:
    """Bits of every text (rows) under every language (columns)."""
    data, at = _texts(column)
    bits = np.zeros((len(trees.langs), len(column)))
    for low in range(0, len(data), SLICE):
        high = min(low + SLICE, len(data))
        lead = max(0, low - ORDER)
        begins = slice(*np.searchsorted(at, [lead, high]))
        ends = at[begins.start + 1 : begins.stop + 1] - lead
        gram = _grams(data[lead:high], at[begins] - lead, ends)[low - lead :]
        first = int(np.searchsorted(at, low, side="right")) - 1
        last = int(np.searchsorted(at, high, side="left"))
        inside = np.clip(at[first:last], low, high) - low
        docs = np.flatnonzero(np.diff(np.append(inside, high - low)) > 0)
        sums = np.add.reduceat(_costs(trees, gram, ORDER), inside[docs], axis=1, dtype=np.float64)
        bits[:, first + docs] += sums
    return bits.T


def labelled(docs: DataFrame) -> DataFrame:
    """(lang, text): every whole document of ``docs`` (doc_id, text, lang) with a text and a language that is not held out, in lower case."""
    known = docs.filter(~held_out(F.col("doc_id"))).filter("lang IS NOT NULL AND text IS NOT NULL")
    return known.select("lang", F.lower("text").alias("text"))


def learn(texts: DataFrame) -> Trees:
    """Trees of every value of ``lang`` in ``texts`` (lang, text).

    All texts are counted by tasks; the driver gets one row per language and different
    gram, the model itself: as many as languages have strings of ORDER + 1 bytes.
    """
    counted = texts.mapInArrow(_count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rows = counted.toArrow().combine_chunks()
    langs = sorted(pc.unique(rows.column("lang")).to_pylist())
    if not langs:
        return Trees([], [], [], [], [])
    lang = pc.index_in(rows.column("lang"), pa.array(langs)).to_numpy()
    return build_trees(langs, lang, rows.column("gram").to_numpy(), rows.column("n").to_numpy())


def train(docs: DataFrame) -> Trees:
    """Trees learned from all texts with a language in ``docs`` (text, lang)."""
    return learn(docs.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", F.lower("text").alias("text")))


def _judge(trees: Trees, docs: DataFrame):
    """A column function of lower-case text: the best language, its posterior, and its bits per byte."""
    known = docs.sparkSession.sparkContext.broadcast(trees)

    @F.arrow_udf("lang string, score double, bits double")
    def best(texts: pa.Array) -> pa.Array:
        trees = known.value
        if len(texts) and trees.langs:
            bits = code_lengths(trees, texts)
            lang = pa.array(trees.langs).take(pa.array(bits.argmin(axis=1)))
            odds = np.exp2(np.maximum(bits.min(axis=1)[:, None] - bits, -1000.0)).sum(axis=1)
            size = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)
            rate = bits.min(axis=1) / np.maximum(size, 1)
        else:
            lang, odds, rate = pa.array([UNKNOWN] * len(texts), pa.string()), np.full(len(texts), np.inf), np.full(len(texts), np.inf)
        tidy()
        return pa.StructArray.from_arrays([lang, pa.array(1.0 / odds), pa.array(rate)], ["lang", "score", "bits"])

    return best


def predict(docs: DataFrame, trees: Trees, text_col: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` to ``docs``; only ``text_col`` is looked at.

    score is the posterior probability of the predicted language with equal priors. A
    null text, a text without a letter, and every text when no language was learned
    get ``und`` and 0. Equal code lengths go to the first language by name. Other
    columns pass through; older columns of the two names are replaced.
    """
    found = docs.withColumn("_best", _judge(trees, docs)(F.lower(text_col)))
    worded = has_letter(F.col(text_col))
    return found.withColumns(
        {
            "lang_pred": F.when(worded, F.col("_best.lang")).otherwise(UNKNOWN),
            "score": F.when(worded, F.col("_best.score")).otherwise(0.0),
        }
    ).drop("_best")


def _own_bits(texts: DataFrame, trees: Trees, quantile: float) -> DataFrame:
    """(lang, bits): a quantile of the bits per byte of the ``texts`` judged to be in their own language, null where none is."""
    rated = texts.select("lang", _judge(trees, texts)("text").alias("of"))
    # A condition within the quantile: a filter would be pushed down and have every text judged a second time.
    own = F.when(F.expr("lang = of.lang"), F.col("of.bits"))
    return rated.groupBy("lang").agg(F.percentile_approx(own, quantile, 10_000).alias("bits"))


def most_bits(texts: DataFrame, trees: Trees, quantile: float = 0.99, factor: float = 2.5) -> dict[str, float]:
    """For every language the bits per byte above which a text is none of it: ``factor`` times a quantile of those of all its ``texts``."""
    return {r.lang: factor * r.bits for r in _own_bits(texts, trees, quantile).collect() if r.bits is not None}


def understood(docs: DataFrame, quantile: float = 0.99, factor: float = 2.5) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, lang, any others) whose text is in a learned language.

    Rejected are texts without a letter, null ones too, and those that cost more bits per
    byte in their best language than :func:`most_bits` allows: other languages, and text
    that is no language. The posterior says nothing there, as one language is always
    the least bad one by far. Where no language was learned every row goes.
    """
    texts = labelled(docs)
    trees = learn(texts)
    limits = most_bits(texts, trees, quantile, factor)
    if not limits:
        return docs.limit(0)
    limit = F.element_at(F.create_map(*[F.lit(x) for pair in limits.items() for x in pair]), F.col("best.lang"))
    # The row is one value here, so that its names meet no others.
    judged = docs.select(F.struct(*docs.columns).alias("row"), _judge(trees, docs)(F.lower("text")).alias("best"))
    kept = judged.filter(has_letter(F.col("row")["text"]) & (F.col("best.bits") <= limit))
    return kept.select(*[F.col("row")[c].alias(c) for c in docs.columns])


def has_letter(text: Column) -> Column:
    """Whether a text holds a letter of any script; false for null."""
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def held_out(doc_id: Column) -> Column:
    """Documents kept from training: crc32 of the id's text leaves 2 when divided by 4; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """``docs`` with ``held_out``, ``lang_pred`` and ``score``; trees are learned from all documents that are not held out."""
    trees = learn(labelled(docs))
    return predict(docs.withColumn("held_out", held_out(F.col("doc_id"))), trees)
