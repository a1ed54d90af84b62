"""Mixing sources to target weights by exact cuts in a random order of each source.

Every document has a key that is a hash of its id and text. The rows of each source are
sorted by key in ranges; sums of the ranges and sums inside them make the prefix sum of
words before each key. A source's budget is its whole size some times over and a rest;
the key at which the prefix sum reaches the rest is the cut. Documents below it are taken
once more than those above, and the document at the cut gives the words that are missing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.joins import lookup_join
from corpusloom.workspace import materialize

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_EPOCHS = 2
SEED = "mix"
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
# A table of cuts is sent to every executor up to this many bytes.
SENT_BYTES = 16 << 20


def source_key(source: Column) -> Column:
    """A text that is never null and orders sources by code point, null last."""
    return F.coalesce(F.concat(F.lit("="), source), F.lit("~"))


def mixing_key(doc_id: Column, text: Column, seed: str = SEED) -> Column:
    """60 bits of a hash of the seed, the id and the text; equal rows have equal keys."""
    whole = F.concat_ws("\n", F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("")), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(whole.cast("binary")), 1, 15), 16, 10).cast("long")


def prefix_sums(rows: DataFrame, group: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """``rows`` with `<value>_before`: the sum of each value over the rows of the group that come earlier in ``order``.

    Rows are sorted in ranges over group and order, so a group of any size spreads over
    many tasks. One row per range and group is summed for the offsets. ``order`` should
    tell the rows of a group apart.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(n, *group, *order).withColumn("_range", F.spark_partition_id())
    ranged = materialize(ranged, "ranged")
    sums = ranged.groupBy(*group, "_range").agg(*[F.sum(v).alias(f"{v}_sum") for v in values])
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*group, "_range", *[F.coalesce(F.sum(f"{v}_sum").over(earlier), F.lit(0)).alias(f"{v}_offset") for v in values])
    inside = Window.partitionBy(*group, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumns({f"{v}_before": F.coalesce(F.sum(v).over(inside), F.lit(0)) for v in values}).join(offsets, [*group, "_range"])
    total = {f"{v}_before": F.col(f"{v}_before") + F.col(f"{v}_offset") for v in values}
    return placed.withColumns(total).select(*rows.columns, *total)


def repeating_weights(totals: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """``totals`` (source_key, ...) with ``weight``: the weights in turn, by the order of the keys."""
    numbered = prefix_sums(totals.withColumn("_one", F.lit(1).cast("long")), [], ["source_key"], ["_one"])
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_one_before") % len(weights) + 1).cast("int"))
    return numbered.withColumn("weight", turn).drop("_one", "_one_before")


def targets(totals: DataFrame, share: float = SHARE, most: int = MOST_EPOCHS) -> DataFrame:
    """``totals`` (source_key, words, weight) with ``target``: ``share`` of all words, dealt by weight, at most ``most`` times a source.

    What a source cannot take is dealt again among the others until none is above its
    bound. By rising ratio of bound to weight the sources at their bound are the first
    ones, so one pass of prefix sums finds the level of the others. A source whose
    weight is null, zero or negative gets nothing.
    """
    rows = totals.withColumn("weight", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)).cast("double"))
    rows = rows.withColumn("bound", F.col("words") * most).withColumn("_ratio", F.col("bound") / F.nullif("weight", F.lit(0.0)))
    placed = materialize(prefix_sums(rows.filter("weight > 0"), [], ["_ratio", "source_key"], ["bound", "weight"]), "placed")
    weights = placed.agg(F.sum("weight").alias("all")).first()["all"] or 0.0
    wanted = share * (rows.agg(F.sum("words").alias("all")).first()["all"] or 0)
    left, over = wanted - F.col("bound_before"), weights - F.col("weight_before")
    unbounded = placed.filter(F.col("bound") * over > F.col("weight") * left)
    row = unbounded.agg(F.min(F.struct("_ratio", "source_key", left.alias("left"), over.alias("over"))).alias("level")).first().level
    bound = F.col("bound").cast("double")
    if row is None:  # every source is at its bound
        dealt = bound
    else:
        dealt = F.least(bound, F.col("weight") * F.lit(float(row.left)) / F.lit(float(row.over)))
    return rows.withColumn("target", F.when(F.col("weight") > 0, dealt).otherwise(0.0)).drop("bound", "_ratio")


def cuts(sized: DataFrame, wanted: DataFrame) -> DataFrame:
    """(source_key, words, target, whole, rest, cut_key, cut_rest, cut_words) of ``sized`` (source_key, key, size) under ``wanted`` (source_key, words, target).

    A source is taken ``whole`` times; the ``rest`` of its words ends in the rows of
    ``cut_key``, which hold ``cut_words`` and give ``cut_rest`` of them.
    """
    budget = F.floor("target").cast("long")
    some = F.when(F.col("words") > 0, F.col("words"))
    wanted = wanted.select("source_key", "words", "target", F.coalesce(F.floor(budget / some), F.lit(0)).cast("long").alias("whole"))
    wanted = wanted.withColumn("rest", budget - F.col("whole") * F.col("words"))
    # Equal rows are one row here, so that a key is never more than one row to sort.
    keys = sized.filter("size > 0").groupBy("source_key", "key").agg(F.sum("size").alias("size"))
    before = prefix_sums(keys, ["source_key"], ["key"], ["size"])
    met = lookup_join(before, wanted.select("source_key", "rest"), ["source_key"])
    met = met.filter("size_before < rest AND rest <= size_before + size")
    found = met.select(
        "source_key", F.col("key").alias("cut_key"), (F.col("rest") - F.col("size_before")).alias("cut_rest"), F.col("size").alias("cut_words")
    )
    return wanted.join(found, "source_key", "left")


def _sent(table: DataFrame) -> bool:
    size = table.agg(F.sum(F.octet_length("source_key") + 64).alias("bytes")).first().bytes
    return (size or 0) <= SENT_BYTES


def mix(
    docs: DataFrame,
    weights: DataFrame | Sequence[int] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST_EPOCHS,
    seed: str = SEED,
    keep: Sequence[str] = (),
) -> DataFrame:
    """(doc_id, source, *keep, size, source_size, target, taken) of every row of ``docs`` (doc_id, source, text).

    ``size`` is the number of words of the text, words being separated by ASCII white
    space; a null text has none. ``weights`` is a table (source, weight), or numbers
    that the sources take in turn by code point, null last; null is a source like any
    other. ``target`` is what :func:`targets` deals to the source, and ``taken`` the
    words that the mix takes of the row, repeats counted: ``taken // size`` times the
    whole text and then its first ``taken % size`` words. The taken words of a source
    add up to its target without the fraction. The order of a source is random by
    ``seed`` and the same for every epoch and every run.

    Rows equal in doc_id, source and text have one key; where the cut meets them, they
    share what is left in proportion to their sizes, rounded down, so that the source
    may miss less than one word per such row. A row without words takes none. Columns
    in ``keep`` must not be named like those returned.
    """
    key, size = mixing_key(F.col("doc_id"), F.col("text"), seed), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    named = docs.select("doc_id", "source", *keep, source_key(F.col("source")).alias("source_key"), key.alias("key"), size.alias("size"))
    sized = materialize(named.select("source_key", "key", "size"), "sized")
    totals = materialize(sized.groupBy("source_key").agg(F.sum("size").alias("words")), "totals")
    if isinstance(weights, DataFrame):
        own = weights.select(source_key(F.col("source")).alias("source_key"), F.col("weight").cast("double").alias("weight"))
        weighed = totals.join(own.groupBy("source_key").agg(F.sum("weight").alias("weight")), "source_key", "left")
    else:
        weighed = repeating_weights(totals, weights)
    table = materialize(cuts(sized, materialize(targets(weighed, share, most), "targets")), "cuts")
    rows = named.join(F.broadcast(table), "source_key") if _sent(table) else lookup_join(named, table, ["source_key"])
    # Wide products: a key of many equal rows may hold more words than the root of a long.
    part = F.expr("CAST(size AS DECIMAL(19, 0)) * CAST(cut_rest AS DECIMAL(19, 0)) DIV CAST(cut_words AS DECIMAL(19, 0))")
    once_more = F.when(F.col("key") < F.col("cut_key"), F.col("size")).when(F.col("key") == F.col("cut_key"), part).otherwise(0)
    taken = (F.col("whole") * F.col("size") + once_more).cast("long")
    return rows.select("doc_id", "source", *keep, "size", F.col("words").alias("source_size"), "target", taken.alias("taken"))


def epochs(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, source, epoch, text): the mix itself, one row per document and epoch in which it is taken, from epoch 1.

    The row of an incomplete epoch holds the first words of the text, joined by one space.
    ``options`` are those of :func:`mix`.
    """
    rows = mix(docs, **{**options, "keep": ["text"]}).filter("taken > 0")
    rest = F.col("taken") - (F.col("epoch") - 1) * F.col("size")
    words = F.filter(F.split("text", SPACE), lambda w: w != "")
    rows = rows.withColumn("epoch", F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("int"))))
    text = F.when(rest >= F.col("size"), F.col("text")).otherwise(F.array_join(F.slice(words, F.lit(1), rest.cast("int")), " "))
    return rows.select("doc_id", "source", "epoch", text.alias("text"))
