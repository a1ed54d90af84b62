"""Balanced label propagation: linked documents move to one shard, shard sizes stay even.

Documents are linked when their texts are equal. All documents of one text that began
in the same shard form a cell, and cells are what moves: in each round the cells of a
text go to the shard that holds most of its documents, and shards that this takes
above their quota send whole texts to shards below theirs. At the end a document's label
is its shard. Only the rows that a shard holds above its exact quota leave it, those of
its rarest texts first, which are whole ones as far as they go, for shards with room.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.llm.components import join_apart
from corpusloom.llm.mixing import prefix_sums
from corpusloom.workspace import materialize

SHARDS = 24
OVERHEAD = 8


def _wanted(cells: DataFrame, capacity: int) -> DataFrame:
    """``cells`` with ``target``, where each is drawn to, and ``free``: a text at rest that may be asked to leave.

    A text with more documents than a shard holds is drawn to as many shards as it
    needs, those that hold most of it; its cells elsewhere are dealt over them.
    """
    held = cells.groupBy("text_key", "shard").agg(F.sum("n").alias("n"))
    # A text has at most as many rows here as there are shards.
    order = Window.partitionBy("text_key").orderBy(F.desc("n"), F.xxhash64("text_key", "shard"))
    total = Window.partitionBy("text_key")
    ranked = held.select(
        "text_key",
        "shard",
        (F.row_number().over(order) - 1).alias("place"),
        F.sum("n").over(total).alias("all"),
        F.count(F.lit(1)).over(total).cast("int").alias("in_use"),
    )
    need = F.least(F.ceil(F.col("all") / F.lit(capacity)).cast("int"), F.col("in_use"))
    ranked = ranked.withColumn("slot", F.pmod(F.col("place"), need))
    homes = ranked.filter("place = slot").select("text_key", "slot", F.col("shard").alias("target"))
    free = (F.col("in_use") == 1) & (F.col("all") <= max(1, capacity // 8))
    moves = ranked.join(homes, ["text_key", "slot"]).select("text_key", "shard", "target", free.alias("free"))
    return cells.join(moves, ["text_key", "shard"])


def _evictions(load: list[int], free: list[int], capacity: int) -> tuple[list[float], list[float]]:
    """By shard: the share of its free texts that leave, and the share of all that leave that it takes up."""
    over = [max(0, x - capacity) for x in load]
    room = [max(0, capacity - x) for x in load]
    leave = [min(1.0, o / f) if f else 0.0 for o, f in zip(over, free, strict=True)]
    space = sum(room) or 1
    return leave, [r / space for r in room]


def _uniform(*what) -> Column:
    return F.pmod(F.xxhash64(*what), F.lit(1 << 30)) / F.lit(float(1 << 30))


def propagate(cells: DataFrame, shards: int, rounds: int = 8) -> DataFrame:
    """(text_key, first, n, shard) of ``cells`` (text_key, first, n) after moving.

    In a round every cell goes where its text draws it. Where that takes a shard above
    its quota, texts at rest there, whole ones, are drawn by lot to leave for shards
    below theirs, in proportion to the room left. At most ``shards`` cells belong to a
    text, whatever the number of its documents. Each round's cells are written to the
    shared folder. It ends when no cell is drawn elsewhere and no shard is over its
    quota by more than one part in 200, or after ``rounds``.
    """
    now = materialize(cells.withColumn("shard", F.col("first")), "cells")
    total = now.agg(F.sum("n")).first()[0] or 0
    capacity = max(1, -(-total // shards))
    for step in range(rounds):
        wanted = materialize(_wanted(now, capacity), "cells")
        rows = wanted.groupBy("shard", "target", "free").agg(F.sum("n").alias("n")).collect()  # twice shards squared at most
        load = [sum(r.n for r in rows if r.target == s) for s in range(shards)]
        free = [sum(r.n for r in rows if r.target == s and r.free) for s in range(shards)]
        now = wanted
        if all(r.shard == r.target for r in rows) and max(load) <= capacity + capacity // 200 + 1:
            break
        leave, take = _evictions(load, free, capacity)
        # A text's cells draw the same lots, so that they go together.
        leaves = F.col("free") & (_uniform(F.lit(2 * step), "text_key") < F.element_at(F.array(*[F.lit(x) for x in leave]), F.col("target") + 1))
        lot, upto, home = _uniform(F.lit(2 * step + 1), "text_key"), 0.0, F.lit(shards - 1)
        steps = []
        for s, share in enumerate(take):
            upto += share
            steps.append((upto, s, share))
        for upto, s, share in reversed(steps):
            if share:
                home = F.when(lot < upto, F.lit(s)).otherwise(home)
        to = F.when(leaves, home).otherwise(F.col("target")) if any(take) else F.col("target")
        now = materialize(wanted.select("text_key", "first", "n", to.cast("int").alias("shard")), "cells")
    return now.select("text_key", "first", "n", "shard")


def _listed(values: list[int], at: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("long") for v in values]), at + 1)


def _settled(numbered: DataFrame, load: list[int]) -> DataFrame:
    """``numbered`` (shard, at, ...) with the final ``shard`` and ``slot``; ``at`` numbers a shard's rows, those to leave first.

    The quotas differ by one at most, the larger ones going to the fullest shards. Rows
    above a shard's quota are laid out one after the other, shard by shard, over the room
    that the others have.
    """
    shards, (base, longer) = len(load), divmod(sum(load), len(load))
    fullest = sorted(range(shards), key=lambda s: (-load[s], s))
    quota = [base + (fullest.index(s) < longer) for s in range(shards)]
    over, room = [max(0, n - q) for n, q in zip(load, quota, strict=True)], [max(0, q - n) for n, q in zip(load, quota, strict=True)]
    before = [sum(over[:s]) for s in range(shards)]
    first = [sum(room[:s]) for s in range(shards)]
    leaves = F.col("at") < _listed(over, F.col("shard"))
    place = _listed(before, F.col("shard")) + F.col("at")
    home = F.lit(shards - 1)
    for s in reversed(range(shards)):
        if room[s]:
            home = F.when(place < first[s] + room[s], F.lit(s)).otherwise(home)
    out = numbered.withColumns({"leaves": leaves, "place": place, "home": F.when(leaves, home).otherwise(F.col("shard")).cast("int")})
    arrived = _listed(load, F.col("home")) + F.col("place") - _listed(first, F.col("home"))
    slot = F.when(F.col("leaves"), arrived).otherwise(F.col("at") - _listed(over, F.col("home")))
    return out.withColumn("slot", slot).withColumn("shard", F.col("home")).drop("leaves", "place", "home", "at")


def balanced_shards(docs: DataFrame, shards: int = SHARDS, rounds: int = 8) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every row of ``docs`` (doc_id, text).

    The law is ``rows``: the counts of any two shards differ by one at most. size is the
    text's UTF-8 bytes plus 8; a null text has no bytes and the checksum of no bytes, 0.
    Documents with equal texts share a shard unless together they exceed one, or some of
    them had to fill the last places of another; null texts are linked with each other,
    and apart from empty ones. slot numbers a shard's rows from 0 without gaps. With fewer
    rows than shards some shards are empty. Repeated rows and rows without a doc_id are
    rows like others.
    """
    text = F.col("text")
    nodes = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.concat_ws(".", F.xxhash64(text), F.xxhash64(F.lit(6), text), F.octet_length(text)).alias("text_key"),
        F.pmod(F.xxhash64(F.lit(7), "doc_id", text), F.lit(shards)).cast("int").alias("first"),
        F.monotonically_increasing_id().alias("tie"),
    )
    nodes = materialize(nodes, "nodes")
    cells = nodes.groupBy("text_key", "first").agg(F.count(F.lit(1)).alias("n"))
    moved = propagate(cells, shards, rounds)
    here = moved.groupBy("text_key", "shard").agg(F.sum("n").alias("n_here"))
    cell = F.concat_ws("/", "text_key", "first").alias("cell")
    labels = moved.join(here, ["text_key", "shard"]).select(cell, "shard", "n_here")
    placed = join_apart(nodes.select("*", cell), labels, "cell")
    load = {r.shard: r.n for r in moved.groupBy("shard").agg(F.sum("n").alias("n")).collect()}  # a row per shard
    rows = placed.select("doc_id", "size", "text_crc32", "shard", "n_here", "text_key", "tie", F.lit(1).cast("long").alias("one"))
    numbered = prefix_sums(rows, ["shard"], ["n_here", "text_key", "tie"], ["one"]).withColumnRenamed("one_before", "at")
    done = _settled(numbered, [load.get(s, 0) for s in range(shards)])
    nothing = F.lit(None).cast("int").alias("grown_shard")
    return done.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), nothing)
