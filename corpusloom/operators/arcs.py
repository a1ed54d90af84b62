"""Dependency arcs: from n-gram lines to counts of lexemes, features and pairs.

A line is ``head <tab> token token ... <tab> count``; a token is
``word/pos/dep/headIndex`` with 1-based indices and 0 for the root. An arc links
a token to its head; its feature is the head word joined to the arc's label.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import COUNT, WIDE, fields, narrow, spaced, whole_number, wide
from corpusloom.joins import lookup_join
from corpusloom.workspace import materialize

SKIP, TAKE = 100, 1000

# What a row of the statistics sums: an arc's counts, or one of the two corpus totals.
PAIR, L_TOTAL, F_TOTAL = 0, 1, 2
# Bytes of a vocabulary that is sent round, and those of a word besides its letters.
SMALL_VOCABULARY, WORD_BYTES = 32 << 20, 64

# Any two fields, then a count.
GOOD_LINE = f"(?s)^[^\\t]*\\t[^\\t]*\\t{COUNT}(\\t|$)"


def staged_arc_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Parse lines to (line, toks, cnt, problem); problem names the failed test or is null."""
    split = lines.select(F.col(line).alias("line"), fields(F.col(line)).alias("f"))
    parsed = split.select(
        "line",
        F.size("f").alias("n_fields"),
        spaced(F.get("f", F.lit(1))).alias("toks"),
        whole_number(F.get("f", F.lit(2))).alias("cnt"),
    )
    problem = F.when(F.col("n_fields") < 3, "fields").when(F.col("cnt").isNull(), "count")
    return parsed.select("line", "toks", "cnt", problem.alias("problem"))


def accepted_arc_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Good lines as (toks, cnt); one pattern on the raw line is the whole test."""
    good = lines.filter(F.col(line).rlike(GOOD_LINE)).select(F.split(line, "\t", 4).alias("f"))
    cnt = F.coalesce(F.get("f", F.lit(2)).cast("bigint"), F.lit(0).cast("bigint"))
    return good.select(spaced(F.get("f", F.lit(1))).alias("toks"), cnt.alias("cnt"))


def rejected_arc_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Bad lines with the first test they failed; only lines that fail the whole test are parsed."""
    bad = lines.filter(~F.coalesce(F.col(line).rlike(GOOD_LINE), F.lit(False)))
    return staged_arc_lines(bad, line).filter(F.col("problem").isNotNull()).select("line", "problem")


def with_arcs(lines: DataFrame, stem: Callable[[Column], Column] | None = None, *keep: str) -> DataFrame:
    """(*keep, cnt, n_toks, arcs) per line, arcs as ``array<struct<lexeme, dep, head>>``.

    Tokens with fewer than four parts, a head that is no number, the root and a
    head outside the line give no arc. ``stem`` maps an array of words to an
    array of stems and is applied to both ends of an arc.
    """
    size = F.size("toks").alias("n_toks")
    split = lines.select(*keep, "cnt", size, F.transform("toks", lambda t: F.split(t, "/")).alias("parts"))

    # The word comes first; a token of slashes only has none.
    def word(parts: Column) -> Column:
        first = F.get(parts, F.lit(0))
        return F.when((first != "") | (F.size(parts) == 1) | (F.array_max(parts) != ""), first)

    words = F.transform("parts", word)
    named = split.withColumn("words", stem(words) if stem else words)

    # Three parts or fewer have no head index and fall out with the null.
    def arc(parts: Column, at: Column) -> Column:
        return F.struct(
            F.get("words", at).alias("lexeme"),
            F.get(parts, F.lit(2)).alias("dep"),
            F.get("words", F.try_subtract(F.get(parts, F.lit(3)).try_cast("int"), F.lit(1))).alias("head"),
        )

    def real(a: Column) -> Column:
        return a["head"].isNotNull() & a["lexeme"].isNotNull()

    return named.select(*keep, "cnt", "n_toks", F.filter(F.transform("parts", arc), real).alias("arcs"))


def make_feature(head: Column, dep: Column) -> Column:
    """Feature of an arc: its head word and label."""
    return F.concat(head, F.lit("-"), dep)


def explode_arcs(lines: DataFrame, *keep: str) -> DataFrame:
    """One row per arc: (*keep, cnt, lexeme, dep, head, feature).

    The outer form, as the inner one makes Spark test the size of ``arcs`` below
    the parsing steps, where it would parse every line a second time.
    """
    rows = lines.select(*keep, "cnt", F.inline_outer("arcs")).filter(F.col("lexeme").isNotNull())
    return rows.withColumn("feature", make_feature(F.col("head"), F.col("dep")))


def distinct_features(arcs: Column) -> Column:
    """The different features of one line."""
    return F.array_distinct(F.transform(arcs, lambda a: make_feature(a["head"], a["dep"])))


def count_distinct_features(arcs: Column) -> Column:
    """How many different features a line has; two arcs, the most that a biarc line has, are compared as they are."""

    def feature(at: int) -> Column:
        arc = F.get(arcs, F.lit(at))
        return make_feature(arc["head"], arc["dep"])

    size = F.size(arcs)
    return F.when(size < 2, size).when(size == 2, F.when(feature(0).eqNullSafe(feature(1)), 1).otherwise(2)).otherwise(F.size(distinct_features(arcs)))


def in_vocabulary(arcs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Rows whose ``lexeme`` is a word of the vocabulary (first column)."""
    listed = vocabulary.select(F.col(vocabulary.columns[0]).alias("lexeme")).distinct()
    return lookup_join(arcs, listed, ["lexeme"], "left_semi").select(arcs.columns)


def _listed(vocabulary: DataFrame) -> tuple[DataFrame, bool]:
    """(word, lexeme) of the vocabulary, written once, and whether it was measured to be small enough to be sent round."""
    word = F.col(vocabulary.columns[0])
    words = materialize(vocabulary.select(word.alias("word")).filter(word.isNotNull()).distinct(), "vocabulary-words")
    size = words.agg(F.sum(F.octet_length("word") + WORD_BYTES)).first()[0] or 0
    return words.withColumn("lexeme", F.col("word")), size <= SMALL_VOCABULARY


def arc_statistics(arc_lines: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """All sums of the corpus in one pass: (lexeme, feature, cnt, l_part, f_part).

    ``lexeme`` is kept only for vocabulary words and null otherwise, so the table
    has one row per feature plus one per vocabulary pair. Each line adds its two totals
    as rows without a feature, which collapse in the task that reads them.
    A vocabulary measured to be small is sent round, so that words meet it where they
    are read and the arcs are shuffled once, by what they are summed by. A larger one
    is joined to arcs that are summed by word and feature first. The tables below are
    folded from this result. The sums are wide: a line's count times its tokens may pass
    64 bits, and so may what many lines add up to.
    """
    listed, small = _listed(vocabulary)
    none = F.lit(None).cast("struct<lexeme:string,dep:string,head:string>")
    per_line = arc_lines.select(
        "cnt",
        F.size("arcs").alias("n_arcs"),
        (F.col("n_toks") - 1).alias("l_times"),
        count_distinct_features(F.col("arcs")).alias("f_times"),
        F.posexplode(F.concat("arcs", F.array(none, none))).alias("at", "arc"),
    )
    kind = F.when(F.col("at") < F.col("n_arcs"), PAIR).when(F.col("at") == F.col("n_arcs"), L_TOTAL).otherwise(F_TOTAL)
    rows = per_line.select(
        kind.alias("kind"),
        F.col("arc.lexeme").alias("word"),
        make_feature(F.col("arc.head"), F.col("arc.dep")).alias("feature"),
        "cnt",
        "l_times",
        "f_times",
    )
    times = F.when(F.col("kind") == L_TOTAL, F.col("l_times")).otherwise(F.col("f_times"))
    product = (times.cast("decimal(12,0)") * F.col("cnt").cast("decimal(20,0)")).cast(WIDE)
    rows = rows.withColumn("cnt", F.when(F.col("kind") == PAIR, wide(F.col("cnt"))).otherwise(product)).drop("l_times", "f_times")
    total = F.sum("cnt").alias("cnt")
    if small:
        known = rows.join(F.broadcast(listed), "word", "left")
    else:
        known = lookup_join(rows.groupBy("kind", "word", "feature").agg(total), listed, ["word"], "left")
    sums = known.groupBy("kind", "lexeme", "feature").agg(total)
    zero = wide(F.lit(0))
    parts = [F.when(F.col("kind") == k, F.col("cnt")).otherwise(zero).alias(name) for k, name in ((PAIR, "cnt"), (L_TOTAL, "l_part"), (F_TOTAL, "f_part"))]
    return sums.select("lexeme", "feature", *parts)


def _wide_pairs(stats: DataFrame) -> DataFrame:
    return stats.filter(F.col("lexeme").isNotNull()).select("lexeme", "feature", "cnt")


def _wide_lexemes(stats: DataFrame) -> DataFrame:
    return _wide_pairs(stats).groupBy("lexeme").agg(F.sum("cnt").alias("cnt"))


def _wide_features(stats: DataFrame) -> DataFrame:
    return stats.filter(F.col("feature").isNotNull()).groupBy("feature").agg(F.sum("cnt").alias("cnt"))


def _narrowed(counts: DataFrame) -> DataFrame:
    """Rows whose count fits a bigint; the others are listed by :func:`count_rejects`."""
    return counts.withColumn("cnt", narrow(F.col("cnt"))).filter(F.col("cnt").isNotNull())


def pair_counts(stats: DataFrame) -> DataFrame:
    """(lexeme, feature, cnt) for vocabulary lexemes."""
    return _narrowed(_wide_pairs(stats))


def lexeme_counts(stats: DataFrame) -> DataFrame:
    """(lexeme, cnt) for vocabulary lexemes that occur in an arc."""
    return _narrowed(_wide_lexemes(stats))


def feature_counts(stats: DataFrame) -> DataFrame:
    """(feature, cnt) over all arcs, whether or not the lexeme is in the vocabulary."""
    return _narrowed(_wide_features(stats))


def wide_totals(stats: DataFrame) -> DataFrame:
    """One row (l_star, f_star) of any width.

    l_star adds each line's token count less one, malformed tokens included;
    f_star adds its number of different features. Both are weighted by the count.
    """
    return stats.agg(F.sum("l_part").alias("l_star"), F.sum("f_part").alias("f_star"))


def global_counts(stats: DataFrame) -> DataFrame:
    """:func:`wide_totals` as bigint, null where one does not fit."""
    return wide_totals(stats).select(narrow(F.col("l_star")).alias("l_star"), narrow(F.col("f_star")).alias("f_star"))


def count_rejects(stats: DataFrame) -> DataFrame:
    """(kind, lexeme, feature, total): counts of pairs, lexemes and features, and corpus totals, that no bigint holds.

    They stand in none of the count tables. ``total`` is their decimal text.
    """
    none = F.lit(None).cast("string")
    totals = wide_totals(stats)
    tables = [
        _wide_pairs(stats).select(F.lit("pair").alias("kind"), "lexeme", "feature", "cnt"),
        _wide_lexemes(stats).select(F.lit("lexeme").alias("kind"), "lexeme", none.alias("feature"), "cnt"),
        _wide_features(stats).select(F.lit("feature").alias("kind"), none.alias("lexeme"), "feature", "cnt"),
        *[totals.select(F.lit(name).alias("kind"), none.alias("lexeme"), none.alias("feature"), F.col(name).alias("cnt")) for name in totals.columns],
    ]
    beyond = reduce(DataFrame.unionByName, tables).filter(F.col("cnt").isNotNull() & narrow(F.col("cnt")).isNull())
    return beyond.select("kind", "lexeme", "feature", F.col("cnt").cast("string").alias("total"))


def top_features(counts: DataFrame, skip: int = SKIP, take: int = TAKE) -> DataFrame:
    """(feature, cnt, feature_idx): ranks skip..skip+take-1 by count, ties by feature.

    With ``skip`` features or fewer the dictionary is empty. The result has at
    most ``take`` rows, which makes the closing numbering a small local step.
    """
    kept = counts.orderBy(F.desc("cnt"), F.asc("feature")).offset(skip).limit(take)
    place = Window.orderBy(F.desc("cnt"), F.asc("feature"))
    return kept.withColumn("feature_idx", F.row_number().over(place) - 1)
