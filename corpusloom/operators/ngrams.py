"""Trigram corpus: filters, counts at three orders, and the parameters of a trigram.

Counts are linear, so each order is folded from the next larger one: trigrams
are summed from the input once, bigrams from trigrams, unigrams from bigrams
and the corpus total from unigrams. Every step reads a smaller table than the
one before, and all steps share the one shuffle of the raw input.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.packing import pack, sum_by_words, unpack
from corpusloom.functions.text import COUNT, fields, narrow, tokens, whole_number, wide, words
from corpusloom.joins import lookup_join
from corpusloom.workspace import passing_tables, settle

WORDS = ("w1", "w2", "w3")
# Bytes of a list that is sent round, and those of a word besides its letters.
SMALL_LIST, WORD_BYTES = 32 << 20, 64

# Three words, any second field, a count, and something after it.
_BLANK = "[ \\x0B\\f\\r\\n]"
GOOD_LINE = (
    f"(?s)^[^\\s]*{_BLANK}+[^\\s]+{_BLANK}+[^\\s]+{_BLANK}*"  # words
    f"\\t[^\\t]*\\t{COUNT}\\t.*[^\\t]"
)


def sliding_trigrams(docs: DataFrame, text: str = "text", *keep: str) -> DataFrame:
    """Every three consecutive tokens of ``text`` as (w1, w2, w3, *keep, cnt=1)."""
    toks = docs.select(*keep, tokens(F.col(text)).alias("toks"))
    span = F.greatest(F.size("toks") - 2, F.lit(0))
    shifted = [F.slice("toks", F.lit(i), span).alias(w) for i, w in enumerate(WORDS, start=1)]
    grams = toks.select(*keep, F.inline(F.arrays_zip(*shifted)).alias(*WORDS))
    return grams.select(*never_null(*WORDS), *keep, F.lit(1).cast("bigint").alias("cnt"))


def ngrams(docs: DataFrame, n: int, text: str = "text", *keep: str) -> DataFrame:
    """Every ``n`` consecutive tokens of ``text`` as (gram array<string>, *keep, cnt=1)."""
    toks = docs.select(*keep, tokens(F.col(text)).alias("toks")).filter(F.size("toks") >= n)
    starts = F.sequence(F.lit(1), F.size("toks") - (n - 1))
    grams = F.transform(starts, lambda i: F.slice("toks", i, n))
    return toks.select(F.explode(grams).alias("gram"), *keep, F.lit(1).cast("bigint").alias("cnt"))


def never_null(*names: str) -> list[Column]:
    """The columns with nullability ruled out.

    Joins then add no null filters of their own, and the branches that read the
    same counts keep identical plans, so that Spark runs their shuffle once.
    """
    return [F.coalesce(F.col(name), F.lit("")).alias(name) for name in names]


def staged_ngram_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Parse `ngram, year, count, ...` lines; ``problem`` is null on the good ones.

    A line needs four fields, three words in the first and a whole number in the
    third. The field and word tests come first, as a line that fails them is not
    an n-gram of this corpus at all.
    """
    split = lines.select(F.col(line).alias("line"), fields(F.col(line)).alias("f"))
    parsed = split.select(
        "line",
        F.size("f").alias("n_fields"),
        words(F.get("f", F.lit(0))).alias("w"),
        F.get("f", F.lit(1)).try_cast("int").alias("year"),
        whole_number(F.get("f", F.lit(2))).alias("cnt"),
    )
    problem = (
        F.when(F.col("n_fields") < 4, "fields")
        .when(F.size("w") != 3, "words")
        .when(F.col("cnt").isNull(), "count")
    )
    picks = [F.get("w", F.lit(i)).alias(w) for i, w in enumerate(WORDS)]
    return parsed.select("line", *picks, "year", "cnt", problem.alias("problem"))


def accepted_ngrams(lines: DataFrame, line: str = "value") -> DataFrame:
    """Good lines as (w1, w2, w3, year, cnt).

    The three tests are one pattern on the raw line: it runs inside the scan and
    only the lines that pass are split.
    """
    good = lines.filter(F.col(line).rlike(GOOD_LINE)).select(F.split(line, "\t", 4).alias("f"))
    split = good.select(
        F.split(F.get("f", F.lit(0)), "\\s+", 4).alias("w"),
        F.get("f", F.lit(1)).try_cast("int").alias("year"),
        F.get("f", F.lit(2)).cast("bigint").alias("cnt"),
    )
    picks = [F.coalesce(F.get("w", F.lit(i)), F.lit("")).alias(w) for i, w in enumerate(WORDS)]
    return split.select(*picks, "year", F.coalesce("cnt", F.lit(0).cast("bigint")).alias("cnt"))


def rejected_ngrams(lines: DataFrame, line: str = "value") -> DataFrame:
    """Bad lines with the first test they failed; only lines that fail the whole test are parsed."""
    bad = lines.filter(~F.coalesce(F.col(line).rlike(GOOD_LINE), F.lit(False)))
    return staged_ngram_lines(bad, line).filter(F.col("problem").isNotNull()).select("line", "problem")


def drop_stopword_ngrams(ngrams: DataFrame, stopwords: Iterable[str] | DataFrame, in_steps: bool = False) -> DataFrame:
    """Drop an n-gram if any of its words is in the list.

    A Python collection becomes an inlined set test inside the scan. A DataFrame
    (first column) is anti-joined per word. ``in_steps`` writes and measures the list:
    a small one is sent round, and for a large one what each join leaves is written, so
    that the disk holds one shuffle of the n-grams at a time.
    """
    if isinstance(stopwords, DataFrame):
        names = ngrams.columns
        if in_steps:
            return _dropped_in_steps(ngrams, stopwords).select(names)
        for word in WORDS:
            listed = stopwords.select(F.col(stopwords.columns[0]).alias(word)).distinct()
            ngrams = lookup_join(ngrams, listed, [word], "left_anti")
        return ngrams.select(names)
    listed = list(stopwords)
    hit = F.lit(False)
    for word in WORDS:
        hit = hit | F.col(word).isin(listed)
    return ngrams.filter(~hit)


def _dropped_in_steps(ngrams: DataFrame, stopwords: DataFrame) -> DataFrame:
    word = F.col(stopwords.columns[0])
    listed = settle(stopwords.select(word.alias("word")).filter(word.isNotNull()).distinct(), "stop-words")
    size = listed.agg(F.sum(F.octet_length("word") + WORD_BYTES)).first()[0] or 0
    if size <= SMALL_LIST:
        for name in WORDS:
            ngrams = ngrams.join(F.broadcast(listed.withColumnRenamed("word", name)), name, "left_anti")
        return ngrams
    null = {f.name: f.nullable for f in ngrams.schema.fields}
    others = [c for c in ngrams.columns if c not in WORDS]
    with passing_tables(ngrams.sparkSession):
        for i, name in enumerate(WORDS):
            rest = [w for w in WORDS if w != name]
            rows = ngrams.select(name, pack(*rest).alias("_rest"), *others)
            left = lookup_join(rows, listed.withColumnRenamed("word", name), [name], "left_anti")
            back = [unpack(F.col("_rest"), k, 2, not null[w]).alias(w) for k, w in enumerate(rest)]
            ngrams = left.select(name, *back, *others)
            if i < 2:
                ngrams = settle(ngrams, "unlisted", keep=i)
    return ngrams


def frequent_words(ngrams: DataFrame, most: int) -> DataFrame:
    """The ``most`` most frequent last words, ties by word; at most ``most`` rows."""
    return (
        ngrams.groupBy(F.col("w3").alias("word"))
        .agg(F.sum("cnt").alias("cnt"))
        .orderBy(F.desc("cnt"), F.asc("word"))
        .limit(most)
    )


def word_counts(ngrams: DataFrame) -> DataFrame:
    """(word, cnt, letters) of last words.

    The length is an aggregate, so that a filter on it stays above the counting and
    the trigram counts below keep the plan that other branches share.
    """
    letters = F.max(F.length("w3")).alias("letters")
    return ngrams.groupBy(F.col("w3").alias("word")).agg(F.sum("cnt").alias("cnt"), letters)


def trigram_counts(ngrams: DataFrame, packed: bool = False) -> DataFrame:
    """Total count of each trigram over all rows (years, sources) that hold it; ``packed`` shuffles its words as one string."""
    if packed:
        return sum_by_words(ngrams, list(WORDS), {"cnt": F.sum("cnt")})
    return ngrams.groupBy(*WORDS).agg(F.sum("cnt").alias("cnt"))


def bigram_counts(tri: DataFrame, packed: bool = False) -> DataFrame:
    """(a, b, cnt) over positions (1,2) and (2,3) of the trigrams; ``packed`` shuffles both words as one string."""
    if packed:
        grams = F.array(pack("w1", "w2"), pack("w2", "w3"))
        sums = tri.select("cnt", F.explode(grams).alias("gram")).groupBy("gram").agg(F.sum("cnt").alias("cnt"))
        null = {f.name: f.nullable for f in tri.schema.fields}
        never = not any(null[w] for w in WORDS)
        return sums.select(unpack(F.col("gram"), 0, 2, never).alias("a"), unpack(F.col("gram"), 1, 2, never).alias("b"), "cnt")
    pairs = F.array(
        F.struct(F.col("w1").alias("a"), F.col("w2").alias("b")),
        F.struct(F.col("w2").alias("a"), F.col("w3").alias("b")),
    )
    return tri.select("cnt", F.inline(pairs)).groupBy("a", "b").agg(F.sum("cnt").alias("cnt"))


def unigram_counts(tri: DataFrame) -> DataFrame:
    """(word, cnt) over positions 2 and 3 of the trigrams; position 1 does not count."""
    return (
        tri.select("cnt", F.explode(F.array("w2", "w3")).alias("word")).groupBy("word").agg(F.sum("cnt").alias("cnt"))
    )


def fold_unigrams(bi: DataFrame) -> DataFrame:
    """:func:`unigram_counts` from bigrams: a word ends a bigram once per position 2 or 3."""
    return bi.groupBy(F.col("b").alias("word")).agg(F.sum("cnt").alias("word_cnt"))


def corpus_total(ngrams: DataFrame) -> DataFrame:
    """One row, c0 = three times the sum of all counts, null where that passes 64 bits."""
    return ngrams.agg(narrow(3 * F.sum(wide(F.col("cnt")))).alias("c0"))


def ngram_roles(ngrams: DataFrame) -> DataFrame:
    """Each trigram once per part it feeds: (w1, w2, w3, role, gram, cnt).

    C1/N1 are its middle and last word, C2/N2 its first and last word pair, N3
    the trigram itself; C0 has an empty gram and three times the count.
    """

    def role(name: str, *parts: str) -> Column:
        gram = F.array(*parts) if parts else F.array().cast("array<string>")
        cnt = F.col("cnt") if parts else 3 * F.col("cnt")
        return F.struct(F.lit(name).alias("role"), gram.alias("gram"), cnt.cast("bigint").alias("cnt"))

    roles = F.array(
        role("C1", "w2"),
        role("N1", "w3"),
        role("C2", "w1", "w2"),
        role("N2", "w2", "w3"),
        role("N3", "w1", "w2", "w3"),
        role("C0"),
    )
    return ngrams.select(*WORDS, F.inline(roles))


def tag_parameter(gram: Column) -> Column:
    """Every role the gram plays inside the trigram (w1, w2, w3), as an array.

    A repeated word plays two roles: in `a b b` the word b is both N1 and C1.
    """
    w1, w2, w3 = (F.col(w) for w in WORDS)
    return F.array_compact(
        F.array(
            F.when(gram == F.array(w3), "N1"),
            F.when(gram == F.array(w2), "C1"),
            F.when(gram == F.array(w2, w3), "N2"),
            F.when(gram == F.array(w1, w2), "C2"),
            F.when(gram == F.array(w1, w2, w3), "N3"),
            F.when(F.size(gram) == 0, "C0"),
        )
    )


def pair_contexts(tri: DataFrame) -> DataFrame:
    """(a, b, pair_cnt, word_cnt): a bigram with the count of its last word.

    This one table serves both sides of a trigram: read at (w2, w3) it gives N2
    and N1, read at (w1, w2) it gives C2 and C1. Frequent words meet the join
    here, on distinct bigrams, and not on the trigram table.
    """
    return _contexts(bigram_counts(tri))


def _contexts(bi: DataFrame) -> DataFrame:
    words = fold_unigrams(bi).withColumnRenamed("word", "b")
    return lookup_join(bi, words, ["b"]).select("a", "b", F.col("cnt").alias("pair_cnt"), "word_cnt")


def assemble_params(tri: DataFrame, in_steps: bool = False) -> DataFrame:
    """Every trigram with its parameters n1, n2, n3, c0, c1, c2; c0 is null where it passes 64 bits.

    ``in_steps`` counts the trigrams as well and writes the tables between the shuffles (:func:`written_params`).
    """
    params = written_params(tri) if in_steps else wide_params(tri)
    return params.withColumn("c0", narrow(F.col("c0")))


def wide_params(tri: DataFrame) -> DataFrame:
    """:func:`assemble_params` with a c0 of any width.

    The join on the context (w1, w2) comes before the other, so that a later
    ranking by context shuffles again: each task then cuts its part of a large
    context first, and the skewed join itself stays open to splitting.
    """
    contexts = pair_contexts(tri)
    # Every trigram is counted at two words.
    total = fold_unigrams(bigram_counts(tri)).agg((3 * F.sum(wide(F.col("word_cnt"))) / 2).cast("decimal(38,0)").alias("c0"))
    after = contexts.toDF("w2", "w3", "n2", "n1")
    before = contexts.toDF("w1", "w2", "c2", "c1")
    return (
        tri.join(before, ["w1", "w2"])
        .join(after, ["w2", "w3"])
        .select(*WORDS, "n1", "n2", F.col("cnt").alias("n3"), total.scalar().alias("c0"), "c1", "c2")
    )


def _written_contexts(tri: DataFrame) -> DataFrame:
    """:func:`pair_contexts` as (gram, pair_cnt, word_cnt), written, by way of written bigrams."""
    with passing_tables(tri.sparkSession):
        bi = settle(bigram_counts(tri, packed=True), "bigrams")
        return settle(_contexts(bi).select(pack("a", "b").alias("gram"), "pair_cnt", "word_cnt"), "contexts", keep=2)


def written_params(ngrams: DataFrame) -> DataFrame:
    """:func:`wide_params` of the counted ``ngrams``, a written table at a time.

    Each step reads what the one before wrote, and the shuffle files of that are gone by
    then, so that the disk holds one shuffle of the trigrams at a time and not all of them.
    Words are shuffled as one string. What is returned reads two tables: the trigrams with
    the parameters of their context, and the bigrams with those of their last word.
    """
    spark = ngrams.sparkSession
    with passing_tables(spark):
        tri = settle(trigram_counts(ngrams, packed=True), "trigrams")
        total = tri.agg((3 * F.sum(wide(F.col("cnt")))).cast("decimal(38,0)")).first()[0]
        contexts = _written_contexts(tri)
        # Null words count, but as in any join they meet no context.
        first = tri.dropna(subset=list(WORDS)).select(pack("w1", "w2").alias("gram"), "w3", F.col("cnt").alias("n3"))
        first = first.join(contexts.toDF("gram", "c2", "c1"), "gram")
        null = tri.schema["w1"].nullable
        words = [unpack(F.col("gram"), i, 2, not null).alias(w) for i, w in enumerate(WORDS[:2])]
        first = settle(first.select(*words, "w3", "n3", "c1", "c2"), "trigrams-in-context", keep=1)
    second = first.select("w1", pack("w2", "w3").alias("gram"), "n3", "c1", "c2").join(contexts.toDF("gram", "n2", "n1"), "gram")
    words = [unpack(F.col("gram"), i, 2, not null).alias(w) for i, w in enumerate(WORDS[1:])]
    return second.select("w1", *words, "n1", "n2", "n3", F.lit(total).cast("decimal(38,0)").alias("c0"), "c1", "c2")
