import math
import random
import re

import pytest
from pyspark.sql import functions as F

from corpusloom import fixtures
from corpusloom.functions.stopwords import HEBREW_STOPWORDS
from corpusloom.operators import ngrams
from corpusloom.operators.ranking import rank_in_group, top_per_group
from corpusloom.plans import next_word

SCHEMA = "w1 string, w2 string, w3 string, cnt bigint"


def corpus(spark, *items):
    rows = [(*text.split(), cnt) for text, cnt in items]
    return spark.createDataFrame(rows, SCHEMA).select(*ngrams.never_null("w1", "w2", "w3"), "cnt")


def params(df):
    return {(r.w1, r.w2, r.w3): r for r in df.collect()}


def test_parameters_by_hand(spark):
    got = params(next_word.next_word_prob(corpus(spark, ("a b c", 2), ("a b d", 1), ("b c d", 1))))
    abc = got["a", "b", "c"]
    # c is in position 2 or 3 three times, b three times, b c spans 2+1, a b 2+1.
    assert (abc.n1, abc.n2, abc.n3, abc.c0, abc.c1, abc.c2) == (3, 3, 2, 12, 3, 3)
    k2 = (math.log(4) + 1) / (math.log(4) + 2)
    k3 = (math.log(3) + 1) / (math.log(3) + 2)
    assert abc.prob == pytest.approx(k3 * 2 / 3 + (1 - k3) * k2 * 3 / 3 + (1 - k3) * (1 - k2) * 3 / 12)


def test_as_written_ignores_the_trigram_count(spark):
    got = params(next_word.next_word_prob(corpus(spark, ("a b c", 2), ("x b c", 9), ("b c d", 1)), as_written=True))
    # Without its own count a trigram is scored by its last two words only.
    assert got["a", "b", "c"].prob == pytest.approx(got["x", "b", "c"].prob)
    r = got["a", "b", "c"]
    k2 = (math.log(r.n2 + 1) + 1) / (math.log(r.n2 + 1) + 2)
    assert r.prob == pytest.approx(0.5 * k2 * r.n2 / r.c1 + 0.5 * (1 - k2) * r.n1 / r.c0)


def test_repeated_words_have_both_counts(spark):
    got = params(next_word.next_word_prob(corpus(spark, ("a b b", 1), ("a a a", 1))))
    abb, aaa = got["a", "b", "b"], got["a", "a", "a"]
    assert (abb.n1, abb.c1, abb.n2, abb.c2) == (2, 2, 1, 1)
    assert (aaa.n1, aaa.c1, aaa.n2, aaa.c2) == (2, 2, 2, 2)


def test_words_that_look_like_keys(spark, rows):
    tri = corpus(spark, ("C0 12:30 ,", 3), ("x,y C0 :*", 1))
    assert rows(ngrams.unigram_counts(tri)) == [(",", 3), ("12:30", 3), (":*", 1), ("C0", 1)]
    assert ngrams.corpus_total(tri).first().c0 == 12


def test_large_counts_do_not_overflow(spark):
    tri = ngrams.trigram_counts(corpus(spark, ("a b c", 2_000_000_000), ("a b c", 2_000_000_000)))
    r = ngrams.assemble_params(tri).first()
    assert (r.n3, r.c0) == (4_000_000_000, 12_000_000_000)


def test_unigrams_fold_from_bigrams(spark, rows):
    rng = random.Random(5)
    items = [(" ".join(rng.choices("abcdef", k=3)), rng.randint(1, 9)) for _ in range(200)]
    tri = ngrams.trigram_counts(corpus(spark, *items))
    assert rows(ngrams.fold_unigrams(ngrams.bigram_counts(tri))) == rows(ngrams.unigram_counts(tri))


def test_result_is_independent_of_order_and_partitions(spark, rows):
    rng = random.Random(7)
    items = [(" ".join(rng.choices("abcdef", k=3)), rng.randint(1, 9)) for _ in range(200)]
    once = next_word.next_word_prob(corpus(spark, *items)).drop("prob")
    rng.shuffle(items)
    again = next_word.next_word_prob(corpus(spark, *items).repartition(5)).drop("prob")
    assert rows(once) == rows(again)


def test_line_filter_and_rejects(spark, rows):
    lines = [
        "a b c\t1999\t5\t1",
        "a b c\t2000\t7\t1\t9\t\t",
        " a b\t2000\t1\t1",
        "a b\t2000\t1\t1",
        "a b c d\t2000\t1\t1",
        "a b c\t2000\tx\t1",
        "a b c\t2000\t 5\t1",
        "a b c\t2000\t5",
        "a b c\t2000\t5\t\t",
        "a b c\tyear\t5\t1",
        "a  b c \t2000\t2\t1",
        "a b c\t2000\t99999999999999999999\t1",
        "",
        "\t\t\t\t",
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    good = [(r.w1, r.w2, r.w3, r.year, r.cnt) for r in ngrams.accepted_ngrams(df).collect()]
    assert sorted(good, key=str) == sorted(
        [
            ("", "a", "b", 2000, 1),
            ("a", "b", "c", 1999, 5),
            ("a", "b", "c", 2000, 7),
            ("a", "b", "c", None, 5),
            ("a", "b", "c", 2000, 2),
        ],
        key=str,
    )
    bad = {r.line: r.problem for r in ngrams.rejected_ngrams(df).collect()}
    assert len(bad) == len(lines) - 5
    assert bad["a b\t2000\t1\t1"] == "words" and bad["a b c\t2000\t5\t\t"] == "fields"
    assert bad["a b c\t2000\tx\t1"] == "count" and bad["a b c\t2000\t 5\t1"] == "count"


def test_accepted_and_rejected_lines_make_up_the_input(spark):
    rng = random.Random(11)
    pieces = ["a", "b c", "\t", " ", "7", "-3", "x y z", "\t\t", "\r", "é"]
    lines = ["".join(rng.choices(pieces, k=rng.randint(0, 9))) for _ in range(3000)]
    lines += [f"{a}\t{b}\t{c}\t{d}" for a in ("x y z", "x y", "x  y z ") for b in ("", "1") for c in ("5", "", "+1") for d in ("", "1")]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    staged = ngrams.staged_ngram_lines(df).filter("problem is null").drop("line", "problem")
    good = ngrams.accepted_ngrams(df)
    assert good.count() + ngrams.rejected_ngrams(df).count() == len(lines)
    assert good.exceptAll(staged).isEmpty() and staged.exceptAll(good).isEmpty() and not good.isEmpty()


def test_stopwords(spark, rows):
    assert len(HEBREW_STOPWORDS) == len(set(HEBREW_STOPWORDS)) == 150
    df = corpus(spark, ("a b c", 1), ("a של c", 1), ("x y .", 1), ("d e f", 1))
    inlined = rows(ngrams.drop_stopword_ngrams(df, HEBREW_STOPWORDS))
    listed = spark.createDataFrame([(w,) for w in HEBREW_STOPWORDS], "w string")
    assert inlined == rows(ngrams.drop_stopword_ngrams(df, listed)) == [("a", "b", "c", 1), ("d", "e", "f", 1)]


def test_tags_of_repeated_words(spark):
    roles = ngrams.ngram_roles(corpus(spark, ("a b b", 2)))
    tags = {(r.role, tuple(r.gram)): r.t for r in roles.withColumn("t", ngrams.tag_parameter(F.col("gram"))).collect()}
    assert tags["N1", ("b",)] == ["N1", "C1"] and tags["C2", ("a", "b")] == ["C2"] and tags["C0", ()] == ["C0"]


def test_equal_probabilities_keep_all_rows(spark):
    scored = spark.createDataFrame([("a", "b", w, 0.5) for w in "zyx"], "w1 string, w2 string, w3 string, prob double")
    ranked = next_word.rank_continuations(scored)
    assert [r.w3 for r in ranked.orderBy("rank").collect()] == ["x", "y", "z"]


@pytest.mark.parametrize("coalesced", ["true", "false"])
def test_groups_over_several_ranges_rank_as_a_whole(spark, coalesced):
    rng = random.Random(3)
    data = [("hot", "x", f"w{i:05d}", rng.choice([0.1, 0.2, 0.3])) for i in range(3000)]
    data += [(f"k{i % 40}", "y", f"w{i}", rng.random()) for i in range(500)]
    df = spark.createDataFrame(data, "w1 string, w2 string, w3 string, prob double").repartition(6)
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, coalesced)
    try:
        got = {(r.w1, r.w2, r.w3): r.rank for r in next_word.rank_continuations(df).collect()}
    finally:
        spark.conf.unset(setting)
    want, seen = {}, {}
    for w1, w2, w3, _ in sorted(data, key=lambda t: (t[0], t[1], -t[3], t[2])):
        seen[w1, w2] = seen.get((w1, w2), 0) + 1
        want[w1, w2, w3] = seen[w1, w2]
    assert got == want


def test_top_k_limits_before_the_shuffle(spark, rows):
    df = spark.createDataFrame([("hot", "x")], "w1 string, w2 string").crossJoin(spark.range(5000)).select("w1", "w2", F.col("id").cast("string").alias("w3"), F.lit(0.5).alias("prob"))
    top = next_word.top_next(df, 5)
    assert [r.w3 for r in top.orderBy("rank").collect()] == ["0", "1", "10", "100", "1000"]
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()
    deep = top_per_group(df, ["w1", "w2"], next_word.continuation_order(), 1500)
    window = rank_in_group(df, ["w1", "w2"], next_word.continuation_order()).filter("rank <= 1500")
    assert rows(deep) == rows(window)


def test_trigram_shuffle_runs_once(spark):
    df = spark.createDataFrame([("a b c d e f",), ("b c d",)], "text string")
    scored = next_word.next_word_prob(ngrams.sliding_trigrams(df))
    scored.collect()
    # What ran is compiled, or stands below a stage; the plans made before the run are printed as well.
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"\*\(\d+\) Scan ExistingRDD", plan)) == 1
    assert len(re.findall(r"ShuffleQueryStage \d+\n[ :|]*\+- Exchange hashpartitioning\(w1#\d+, w2#\d+, w3#\d+,", plan)) == 1


def test_large_context_is_split_in_the_join(spark, rows):
    """A context with a third of all trigrams does not keep one task busy alone."""
    settings = {
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    number = F.col("id").cast("string")
    hot = spark.range(20_000).select(F.lit("hot").alias("w1"), F.lit("x").alias("w2"), F.concat(F.lit("w"), number).alias("w3"))
    cold = spark.range(40_000).select(
        F.concat(F.lit("a"), number).alias("w1"), F.concat(F.lit("b"), F.col("id") % 50).alias("w2"), F.concat(F.lit("w"), F.col("id") % 900).alias("w3")
    )
    tri = hot.unionByName(cold).select(*ngrams.never_null("w1", "w2", "w3"), F.lit(1).cast("bigint").alias("cnt"))
    plain = rows(next_word.top_next(next_word.scored_trigrams(tri), 3).drop("prob"))
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        top = next_word.top_next(next_word.scored_trigrams(tri), 3).drop("prob")
        assert rows(top) == plain
        assert "skew=true" in top._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def test_documents_are_dealt_by_their_text(spark, tmp_path, rows, monkeypatch):
    data = [(i, "a b c d " * 50, "src1") for i in range(100)] + [(None, None, None), (None, "a b c", "src1"), (7, "", "src2")]
    spark.createDataFrame(data, "doc_id bigint, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    monkeypatch.setattr(fixtures, "TASK_TEXT", 1 << 10)
    docs = fixtures.documents(spark, str(tmp_path))
    assert rows(docs.filter("doc_id IS NOT NULL")) == sorted(r for r in data if r[0] is not None) and docs.count() == len(data)
    assert docs.rdd.getNumPartitions() >= 40_000 / 1024


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    assert fixtures.tri(spark, str(tmp_path)).collect() == []
