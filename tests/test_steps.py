"""The next-word model and its rankings written in steps: the same rows, with one shuffle of the trigrams at a time."""

import os
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from corpusloom.catalog import QUERIES
from corpusloom.functions.packing import ESCAPE, SEPARATOR, pack, sum_by_words, unpack
from corpusloom.operators import arcs, ngrams
from corpusloom.operators.ranking import rank_in_group
from corpusloom.plans import next_word
from corpusloom.sources import matrices
from corpusloom.workspace import passing_tables, settle, shared_dir

ODD = ["", "a", "b", "é", " ", "a b", SEPARATOR, ESCAPE, ESCAPE + "0", ESCAPE + "1", ESCAPE + "2", f"a{SEPARATOR}b", f"{ESCAPE}{SEPARATOR}x", None]


def trigrams(spark, words, n=400, seed=5):
    rng = random.Random(seed)
    data = [(*rng.choices(words, k=3), rng.randint(1, 9)) for _ in range(n)]
    return spark.createDataFrame(data, "w1 string, w2 string, w3 string, cnt bigint")


def shuffle_files(spark):
    """Names of the shuffle files on this machine's disk."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for top in folders for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}


def exchanges(df):
    """What the plan shuffles, broadcasts left out."""
    return re.findall(r"(?<!Broadcast)Exchange (\w+)", df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0])


def test_packed_words_come_back(spark):
    rows = spark.createDataFrame([(a, b, c) for a in ODD for b in ODD for c in ODD], "a string, b string, c string")
    packed = rows.select("a", "b", "c", pack("a", "b", "c").alias("p"))
    assert packed.select("p").distinct().count() == len(ODD) ** 3
    back = packed.select("a", "b", "c", *[unpack(F.col("p"), i, 3).alias(f"x{i}") for i in range(3)])
    assert back.filter("NOT (a <=> x0 AND b <=> x1 AND c <=> x2)").isEmpty()


def test_packed_counts_are_the_counts(spark, rows):
    tri = trigrams(spark, ODD)
    key = lambda t: str(t)
    assert sorted(map(tuple, ngrams.trigram_counts(tri, packed=True).collect()), key=key) == sorted(map(tuple, ngrams.trigram_counts(tri).collect()), key=key)
    known = tri.fillna("~").select(*ngrams.never_null("w1", "w2", "w3"), "cnt")
    assert rows(ngrams.bigram_counts(known, packed=True)) == rows(ngrams.bigram_counts(known))
    assert [f.nullable for f in ngrams.trigram_counts(known, packed=True).schema.fields[:3]] == [False] * 3


@pytest.mark.parametrize("words", [list("abcdef"), ODD])
def test_steps_give_the_same_parameters(spark, words):
    tri = trigrams(spark, words)
    for as_written in (False, True):
        plain = next_word.next_word_prob(tri, as_written).withColumn("prob", F.round("prob", 9))
        steps = next_word.next_word_prob(tri, as_written, in_steps=True).withColumn("prob", F.round("prob", 9))
        assert steps.schema.simpleString() == plain.schema.simpleString()
        assert steps.exceptAll(plain).isEmpty() and plain.exceptAll(steps).isEmpty() and not plain.isEmpty()
    assert next_word.next_word_prob(tri.filter("cnt < 0"), in_steps=True).collect() == []


def test_last_step_shuffles_the_trigrams_once(spark):
    steps = next_word.next_word_prob(trigrams(spark, list("abcdef")), in_steps=True)
    steps.collect()
    assert len(exchanges(steps)) == 2  # trigrams with their contexts, and bigrams


def test_only_what_is_read_stays(spark):
    before, kept = set(os.listdir(shared_dir(spark).removeprefix("file:"))), shuffle_files(spark)
    steps = next_word.next_word_prob(trigrams(spark, list("abcdef")), in_steps=True)
    left = sorted(name.rsplit("-", 1)[0] for name in set(os.listdir(shared_dir(spark).removeprefix("file:"))) - before)
    assert left == ["contexts", "trigrams-in-context"]
    for _ in range(50):
        new = shuffle_files(spark) - kept
        # The total comes from a sum of its own, one row a task.
        if len({name.split("_")[1] for name in new}) <= 1:
            break
        time.sleep(0.2)
    assert len({name.split("_")[1] for name in new}) <= 1
    assert steps.count() > 0


def test_tables_outlive_as_many_scopes_as_asked(spark):
    df = spark.range(10)
    with passing_tables(spark):
        with passing_tables(spark):
            a, b, c = settle(df, "a"), settle(df, "b", keep=1), settle(df, "c", keep=2)
            assert a.count() == 10
        assert b.count() == 10
    assert c.count() == 10
    for gone in (a, b):
        with pytest.raises(Exception, match="(?i)not.exist"):
            gone.collect()


def test_large_context_is_split_in_the_steps(spark, rows):
    settings = {
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "40KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    number = F.col("id").cast("string")
    # Half of the trigrams end in one pair of words.
    hot = spark.range(20_000).select(F.concat(F.lit("w"), number).alias("w1"), F.lit("hot").alias("w2"), F.lit("x").alias("w3"))
    cold = spark.range(20_000).select(F.concat(F.lit("a"), number).alias("w1"), F.concat(F.lit("b"), F.col("id") % 50).alias("w2"), number.alias("w3"))
    tri = hot.unionByName(cold).select(*ngrams.never_null("w1", "w2", "w3"), F.lit(1).cast("bigint").alias("cnt"))
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        steps = next_word.next_word_prob(tri, in_steps=True)
        assert rows(steps.filter("w2 = 'hot'").select("n1", "n2", "n3", "c1", "c2").distinct()) == [(20_000, 20_000, 1, 20_000, 1)]
        steps.collect()
        assert "skew=true" in steps._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def test_ranking_shuffles_rows_once(spark):
    rng = random.Random(3)
    data = [(rng.choice(["hot", "hot", None, "k"]), rng.choice([None, "x", "y"]), f"w{i:05d}", rng.choice([0.1, 0.2])) for i in range(5000)]
    df = spark.createDataFrame(data, "w1 string, w2 string, w3 string, prob double").repartition(6)
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(setting, "100")
    try:
        ranked = next_word.rank_continuations(df)
        got = {r.w3: r.rank for r in ranked.collect()}
    finally:
        spark.conf.unset(setting)
    want, seen = {}, {}
    for w1, w2, w3, _ in sorted(data, key=lambda t: (t[0] or "", t[1] or "", -t[3], t[2])):
        seen[w1, w2] = want[w3] = seen.get((w1, w2), 0) + 1
    assert got == want
    # Rows are numbered where they are written, so the plan that reads them shuffles none: only a row a range.
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert rank_in_group(df.filter("prob < 0"), ["w1"], [F.asc("w3")]).collect() == []


def test_ranked_text_is_read_without_a_shuffle_of_its_lines(spark, tmp_path):
    scored = spark.createDataFrame([(f"a{i % 7}", "b", f"c{i}", (i % 5) / 10) for i in range(3000)], "w1 string, w2 string, w3 string, prob double").repartition(5)
    matrices.write_ranked_text(scored, str(tmp_path / "ranked"))
    read = matrices.read_ranked_text(spark, str(tmp_path / "ranked"))
    want = sorted(scored.collect(), key=lambda r: (r.w1, r.w2, -r.prob, r.w3))
    got = read.orderBy("place").collect()
    assert [(r.place, r.trigram, r.prob) for r in got] == [(i, f"{r.w1} {r.w2} {r.w3}", r.prob) for i, r in enumerate(want)]
    read.collect()
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


@pytest.mark.parametrize("most", [ngrams.SMALL_LIST, -1])
def test_lists_drop_the_same_in_steps(spark, monkeypatch, most):
    monkeypatch.setattr(ngrams, "SMALL_LIST", most)
    tri = trigrams(spark, [*ODD, "stop", "halt"], n=800)
    listed = spark.createDataFrame([("stop",), (None,), ("halt",), ("stop",), (SEPARATOR,), ("",)], "word string")
    plain, steps = ngrams.drop_stopword_ngrams(tri, listed), ngrams.drop_stopword_ngrams(tri, listed, in_steps=True)
    assert steps.columns == plain.columns and not plain.isEmpty()
    assert steps.exceptAll(plain).isEmpty() and plain.exceptAll(steps).isEmpty()
    # A small list meets the trigrams where they are read; a large one in one shuffle of them at a time.
    steps.collect()
    assert len(exchanges(steps)) == (0 if most > 0 else 2)


def test_sums_by_words_keep_nulls_apart(spark):
    data = [(a, b, 1) for a in (None, "", "x") for b in (None, "", "y")] * 2
    got = sum_by_words(spark.createDataFrame(data, "a string, b string, n int"), ["a", "b"], {"n": F.sum("n"), "most": F.max("n")})
    assert {(r.a, r.b): (r.n, r.most) for r in got.collect()} == {(a, b): (2, 1) for a, b, _ in data} and got.count() == 9


def test_statistics_are_worked_out_once_for_all_rejects(spark, sf_dir):
    plan = QUERIES["count_rejects"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" not in plan and "Generate" not in plan


@pytest.mark.parametrize("name", ["arc_explode", "arc_files", "ngram_line_filter", "ngram_files", "ngram_sequence"])
def test_one_shuffle_is_left_when_lines_are_summed(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # The words go as one string.
    assert len(exchanges(df)) == 1 and "hashpartitioning(_packed" in plan


def test_distinct_features_are_counted(spark):
    rng = random.Random(9)
    lines = [(["h", *[f"{rng.choice('ab')}/X/{rng.choice(['n', '', 'v'])}/{rng.randint(0, 4)}" for _ in range(rng.randint(0, 5))]], 1) for _ in range(500)]
    found = arcs.with_arcs(spark.createDataFrame(lines, "toks array<string>, cnt bigint"))
    rows = found.select(F.size("arcs").alias("n"), arcs.count_distinct_features(F.col("arcs")).alias("a"), F.size(arcs.distinct_features(F.col("arcs"))).alias("b")).collect()
    assert all(r.a == r.b for r in rows) and {(2, 1), (2, 2), (1, 1), (0, 0)} <= {(r.n, r.a) for r in rows}
