import math
import random

import pytest
from pyspark.sql import functions as F

from corpusloom import fixtures as fx
from corpusloom.catalog import QUERIES
from corpusloom.functions.stemming import stem_word
from corpusloom.functions.vectors import MEASURES, aligned, array_measures
from corpusloom.operators import arcs, association, ngrams, similarity
from corpusloom.plans.similarity import gold_similarity


def lines_of(spark, *items):
    return spark.createDataFrame([(x,) for x in items], "value string")


def arcs_of(spark, *items):
    return arcs.with_arcs(arcs.accepted_arc_lines(lines_of(spark, *items)))


def words(spark, *items):
    return spark.createDataFrame([(x,) for x in items], "lexeme string")


def test_arcs_by_hand(spark, rows):
    got = arcs.explode_arcs(
        arcs_of(
            spark,
            "h\tdogs/NNS/nsubj/2 bark/VB/ROOT/0 loudly/RB/advmod/2\t5\t1",
            "h\tbad x/X/n/9 x/X/n/zz x/X/n/-1 1/2/CD/n/3 a/X/dep/+1\t3",
            "h\t///// y/X/n/1 //q/2 z/X//2\t2",
        )
    )
    assert rows(got.select("cnt", "lexeme", "dep", "head")) == [
        (2, "", "q", "y"),
        (2, "z", "", "y"),
        (3, "a", "dep", "bad"),
        (5, "dogs", "nsubj", "bark"),
        (5, "loudly", "advmod", "bark"),
    ]


def test_totals_count_malformed_tokens_and_distinct_features(spark):
    lines = arcs_of(
        spark,
        "h\ta/X/n/2 b/X/ROOT/0 c/X/n/2 bad\t5",  # 4 tokens, one distinct feature of two arcs
        "h\tx\t7",  # one token, no arc
        "h\tx y/X/n/zz\t2",  # two tokens, no arc
        "h\t \t4",  # no token
    )
    stats = arcs.arc_statistics(lines, words(spark, "a"))
    totals = arcs.global_counts(stats).first()
    assert (totals.l_star, totals.f_star) == (3 * 5 + 0 + 1 * 2 - 4, 5)
    assert [tuple(r) for r in arcs.feature_counts(stats).collect()] == [("b-n", 10)]
    assert [tuple(r) for r in arcs.pair_counts(stats).collect()] == [("a", "b-n", 5)]
    assert [tuple(r) for r in arcs.lexeme_counts(stats).collect()] == [("a", 5)]


def test_statistics_add_up_under_repetition(spark, rows):
    items = ["h\ta/X/n/2 b/X/ROOT/0 c/X/v/1\t5", "h\tb/X/n/2 a/X/v/1\t3"]
    once = arcs.arc_statistics(arcs_of(spark, *items), words(spark, "a", "b"))
    twice = arcs.arc_statistics(arcs_of(spark, *items, *items), words(spark, "a", "b"))
    doubled = once.select("lexeme", "feature", *[(2 * F.col(c)).alias(c) for c in ("cnt", "l_part", "f_part")])
    assert twice.exceptAll(doubled).isEmpty() and doubled.exceptAll(twice).isEmpty()


STAT_LINES = ["h\ta/X/n/2 b/X/ROOT/0 c/X/n/2 bad\t5", "h\tx\t7", "h\t \t4", "h\tc/X/n/2 b/X/R/0\t9223372036854775807", "h\tc/X/n/2 b/X/R/0\t9"]


def test_arcs_are_shuffled_once(spark):
    stats = arcs.arc_statistics(arcs_of(spark, *STAT_LINES), words(spark, "a", "a", None))
    plan = stats._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert stats._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_large_vocabularies_give_the_same_statistics(spark, rows, monkeypatch):
    listed = words(spark, "a", "c", "c", None, "none")
    results = []
    for most in (arcs.SMALL_VOCABULARY, -1):
        monkeypatch.setattr(arcs, "SMALL_VOCABULARY", most)
        stats = arcs.arc_statistics(arcs_of(spark, *STAT_LINES), listed)
        tables = (arcs.pair_counts(stats), arcs.lexeme_counts(stats), arcs.feature_counts(stats), arcs.wide_totals(stats))
        results.append([rows(t) for t in tables])
        assert {r.kind for r in arcs.count_rejects(stats).collect()} == {"pair", "lexeme", "feature", "l_star", "f_star"}
    assert results[0] == results[1]
    assert results[0][0] == [("a", "b-n", 5)]


def test_only_bad_lines_are_parsed_for_the_rejects(spark):
    for bad in (arcs.rejected_arc_lines(lines_of(spark, "h\tt")), ngrams.rejected_ngrams(lines_of(spark, "a b c"))):
        assert "RLIKE(value" in bad._jdf.queryExecution().optimizedPlan().toString()


def test_lines_are_made_once(spark):
    tri = spark.createDataFrame([("a", "b", "c", 3)], "w1 string, w2 string, w3 string, cnt bigint")
    for lines in (arcs.accepted_arc_lines(fx.arc_lines(tri)), arcs.rejected_arc_lines(fx.arc_lines(tri))):
        steps = lines._jdf.queryExecution().optimizedPlan().toString().splitlines()
        assert sum("/X/ROOT/0 " in step for step in steps) == 1


def test_vocabulary_meets_sums(spark, sf_dir):
    plan = QUERIES["vocabulary_arcs"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("LeftSemi") < plan.index("Aggregate [lexeme")


def test_large_counts(spark):
    stats = arcs.arc_statistics(arcs_of(spark, *["h\ta/X/n/2 b/X/R/0\t2000000000"] * 2), words(spark, "a"))
    assert arcs.pair_counts(stats).first().cnt == 4_000_000_000


def test_line_rejects(spark):
    lines = lines_of(spark, "h\tt", "h\tt\tx", "h\tt\t5", "h\tt\t5\t\t", "h\tt\t\t", "h\t\t5", "")
    assert arcs.accepted_arc_lines(lines).count() == 3
    bad = {r.line: r.problem for r in arcs.rejected_arc_lines(lines).collect()}
    assert bad == {"h\tt": "fields", "h\tt\tx": "count", "h\tt\t\t": "fields", "": "fields"}


def test_accepted_and_rejected_make_up_the_input(spark):
    rng = random.Random(2)
    lines = ["".join(rng.choices(["a", "\t", " ", "7", "x/y", "\t\t"], k=rng.randint(0, 8))) for _ in range(3000)]
    df = lines_of(spark, *lines)
    good, staged = arcs.accepted_arc_lines(df), arcs.staged_arc_lines(df).filter("problem is null")
    assert good.count() + arcs.rejected_arc_lines(df).count() == len(lines)
    assert good.exceptAll(staged.select("toks", "cnt")).isEmpty() and good.count() == staged.count() > 0


def test_dictionary_ranks(spark):
    counts = spark.createDataFrame([(f"f{i:02d}", 100 - i // 2) for i in range(50)], "feature string, cnt bigint")
    assert arcs.top_features(counts).isEmpty()
    top = arcs.top_features(counts, skip=0, take=3).orderBy("feature_idx").collect()
    assert [(r.feature, r.feature_idx) for r in top] == [("f00", 0), ("f01", 1), ("f02", 2)]
    assert arcs.top_features(counts, skip=10).count() == 40


def test_non_ascii_features_match(spark):
    stats = arcs.arc_statistics(arcs_of(spark, "h\tשלום/X/n/2 été/X/ROOT/0\t5"), words(spark, "שלום"))
    assoc = association.assoc_from_statistics(stats, skip=0, take=10)
    assert [(r.lexeme, r.feature, r.freq) for r in assoc.collect()] == [("שלום", "été-n", 5.0)]


def test_association_by_hand(spark):
    stats = arcs.arc_statistics(
        arcs_of(spark, "h\ta/X/n/2 b/X/ROOT/0\t4", "h\ta/X/v/2 c/X/ROOT/0\t2", "h\td/X/n/2 b/X/ROOT/0\t4"), words(spark, "a")
    )
    r = association.assoc_from_statistics(stats, skip=0, take=10).filter("feature = 'b-n'").first()
    # l_star 10, f_star 10, count(a) 6, count(b-n) 8, count(a, b-n) 4
    expected = 6 / 10 * (8 / 10)
    assert (r.freq, r.prob) == (4.0, pytest.approx(4 / 6))
    assert r.pmi == pytest.approx(math.log(0.4 / expected))
    assert r.ttest == pytest.approx((0.4 - expected) / math.sqrt(expected))


def test_gold_pairs(spark, rows):
    gold = spark.createDataFrame(
        [("b", "a", "no", 1), ("a", "b", "yes", 2), ("b", "a", "last", 3), ("c", "c", "x", 4), ("a", "c", "y", 5)],
        "l1 string, l2 string, relatedness string, line_no bigint",
    )
    assert rows(similarity.canonical_pairs(gold)) == [("a", "b", "last"), ("a", "c", "y")]
    assert rows(similarity.canonical_pairs(gold, as_written=True)) == [("a", "b", "yes"), ("a", "c", "y")]
    stems = spark.createDataFrame(
        [("meetings", "meeting", "x", 1), ("cats", "ponies", "y", 2)],
        "l1 string, l2 string, relatedness string, line_no bigint",
    )
    assert rows(similarity.canonical_pairs(stems, stem_word)) == [("cat", "poni", "y")]


def reference_measures(a, b):
    def ratio(x, y):
        return x / y if y else 0.0

    both = sum(x > 0 and y > 0 for x, y in zip(a, b))
    return {
        "cosine": ratio(sum(x * y for x, y in zip(a, b)), math.hypot(*a) * math.hypot(*b)),
        "jaccard": ratio(both, sum(x > 0 or y > 0 for x, y in zip(a, b))),
        "euclidean": math.dist(a, b),
        "dice": ratio(2 * both, sum(a) + sum(b)),
        "overlap": ratio(sum(map(min, a, b)), sum(map(max, a, b))),
        "manhattan": sum(abs(x - y) for x, y in zip(a, b)),
    }


VECTORS = [
    ([1.0, 2.0, 0.0], [0.0, 2.0, 5.0]),
    ([-1.0, 2.0, 0.5], [3.0, -2.0, 0.5]),
    ([0.0, 0.0, 0.0], [0.0, 0.0, 0.0]),
    ([0.0, 0.0, 0.0], [1.0, 0.0, 2.0]),
    ([1.5, -2.0, 0.0], [1.5, -2.0, 0.0]),
]


@pytest.mark.parametrize("a,b", VECTORS)
def test_measures(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a array<double>, b array<double>")
    for x, y in ((a, b), (b, a)):
        df = spark.createDataFrame([(x, y)], "a array<double>, b array<double>")
        got = df.select(*[v.alias(n) for n, v in array_measures(aligned(F.col("a"), F.col("b"))).items()]).first()
        for name, value in reference_measures(a, b).items():
            assert got[name] == pytest.approx(value), name
    # The sparse form, which leaves out coordinates that are zero in both.
    cells = [("p", "q", "r", i, *[x] * 4, *[y] * 4) for i, (x, y) in enumerate(zip(a, b)) if x or y]
    names = ", ".join(f"{s}_{e} double" for s in "ab" for e in ("freq", "prob", "pmi", "ttest"))
    cells = cells or [("p", "q", "r", None, *[0.0] * 8)]
    sparse = spark.createDataFrame(cells, f"l1 string, l2 string, relatedness string, feature_idx int, {names}")
    row = similarity.assemble_similarity(sparse).first()
    assert all(row[f"{m}_pmi"] == pytest.approx(reference_measures(a, b)[m]) for m in MEASURES)


def test_pairs_without_features_give_zeros(spark):
    lines = arcs.accepted_arc_lines(lines_of(spark, "h\ta/X/n/2 b/X/ROOT/0\t5", "h\tc/X/n/2 b/X/ROOT/0\t5"))
    gold = spark.createDataFrame(
        [("c", "a", "yes", 1), ("a", "z", "no", 2)], "l1 string, l2 string, relatedness string, line_no bigint"
    )
    got = gold_similarity(lines, words(spark, "a", "c", "z"), gold).collect()
    assert [(r.l1, r.l2, r.relatedness) for r in got] == [("a", "c", "yes")]
    assert all(got[0][f] == 0.0 for f in similarity.FEATURES)
    full = gold_similarity(lines, words(spark, "a", "c", "z"), gold, skip=0).first()
    assert full.cosine_freq == pytest.approx(1.0) and full.euclidean_freq == 0.0 and full.jaccard_freq == 1.0


def test_dense_and_sparse_agree(spark, rows):
    stats = arcs.arc_statistics(
        arcs_of(spark, "h\ta/X/n/2 b/X/ROOT/0 c/X/v/1\t5", "h\tc/X/n/2 b/X/ROOT/0\t3"), words(spark, "a", "c", "b")
    )
    assoc = association.assoc_from_statistics(stats, skip=0, take=10)
    vectors = association.dense_vectors(assoc, arcs.lexeme_counts(stats), 10)
    assert vectors.count() == 4 * arcs.lexeme_counts(stats).count()
    assert vectors.filter(F.size("vector") != 10).isEmpty()
    assert rows(association.sparse_from_dense(vectors)) == rows(assoc.drop("feature"))


# Words and stems of the paper's examples, and of the two rules that differ.
