"""Odd input neither aborts a job nor passes as good."""

import pytest

from corpusloom.functions.reports import url_object_key
from corpusloom.functions.text import whole_number
from corpusloom.operators import arcs, association, ngrams, tasks
from corpusloom.plans import next_word
from corpusloom.sizing import target_partitions
from corpusloom.sources.documents import documents_by_url


def test_counts_of_any_width(spark):
    cases = {"7": 7, "+7": 7, "-7": -7, "0" * 30 + "12": 12, "1234567890123456789": 1234567890123456789, str(2**63 - 1): 2**63 - 1}
    cases |= {str(2**63): None, "9" * 19: None, "9" * 30: None, "": None, "x": None, "1.0": None, None: None}
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    assert {r.v: r.n for r in df.select("v", whole_number(df.v).alias("n")).collect()} == cases


def test_missing_status_is_a_problem(spark):
    df = spark.createDataFrame([(None, "application/pdf"), (200, "application/pdf"), (404, "application/pdf")], "s int, t string")
    got = [r.p for r in df.select(tasks.content_problem(df.s, df.t).alias("p")).collect()]
    assert got == ["Failed to connect, HTTP response code: null", None, "Failed to connect, HTTP response code: 404"]


def test_smallest_head_index(spark):
    lines = spark.createDataFrame([("a\ta/X/n/-2147483648 b/X/n/1\t3\t2000,3",)], "value string")
    assert [tuple(r)[:2] for r in arcs.explode_arcs(arcs.with_arcs(arcs.accepted_arc_lines(lines))).select("lexeme", "head").collect()] == [("b", "a")]


def test_feature_beyond_the_size(spark):
    columns = ", ".join(f"{c} double" for c in association.EQUATIONS.values())
    assoc = spark.createDataFrame([("w", 5, 1.0, 1.0, 1.0, 1.0)], f"lexeme string, feature_idx int, {columns}")
    lexemes = spark.createDataFrame([("w",)], "lexeme string")
    assert len(association.dense_vectors(assoc, lexemes, 6).first().vector) == 6
    with pytest.raises(Exception, match="beyond the 5 coordinates"):
        association.dense_vectors(assoc, lexemes, 5).collect()


def test_workers_as_written():
    assert target_partitions(1, 10) == 1
    assert target_partitions(1, 10, as_written=True) == 0


DOC = "url string, http_status int, content_type string, body string"
TASK = "app_id string, line_no bigint, op string, url string"


def test_converters_of_any_outcome(spark):
    todo = [("1", 0, "ToImage", "a"), ("1", 1, "ToImage", "a"), ("1", 2, "ToHTML", "a"), ("1", 3, "ToImage", "b")]
    todo += [("1", 4, "ToText", None), ("1", 5, None, "a"), ("1", 6, "ToText", "a")]
    docs = [("a", 200, "application/pdf", "x"), ("b", 200, "application/pdf", None)]
    made = {"ToImage": lambda body: b"\x00\xff", "ToHTML": lambda body: 7}
    df = tasks.convert_tasks(spark.createDataFrame(todo, TASK), spark.createDataFrame(docs, DOC), made)
    got = {r.line_no: r for r in df.collect()}
    assert bytes(got[0].data) == bytes(got[1].data) == b"\x00\xff" and got[0].status == "success"
    assert (got[2].status, got[2].error) == ("error", "a converter gave int, not text or bytes")
    assert got[4].status == "error" and got[4].error == "Failed to download PDF from URL: "
    assert got[5].error == "Unsupported operation: "
    assert got[6].output == "x" and len(got) == 7


def test_object_keys_are_decoded(spark):
    cases = {"http://x/a%20b": "a b", "http://x/a+b%2Fc?q=1": "a+b/c", "http://x/50%": None, "http://x": "", None: None}
    df = spark.createDataFrame([(k,) for k in cases], "u string")
    assert {r.u: r.k for r in df.select("u", url_object_key(df.u).alias("k")).collect()} == cases


def test_documents_fetched_at_one_time(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "z"), ("b", None, "n"), (None, 3, "lost"), ("c", 1, "c")]
    landed = spark.createDataFrame(rows, "url string, fetched_at int, body string")
    got = {r.url: r.body for r in documents_by_url(landed).collect()}
    assert got == {"a": "z", "b": "n", "c": "c"}
    asked = spark.createDataFrame([("a",), ("a",), (None,)], "url string")
    assert [r.url for r in documents_by_url(landed, asked).collect()] == ["a"]


def test_ngrams_of_any_length(spark):
    docs = spark.createDataFrame([("a b c",), ("",), (None,), ("d",)], "text string")
    for n, want in ((1, ["a", "b", "c", "d"]), (2, ["a b", "b c"]), (3, ["a b c"]), (4, [])):
        assert sorted(" ".join(r.gram) for r in ngrams.ngrams(docs, n).collect()) == want


NINE = 9 * 10**17


def test_totals_beyond_64_bits(spark):
    """A legal line of 21 tokens and a count of 9e17 makes a total that no bigint holds."""
    tokens = " ".join(f"t{i}/X/n/{i + 2}" for i in range(20)) + " t20/X/ROOT/0"
    lines = spark.createDataFrame([(f"h\t{tokens}\t{NINE}",), (f"h\ta/X/n/2 b/X/R/0\t{2**63 - 1}",), (f"h\ta/X/n/2 b/X/R/0\t{2**63 - 1}",), ("h\tc/X/n/2 d/X/R/0\t5",)], "value string")
    stats = arcs.arc_statistics(arcs.with_arcs(arcs.accepted_arc_lines(lines)), spark.createDataFrame([("a",), ("c",), ("t0",)], "w string"))
    l_star, f_star = 20 * NINE + 2 * (2**63 - 1) + 5, 20 * NINE + 2 * (2**63 - 1) + 5
    assert tuple(map(int, arcs.wide_totals(stats).first())) == (l_star, f_star)
    assert tuple(arcs.global_counts(stats).first()) == (None, None)
    assert {(r.lexeme, r.feature): r.cnt for r in arcs.pair_counts(stats).collect()} == {("c", "d-n"): 5, ("t0", "t1-n"): NINE}
    assert "b-n" not in {r.feature for r in arcs.feature_counts(stats).collect()}
    twice = str(2 * (2**63 - 1))
    want = {("pair", "a", "b-n", twice), ("lexeme", "a", None, twice), ("feature", None, "b-n", twice), ("l_star", None, None, str(l_star)), ("f_star", None, None, str(f_star))}
    assert {tuple(r) for r in arcs.count_rejects(stats).collect()} == want
    measures = association.assoc_from_statistics(stats, skip=0).collect()
    assert {r.lexeme for r in measures} == {"c", "t0"} and all(r.pmi is not None for r in measures)


def test_corpus_total_beyond_64_bits(spark):
    rows = [("a", "b", f"w{i}", NINE) for i in range(4)]
    grams = spark.createDataFrame(rows, "w1 string, w2 string, w3 string, cnt bigint")
    assert ngrams.corpus_total(grams).first().c0 is None
    assert ngrams.corpus_total(grams.limit(2)).first().c0 == 6 * NINE
    scored = next_word.next_word_prob(grams).collect()
    assert len(scored) == 4 and all(r.c0 is None and 0 < r.prob < 1 for r in scored)
    assert ngrams.assemble_params(grams).filter("c0 IS NULL AND n1 = c2 / 4").count() == 4
