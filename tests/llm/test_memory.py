"""What the pipeline's stages hold: one Python worker a task, and tables of few rows in few files."""

import re
from pathlib import Path

import pytest

import corpus_pipeline
from corpusloom.llm import components, language, line_dedup, pieces, simhash
from corpusloom.workspace import materialize

LINES = ["a line that many of the documents share", "and one more of those lines, also shared"]


@pytest.fixture
def docs(spark):
    rows = [(i, "\n".join([*LINES, f"own words of number {i} in this text"]), "en" if i % 3 else None, "s", 10) for i in range(12)]
    return spark.createDataFrame([*rows, (12, None, "en", "s", 0), (13, "\n".join(LINES), None, None, None)], "doc_id long, text string, lang string, source string, n_chars int")


def workers(df) -> int:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"(?:ArrowEvalPython|MapInArrow)\b", plan))


def test_texts_are_judged_once(spark, docs, monkeypatch):
    texts = language.labelled(docs)
    trees, judged, judge = language.learn(texts), spark.sparkContext.accumulator(0), language.code_lengths

    def counted(trees, column):
        judged.add(len(column))
        return judge(trees, column)

    monkeypatch.setattr(language, "code_lengths", counted)
    assert set(language.most_bits(texts, trees)) == {"en"}
    assert judged.value == texts.count()


def test_limits_of_languages_without_texts_of_their_own(spark):
    """A language whose texts all look like another one has no limit, and one with texts has it."""
    texts = spark.createDataFrame([("x", "abab"), ("x", "abba"), ("y", "abab")], "lang string, text string")
    trees = language.learn(texts)
    assert set(language.most_bits(texts.filter("lang = 'x'"), trees)) == {"x"}
    assert set(language.most_bits(spark.createDataFrame([("y", "abba"), ("x", "abba")], "lang string, text string"), trees)) == {"x"}
    assert language.most_bits(texts.limit(0), trees) == {}


def test_texts_are_rewritten_once(spark, docs):
    done = corpus_pipeline.line_dedup_stage(spark, docs, "")
    # The prober of the shards and the rewriting.
    assert workers(done) == 2
    assert sorted(r.doc_id for r in done.collect()) == [*range(14)]


def test_fingerprints_are_made_once_to_choose(docs):
    assert workers(simhash.one_of_each(docs)) == 1


def test_encoded_and_decoded_by_one_worker(docs):
    done = pieces.round_trip(docs)
    assert workers(done) == 1
    vocabulary = pieces.load()
    parts = pieces.decode_ids(pieces.encode_texts(docs, vocabulary), vocabulary)
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, done.collect()))
    assert done.dtypes == parts.dtypes


def test_few_rows_in_few_files(spark, monkeypatch):
    written = []
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    shuffled = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "40")

    def kept(df, name, *rows):
        out = materialize(df, name, *rows)
        written.append((name, len(list(Path(out.inputFiles()[0].removeprefix("file:")).parent.glob("*.parquet")))))
        return out

    try:
        for module in (components, simhash, line_dedup):
            monkeypatch.setattr(module, "materialize", kept)
        texts = spark.range(300).selectExpr("id AS doc_id", "concat_ws('\n', 'some line that all of them share', repeat(cast(id AS string), 30)) AS text")
        assert line_dedup.dedup_lines(texts).filter("n_dropped = 1").count() == 299
        assert simhash.near_duplicates(texts).count() == 300
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", shuffled)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    cores = spark.sparkContext.defaultParallelism
    assert {name for name, _ in written} >= {"line-index", "print-nodes", "links", "edges", "print-roots"}
    # The number of distinct lines is not known before they are written.
    assert all(files <= max(cores, 4) for name, files in written if name != "line-counts"), written
