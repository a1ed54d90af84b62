"""A key with most of the rows is split in every join to a list, a vocabulary or documents."""

import pytest
from pyspark.sql import functions as F

from corpusloom.joins import lookup_join
from corpusloom.operators import arcs, ngrams, tasks

SETTINGS = {
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture
def lowered(spark):
    before = {key: spark.conf.get(key, None) for key in SETTINGS}
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def hot(spark, rows=20_000):
    """(word, other): half the rows have one word."""
    number = F.col("id").cast("string")
    word = F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("w"), (F.col("id") % 500).cast("string")))
    return spark.range(rows).select(word.alias("word"), F.concat(F.lit("o"), number).alias("other"))


def parts_of_hot(joined, word):
    """How many tasks hold the rows of the hot key after the join, all columns read."""
    rows = joined.withColumn("_part", F.spark_partition_id())
    return len({r._part for r in rows.collect() if r[word] == "hot"})


def test_vocabulary(spark, lowered):
    rows = hot(spark).select(F.col("word").alias("lexeme"), "other")
    kept = arcs.in_vocabulary(rows, spark.createDataFrame([("hot",), ("w1",), ("w1",)], "v string"))
    assert kept.columns == ["lexeme", "other"]
    assert kept.count() == 10_000 + 40
    assert parts_of_hot(kept, "lexeme") > 2


def test_stop_words(spark, lowered):
    rows = hot(spark).select(F.col("word").alias("w1"), F.lit("x").alias("w2"), F.col("other").alias("w3"), F.lit(1).alias("cnt"))
    kept = ngrams.drop_stopword_ngrams(rows, spark.createDataFrame([("w1",), ("o0",), ("o0",)], "v string"))
    assert kept.columns == rows.columns
    assert kept.count() == 20_000 - 40 - 1
    assert parts_of_hot(kept, "w1") > 2


def test_contexts(spark, lowered):
    tri = hot(spark).select(F.lit("s").alias("w1"), F.col("other").alias("w2"), F.col("word").alias("w3"), F.lit(1).cast("bigint").alias("cnt"))
    contexts = ngrams.pair_contexts(tri)
    assert contexts.filter("b = 'hot'").agg(F.sum("pair_cnt"), F.max("word_cnt")).first() == (10_000, 10_000)
    assert parts_of_hot(contexts, "b") > 2


def test_one_url(spark, lowered):
    todo = hot(spark, 60_000).select(
        F.lit("1").alias("app_id"), F.monotonically_increasing_id().alias("line_no"), F.lit("ToText").alias("op"), F.col("word").alias("url")
    )
    docs = spark.createDataFrame([("hot", 200, "application/pdf", "page")], "url string, http_status int, content_type string, body string")
    done = tasks.convert_tasks(todo, docs)
    tally = {r.status: r.n for r in done.groupBy("status").agg(F.count("*").alias("n")).collect()}
    assert tally == {"success": 30_000, "error": 30_000}
    done.collect()
    assert "skew=true" in done._jdf.queryExecution().executedPlan().toString()


def test_rows_equal_in_all_columns(spark, lowered):
    rows = spark.range(600_000).select(F.lit("hot").alias("lexeme"), F.lit(1).alias("cnt"))
    listed = spark.createDataFrame([("hot", 7), ("cold", 8), (None, 9)], "lexeme string, n int")
    joined = lookup_join(rows, listed, ["lexeme"])
    assert joined.columns == ["lexeme", "cnt", "n"]
    assert joined.agg(F.sum("n")).first()[0] == 7 * 600_000
    assert parts_of_hot(joined, "lexeme") > 2
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan  # no copies of the table


def test_null_keys_never_meet(spark):
    rows = spark.createDataFrame([("a", None, 1), (None, None, 2), ("a", "b", 3)], "x string, y string, n int")
    table = spark.createDataFrame([("a", "b", "z"), (None, None, "nothing"), ("a", None, "half")], "x string, y string, v string")
    got = lambda how: sorted((r.n, r.asDict().get("v")) for r in lookup_join(rows, table, ["x", "y"], how).collect())
    assert got("inner") == [(3, "z")] and got("left") == [(1, None), (2, None), (3, "z")]
    assert got("left_anti") == [(1, None), (2, None)] and got("left_semi") == [(3, None)]
