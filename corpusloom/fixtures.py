"""Inputs of the reference's shapes, derived by Spark from the test tables.

Each has a twin in ``oracle.py``. Nothing here is part of an operator.
"""

from __future__ import annotations

import math
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions.packing import sum_by_words
from corpusloom.operators.ngrams import frequent_words, sliding_trigrams, trigram_counts, word_counts
from corpusloom.sources.documents import write_named_files
from corpusloom.workspace import settle

VOCABULARY_COUNT = 100
# Counts up to 922 times this stay within 64 bits, their sums do not.
LARGE = 10**16
# Text whose n-grams one task counts in memory before the shuffle: about 100 bytes a trigram, a trigram every 7 bytes.
TASK_TEXT = 1 << 24


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, dealt out anew: the test files have one row group each, which one task would read.

    Tasks go by the text, not by the shuffled bytes: a partition that adaptive execution
    put together by those holds more n-grams than a task has memory for, and spills them.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    size = docs.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    return docs.repartition(max(spark.sparkContext.defaultParallelism, math.ceil(size / TASK_TEXT)), "doc_id")


def trigram_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row (w1, w2, w3, cnt=1) per trigram occurrence."""
    return sliding_trigrams(documents(spark, sf_dir))


def trigram_rows_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trigram rows with their source, which stands in for the year."""
    return sliding_trigrams(documents(spark, sf_dir), "text", "source")


def tri(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trigram_counts(trigram_rows(spark, sf_dir), packed=True)


def _shape_number(modulus: int) -> Column:
    """A number from word lengths, equal in every engine."""
    return (7 * F.length("w1") + 3 * F.length("w2") + F.length("w3")) % modulus


def _made_once(rows: DataFrame, value: Column) -> DataFrame:
    """The column ``value``, worked out once a row: what is tested on it is not tested below on a second copy."""
    return rows.select(F.explode(F.array(value)).alias("value"))


def ngram_lines(spark: SparkSession, sf_dir: str, written: bool = False) -> DataFrame:
    """Lines `w1 w2 w3, source number, cnt, 1`, some of them broken in one way each; ``written`` where they are shuffled again."""
    rows = sum_by_words(trigram_rows_by_source(spark, sf_dir), ["w1", "w2", "w3", "source"], {"cnt": F.sum("cnt")})
    if written:
        rows = settle(rows, "source-counts")
    rows = rows.withColumn("flaw", _shape_number(40))
    gram = F.concat_ws(" ", "w1", "w2", "w3")
    year = F.regexp_replace("source", "[^0-9]", "")
    cnt = F.col("cnt").cast("string")
    flaw = F.col("flaw")
    line = (
        F.when(flaw == 0, F.concat_ws("\t", gram, year, cnt))
        .when(flaw == 1, F.concat_ws("\t", F.concat(gram, F.lit(" four")), year, cnt, F.lit("1")))
        .when(flaw == 2, F.concat_ws("\t", gram, year, F.concat(cnt, F.lit("x")), F.lit("1")))
        .when(flaw == 3, F.concat_ws("\t", gram, year, cnt, F.lit("1"), F.lit("9"), F.lit("\t\t")))
        .when(flaw == 4, F.concat_ws("\t", gram, year, cnt, F.lit("\t\t")))
        .when(flaw == 5, F.concat_ws("\t", F.concat_ws(" ", "w1", "w2"), year, cnt, F.lit("1")))
        .otherwise(F.concat_ws("\t", gram, year, cnt, F.lit("1")))
    )
    return _made_once(rows, line)


def stopword_list(ngrams: DataFrame) -> DataFrame:
    """The 20 most frequent words."""
    return frequent_words(ngrams, 20).select("word")


def arc_lines(trigrams: DataFrame) -> DataFrame:
    """Lines `head, tokens, cnt, per-year` with two arcs each, some tokens and lines broken."""

    def label(word: str) -> Column:
        return F.when(F.length(word) % 2 == 0, "n").otherwise("v")

    good = F.concat(
        F.col("w1"), F.lit("/X/"), label("w1"), F.lit("/2 "),
        F.col("w2"), F.lit("/X/ROOT/0 "),
        F.col("w3"), F.lit("/X/"), label("w3"), F.lit("/2"),
    )
    flaw = F.col("flaw")
    toks = F.concat(
        good,
        F.when(flaw == 0, " bad")
        .when(flaw == 1, " x/X/n/9")
        .when(flaw == 2, " x/X/n/zz")
        .when(flaw == 3, " x/X/n/-1")
        .when(flaw == 4, " 1/2/CD/n/3")
        .when(flaw == 5, "  y/X/n/1 ")
        .otherwise(""),
    )
    cnt = F.col("cnt").cast("string")
    line = (
        F.when(flaw == 6, F.concat_ws("\t", "w2", toks))
        .when(flaw == 7, F.concat_ws("\t", "w2", toks, F.concat(F.lit("n"), cnt)))
        .otherwise(F.concat_ws("\t", "w2", toks, cnt, F.concat(F.lit("2001,"), cnt)))
    )
    return _made_once(trigrams.withColumn("flaw", _shape_number(40)), line)


def vocabulary(trigrams: DataFrame) -> DataFrame:
    """(lexeme, letters, r): last words of at least three letters seen often, numbered by word in their length."""
    words = word_counts(trigrams).filter((F.col("letters") >= 3) & (F.col("cnt") >= VOCABULARY_COUNT))
    place = Window.partitionBy("letters").orderBy("word")
    return words.select(F.col("word").alias("lexeme"), "letters", F.row_number().over(place).alias("r"))


def rare_words(trigrams: DataFrame) -> DataFrame:
    """Last words seen once; a list that grows with the documents."""
    return word_counts(trigrams).filter("cnt = 1").select("word")


def gold_lines(words: DataFrame) -> DataFrame:
    """Numbered lines `word1, word2, label`: neighbours of rank distance 1 and 7
    among the words of one length.

    Pairs of even rank are reversed; some pairs come again later with the other
    label; some pair a word with itself or with an unknown word.
    """
    near = words.select(F.col("lexeme").alias("a"), "letters", "r", F.explode(F.array(F.lit(1), F.lit(7))).alias("d"))
    other = words.select(F.col("lexeme").alias("b"), "letters", F.col("r").alias("rb"))
    pairs = near.withColumn("rb", F.col("r") + F.col("d")).join(other, ["letters", "rb"])
    same = F.substring("a", 1, 1) == F.substring("b", 1, 1)
    yes, no = F.lit("True"), F.lit("False")
    even = F.col("r") % 2 == 0
    first = pairs.select(
        F.when(even, F.col("b")).otherwise(F.col("a")).alias("x"),
        F.when(even, F.col("a")).otherwise(F.col("b")).alias("y"),
        F.when(same, yes).otherwise(no).alias("label"),
        (F.col("r") * 10 + F.col("d")).alias("line_no"),
    )
    again = pairs.filter("r % 5 = 0").select(
        F.col("a").alias("x"),
        F.col("b").alias("y"),
        F.when(same, no).otherwise(yes).alias("label"),
        (F.col("r") * 10 + F.col("d") + 1000).alias("line_no"),
    )
    selfs = words.filter("r % 11 = 0").select(
        F.col("lexeme").alias("x"), F.col("lexeme").alias("y"), yes.alias("label"), (F.col("r") * 10 + 8).alias("line_no")
    )
    unknown = words.filter("r % 13 = 0").select(
        F.col("lexeme").alias("x"), F.lit("~none~").alias("y"), no.alias("label"), (F.col("r") * 10 + 9).alias("line_no")
    )
    lines = first.unionByName(again).unionByName(selfs).unionByName(unknown)
    return lines.select(F.col("line_no").cast("bigint").alias("line_no"), F.concat_ws("\t", "x", "y", "label").alias("value"))


def task_lines(pages: DataFrame) -> DataFrame:
    """(app_id, line_no, value): four jobs of lines `op, url`; some ask for a URL that is not landed."""
    n = F.col("page_id") % 10
    op = (
        F.when(n == 0, "ToImage").when(n == 1, "ToPdf").when(n.isin(2, 3), "ToText").otherwise("ToHTML")
    )
    url = F.when(F.col("page_id") % 9 == 0, F.concat("url", F.lit("&gone=1"))).otherwise(F.col("url"))
    return pages.select(
        (F.col("page_id") % 4).cast("string").alias("app_id"),
        F.col("page_id").alias("line_no"),
        F.concat_ws("\t", op, url).alias("value"),
    )


# The job of a task list written by write_task_files.
JOB_OF_FOLDER = "/app_id=([^/]+)/"


def write_task_files(lines: DataFrame, path: str) -> None:
    """Task lists as text, a folder with one file per job, its lines in order."""
    dealt = lines.repartition("app_id").sortWithinPartitions("app_id", "line_no")
    dealt.select("app_id", "value").write.mode("append").partitionBy("app_id").text(path)


def escaped_urls(pages: DataFrame) -> DataFrame:
    """(page_id, url): paths of every third page begin with escapes, of every seventh other page with a broken one."""
    page = F.col("page_id")
    host = "^([a-z]+://[^/]+/)"
    good, bad = F.regexp_replace("url", host, "$1%41%20b+c%2F"), F.regexp_replace("url", host, "$1%zz")
    return pages.select("page_id", F.when(page % 3 == 0, good).when(page % 7 == 0, bad).otherwise(F.col("url")).alias("url"))


PAGE_OF_FILE = "/page_id=([0-9]+)$"


def write_landed_files(pages: DataFrame, path: str) -> None:
    """A file per page and fetch: of every second page an old one, of all but every fifth a new one, written later."""
    page = F.col("page_id")
    old = pages.filter((page % 2 == 0) | (page % 5 == 0)).select(page, F.concat(F.lit("old "), "html").alias("value"))
    new = pages.filter(page % 5 != 0).select(page, F.col("html").alias("value"))
    for fetch, rows in enumerate((old, new)):
        write_named_files(rows.select(F.concat(F.lit("page_id="), page.cast("string")).alias("name"), "value"), f"{path}/fetch={fetch}")


def landed_documents(pages: DataFrame) -> DataFrame:
    """(url, fetched_at, http_status, content_type, body), some URLs fetched twice.

    Every third body has a page break, some fetches failed or gave another type.
    """
    page = F.col("page_id")
    broken = F.replace("html", F.lit("<body>"), F.lit("<body>\f"))
    now = pages.select(
        "url",
        F.lit(2).alias("fetched_at"),
        F.when(page % 13 == 0, 404).otherwise(200).alias("http_status"),
        F.when(page % 17 == 0, "text/plain").otherwise("application/pdf").alias("content_type"),
        F.when(page % 3 == 0, broken).otherwise(F.col("html")).alias("body"),
    )
    before = pages.filter(page % 7 == 0).select(
        "url",
        F.lit(1).alias("fetched_at"),
        F.lit(200).alias("http_status"),
        F.lit("application/pdf").alias("content_type"),
        F.lit("stale").alias("body"),
    )
    return now.unionByName(before)


def messages(pages: DataFrame) -> DataFrame:
    """(message_no, body): job submissions, every third job twice, and stop requests."""
    page = F.col("page_id")
    job = F.concat(F.lit("job"), (page % 100).cast("string"))
    per_worker = (page % 7 + 1).cast("string")
    body = F.when(page % 10 == 9, F.concat(job, F.lit("\tstop"))).otherwise(F.concat_ws("\t", job, "url", per_worker))
    return pages.select(page.alias("message_no"), body.alias("body"))


def deliveries(events: DataFrame) -> DataFrame:
    """(app_id, line_no, op, arrival): results of jobs, every twentieth delivered twice.

    The second delivery arrives later with another content; jobs whose id is a
    multiple of 10 miss their lines divisible by 50.
    """
    named = events.select(
        F.col("user_id").cast("string").alias("app_id"),
        F.col("event_id").alias("line_no"),
        F.col("event_type").alias("op"),
        F.lit(1).alias("arrival"),
        "user_id",
    )
    first = named.filter(~((F.col("user_id") % 10 == 0) & (F.col("line_no") % 50 == 0))).drop("user_id")
    again = first.filter("line_no % 20 = 0").withColumn("op", F.lit("again")).withColumn("arrival", F.lit(2))
    return first.unionByName(again)


HORIZON = "2 days"
# Far enough for the state of the first delivery to be gone when the second comes.
AGAIN_DAYS = 15


def timed_deliveries(events: DataFrame) -> DataFrame:
    """(app_id, line_no, at): every event, some an hour later again, some of them days later."""
    first = events.select(F.col("user_id").cast("string").alias("app_id"), F.col("event_id").alias("line_no"), F.col("ts").cast("timestamp").alias("at"))
    soon = first.filter("line_no % 20 = 0").withColumn("at", F.col("at") + F.expr("INTERVAL 1 HOUR"))
    late = first.filter("line_no % 33 = 0").withColumn("at", F.col("at") + F.expr(f"INTERVAL {AGAIN_DAYS} DAYS"))
    return first.unionByName(soon).unionByName(late)


def slices(deliveries: DataFrame, days: int = 10) -> list:
    """(start, end) of ten days each, over all deliveries."""
    first, last = deliveries.agg(F.min("at"), F.max("at")).first()
    step = timedelta(days=days)
    return [(first + i * step, first + (i + 1) * step) for i in range((last - first) // step + 1)]


def announced_jobs(events: DataFrame) -> DataFrame:
    """(app_id, expected): every job with an id not divisible by 3 is known."""
    counts = events.filter("user_id % 3 <> 0").groupBy(F.col("user_id").cast("string").alias("app_id"))
    return counts.agg(F.count(F.lit(1)).alias("expected"))


def embedding_pairs(embeddings: DataFrame) -> DataFrame:
    """(vec_id, a, b): each vector with its successor."""
    nxt = embeddings.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("b"))
    return embeddings.select("vec_id", F.col("embedding").alias("a")).join(nxt, "vec_id")
