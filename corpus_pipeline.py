"""Preparing a corpus for training in five stages, each written as Parquet before the next reads it.

Every stage takes (spark, docs, sf_dir) and works on all that the one before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corpusloom.fixtures import table
from corpusloom.llm import decontaminate, language, line_dedup, pieces, simhash
from corpusloom.workspace import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without a letter, and those that cost far more bits a byte than its texts do, go."""
    return language.understood(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many share; n_chars follows the text, and a document without any line left goes."""
    keep = tuple(c for c in docs.columns if c not in ("doc_id", "text", "n_chars"))
    done = line_dedup.dedup_lines(docs, keep=keep)
    done = done.filter("NOT (n_dropped > 0 AND trim(text) = '')").withColumn("n_chars", _length(docs))
    return done.select(*docs.columns)


def _length(docs: DataFrame):
    from pyspark.sql import functions as F

    return F.char_length("text").cast(dict(docs.dtypes).get("n_chars", "bigint"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates, the one with the smallest doc_id: 4-word shingles, at most 4 differing bits."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    return decontaminate.remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_ids, text): every text's ids, and the text decoded from them."""
    from pyspark.sql import functions as F

    done = pieces.round_trip(docs)
    return done.select("doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), F.col("decoded").alias("text"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup_stage),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

# Language identification, XXH64 fingerprints and piece encoding have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
