"""Readers and writers of the document batch."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import fields
from corpusloom.sources.corpus import read_ordered_lines
from corpusloom.sources.files import located

# Executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Files whose content a task holds together.
FILES_AT_ONCE = 16

# The name of a file without its ending.
JOB_OF_FILE = r"([^/]+?)(\.[^./]*)?$"


def parse_tasks(lines: DataFrame, *places: str, line: str = "value") -> DataFrame:
    """Lines `op, url` of a job as (app_id, *places, op, url); ``places`` are the columns that place a line."""
    f = fields(F.col(line))
    return lines.select("app_id", *places, F.get(f, F.lit(0)).alias("op"), F.get(f, F.lit(1)).alias("url"))


def read_tasks(spark: SparkSession, path: str | list[str], job: str = JOB_OF_FILE) -> DataFrame:
    """Task files as (app_id, line_no, op, url); ``job`` is a pattern whose group is the job's id in a file's path.

    The files of a job are one text, its lines numbered from 0.
    """
    lines = read_ordered_lines(spark, path, job)
    return parse_tasks(lines.select(F.col("of").alias("app_id"), F.col("place").alias("line_no"), "value"), "line_no")


def read_landed_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Landed binary documents as (url, fetched_at, http_status, content_type, body).

    The path under ``path`` stands for the URL. What the files contain is left to
    a converter; see ``convert_tasks``.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
    )
    return files.select(
        F.regexp_replace("path", "^[a-z]+:/+", "/").alias("url"),
        F.col("modificationTime").alias("fetched_at"),
        F.lit(200).alias("http_status"),
        _kind(F.col("path")).alias("content_type"),
        F.col("content").alias("body"),
    )


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files by path with their content as ``body``, a few at a time."""
    for batch in batches:
        for low in range(0, len(batch), FILES_AT_ONCE):
            part = batch.slice(low, FILES_AT_ONCE)
            bodies = []
            for path in part.column("path").to_pylist():
                system, place = located(path)
                with system.open_input_stream(place) as file:
                    bodies.append(file.read())
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(bodies, pa.binary())], [*part.schema.names, "body"])


def _written(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Write (part, name, value), ordered by name, as files; gives the number of each batch's lines."""
    system, place = located(path)
    folders, name, file = set(), None, None
    for batch in batches:
        for part, next_name, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if next_name != name:
                if file:
                    file.close()
                folder = f"{place}/part={part}"
                if folder not in folders:
                    system.create_dir(folder, recursive=True)
                    folders.add(folder)
                name, file = next_name, system.open_output_stream(f"{folder}/{next_name}")
            file.write((value or "").encode() + b"\n")
        yield pa.RecordBatch.from_arrays([pa.array([len(batch)], pa.int64())], ["lines"])
    if file:
        file.close()


def write_named_files(rows: DataFrame, path: str) -> None:
    """A text file of each name of ``rows`` (name, value), its lines the values; null ones are empty lines.

    The tasks open the files themselves, so that a file costs no folder, rename or work of
    the driver. They lie in a thousand folders at most, by which a listing is divided; a
    task that runs again writes the same files.
    """
    dealt = rows.filter("name IS NOT NULL").select("name", "value").repartition("name").sortWithinPartitions("name")
    placed = dealt.select(F.pmod(F.hash("name"), F.lit(1000)).alias("part"), "name", "value")
    placed.mapInArrow(lambda batches: _written(batches, path), "lines bigint").agg(F.sum("lines")).collect()


def newest_landed_files(spark: SparkSession, path: str, url: str, urls: DataFrame | None = None, glob: str = "*") -> DataFrame:
    """The file last changed of each URL as (url, fetched_at, http_status, content_type, body).

    ``url`` is a pattern whose group, in a file's path, stands for the URL. Files are
    ranked by names and times alone, of equal times the last by name counts, and
    ``urls`` (column ``url``) names those asked for. Only the files that are left are
    opened, in the task that gives out their row: no content is shuffled.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path)
    named = files.select(F.regexp_extract("path", url, 1).alias("url"), F.col("modificationTime").alias("fetched_at"), "path")
    newest = named.filter("url <> ''").groupBy("url").agg(F.max(F.struct("fetched_at", "path")).alias("last"))
    if urls is not None:
        newest = newest.join(urls.select("url").distinct(), "url", "left_semi")
    chosen = newest.select("url", "last.fetched_at", "last.path")
    read = chosen.mapInArrow(_bodies, "url string, fetched_at timestamp, path string, body binary")
    return read.select("url", "fetched_at", F.lit(200).alias("http_status"), _kind(F.col("path")).alias("content_type"), "body")


def _kind(path: Column) -> Column:
    return F.when(F.lower(path).endswith(".pdf"), "application/pdf").otherwise("application/octet-stream")


def documents_by_url(landed: DataFrame, urls: DataFrame | None = None) -> DataFrame:
    """One landed document per URL, the one fetched last; of several, the last in order of its columns.

    ``urls`` (column ``url``) names the documents asked for; others fall out. The time
    of the last fetch is found without bodies. Documents without a URL drop out.
    """
    narrow = landed.select("url", "fetched_at").filter(F.col("url").isNotNull())
    newest = narrow.groupBy("url").agg(F.max("fetched_at").alias("_last"))
    if urls is not None:
        newest = newest.join(urls.select("url").distinct(), "url", "left_semi")
    newest = newest.withColumnRenamed("url", "_url")
    same = (F.col("url") == F.col("_url")) & F.col("fetched_at").eqNullSafe(F.col("_last"))
    last = landed.join(newest, same, "left_semi")
    rest = [c for c in landed.columns if c != "url"]
    return last.groupBy("url").agg(F.max(F.struct(*rest)).alias("doc")).select("url", "doc.*")


def write_outputs(results: DataFrame, path: str) -> None:
    """Converted texts by job and operation, each row under its task's line number.

    The rebalance evens out file sizes: a large job gets several files, and small
    jobs do not get one file per task.
    """
    done = results.filter(F.col("status") == "success").select("app_id", "op", "line_no", "url", "output")
    done.hint("rebalance", "app_id", "op").write.partitionBy("app_id", "op").parquet(path)


def write_ordered_text(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Text of each job under ``app_id=<id>/``, in the order of ``position``.

    Ranges of (app_id, position) are written in order, so the part files of a
    job read one after the other give its text, whatever its size.
    """
    (
        lines.repartitionByRange("app_id", "position")
        .sortWithinPartitions("app_id", "position")
        .select("app_id", "line")
        .write.mode(mode)
        .partitionBy("app_id")
        .text(path)
    )


def write_summary(results: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The summary text of each job: its result lines by line number."""
    write_ordered_text(results.select("app_id", F.col("line_no").alias("position"), "line"), path, mode)
