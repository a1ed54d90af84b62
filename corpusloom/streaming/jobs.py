"""Document jobs as streams: arriving tasks, conversion, summaries, and results delivered more than once.

Delivery is at least once and in any order. What tells a finished job stands in
``completion``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from corpusloom.operators.tasks import convert_tasks, result_lines, tasks_per_app
from corpusloom.sources.corpus import line_places, number_lines, read_ordered_lines
from corpusloom.sources.documents import JOB_OF_FILE, parse_tasks, write_summary
from corpusloom.streaming.completion import follow_jobs


def read_stream(
    spark: SparkSession, path: str, schema: StructType | str, fmt: str = "parquet", glob: str | None = None, max_files: int | None = None
) -> DataFrame:
    """Files arriving in a folder; ``max_files`` bounds what one micro-batch takes."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def read_task_stream(spark: SparkSession, path: str, max_files: int | None = None, job: str = JOB_OF_FILE) -> DataFrame:
    """Task lines (app_id, op, url, file, split) from text files arriving in a folder, one job per file.

    ``job`` is a pattern whose group is the job's id in the file's path. ``file`` and
    ``split`` place a line for :func:`~corpusloom.sources.corpus.number_lines`.
    """
    lines = read_stream(spark, path, "value string", "text", max_files=max_files).select("value", *line_places())
    return parse_tasks(lines.withColumn("app_id", F.regexp_extract("file", job, 1)), "file", "split")


def convert_task_files(
    tasks: DataFrame, documents: DataFrame, path: str, checkpoint: str, converters: Mapping[str, Callable] | None = None
) -> StreamingQuery:
    """Convert the task files that a stream of :func:`read_task_stream` brings, then stop when drained.

    Every micro-batch writes the result lines of its jobs to ``path``/lines, by job, and
    (app_id, expected) to ``path``/announced, under its number: a repeated one replaces
    what it wrote.
    """

    def step(batch: DataFrame, number: int) -> None:
        todo = number_lines(batch)
        lines = result_lines(convert_tasks(todo, documents, converters))
        lines.select("app_id", "line_no", "line").write.mode("overwrite").partitionBy("app_id").parquet(f"{path}/lines/batch={number}")
        tasks_per_app(todo).write.mode("overwrite").parquet(f"{path}/announced/batch={number}")

    return tasks.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def summarise_jobs(spark: SparkSession, path: str, checkpoint: str, max_files: int | None = None) -> StreamingQuery:
    """Follow the lines and announcements under ``path`` and write a job's summary to ``path``/summaries when it is complete.

    Of the lines only the folders of the jobs that completed are read, and a line that
    was delivered again stands once.
    """
    lines = read_stream(spark, f"{path}/lines", "line_no bigint, app_id string", max_files=max_files)
    told = read_stream(spark, f"{path}/announced", "app_id string, expected bigint")

    def save(done: DataFrame, number: int) -> None:
        stored = spark.read.schema("line_no bigint, line string, app_id string").parquet(f"{path}/lines")
        own = stored.join(done.select("app_id"), "app_id", "left_semi").dropDuplicates(["app_id", "line_no"])
        write_summary(own, f"{path}/summaries/batch={number}", mode="overwrite")

    return follow_jobs(lines, told.select("app_id", "expected"), f"{path}/jobs", checkpoint, save)


def read_summaries(spark: SparkSession, path: str) -> DataFrame:
    """(app_id, position, line): the summaries under ``path`` in the order in which they stand, from 1."""
    lines = read_ordered_lines(spark, f"{path}/summaries", "/app_id=([^/]+)/")
    return lines.select(F.col("of").alias("app_id"), (F.col("place") + 1).alias("position"), F.col("value").alias("line"))


def dedupe_stream(results: DataFrame, event_time: str | None = None, horizon: str = "1 hour") -> DataFrame:
    """Each (app_id, line_no) once.

    Without ``event_time`` every key is remembered. With it, a key is forgotten
    ``horizon`` after the watermark, which bounds the state where redelivery is
    known to stop within that time.
    """
    keys = ["app_id", "line_no"]
    if event_time is None:
        return results.dropDuplicates(keys)
    return results.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark(keys)
