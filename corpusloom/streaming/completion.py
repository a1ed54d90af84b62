"""Completion of jobs from a stream of results, with state that ends with the job.

State is kept per job and bucket of line numbers, at most one bit for each line there can
be in it, so its size is bounded and a job of any length spreads over many. Each micro-batch gives
the number of new lines per bucket. They are added to a small table of open buckets,
written once per micro-batch under its number; a job whose lines reach the announced
number moves to the completed jobs. Its buckets are written to a folder that the stream
reads as well: the next micro-batch drops their state. Every table is named by the number
of its micro-batch, and a repeated micro-batch replaces its own, so a restart adds nothing.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

# Executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# A state row holds the numbers of up to 2 to this many lines, 128 KB at most. Every row costs a call
# of Python in each micro-batch that touches it, so a job whose lines lie far apart should not have many.
BUCKET_BITS = 20
BUCKET_LINES = 1 << BUCKET_BITS
# Of fewer lines their numbers are kept, of more one bit for every line there can be.
SPARSE = BUCKET_LINES // 32

OPEN = "app_id string, bucket bigint, received bigint, expected bigint"
COMPLETED = "app_id string, expected bigint, received bigint"
RETIRED = "app_id string, bucket bigint"


def _packed(lines: np.ndarray) -> bytes:
    """Sorted line numbers of a bucket as bytes, at most one bit for each that there can be."""
    if len(lines) < SPARSE:
        return lines.astype("<u4").tobytes()
    bits = np.zeros(BUCKET_LINES, bool)
    bits[lines] = True
    return np.packbits(bits).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    if len(data) < 4 * SPARSE:
        return np.frombuffer(data, "<u4").astype(np.int64)
    return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8)))


def _count_new(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The number of lines of one bucket that were not there before."""
    before = _unpacked(state.get[0]) if state.exists else np.zeros(0, np.int64)
    seen, over = before, False
    for part in parts:
        lines = part["line_no"].dropna().to_numpy(np.int64)
        seen = np.union1d(seen, lines - key[1] * BUCKET_LINES)
        over = over or len(lines) < len(part)
    # A row without a line number says that the job is over; what came with it came too late.
    if over:
        if state.exists:
            state.remove()
        return
    if len(seen) > len(before):
        state.update((_packed(seen),))
        yield pd.DataFrame({"app_id": [key[0]], "bucket": [key[1]], "received": [len(seen) - len(before)]})


def new_lines(results: DataFrame, retired: DataFrame | None = None) -> DataFrame:
    """Stream of (app_id, bucket, received): how many lines of a bucket are new in a micro-batch.

    ``results`` is a stream of (app_id, line_no), where lines may come again; rows without
    either drop out. The buckets named by the stream ``retired`` lose their state.
    """
    named = results.filter("app_id IS NOT NULL AND line_no IS NOT NULL").select("app_id", F.col("line_no").cast("bigint"))
    rows = named.select("app_id", F.shiftright("line_no", BUCKET_BITS).alias("bucket"), "line_no")
    if retired is not None:
        rows = rows.unionByName(retired.select("app_id", "bucket", F.lit(None).cast("bigint").alias("line_no")))
    grouped = rows.groupBy("app_id", "bucket")
    return grouped.applyInPandasWithState(
        _count_new, "app_id string, bucket bigint, received bigint", "seen binary", "update", GroupStateTimeout.NoTimeout
    )


def _at(path: str, table: str, number: int) -> str:
    return f"{path}/{table}/batch={number}"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)


def _start(spark: SparkSession, path: str) -> None:
    """The tables of no micro-batch, so that the first one finds them."""
    for table, schema in (("open", OPEN), ("completed", COMPLETED), ("retired", RETIRED)):
        spark.createDataFrame([], schema).write.mode("ignore").parquet(_at(path, table, -1))


def _advance(batch: DataFrame, number: int, path: str) -> DataFrame:
    """Move the tables on by one micro-batch; the jobs it completed as (app_id, expected, received)."""
    spark = batch.sparkSession
    # The micro-batch is run once and whole, to commit its state.
    batch.select("app_id", "bucket", "received", "expected").write.mode("overwrite").parquet(_at(path, "arrived", number))
    rows = _read(spark, _at(path, "arrived", number), OPEN).unionByName(_read(spark, _at(path, "open", number - 1), OPEN))
    sums = rows.groupBy("app_id", "bucket").agg(F.sum("received").alias("received"), F.max("expected").alias("expected"))
    written = F.regexp_extract(F.col("_metadata.file_path"), "/batch=(-?[0-9]+)/", 1).cast("int")
    earlier = _read(spark, f"{path}/completed", COMPLETED).filter(written < number).select("app_id").distinct()
    late = sums.join(earlier, "app_id", "left_semi")
    current = sums.join(earlier, "app_id", "left_anti")
    jobs = current.groupBy("app_id").agg(F.max("expected").alias("expected"), F.sum("received").alias("received"))
    jobs.filter("expected > 0 AND received >= expected").write.mode("overwrite").parquet(_at(path, "completed", number))
    done = _read(spark, _at(path, "completed", number), COMPLETED)
    current.join(done, "app_id", "left_anti").select("app_id", "bucket", "received", "expected").write.mode("overwrite").parquet(_at(path, "open", number))
    over = late.unionByName(current.join(done, "app_id", "left_semi")).filter("bucket IS NOT NULL")
    over.select("app_id", "bucket").write.mode("overwrite").parquet(_at(path, "retired", number))
    return done


def follow_jobs(
    results: DataFrame,
    announced: DataFrame,
    path: str,
    checkpoint: str,
    on_complete: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Drain the streams into the tables under ``path``, then stop.

    ``results`` is a stream of (app_id, line_no), ``announced`` one of (app_id, expected);
    of several announcements of a job the greatest counts. A job is written once to
    ``path``/completed, in the micro-batch in which the number of its different lines
    reaches or passes the expected one, whether the results or the announcement came
    last. ``on_complete`` is given these jobs and the number of the micro-batch, perhaps
    again after a failure.

    The table of open buckets has one row per bucket of an unfinished job and is
    written anew by each micro-batch; the completed jobs are kept, one row each, so that
    late results of a finished job open nothing.
    """
    spark = results.sparkSession
    _start(spark, path)
    retired = spark.readStream.schema(RETIRED).option("recursiveFileLookup", "true").parquet(f"{path}/retired")
    nothing = F.lit(None).cast("bigint")
    told = announced.filter("app_id IS NOT NULL AND expected IS NOT NULL")
    told = told.select("app_id", nothing.alias("bucket"), F.lit(0).cast("bigint").alias("received"), F.col("expected").cast("bigint"))
    moved = new_lines(results, retired).withColumn("expected", nothing).unionByName(told)

    def step(batch: DataFrame, number: int) -> None:
        done = _advance(batch, number, path)
        if on_complete:
            on_complete(done, number)

    writer = moved.writeStream.outputMode("update").foreachBatch(step).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def settle(spark: SparkSession, path: str, start: Callable[[], StreamingQuery]) -> StreamingQuery:
    """Drain by ``start`` and, where jobs ended, once more, so that their state is gone; the last query."""
    _start(spark, path)
    before = _read(spark, f"{path}/retired", RETIRED).count()
    query = start()
    query.awaitTermination()
    if _read(spark, f"{path}/retired", RETIRED).count() > before:
        query = start()
        query.awaitTermination()
    return query


def completed_jobs(spark: SparkSession, path: str) -> DataFrame:
    """(app_id, expected, received) of all jobs that :func:`follow_jobs` found complete."""
    return _read(spark, f"{path}/completed", COMPLETED)
