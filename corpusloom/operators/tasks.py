"""Document jobs: submissions, tasks, conversion, completion and reports."""

from __future__ import annotations

from collections.abc import Callable, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.reports import (
    REPORT_FOOT,
    REPORT_HEAD,
    report_class,
    report_line,
    result_line,
    to_html,
    to_text,
)
from corpusloom.functions.text import fields
from corpusloom.joins import lookup_join
from corpusloom.operators.ranking import rank_in_group
from corpusloom.sizing import target_partitions_column

OPERATIONS = ("ToImage", "ToHTML", "ToText")
BUILT_IN = {"ToHTML": to_html, "ToText": to_text}
EXPECTED_TYPE = "application/pdf"


def submissions(messages: DataFrame, body: str = "body", order: str = "message_no") -> DataFrame:
    """Jobs (app_id, source, per_worker) among messages; a repeated id counts once, the first.

    A message of more than two fields submits a job; any other asks to stop.
    """
    f = fields(F.col(body))
    jobs = messages.filter(F.size(f) > 2).select(
        F.get(f, F.lit(0)).alias("app_id"),
        F.struct(F.get(f, F.lit(1)).alias("source"), F.get(f, F.lit(2)).try_cast("int").alias("per_worker")).alias("job"),
        F.col(order).alias("message_no"),
    )
    return jobs.groupBy("app_id").agg(F.min_by("job", "message_no").alias("job")).select("app_id", "job.*")


def stop_requests(messages: DataFrame, body: str = "body") -> DataFrame:
    """Messages of at most two fields."""
    return messages.filter(F.size(fields(F.col(body))) <= 2)


def tasks_per_app(tasks: DataFrame) -> DataFrame:
    """(app_id, expected): the number of tasks of each job."""
    return tasks.groupBy("app_id").agg(F.count(F.lit(1)).alias("expected"))


def parallelism_per_app(tasks: DataFrame, per_worker: Column | int, most: int = 8) -> DataFrame:
    """(app_id, expected, workers): tasks and the parallel tasks they call for."""
    workers = target_partitions_column(F.col("expected"), per_worker, most)
    return tasks_per_app(tasks).withColumn("workers", workers)


def deal_tasks(tasks: DataFrame, per_worker: Column | int, most: int = 8) -> DataFrame:
    """``tasks`` with ``part``, from 0: each job's tasks dealt over as many parts as it calls for, by a hash of the line number."""
    workers = parallelism_per_app(tasks, per_worker, most).select("app_id", "workers")
    dealt = lookup_join(tasks, workers, ["app_id"], "left")
    part = F.pmod(F.xxhash64("line_no"), F.coalesce("workers", F.lit(1)))
    return dealt.select(*tasks.columns, part.cast("int").alias("part"))


def content_problem(http_status: Column, content_type: Column) -> Column:
    """Why landed content cannot be used, or null."""
    return F.when(
        ~http_status.eqNullSafe(200),
        F.concat(F.lit("Failed to connect, HTTP response code: "), F.coalesce(http_status.cast("string"), F.lit("null"))),
    ).when(
        ~content_type.eqNullSafe(EXPECTED_TYPE),
        F.concat(F.lit("Error: Unexpected content type: "), F.coalesce(content_type, F.lit("null"))),
    )


def operation_problem(op: Column) -> Column:
    """Message for an operation that does not exist, or null."""
    unknown = ~F.coalesce(op.isin(*OPERATIONS), F.lit(False))
    return F.when(unknown, F.concat(F.lit("Unsupported operation: "), F.coalesce(op, F.lit(""))))


def _user_converters(converters: Mapping[str, Callable]) -> Callable[[Column, Column], Column]:
    """Per-document functions by operation as one Arrow-batched column; a failure becomes that row's error."""

    @F.pandas_udf("output string, data binary, error string")
    def run(ops: pd.Series, bodies: pd.Series) -> pd.DataFrame:
        rows = []
        for op, body in zip(ops, bodies):
            output = data = error = None
            if body is not None:
                try:
                    made = converters[op](body)
                    if isinstance(made, (bytes, bytearray)):
                        data = bytes(made)
                    elif made is None or isinstance(made, str):
                        output = made
                    else:
                        raise TypeError(f"a converter gave {type(made).__name__}, not text or bytes")
                except Exception as failure:  # any failure of a document stays with its row
                    error = str(failure) or type(failure).__name__
            rows.append((output, data, error))
        return pd.DataFrame(rows, columns=["output", "data", "error"], dtype=object)

    return run


def convert_tasks(
    tasks: DataFrame, documents: DataFrame, converters: Mapping[str, Callable] | None = None, per_worker: int | None = None
) -> DataFrame:
    """(app_id, line_no, op, url, status, output, error, cause) with one row per task.

    ``documents`` has one row per URL: (url, http_status, content_type, body). A
    task whose document is missing or unusable, whose operation is unknown, or
    whose conversion fails becomes an error row. ToHTML and ToText work on landed
    text inside the plan; ``converters`` adds or replaces operations by a function
    of one document body that gives text, or bytes for a further column ``data``.

    Each URL is converted once per operation, however many tasks ask for it, and
    only outcomes meet the tasks: a body is sent only where it is asked for.

    With ``per_worker`` the tasks are dealt by :func:`deal_tasks`, and the rows carry
    their ``part``: a job's results come in as many parts as it calls for.
    """
    converters = dict(converters or {})
    if per_worker is not None:
        tasks = deal_tasks(tasks, per_worker)
    asked = tasks.select("url", "op").filter(F.col("url").isNotNull()).distinct()
    landed = documents.select("url", "http_status", "content_type", "body")
    cause = content_problem(F.col("http_status"), F.col("content_type"))
    found = asked.join(landed, "url").withColumn("cause", cause)
    found = found.withColumn("problem", F.coalesce("cause", operation_problem(F.col("op"))))
    wanted: Callable[..., Column] = lambda *ops: F.col("problem").isNull() & F.col("op").isin(*ops)
    output, data, failure = (F.lit(None).cast(kind) for kind in ("string", "binary", "string"))
    if converters:
        body = F.when(wanted(*converters), F.col("body"))
        found = found.withColumn("_ran", _user_converters(converters)(F.col("op"), body))
        output, data, failure = (F.col(f"_ran.{name}") for name in ("output", "data", "error"))
    for op, convert in BUILT_IN.items():
        if op not in converters:
            output = F.when(wanted(op), convert(F.col("body").cast("string"))).otherwise(output)
    for op in sorted(set(OPERATIONS) - set(BUILT_IN) - set(converters)):
        failure = F.when(wanted(op), F.lit(f"Failed to convert: no converter for {op}")).otherwise(failure)
    outcomes = found.select(
        "url", "op", "cause", output.alias("output"), data.alias("data"), failure.alias("failure"), F.lit(True).alias("_landed")
    ).withColumnsRenamed({"url": "_url", "op": "_op"})

    # One key of both columns: it is always shuffled for this join, which may then split a URL many tasks ask for.
    def key(url: str, op: str) -> Column:
        return F.struct(F.col(url).alias("url"), F.col(op).alias("op"))

    joined = tasks.join(outcomes, key("url", "op") == key("_url", "_op"), "left").withColumn(
        "cause", F.coalesce(F.when(F.col("_landed").isNull(), "No landed document"), F.col("cause"))
    )
    download = F.concat(F.lit("Failed to download PDF from URL: "), F.coalesce("url", F.lit("")))
    error = F.coalesce(F.when(F.col("cause").isNotNull(), download), operation_problem(F.col("op")), F.col("failure"))
    return joined.select(
        "app_id",
        "line_no",
        "op",
        "url",
        F.when(error.isNull(), "success").otherwise("error").alias("status"),
        F.when(error.isNull(), F.col("output")).alias("output"),
        error.alias("error"),
        "cause",
        *([F.when(error.isNull(), F.col("data")).alias("data")] if converters else []),
        *(["part"] if per_worker is not None else []),
    )


def output_link(results: DataFrame) -> Column:
    """Where ``write_outputs`` puts a row: its partition folder and line number."""
    return F.concat(
        F.lit("app_id="), F.col("app_id"), F.lit("/op="), F.col("op"), F.lit("#"), F.col("line_no").cast("string")
    )


def result_lines(results: DataFrame) -> DataFrame:
    """(app_id, line_no, op, status, line): each result as a line of its job's summary."""
    out = F.when(F.col("status") == "success", output_link(results)).otherwise(F.col("error"))
    line = result_line(F.col("op"), F.col("url"), out)
    return results.select("app_id", "line_no", "op", "status", line.alias("line"))


def dedupe_results(results: DataFrame, arrival: str | None = None) -> DataFrame:
    """One result per (app_id, line_no), the first to arrive where ``arrival`` says.

    Among those that arrived together, or where no arrival is known, it is the one
    whose columns come first in order.
    """
    rest = [c for c in results.columns if c not in ("app_id", "line_no")]
    order = [arrival] if arrival else []
    first = F.min_by(F.struct(*rest), F.struct(*order, *[c for c in rest if c != arrival])).alias("first")
    return results.groupBy("app_id", "line_no").agg(first).select("app_id", "line_no", "first.*").select(results.columns)


def job_progress(results: DataFrame, expected: DataFrame) -> DataFrame:
    """(app_id, expected, received, complete) per job; results of unknown jobs drop out.

    Deliveries may repeat, so a line counts once. Counting per line comes first
    and per job second, each pre-aggregated, so a large job is no hot spot.
    """
    received = (
        results.select("app_id", "line_no").distinct().groupBy("app_id").agg(F.count(F.lit(1)).alias("received"))
    )
    known = expected.join(received, "app_id", "left")
    got = F.coalesce("received", F.lit(0)).cast("bigint")
    return known.select("app_id", "expected", got.alias("received"), (got == F.col("expected")).alias("complete"))


def completed_jobs(results: DataFrame, expected: DataFrame) -> DataFrame:
    """Jobs with a result for every task."""
    return job_progress(results, expected).filter("complete").select("app_id", "expected", "received")


def collect_results(lines: DataFrame) -> DataFrame:
    """(app_id, position, line): the summary of each job, numbered by line."""
    ranked = rank_in_group(lines.select("app_id", "line_no", "line"), ["app_id"], [F.asc("line_no")], "position")
    return ranked.select("app_id", "position", "line")


def status_summary(lines: DataFrame) -> DataFrame:
    """Tally of results by job, operation, status and report class."""
    kind = report_class(F.col("line")).alias("report_class")
    return lines.groupBy("app_id", "op", "status", kind).agg(F.count(F.lit(1)).alias("n"))


def render_report(lines: DataFrame) -> DataFrame:
    """(app_id, position, line): the report page of each job as ordered rows.

    The frame comes before and after the result lines. Written with
    ``write_ordered_text`` the rows form the page; no page is built in memory.
    """
    body = lines.select("app_id", F.col("line_no").alias("position"), report_line(F.col("line")).alias("line"))
    frame = lines.select("app_id").distinct()
    head = frame.select("app_id", F.lit(-1).cast("bigint").alias("position"), F.lit(REPORT_HEAD).alias("line"))
    foot = frame.select("app_id", F.lit(2**63 - 1).alias("position"), F.lit(REPORT_FOOT).alias("line"))
    return head.unionByName(body).unionByName(foot)
