"""Streams of tasks and results: restarts, repeated delivery, and state that ends with the job."""

import random

import numpy as np
import pytest

from corpusloom.streaming import completion, jobs

RESULT = "app_id string, line_no bigint"
TOLD = "app_id string, expected bigint"


def drain(query):
    query.awaitTermination(120)
    assert query.exception() is None
    return query


class Jobs:
    """Folders of results and announcements, and the stream over them."""

    def __init__(self, spark, tmp_path, max_files=None):
        self.spark, self.root, self.max_files = spark, str(tmp_path), max_files
        self.send([], [])

    def send(self, results, told):
        for rows, schema, name in ((results, RESULT, "in"), (told, TOLD, "told")):
            self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{self.root}/{name}")

    def start(self):
        arrived = jobs.read_stream(self.spark, f"{self.root}/in", RESULT, max_files=self.max_files)
        announced = jobs.read_stream(self.spark, f"{self.root}/told", TOLD)
        return completion.follow_jobs(arrived, announced, f"{self.root}/out", f"{self.root}/state")

    def run(self):
        return drain(completion.settle(self.spark, f"{self.root}/out", self.start))

    def completed(self):
        return sorted(tuple(r) for r in completion.completed_jobs(self.spark, f"{self.root}/out").collect())

    def state_rows(self, query):
        return query.lastProgress["stateOperators"][0]["numRowsTotal"]


def test_completion_in_any_order(spark, tmp_path):
    rng = random.Random(1)
    sizes = {f"j{i}": i + 1 for i in range(8)}
    deliveries = [(job, line) for job, n in sizes.items() for line in range(n)]
    deliveries += rng.sample(deliveries, 12)
    deliveries = [d for d in deliveries if d != ("j7", 7)]
    rng.shuffle(deliveries)
    told = [(job, n) for job, n in sizes.items() if job != "j3"] + [("j1", 2), (None, 4), ("j0", None)]
    stream = Jobs(spark, tmp_path, 1)
    for i in range(4):
        stream.send(deliveries[i::4] + [(None, 1), ("j2", None)], [])
    stream.send([], told[:3])
    stream.run()
    assert stream.completed() == [("j0", 1, 1), ("j1", 2, 2), ("j2", 3, 3)]
    # The other jobs are announced only after all their results came in.
    stream.send([], told[3:])
    query = stream.run()
    assert stream.completed() == [(job, n, n) for job, n in sorted(sizes.items()) if job not in ("j3", "j7")]
    # Of the unfinished jobs one state row each stays.
    assert stream.state_rows(query) == 2


def test_more_lines_than_announced_in_one_batch(spark, tmp_path):
    stream = Jobs(spark, tmp_path)
    stream.send([("a", i) for i in range(7)], [("a", 4), ("b", 2)])
    stream.run()
    assert stream.completed() == [("a", 4, 7)]
    # What comes after the end neither completes the job again nor stays in the state.
    stream.send([("a", i) for i in range(5, 9)] + [("b", 0)], [("a", 4)])
    query = stream.run()
    assert stream.completed() == [("a", 4, 7)] and stream.state_rows(query) == 1
    stream.send([("b", 0), ("b", -5), ("b", 10**17)], [])
    query = stream.run()
    assert stream.completed() == [("a", 4, 7), ("b", 2, 3)] and stream.state_rows(query) == 0


def test_lines_far_apart_share_a_state_row(spark, tmp_path):
    stream = Jobs(spark, tmp_path)
    stream.send([("a", i * 100_000) for i in range(10)], [("a", 11)])
    query = stream.run()
    assert not stream.completed() and stream.state_rows(query) == 1
    stream.send([("a", 7)], [])
    stream.run()
    assert stream.completed() == [("a", 11, 11)]


def test_a_job_over_many_buckets(spark, tmp_path):
    n = 2 * completion.BUCKET_LINES + 5
    stream = Jobs(spark, tmp_path)
    spark.range(n - 1).selectExpr("'big' AS app_id", "id AS line_no").write.mode("append").parquet(f"{stream.root}/in")
    stream.send([("big", 3)] * 50, [("big", n)])
    query = stream.run()
    assert not stream.completed() and stream.state_rows(query) == 3
    stream.send([("big", n - 1), ("big", 7)], [])
    query = stream.run()
    assert stream.completed() == [("big", n, n)] and stream.state_rows(query) == 0


@pytest.mark.parametrize("n", [0, 1, completion.SPARSE - 1, completion.SPARSE, completion.BUCKET_LINES])
def test_line_numbers_are_packed(n):
    lines = np.sort(np.random.default_rng(n).choice(completion.BUCKET_LINES, n, replace=False))
    data = completion._packed(lines)
    assert completion._unpacked(data).tolist() == lines.tolist() and len(data) <= completion.BUCKET_LINES // 8


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    """A micro-batch that failed after its tables were written is run again and replaces them."""
    stream = Jobs(spark, tmp_path)
    stream.send([("a", 0), ("a", 1)], [("a", 2)])

    def fail(done, number):
        raise RuntimeError("lost")

    arrived = jobs.read_stream(spark, f"{stream.root}/in", RESULT)
    announced = jobs.read_stream(spark, f"{stream.root}/told", TOLD)
    broken = completion.follow_jobs(arrived, announced, f"{stream.root}/out", f"{stream.root}/state", fail)
    with pytest.raises(Exception, match="lost"):
        broken.awaitTermination(120)
    stream.run()
    assert stream.completed() == [("a", 2, 2)]


def test_summaries_of_task_files(spark, tmp_path):
    tasks, out = tmp_path / "tasks", str(tmp_path / "out")
    tasks.mkdir()
    docs = spark.createDataFrame([("http://x/a", 200, "application/pdf", "A"), ("http://x/b", 200, "application/pdf", "B")], "url string, http_status int, content_type string, body string")

    def run():
        arrived = jobs.read_task_stream(spark, str(tasks), 1)
        drain(jobs.convert_task_files(arrived, docs, out, str(tmp_path / "c1")))
        drain(completion.settle(spark, f"{out}/jobs", lambda: jobs.summarise_jobs(spark, out, str(tmp_path / "c2"))))
        return sorted(tuple(r) for r in jobs.read_summaries(spark, out).collect())

    (tasks / "j1.txt").write_text("ToText\thttp://x/b\nToHTML\thttp://x/a\nToText\thttp://x/gone\n")
    first = run()
    assert [(a, p) for a, p, _ in first] == [("j1", 1), ("j1", 2), ("j1", 3)]
    assert [line.split("\t")[:2] for _, _, line in first] == [["ToText:", "http://x/b"], ["ToHTML:", "http://x/a"], ["ToText:", "http://x/gone"]]
    (tasks / "j2.txt").write_text("ToText\thttp://x/a\n")
    second = run()
    assert second[:3] == first and [(a, p) for a, p, _ in second[3:]] == [("j2", 1)]
    # A result delivered again and a run without news change nothing.
    spark.createDataFrame([(0, "again", "j1")], "line_no bigint, line string, app_id string").write.mode("append").partitionBy("app_id").parquet(f"{out}/lines/batch=99")
    assert run() == second


def test_bounded_dedupe(spark, tmp_path):
    source, out, state = (str(tmp_path / name) for name in ("r", "d", "dc"))

    def send(rows):
        spark.createDataFrame(rows, "app_id string, line_no bigint, at string").selectExpr("app_id", "line_no", "timestamp(at) AS at").write.mode("append").parquet(source)
        results = jobs.read_stream(spark, source, "app_id string, line_no bigint, at timestamp")
        sink = jobs.dedupe_stream(results, "at").writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
        return drain(sink.trigger(availableNow=True).start())

    send([("1", i % 3, f"2024-01-01 00:0{i}:00") for i in range(9)])
    assert spark.read.parquet(out).count() == 3
    # Within the horizon a line is known, beyond it its state is given up and it counts again.
    send([("1", 0, "2024-01-01 00:30:00")])
    assert spark.read.parquet(out).count() == 3
    send([("1", 9, "2024-01-01 12:00:00")])
    query = send([("1", 0, "2024-01-01 12:30:00")])
    assert spark.read.parquet(out).filter("line_no = 0").count() == 2
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] == 2


def test_task_stream(spark, tmp_path):
    (tmp_path / "tasks").mkdir()
    (tmp_path / "tasks" / "j1.txt").write_text("ToText\thttp://x/a\nToHTML\thttp://x/b\n")
    stream = jobs.read_task_stream(spark, str(tmp_path / "tasks")).select("app_id", "op", "url")
    sink = stream.writeStream.format("parquet").option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "c"))
    drain(sink.trigger(availableNow=True).start())
    assert sorted(tuple(r) for r in spark.read.parquet(str(tmp_path / "o")).collect()) == [("j1", "ToHTML", "http://x/b"), ("j1", "ToText", "http://x/a")]
