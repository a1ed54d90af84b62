import pytest
from pyspark.sql import functions as F

from corpusloom.functions.reports import report_class, report_line, to_html, to_text, url_object_key
from corpusloom.operators import tasks
from corpusloom.sizing import target_partitions
from corpusloom.sources import corpus, documents, matrices

DOCS = "url string, http_status int, content_type string, body string"
TASKS = "app_id string, line_no bigint, op string, url string"


@pytest.fixture
def results(spark):
    todo = [
        ("1", 0, "ToHTML", "http://x/a"),
        ("1", 1, "ToText", "http://x/error-page"),
        ("1", 2, "ToPdf", "http://x/a"),
        ("1", 3, "ToText", "http://x/gone"),
        ("1", 4, "ToText", "http://x/404"),
        ("1", 5, "ToText", "http://x/html"),
        ("2", 0, "ToImage", "http://x/a"),
    ]
    docs = [
        ("http://x/a", 200, "application/pdf", "1 < 2 & 3\fsecond page"),
        ("http://x/error-page", 200, "application/pdf", "boom"),
        ("http://x/404", 404, "application/pdf", "x"),
        ("http://x/html", 200, None, "x"),
    ]
    return lambda converters=None: tasks.convert_tasks(
        spark.createDataFrame(todo, TASKS), spark.createDataFrame(docs, DOCS), converters
    )


def test_conversion_and_errors(results):
    got = {(r.app_id, r.line_no): r for r in results().collect()}
    assert got["1", 0].output == "<html><body><pre>1 &lt; 2 &amp; 3</pre></body></html>"
    assert (got["1", 1].status, got["1", 1].output) == ("success", "boom")
    assert got["1", 2].error == "Unsupported operation: ToPdf"
    assert got["1", 3].error == "Failed to download PDF from URL: http://x/gone"
    assert got["1", 4].cause == "Failed to connect, HTTP response code: 404"
    assert got["1", 5].cause == "Error: Unexpected content type: null"
    assert got["2", 0].status == "error" and got["2", 0].output is None


def test_failing_converter_is_an_error_row(results):
    def image(body):
        if "second" in body:
            raise ValueError("no page to draw")
        return "png"

    got = {(r.app_id, r.line_no): r for r in results({"ToImage": image, "ToText": str.upper}).collect()}
    assert (got["2", 0].status, got["2", 0].error) == ("error", "no page to draw")
    assert got["1", 1].output == "BOOM"
    assert got["1", 0].status == "success"


def test_report_class_goes_by_words(spark, results):
    lines = tasks.result_lines(results())
    shown = {r.line_no: r for r in lines.withColumn("c", report_class(F.col("line"))).filter("app_id = '1'").collect()}
    assert shown[2].status == "error" and shown[2].c == "success"
    assert shown[3].c == "error" and shown[0].c == "success"
    odd = spark.createDataFrame([("a\tb\tan ERROR",), ("a\tb",), ("a\tb\tc\td",), ("a\tb\tc\t",)], "line string")
    got = odd.select(report_class(F.col("line")).alias("c"), report_line(F.col("line")).alias("p")).collect()
    assert [r.c for r in got] == ["error", "plain", "plain", "success"]
    assert got[1].p == "<p>a\tb</p>" and got[3].p == "<p class='success'>a\tb\tc</p>"


def test_delivered_twice_and_unknown_jobs(spark, rows):
    delivered = spark.createDataFrame(
        [("1", 0, "first", 1), ("1", 0, "again", 2), ("1", 1, "x", 1), ("9", 0, "x", 1), ("2", 0, "x", 1)],
        "app_id string, line_no bigint, op string, arrival int",
    )
    expected = spark.createDataFrame([("1", 2), ("2", 2), ("3", 1)], "app_id string, expected bigint")
    assert rows(tasks.completed_jobs(delivered, expected)) == [("1", 2, 2)]
    assert rows(tasks.job_progress(delivered, expected)) == [("1", 2, 2, True), ("2", 2, 1, False), ("3", 1, 0, False)]
    assert ("1", 0, "first", 1) in rows(tasks.dedupe_results(delivered, "arrival"))
    assert tasks.dedupe_results(delivered).count() == 4


def test_submissions(spark, rows):
    mail = spark.createDataFrame(
        [(2, "j1\tu2\t5"), (1, "j1\tu1\t3"), (3, "j2\tstop"), (4, "j3\tu3\tmany")], "message_no bigint, body string"
    )
    assert sorted(map(str, rows(tasks.submissions(mail)))) == ["('j1', 'u1', 3)", "('j3', 'u3', None)"]
    assert rows(tasks.stop_requests(mail)) == [(3, "j2\tstop")]


def test_partition_target():
    assert [target_partitions(n, 10) for n in (0, 1, 10, 11, 80, 1500)] == [0, 1, 1, 2, 8, 8]


def test_text_functions(spark):
    df = spark.createDataFrame([("a&b<c>\fnext", "http://h/p/q.txt?x=1#y"), ("", "http://h")], "t string, u string")
    got = df.select(to_text(F.col("t")).alias("t"), to_html(F.col("t")).alias("h"), url_object_key(F.col("u")).alias("k")).collect()
    assert (got[0].t, got[0].k) == ("a&b<c>", "p/q.txt")
    assert got[0].h == "<html><body><pre>a&amp;b&lt;c&gt;</pre></body></html>"
    assert (got[1].t, got[1].k) == ("", "")


def test_task_files_and_summaries(spark, tmp_path, results):
    folder = tmp_path / "tasks"
    folder.mkdir()
    (folder / "job7.txt").write_text("".join(f"ToText\thttp://x/{i}\n" for i in range(500)))
    (folder / "job8.txt").write_text("ToHTML\thttp://x/a\n")
    conf = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "1000")
    try:
        got = documents.read_tasks(spark, str(folder)).collect()
    finally:
        spark.conf.set(conf, before)
    seven = {r.line_no: r.url for r in got if r.app_id == "job7"}
    assert seven == {i: f"http://x/{i}" for i in range(500)} and len(got) == 501

    lines = tasks.result_lines(results())
    documents.write_summary(lines, str(tmp_path / "summary"))
    parts = sorted((tmp_path / "summary" / "app_id=1").glob("part-*"))
    text = "".join(p.read_text() for p in parts).splitlines()
    assert text == [r.line for r in lines.filter("app_id = '1'").orderBy("line_no").collect()]

    documents.write_ordered_text(tasks.render_report(lines), str(tmp_path / "report"))
    page = "".join(p.read_text() for p in sorted((tmp_path / "report" / "app_id=2").glob("part-*")))
    assert page.startswith("<html>\n<head>\n<title>Summary File</title>") and page.endswith("</body>\n</html>\n")

    documents.write_outputs(results(), str(tmp_path / "out"))
    assert (tmp_path / "out" / "app_id=1" / "op=ToHTML").is_dir()


def test_landed_files(spark, tmp_path):
    (tmp_path / "a.pdf").write_bytes(b"%PDF 1")
    (tmp_path / "b.bin").write_bytes(b"x")
    docs = documents.documents_by_url(documents.read_landed_files(spark, str(tmp_path)))
    got = {r.url.rsplit("/", 1)[1]: r for r in docs.collect()}
    assert got["a.pdf"].content_type == "application/pdf" and bytes(got["a.pdf"].body) == b"%PDF 1"
    todo = spark.createDataFrame([("1", 0, "ToImage", got["a.pdf"].url), ("1", 1, "ToImage", got["b.bin"].url)], TASKS)
    done = tasks.convert_tasks(todo, docs, {"ToImage": lambda body: f"{len(body)} bytes"}).collect()
    assert {r.line_no: (r.status, r.output) for r in done} == {0: ("success", "6 bytes"), 1: ("error", None)}


def test_corpus_readers(spark, tmp_path, rows):
    lines = ["a b c\t1999\t5\t1", "bad", "d e f\t2000\t7\t1"]
    pairs = spark.sparkContext.parallelize(list(enumerate(lines)))
    pairs.saveAsSequenceFile(str(tmp_path / "seq"))
    (tmp_path / "n.txt").write_text("\n".join(lines))
    want = [("a", "b", "c", 1999, 5), ("d", "e", "f", 2000, 7)]
    assert rows(corpus.read_ngrams(spark, str(tmp_path / "seq"), "sequence")) == want
    assert rows(corpus.read_ngrams(spark, str(tmp_path / "n.txt"), "text")) == want
    corpus.read_ngrams(spark, str(tmp_path / "n.txt"), "text").write.parquet(str(tmp_path / "n.parquet"))
    assert rows(corpus.read_ngrams(spark, str(tmp_path / "n.parquet"))) == want

    for i in range(4):
        (tmp_path / f"arcs.{i}.txt").write_text(f"h\ta/X/n/2 b/X/R/0\t{i + 1}\n")
    shards = corpus.numbered_shards(str(tmp_path / "arcs.{}.txt"), range(4))
    kept = corpus.select_input_files(shards, lambda p: not p.endswith("2.txt"))
    assert sorted(r.cnt for r in corpus.read_arc_lines(spark, kept).collect()) == [1, 2, 4]

    (tmp_path / "vocab.txt").write_text(" cat \ndog\ncat\n")
    assert rows(corpus.read_vocabulary(spark, str(tmp_path / "vocab.txt"))) == [("cat",), ("dog",)]
    (tmp_path / "gold.txt").write_text("cat\tdog\tTrue\nshort\nb\ta\tFalse\n")
    assert rows(corpus.read_gold_pairs(spark, str(tmp_path / "gold.txt"))) == [("b", "a", "False", 2), ("cat", "dog", "True", 0)]


def test_ranked_text_and_vectors(spark, tmp_path, rows):
    scored = spark.createDataFrame(
        [("b", "c", "x", 0.25), ("a", "b", "y", 0.5), ("a", "b", "x", 0.75)], "w1 string, w2 string, w3 string, prob double"
    )
    matrices.write_ranked_text(scored, str(tmp_path / "ranked"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "ranked").glob("part-*")))
    assert text == "a b x\t0.75\na b y\t0.5\nb c x\t0.25\n"
    got = matrices.read_ranked_text(spark, str(tmp_path / "ranked")).orderBy("place").collect()
    assert [tuple(r) for r in got] == [(0, "a b x", 0.75), (1, "a b y", 0.5), (2, "b c x", 0.25)]
    vectors = spark.createDataFrame([("w,1", 5, [0.0, 1.5, -2.0])], "lexeme string, eq int, vector array<double>")
    for fmt in ("text", "parquet"):
        matrices.write_vectors(vectors, str(tmp_path / fmt), fmt)
        assert [tuple(r) for r in matrices.read_vectors(spark, str(tmp_path / fmt), fmt).collect()] == [("w,1", 5, [0.0, 1.5, -2.0])]


def test_lines_in_the_order_of_files(spark, tmp_path):
    """Parts come by number and lines by place, also where a file is read in many splits; texts are told apart by folder."""
    want = {}
    for text, parts in (("a", {9: 400, 10: 3, 100000: 250, 2: 0}), ("b", {0: 5})):
        (tmp_path / f"of={text}").mkdir()
        want[text] = [f"{text}-{part}-{i}" for part in sorted(parts) for i in range(parts[part])]
        for part, n in parts.items():
            (tmp_path / f"of={text}" / f"part-{part:05d}-x.txt").write_text("".join(f"{text}-{part}-{i}\n" for i in range(n)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        got = corpus.read_ordered_lines(spark, str(tmp_path), "/of=([^/]+)/").collect()
        whole = corpus.read_ordered_lines(spark, str(tmp_path / "of=a")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {(r.of, r.place): r.value for r in got} == {(t, i): v for t, lines in want.items() for i, v in enumerate(lines)}
    assert [r.value for r in sorted(whole, key=lambda r: r.place)] == want["a"]


def test_named_files_need_no_folder_or_commit_each(spark, tmp_path):
    data = [(f"page_id={i}", f"<p>{i}\n</p>") for i in range(3000)] + [("page_id=7", "again"), ("page_id=9000", None), (None, "nowhere")]
    documents.write_named_files(spark.createDataFrame(data, "name string, value string"), f"file://{tmp_path}/landed")
    folders, files = list((tmp_path / "landed").iterdir()), {f.name: f.read_text() for f in (tmp_path / "landed").glob("*/*")}
    assert len(folders) <= 1000 and len(files) == 3001
    assert sorted(files["page_id=7"].split("\n")) == ["", "</p>", "<p>7", "again"]
    assert files["page_id=8"] == "<p>8\n</p>\n" and files["page_id=9000"] == "\n"
    found = documents.newest_landed_files(spark, f"file://{tmp_path}/landed", "/page_id=([0-9]+)$").collect()
    assert {r.url: bytes(r.body).decode() for r in found} == {name[8:]: body for name, body in files.items()}
