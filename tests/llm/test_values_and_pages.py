"""Pseudonyms of every date in every layout, and pages written in unusual ways."""

import random
from datetime import date, timedelta

import pytest

from corpusloom.llm import decontaminate, html_text, line_dedup, pii

LAYOUTS = ["{y}-{m:02d}-{d:02d}", "{d:02d}/{m:02d}/{y}", "{m:02d}/{d:02d}/{y}", "{d}.{m}.{y}", "{m}-{d}-{y}", "{d:02d}/{m}/{y}", "{d}/{m:02d}/{y}"]


def test_dates_keep_to_their_layout():
    """No two date strings meet, all come back, and each keeps the shape that it had."""
    there, back = pii.Pseudonyms(b"k"), pii.Pseudonyms(b"k", back=True)
    days = [date(1900, 1, 1) + timedelta(i) for i in range(36_525)]
    strings = {layout.format(y=d.year, m=d.month, d=d.day) for layout in LAYOUTS for d in days[::7] + days[:400]}
    image = {}
    for s in strings:
        new = there.day(s)
        assert [len(x) for x in pii.re.split(r"\D", new)] == [len(x) for x in pii.re.split(r"\D", s)]
        assert image.setdefault(new, s) == s
        assert back.day(new) == s


@pytest.mark.parametrize("layout", ["{d}/{m}/{y}", "{m:02d}/{d:02d}/{y}"])
def test_a_layout_is_permuted_as_a_whole(layout):
    there = pii.Pseudonyms(b"k")
    days = (date(2000, 1, 1) + timedelta(i) for i in range(36_525))
    own = {layout.format(y=d.year, m=d.month, d=d.day) for d in days if (d.day > 12 if layout.startswith("{m") else d.day < 10 and d.month < 10)}
    assert {there.day(s) for s in own} == own


def test_secrets_keep_their_class():
    rng, there, back = random.Random(2), pii.Pseudonyms(b"k"), pii.Pseudonyms(b"k", back=True)
    for _ in range(3_000):
        text = "token=" + "".join(rng.choice("abcdef0123") for _ in range(4)) + "".join(rng.choice("0123456789") for _ in range(4))
        for t in (text, text[:-1] + "z", text.replace("token=", "token=g", 1)):
            new = there.replace(t)[0]
            assert back.replace(new)[0] == t


def main_page(i):
    prose = " ".join(f"word{(i * 7 + k) % 50}, thing{k}" for k in range(25)) + "."
    return f"<html><body><nav><a href=/>Home</a> <a href=/x>About us</a></nav><main><h1>Title {i}</h1><p title=it's>{prose}</p><p>Second {prose}</p></main><footer>&copy; Site {i}</footer></body></html>"


def test_pages_without_an_article_element(spark):
    pages = spark.createDataFrame([(i, f"u{i}", main_page(i)) for i in range(50)], "page_id long, url string, html string")
    texts = [r.text for r in html_text.extract(pages, html_text.train(pages)).orderBy("page_id").collect()]
    good = [t for i, t in enumerate(texts) if t.startswith(f"Title {i}\n") and "Second word" in t and "Home" not in t and "Site" not in t]
    assert len(good) >= 45


def test_pages_that_mark_nothing(spark):
    body = "<div class=nav><a href=/>Home</a></div><div id=content><p>{0} is a sentence of prose, with some words in it.</p><p>And another one follows, it is as long.</p></div><div class=footer>&copy; {0}</div>"
    pages = spark.createDataFrame([(i, "u", "<html><body>" + body.format(f"Page {i}") + "</body></html>") for i in range(20)], "page_id long, url string, html string")
    texts = [r.text for r in html_text.extract(pages, html_text.train(pages)).collect()]
    assert sum("sentence of prose" in t and "Home" not in t for t in texts) >= 18


def test_long_pages_teach(spark):
    long = "".join(f"<p>Paragraph {k} has words, and more words than a menu has.</p>" for k in range(600))
    rows = [(i, "u", f"<body><nav><a>Menu {i}</a></nav><article>{long}</article><footer>end {i}</footer></body>") for i in range(3)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for r in html_text.extract(pages, html_text.train(pages)).collect():
        assert r.text.count("\n") == 599 and "Menu" not in r.text


def test_tags_and_references():
    read = lambda html: [b.text for b in html_text.blocks(html)]
    assert read("<p title=it's>one</p><p>two</p>") == ["one", "two"]
    assert read("""<p title="a>b" alt='c>d'>one</p><p title='open>two</p>""") == ["one", "two"]
    assert read("<p title = \"x > y\">one<p 'odd\">two") == ["one", "two"]
    assert read("<p>&am<b>p;</b> &lt;b&gt; &#65;&amp;amp;</p>") == ["&amp; <b> A&amp;"]
    assert html_text.blocks("<div class=\"main text\">x</div>")[0].context[-1] == "boxnamed:text"


def test_leaks_among_columns_of_any_name(spark):
    rows = [(1, "x a b c d e f g h i j y", 5, [1], "k", 2, "row"), (2, "clean words only", 6, None, None, None, None), (None, None, 7, [2], "", 0, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, first array<int>, items string, n_hit int, row string")
    docs = docs.withColumnsRenamed({}).selectExpr("*", "1 AS length", "2 AS before", "3 AS _before")
    bench = spark.createDataFrame([("i1", "A b c d e f g h i j"), ("i2", "nothing of the kind stands anywhere in these few short rows")], "item_id string, text string")
    for block in (1 << 20, 12):
        kept = decontaminate.remove_leaks(docs, bench, block)
        assert kept.columns == docs.columns and sorted(map(str, (r.doc_id for r in kept.collect()))) == ["2", "None"]
        found = {r.doc_id: (r.n_hit, r["items"]) for r in decontaminate.find_leaks(docs, bench, ("doc_id",), block).collect()}
        assert found == {1: (10, ["i1"]), 2: (0, []), None: (0, [])}


def test_lines_of_more_than_255_documents(spark):
    line = "a line that stands in six hundred documents"
    docs = spark.range(600).selectExpr("id AS doc_id", f"'{line}' AS text")
    kept = lambda n: sum(r.text == line for r in line_dedup.dedup_lines(docs, least_docs=n).collect())
    assert (kept(1000), kept(601), kept(600), kept(256)) == (600, 600, 1, 1)


def test_rows_without_ids_keep_their_own_lines(spark):
    """A row loses only lines that it has, whatever other rows share its id or have none."""
    shared = "this line is found in many documents"
    rows = [(None, f"{shared}\nonly here, in row number {i}, at some length") for i in range(300)] + [(7, f"{shared}\nfirst of the sevens is here"), (7, "second of the sevens is here")]
    rows += [(i, shared) for i in range(3)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, row int, gone int").repartition(4)
    got = sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.text) for r in line_dedup.dedup_lines(docs).collect())
    want = [("None", 2, 1, t.split("\n")[1]) for i, t in rows if i is None]
    # Seven is the largest id that holds the line.
    want += [("7", 2, 0, f"{shared}\nfirst of the sevens is here"), ("7", 1, 0, "second of the sevens is here"), *[(str(i), 1, 1, "") for i in range(3)]]
    assert got == sorted(want)
