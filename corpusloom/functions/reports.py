"""Conversions of landed text and the lines of a job report."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusloom.functions.text import fields

# The frame of a report page.
REPORT_HEAD = """<html>
<head>
<title>Summary File</title>
<style>
    body { font-family: Arial, sans-serif; margin: 20px; }
    h1 { color: #333333; }
    p { color: #555555; }
    .error { color: red; }
    .success { color: green; }
</style>
</head>
<body>
<h1>Summary of the File</h1>"""
REPORT_FOOT = "</body>\n</html>"


def to_text(text: Column) -> Column:
    """Text of the first page; pages are separated by form feeds."""
    return F.get(F.split(text, "\f"), F.lit(0))


def to_html(text: Column) -> Column:
    """The first page as preformatted HTML."""
    page = to_text(text)
    for mark, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        page = F.replace(page, F.lit(mark), F.lit(entity))
    return F.concat(F.lit("<html><body><pre>"), page, F.lit("</pre></body></html>"))


def result_line(op: Column, url: Column, out: Column) -> Column:
    """`op: <tab> url <tab> link or error`."""
    return F.concat_ws("\t", F.concat(op, F.lit(":")), url, out)


def report_class(line: Column) -> Column:
    """How a result line is shown: error, success, or plain if it has not three fields.

    The class goes by the words of the third field, so it can differ from the
    result's status: an error that says neither "error" nor "failed" counts as
    success, and a link that says so as error.
    """
    f = fields(line)
    third = F.lower(F.get(f, F.lit(2)))
    return (
        F.when(F.size(f) != 3, "plain")
        .when(third.contains("error") | third.contains("failed"), "error")
        .otherwise("success")
    )


def report_line(line: Column) -> Column:
    """A result line as a paragraph of its class."""
    kind = report_class(line)
    return (
        F.when(kind == "plain", F.concat(F.lit("<p>"), line, F.lit("</p>")))
        .otherwise(F.concat(F.lit("<p class='"), kind, F.lit("'>"), F.array_join(fields(line), "\t"), F.lit("</p>")))
    )


def url_object_key(url: Column) -> Column:
    """Path of a URL without its leading slash, percent escapes decoded; a bad escape leaves the path as it is."""
    path = F.substring(F.try_parse_url(url, F.lit("PATH")), 2, 2_147_483_647)
    # A plus sign of a path is no space.
    return F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)
