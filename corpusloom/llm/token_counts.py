"""Token counts of the sections of documents, by the places of the tokens of whole texts.

A document is encoded once, as a whole. Tokens cover its UTF-8 bytes without gaps, so
their byte spans come from their lengths and their character spans from those. The
sorted spans are joined with the sorted bounds of the sections, and a token that
crosses a bound is allocated by an explicit rule.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# The splitting pattern that belongs to these ranks.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RULES = ("first", "most", "each")
# White space of the pattern, in runs that its engine cannot take whole.
_SPACES = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
LONG_SPACE = re.compile("[" + "".join(map(chr, _SPACES)) + "]{5000,}")


def read_ranks(path: str = RANKS) -> bytes:
    with open(path, "rb") as file:
        return file.read()


class Encoder:
    def __init__(self, ranks: bytes):
        import tiktoken

        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines())}
        self.encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})
        self.length = np.zeros(max(table.values()) + 1, dtype=np.int64)
        self.length[list(table.values())] = [len(t) for t in table]

    def ids(self, text: str) -> list[int]:
        """Tokens of the whole text.

        A very long run of white space is one piece of the pattern (without its last
        character if more text follows) and is encoded as that piece.
        """
        out, at = [], 0
        for run in LONG_SPACE.finditer(text):
            end = run.end() - (run.end() < len(text))
            out += self.encoding.encode_ordinary(text[at : run.start()])
            out += self.encoding._encode_single_piece(text[run.start() : end])
            at = end
        return out + self.encoding.encode_ordinary(text[at:])

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First and last character of every token; a character whose bytes lie in several tokens belongs to each."""
        ends = np.cumsum(self.length[self.ids(text)])
        if not len(ends):
            return ends, ends
        raw = np.frombuffer(text.encode(), dtype=np.uint8)
        if len(raw) == len(text):
            return np.concatenate([[0], ends[:-1]]), ends - 1
        char = np.cumsum((raw & 0xC0) != 0x80) - 1
        return char[np.concatenate([[0], ends[:-1]])], char[ends - 1]


def allocate(first: np.ndarray, last: np.ndarray, starts: np.ndarray, rule: str) -> np.ndarray:
    """Tokens of each section; sections begin at ``starts`` (sorted, the first at 0) and reach to the next.

    first: a token goes to the section of its first character. most: to the one that
    holds most of its characters, the earlier of equal ones. each: every section that
    it touches counts it.
    """
    a = np.searchsorted(starts, first, side="right") - 1
    b = np.searchsorted(starts, last, side="right") - 1
    n = len(starts)
    if rule == "first":
        return np.bincount(a, minlength=n)
    if rule == "each":
        steps = np.bincount(a, minlength=n + 1) - np.bincount(b + 1, minlength=n + 1)
        return np.cumsum(steps)[:n]
    counts = np.bincount(a[a == b], minlength=n)
    bounds = np.append(starts, np.iinfo(np.int64).max)
    for i in np.flatnonzero(a != b):
        inside = [min(last[i] + 1, bounds[s + 1]) - max(first[i], bounds[s]) for s in range(a[i], b[i] + 1)]
        counts[a[i] + int(np.argmax(inside))] += 1
    return counts


def line_starts(text: str) -> np.ndarray:
    """First characters of the lines; the line feed belongs to the line that it ends."""
    starts = [0]
    at = text.find("\n")
    while at >= 0 and at + 1 < len(text):
        starts.append(at + 1)
        at = text.find("\n", at + 1)
    return np.array(starts, dtype=np.int64)


def _counter(known, rule: str, fields: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(known.value)
        for batch in batches:
            counts, chars = [], []
            for row in range(batch.num_rows):
                if fields:
                    parts = [batch.column(f"_f{i}")[row].as_py() or "" for i in range(fields)]
                    text, starts = "".join(parts), np.cumsum([0, *map(len, parts[:-1])])
                else:
                    text = batch.column("_text")[row].as_py() or ""
                    starts = line_starts(text)
                first, last = encoder.spans(text)
                counts.append(allocate(first, last, starts, rule))
                chars.append(np.diff(np.append(starts, len(text))))
            kept = [c for c in batch.schema.names if not c.startswith("_f") and c != "_text"]
            columns = [batch.column(c) for c in kept]
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (counts, chars)]
            yield pa.RecordBatch.from_arrays([*columns, *lists], [*kept, "_tokens", "_chars"])

    return count


def _sections(rows: DataFrame, rule: str, ranks: str, fields: int, keep: list[str]) -> DataFrame:
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    known = rows.sparkSession.sparkContext.broadcast(read_ranks(ranks))
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", _tokens array<long>, _chars array<long>"
    counted = rows.mapInArrow(_counter(known, rule, fields), schema)
    return counted.select(*keep, F.posexplode(F.arrays_zip("_tokens", "_chars")).alias("section", "_n")).select(
        *keep, "section", F.col("_n._tokens").alias("n_tokens"), F.col("_n._chars").alias("n_chars")
    )


def tokens_by_line(docs: DataFrame, rule: str = "first", ranks: str = RANKS) -> DataFrame:
    """(doc_id, section, n_tokens, n_chars): a row per line of every whole text, numbered from 0.

    Every row of ``docs`` has one section at least: a null or empty text has one without
    tokens. Under the rules ``first`` and ``most`` the counts of a document sum to the
    tokens of the whole text. A final line feed begins no further line.
    """
    rows = docs.select("doc_id", F.col("text").alias("_text"))
    return _sections(rows, rule, ranks, 0, ["doc_id"])


def tokens_by_field(docs: DataFrame, fields: list[str], rule: str = "first", ranks: str = RANKS) -> DataFrame:
    """(doc_id, section, n_tokens, n_chars): the joined ``fields`` are encoded as one text; section is a field's place.

    A null field is empty. An empty field has no tokens; where several fields begin at
    one character, the last of them holds it.
    """
    rows = docs.select("doc_id", *[F.col(c).cast("string").alias(f"_f{i}") for i, c in enumerate(fields)])
    return _sections(rows, rule, ranks, len(fields), ["doc_id"])
