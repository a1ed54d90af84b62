"""Periodic runs against comparing every word with those behind it."""

import random
import re

import numpy as np
import pytest

from corpusloom.llm import periodic

SPACE = re.compile("[\x20\x09-\x0d]+")


def brute_runs(words, least_length=6, least_exponent=4):
    found = {}
    for period in range(1, len(words) // least_exponent + 1):
        i = 0
        while i + period < len(words):
            start = i
            while i + period < len(words) and words[i] == words[i + period]:
                i += 1
            length = i - start + period
            if i > start and length >= max(least_length, least_exponent * period):
                found.setdefault((start, length), period)  # periods rise, so the smallest stays
            i += i == start
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic_words(rng, n, letters):
    words = [rng.randint(1, letters) for _ in range(n)]
    if n and rng.random() < 0.6:
        a, p = rng.randrange(n), rng.randint(1, 7)
        words = [words[i] if i < a else words[a + (i - a) % min(p, n - a)] for i in range(n)]
    return words


@pytest.mark.parametrize("length,exponent", [(6, 4), (6, 2), (2, 2), (12, 3)])
def test_runs_of_arrays(length, exponent):
    rng = random.Random(length)
    for _ in range(300):
        texts = [periodic_words(rng, rng.randint(0, 45), rng.choice([1, 2, 3, 6])) for _ in range(rng.randint(1, 4))]
        got = periodic.runs_of([np.array(t, np.int64) for t in texts], length, exponent)
        assert got == [brute_runs(t, length, exponent) for t in texts]
    assert periodic.runs_of([]) == [] and periodic.runs_of([np.zeros(0, np.int64)]) == [[]]


def test_positions_stay_in_order():
    rng = random.Random(4)
    held, want = periodic.Positions(5000), [5000]
    for x in rng.sample(range(5000), 3000) + [6000, 7000]:
        before, after = held.insert(x)
        assert before == max((w for w in want if w < x), default=None) and after == min((w for w in want if w > x), default=None)
        want.append(x)
    assert list(held) == sorted(want) and len(held.blocks) > 1


def test_find_runs(spark):
    rng = random.Random(9)
    rows = [(None, "a b a b a b a b"), (1, None), (1, ""), (2, " \t\n"), (2, " \t\n"), (3, "x " * 30), (3, "x " * 30), (4, "one")]
    rows += [(5, "w " * 60_000 + "end"), (6, "é\x0b" * 9 + " é é é"), (7, " ".join(f"t{i % 11}" for i in range(50_000)))]
    rows += [(10 + i, "".join(f"w{x}{rng.choice([' ', chr(10), '  '])}" for x in periodic_words(rng, rng.randint(0, 60), 3))) for i in range(80)]
    docs = spark.createDataFrame([(i, t, 1, [2], "c") for i, t in rows], "doc_id long, text string, n_words int, runs array<int>, collapsed string")
    found = periodic.find_runs(docs.repartition(3))
    top = periodic.longest_run("runs")
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed, tuple(r.top), r.lines) for r in found.select("*", top.alias("top"), periodic.runs_text(found.runs).alias("lines")).collect()]
    want = []
    for i, text in rows:
        words = [w for w in SPACE.split(text or "") if w]
        # The long ones are one run each, which needs no search.
        runs = [(0, 60_000, 1)] if i == 5 else [(0, 50_000, 11)] if i == 7 else brute_runs(words)
        best = min(((-n, s, q) for s, n, q in runs), default=None)
        want.append((i, len(words), runs, brute_collapse(words, runs), (best[1], -best[0], best[2]) if best else (None,) * 3, "".join(f"{s},{n},{q}\n" for s, n, q in runs)))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert periodic.find_runs(docs.limit(0)).count() == 0
    # Another block size gives the same runs.
    held, periodic.BLOCK_WORDS = periodic.BLOCK_WORDS, 1
    try:
        assert sorted((r.doc_id is None, r.doc_id or 0, r.n_words, r.collapsed) for r in periodic.find_runs(docs).collect()) == sorted((i is None, i or 0, n, c) for i, n, _, c, _, _ in want)
    finally:
        periodic.BLOCK_WORDS = held


def test_parameters():
    assert periodic.least_prefix(6, 4) == 5 and periodic.least_prefix(2, 2) == 1
    with pytest.raises(ValueError):
        periodic.find_runs(None, least_exponent=1)
