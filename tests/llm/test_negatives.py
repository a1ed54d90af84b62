"""Hard negatives against scoring every pair with Python's integers."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import negatives

LONG = "vec_id long, embedding array<double>, label int, id string, v int, grp int, kind string, rank int"


def brute(rows, every=50, k=5, m=3):
    def taken(i, v, label):
        return i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)

    rows = [(i, [max(min(math.floor(256 * x), 2**63 - 1), -(2**63)) for x in v], label) for i, v, label in rows if taken(i, v, label)]
    out, anchors = Counter(), {}
    for i, v, label in rows:
        if i % every == 0:
            anchors[i] = min(anchors.get(i, (label, v)), (label, v))
    for a, (label, v) in anchors.items():
        scored = []
        for i, w, other in rows:
            score = sum(x * y for x, y in zip(v, w, strict=True)) if len(v) == len(w) else None
            if i != a and score is not None and -(2**63) < score < 2**63:
                scored.append((-score, i, other))
        scored.sort()
        for p, i, _ in [s for s in scored if s[2] == label][:k]:
            fits = [s for s in scored if s[2] != label and 50 * -p <= 100 * -s[0] <= 95 * -p][:m]
            for rank, (n, j, _) in enumerate(fits, 1):
                out[(a, i, rank, j, -p, -n)] += 1
    return out


def found(spark, rows, **options):
    vectors = spark.createDataFrame([(*r, "x", 1, 2, "y", 3) for r in rows], LONG).repartition(3)
    return Counter(map(tuple, negatives.hard_negatives(negatives.integer_vectors(vectors, F.col("label")), **options).collect()))


def vectors(rng, n, dim=5, low=-1.0, high=1.0):
    return [(i, [rng.uniform(low, high) for _ in range(dim)], rng.randrange(4)) for i in range(n)]


def test_hard_negatives(spark):
    rng = random.Random(3)
    rows = vectors(rng, 700, low=-0.3)
    rows += [(i, None, 1) for i in range(50, 400, 50)] + [(900, [1.0, None, 1.0, 1.0, 1.0], 1), (950, [float("nan")] * 5, 2), (951, [float("inf")] * 5, 2)]
    rows += [(1000, [0.1] * 5, None), (None, [1.0] * 5, 1), (1050, [], 1), (1051, [], 2), (1100, [0.5, 0.5], 1), (1101, [0.5, 0.5], 1), (1102, [0.4, 0.4], 2)]
    # Ties, repeated rows, and an anchor's id with two rows.
    rows += [(2000 + i, [0.7] * 5, i % 3) for i in range(60)] + [(2001, [0.7] * 5, 1)] * 8 + [(2050, [0.2] * 5, 0), (2050, [0.9] * 5, 3)]
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows, every=20, most_positives=2, most_negatives=6) == brute(rows, 20, 2, 6)
    assert not found(spark, [])


def test_large_components(spark):
    rng = random.Random(8)
    rows = [(i, [rng.choice([-1, 1]) * 2.0 ** rng.randint(0, 28) + rng.random() for _ in range(3)], i % 2) for i in range(160)]
    rows += [(200 + i, [2.0 ** (40 + i % 30), 1.0, 0.0], i % 2) for i in range(60)] + [(300, [1e300, 0.0, 0.0], 0), (301, [0.001, 0.0, 0.0], 0), (302, [0.004, 0.0, 0.0], 1)]
    assert found(spark, rows, every=10) == brute(rows, 10)


@pytest.mark.parametrize("dim,most", [(1, 3), (64, 300), (130, 200), (1500, 1 << 15), (7, 1 << 28)])
def test_scores_are_exact(dim, most):
    rng = np.random.default_rng(dim)
    a, b = rng.integers(-most, most + 1, (9, dim)), rng.integers(-most, most + 1, (70, dim))
    a[0], b[0], b[1] = most, most, -most  # the greatest and the least score that the bound allows
    got = negatives.scores(negatives.Residues(a), negatives.Residues(b), slice(None), slice(None))
    assert got.tolist() == (a.astype(object) @ b.astype(object).T).tolist()
    primes = negatives.primes_for(dim * most * most)
    assert math.prod(primes) > 2 * dim * most * most >= math.prod(primes[:-1])


def test_scores_beyond_64_bits_take_no_part():
    a, b = np.array([[2**62, 2**62]]), np.array([[4, 4], [1, 0], [-1, 0], [2, -2]])
    got = negatives.scores(negatives.Residues(a), negatives.Residues(b), slice(None), slice(None))
    assert got.tolist() == [[negatives.NONE, 2**62, -(2**62), 0]]


def test_reduction_is_exact():
    for p in negatives.PRIMES[:3]:
        edge = negatives.SLICE * (p // 2) ** 2
        x = np.concatenate([np.arange(-edge, -edge + 400_000), np.arange(edge - 400_000, edge + 1), np.arange(-2000, 2000)])
        want = (x + p // 2) % p - p // 2
        assert (negatives._reduced(x.astype(np.float32), p) == want).all()
    assert negatives.PRIMES[:4] == [251, 241, 239, 233]


def test_windows():
    p = np.array([0, 1, 7, 100, 101, -3, 2**62 + 7])
    low, high = negatives.window(p, (50, 100), (95, 100))
    assert low.tolist() == [-(-int(x) // 2) for x in p] and high.tolist() == [95 * int(x) // 100 for x in p]
