"""The mix against filling targets by rounds and walking every source's documents in order."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest

from corpusloom.llm import mixing

WORDS = re.compile("[^\x20\x09-\x0d]+")


def brute_targets(words, weights, share=1.5, most=2):
    """Deal by weight, cap, deal the excess again until nobody is above."""
    open_, target, left = {s for s in words if weights.get(s)}, dict.fromkeys(words, 0.0), share * sum(words.values())
    while open_ and left > 1e-9:
        total = sum(weights[s] for s in open_)
        offer = {s: left * weights[s] / total for s in open_}
        full = {s for s in open_ if offer[s] >= most * words[s]}
        for s in full or open_:
            target[s] = float(most * words[s]) if full else offer[s]
            left -= target[s]
        open_ -= full or open_
    return target


def brute_mix(rows, weights, seed="mix", share=1.5, most=2):
    size = lambda t: len(WORDS.findall(t or ""))
    words = defaultdict(int)
    for _, source, text in rows:
        words[source] += size(text)
    target = brute_targets(words, weights, share, most)
    order = defaultdict(list)
    for row in rows:
        i, source, text = row
        whole = "\n".join([seed, "" if i is None else str(i), text or ""])
        order[source].append((hashlib.md5(whole.encode()).hexdigest()[:15], row))
    out = Counter()
    for source, held in order.items():
        budget, taken = int(target[source] + 1e-9), Counter()
        for key in sorted({k for k, _ in held}) * most:
            group = [r for k, r in held if k == key]
            all_ = sum(size(t) for *_, t in group)
            left = min(budget, all_)
            budget -= left
            for n, r in enumerate(group):
                taken[(key, n, r)] += size(r[2]) * left // all_ if all_ else 0
        for (_, _, (i, s, t)), n in taken.items():
            out[(i, s, size(t), words[s], round(target[s], 6), n)] += 1
    return out


def corpus(rng, sources=7, docs=120):
    rows = [(None, "s0", "row without an id"), (None, None, None), (1, None, "a b c"), (2, "s1", ""), (3, "s1", " \n"), (4, "", "empty name")]
    rows += [(5, "copies", "five words in each copy")] * 9 + [(6, "silent", None)]
    rows += [(i, f"s{int(rng.random() ** 2 * sources)}", "w " * rng.choice([0, 1, 3, 10, 40])) for i in range(10, 10 + docs)]
    return rows + [(9, "s0", "long " * 30_000)]


def frame(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "k", 2.0) for r in rows], "doc_id long, source string, text string, size int, key string, target double")
    return docs.repartition(3)


def turn(rows, weights=(3, 1, 2)):
    names = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, (s or "").encode()))
    return {s: weights[i % 3] for i, s in enumerate(names)}


def collected(df):
    return Counter((r.doc_id, r.source, r["size"], r.source_size, round(r.target, 6), r.taken) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_mix(spark, seed):
    rows = corpus(random.Random(seed))
    docs = frame(spark, rows)
    got = collected(mixing.mix(docs))
    assert got == brute_mix(rows, turn(rows))
    assert got == collected(mixing.mix(docs.repartition(5, "doc_id")))
    lost = defaultdict(float)
    for (_, s, size, _, target, taken), n in got.items():
        assert 0 <= taken <= 2 * size
        lost[s] += n * taken - target / sum(c for k, c in got.items() if k[1] == s) * n
    assert all(-9 <= x <= 0.001 for x in lost.values())


def test_given_weights_and_shares(spark):
    rows = corpus(random.Random(5))
    given = {"s0": 0.5, "s1": 2.0, "s2": 0.0, "copies": 1.0, None: 1.0}
    table = spark.createDataFrame([(s, w) for s, w in given.items()] + [("nowhere", 3.0), ("s3", None)], "source string, weight double")
    docs = frame(spark, rows)
    for share, most in ((0.25, 1), (0.9, 3)):
        got = collected(mixing.mix(docs, table, share=share, most=most, seed="other"))
        assert got == brute_mix(rows, given, "other", share, most)


def test_table_of_cuts_too_large_to_send(spark, monkeypatch):
    rows = corpus(random.Random(6))
    monkeypatch.setattr(mixing, "SENT_BYTES", 0)
    assert collected(mixing.mix(frame(spark, rows))) == brute_mix(rows, turn(rows))


def test_empty_and_silent(spark):
    docs = frame(spark, corpus(random.Random(1)))
    assert mixing.mix(docs.limit(0)).count() == 0
    silent = frame(spark, [(1, "a", None), (2, "b", " ")])
    assert sorted((r.doc_id, r.target, r.taken) for r in mixing.mix(silent).collect()) == [(1, 0.0, 0), (2, 0.0, 0)]


def test_epochs(spark):
    rows = corpus(random.Random(3))
    want = Counter()
    for (i, s, _, _, _, taken), n in brute_mix(rows, turn(rows)).items():
        want[(i, s)] += n * taken
    got, text = Counter(), {(i, s): t for i, s, t in rows}
    for r in mixing.epochs(frame(spark, rows)).collect():
        words = WORDS.findall(r.text)
        got[(r.doc_id, r.source)] += len(words)
        if i := r.doc_id:
            assert words == WORDS.findall(text[(i, r.source)])[: len(words)]
    assert +got == +want


def test_prefix_sums(spark):
    rng = random.Random(2)
    rows = [(rng.choice("aaaaab"), k, rng.randint(0, 9)) for k in rng.sample(range(10_000), 600)]
    got = mixing.prefix_sums(spark.createDataFrame(rows, "g string, k long, v long"), ["g"], ["k"], ["v"])
    assert {(r.g, r.k): r.v_before for r in got.collect()} == {(g, k): sum(v for h, j, v in rows if h == g and j < k) for g, k, _ in rows}
